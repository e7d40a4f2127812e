"""``spark-submit`` entry: JSON lines in, peak lines out."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from termpeak.plans.layout import apply_settings, cluster_settings, stored_bytes
from termpeak.plans.peaks import run_job


def main() -> None:
    parser = argparse.ArgumentParser(prog="termpeak", description=__doc__)
    parser.add_argument("input", nargs="+", help="JSON-lines files or directories")
    parser.add_argument("output", help="directory to write, which must not exist")
    parser.add_argument("--rejects", help="write malformed lines here instead of failing")
    parser.add_argument("--split-bytes", help="bytes of a split, instead of the chosen ones")
    parser.add_argument("--shuffle-partitions", help="instead of the chosen number")
    parser.add_argument("--repartition", type=int, help="deal lines out over so many tasks")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("termpeak").getOrCreate()
    try:
        cores = spark.sparkContext.defaultParallelism
        chosen = apply_settings(
            spark,
            cluster_settings(stored_bytes(spark, args.input), cores),
            {
                "spark.sql.files.maxPartitionBytes": args.split_bytes,
                "spark.sql.shuffle.partitions": args.shuffle_partitions,
            },
        )
        print("settings:", json.dumps(chosen))
        run_job(spark, args.input, args.output, args.rejects, args.repartition)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
