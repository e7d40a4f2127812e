"""How the work is divided: input splits, shuffle partitions, scratch space."""

from __future__ import annotations

from math import ceil
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1024 * 1024
GIB = 1024 * MIB

# Spark's bound (spark.shuffle.sort.bypassMergeThreshold) on the partitions of a shuffle
# that a task writes straight to files; for more of them it holds its rows and sorts them.
STREAMED = 200


def cluster_settings(
    text_bytes: int, cores: int, shuffled_share: float = 0.5
) -> dict[str, str]:
    """Session settings for a job over ``text_bytes`` of stored text.

    Splits: each map task sorts its (word, filename, n) rows to pre-aggregate
    them, so small splits keep that sort in memory; but every split sends a
    piece to every shuffle partition, so many splits make tiny pieces. Splits
    stay at 128 MiB until that would be more than 100,000 tasks, then grow to
    1 GiB, where the sort spills in long sequential runs and pre-aggregation
    removes more.

    Shuffle partitions: 256 MiB each, given the share of the input that is left
    after pre-aggregation (measure it on a sample; it falls as splits grow).
    Beyond 100,000 they grow instead, into a sort that may spill: for every map
    task the driver keeps a bit for each partition, 1.25 GB for 100,000 of both.
    100 TB at the default share makes partitions of about 525 MiB. Adaptive
    execution merges what turns out smaller.
    """
    split = min(GIB, max(128 * MIB, ceil(text_bytes / 100_000)))
    partitions = min(100_000, ceil(text_bytes * shuffled_share / (256 * MIB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(max(cores, partitions)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
    }


def stored_bytes(spark: SparkSession, paths: str | list[str]) -> int:
    """Bytes of the files below the paths, from their metadata alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.load(paths).agg(F.sum("length")).first()[0] or 0


def text_bytes(spark: SparkSession, path: str, content: str) -> int:
    """Bytes of a column's texts, as they are once read."""
    texts = spark.read.parquet(path).select(F.col(content).alias("content"))
    return texts.agg(F.sum(F.octet_length("content"))).first()[0] or 0


def scan_pieces(
    spark: SparkSession, path: str, piece: int = 16 * MIB, content: str | None = None
) -> int:
    """How many partitions to deal a stored table out over: one to a core or more.

    A map task sorts a row for each distinct word of each of its documents, which takes
    about 13 times the bytes of the texts. So the bytes of a partition are bounded, not
    the number of partitions, and a task's memory does not grow with the table. Texts
    that are alike are stored in far fewer bytes than they have; with the name of their
    column, ``content``, theirs count too, for which they are read once more. Pieces grow
    to four times ``piece`` before there are more than can be dealt out without a sort.
    """
    size = stored_bytes(spark, path)
    if content is not None:
        size = max(size, text_bytes(spark, path, content))
    pieces = min(ceil(size / piece), max(STREAMED, ceil(size / (4 * piece))))
    return max(spark.sparkContext.defaultParallelism, pieces)


def dealt_out(rows: DataFrame, pieces: int) -> DataFrame:
    """The rows of a Parquet table, over so many partitions.

    They are dealt out by where they are stored, which no two rows share, whatever they
    hold. Dealing them out in turn instead (``repartition(n)``) has every scan task sort
    its rows, whole texts, before: so that a retry deals alike. A scan task reads at least
    one row group, and its memory would grow with it.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return rows.withColumn("place", place).repartition(pieces, "place").drop("place")


def apply_settings(
    spark: SparkSession, settings: dict[str, str], given: dict[str, str | None] | None = None
) -> dict[str, str]:
    """Set what the session was not started with; ``given`` overrides both."""
    started = spark.sparkContext.getConf()
    chosen = {k: v for k, v in settings.items() if not started.contains(k)}
    chosen |= {k: v for k, v in (given or {}).items() if v is not None}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    return chosen


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that every executor shares.

    That folder is ``spark.checkpoint.dir`` or, where none is set, one below the
    session's warehouse. Nothing here deletes it: it belongs to whoever set it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"
