"""Documents as a table that later scans can split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024
DOCUMENT = "filename string, content string"


def write_documents(
    docs: DataFrame, path: str, split_bytes: int = 128 * MIB, mode: str = "errorifexists"
) -> None:
    """Write ``filename`` and ``content`` as Parquet with row groups well below a split.

    A scan gives a row group to one task, whole, however small the splits are. So a
    table of large row groups has to be dealt out over the network each time it is
    read; this one is read where it lies. ``split_bytes`` is the smallest split that
    it will be read with (``spark.sql.files.maxPartitionBytes``). Row groups are a
    quarter of that, before compression, so that splits come out even; much smaller
    ones would only add to what a reader has to look up. Texts larger than that have a
    row group each.
    """
    group = max(MIB, split_bytes // 4)
    # the writer looks at its size after so many rows; texts can be long
    options = {
        "parquet.block.size": group,
        "parquet.block.size.row.check.min": 1,
        "parquet.block.size.row.check.max": 100,
    }
    writer = docs.select("filename", "content").write.mode(mode)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(path)


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``filename`` and ``content`` of a table of :func:`write_documents`; no shuffle."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(DOCUMENT).parquet(*paths)
