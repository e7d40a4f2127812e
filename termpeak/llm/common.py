"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termpeak.plans.layout import scratch_path

# Rows, and bytes, that a Python worker is sent at a time by jobs in small_batches().
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20

# Bytes of UTF-8 text with A-Z lower-cased; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# As LOWER, with every ASCII byte that is no letter or digit made a space.
WORD_BYTES = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8; null has none.

    ``bytes.split`` splits at exactly those six ASCII characters.
    """
    return encoded(text).translate(LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and non-ASCII characters, A-Z lower-cased first."""
    return encoded(text).translate(WORD_BYTES).split()


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def quoted(name: str) -> str:
    """A column's name as a reference to it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def carried(docs: DataFrame, *names: str) -> DataFrame:
    """``row``, all columns of ``docs`` in one, and beside it the columns named.

    Helper columns can then have any name: they meet none of those that are carried.
    """
    every = F.struct(*(F.col(quoted(c)).alias(c) for c in docs.columns))
    return docs.select(every.alias("row"), *(F.col(quoted(n)).alias(n) for n in names))


def restored(frame: DataFrame, **changed: Column) -> DataFrame:
    """The columns of :func:`carried`, some of them with a new value."""
    row = F.col("row")
    for name, value in changed.items():
        row = row.withField(quoted(name), value)
    return frame.select(row.alias("row")).select("row.*")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Where none is set, as in tests, it is a folder below the warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return shared


def checkpointed(frame: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, with their lineage cut."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(frame.sparkSession))
    return frame.checkpoint()


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder, and read again from there."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Within this, the session has these settings."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within this, jobs send Python workers few rows at a time.

    A batch is held by Spark outside its heap and twice by the worker. Whole texts, of
    which a batch otherwise takes 10,000, are most of a worker's memory by that.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = int(spark.conf.get(rows))
    fewer = min(own, BATCH_ROWS) if own > 0 else BATCH_ROWS
    size = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    with settings(spark, {rows: str(fewer)} | size):
        yield


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within this, Spark deletes the shuffle files of a query when the query has ended.

    For jobs of several steps that write what the next one reads; otherwise those files
    stay until the driver happens to collect garbage. No frame may be run twice within,
    as its shuffles are gone then; what is written and read again is a new frame.
    """
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


def digest_hex(value: Column) -> Column:
    """A long as 16 lowercase hex digits of its unsigned value."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
