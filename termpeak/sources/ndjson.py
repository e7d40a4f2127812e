"""Documents as JSON lines: one ``{"filename": …, "content": …}`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termpeak.functions.records import document, line_text


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as ``value``, split at newlines only, so a bare CR stays in its line."""
    return decoded_lines(raw_lines(spark, path))


def raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as ``value``, whatever their bytes are."""
    return spark.read.text(path, lineSep="\n")


def decoded_lines(lines: DataFrame) -> DataFrame:
    """Lines with every ``value`` as valid text."""
    return lines.select(line_text(F.col("value")).alias("value"))


def read_ndjson(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``filename`` and ``content`` of every line; a malformed line fails the job."""
    return decode_documents(read_lines(spark, path))


def decode_documents(lines: DataFrame) -> DataFrame:
    """``filename`` and ``content`` of the JSON lines in ``value``.

    A malformed line raises an error. The check sits in a generator, which the
    optimizer neither prunes nor evaluates twice: counting the rows checks them
    too, and each line is parsed once.
    """
    line = F.col("value")
    start = F.coalesce(F.left(line, F.lit(200)), F.lit("null"))
    error = F.raise_error(F.concat(F.lit("malformed document record: "), start))
    return lines.select(F.inline(F.array(F.coalesce(document(line), error))))


def quarantine_documents(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents of the well-formed lines, and the malformed lines themselves.

    Two DataFrames over the same input, each a narrow pass without a shuffle; an
    action on both reads the input twice.
    """
    line = F.col("value")
    records = F.array(document(line))
    accepted = F.filter(records, lambda record: record.isNotNull())
    rejected = F.transform(
        F.filter(records, lambda record: record.isNull()), lambda _: line
    )
    return (
        lines.select(F.inline(accepted)),
        lines.select(F.explode(rejected).alias("line")),
    )


def observed_documents(lines: DataFrame, rejects: Observation) -> DataFrame:
    """The documents of the well-formed lines; the others are counted as ``rejects``.

    One pass over the input. The count is there once an action has run.
    """
    parsed = lines.select(document(F.col("value")).alias("record"))
    missing = F.count(F.when(F.col("record").isNull(), 1)).alias("rejects")
    counted = parsed.observe(rejects, missing)
    return counted.where(F.col("record").isNotNull()).select("record.*")


def malformed_lines(raw_lines: DataFrame) -> DataFrame:
    """``value``, with the bytes as they were read, of the lines that are no record."""
    return raw_lines.where(document(line_text(F.col("value"))).isNull())


def encode_documents(docs: DataFrame) -> DataFrame:
    """``value``: each document as one JSON line."""
    return docs.select(F.to_json(F.struct("filename", "content")).alias("value"))


def write_ndjson(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write documents as JSON lines, one file per partition."""
    encode_documents(docs).write.mode(mode).text(path)
