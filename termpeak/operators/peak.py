"""For each word, the document in which it occurs most often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def peak_document(frequencies: DataFrame) -> DataFrame:
    """``word``, ``filename``, ``n``: the highest count of each word and its document.

    Ties go to the smallest filename in binary order, so the answer depends on
    neither partitioning nor retries; a numeric filename is compared as text.

    The pre-aggregation before the shuffle keeps the count next to the filename.
    A combiner that hands on the filename in place of the count would make the
    answer depend on where it happens to run, so that reading of the job is
    deliberately not reproduced.

    A null filename raises an error, as a record without one does: it could neither
    be written out nor take part in a tie.

    One aggregate with a map-side stage does it all: a word found in every
    document crosses the network once per map task, not once per document.
    """
    missing = F.raise_error(F.lit("a document without a filename"))
    filename = F.coalesce(F.col("filename").cast("string"), missing).alias("filename")
    best = F.min(F.struct((-F.col("n")).alias("negated"), filename))
    return (
        frequencies.groupBy("word")
        .agg(best.alias("best"))
        .select(
            "word",
            F.col("best.filename").alias("filename"),
            (-F.col("best.negated")).alias("n"),
        )
    )


def merge_peaks(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The peaks of all documents from the peaks of parts of them.

    A maximum of maxima: each part brings at most one row for a word, with its count, and
    the rule for ties is the same, so parts merged in any order and any grouping give
    what all documents give at once. No documents are read again.
    """
    parts = first.select("word", "filename", "n")
    for other in others:
        parts = parts.unionAll(other.select("word", "filename", "n"))
    return peak_document(parts)


def format_peak(peaks: DataFrame) -> DataFrame:
    """``word`` and ``peak``, the text ``<filename, n>``."""
    text = F.concat(
        F.lit("<"), F.col("filename"), F.lit(", "), F.col("n").cast("string"), F.lit(">")
    )
    return peaks.select("word", text.alias("peak"))
