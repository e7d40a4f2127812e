"""Results as text: JSON word, tab, JSON text of the peak, one word per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termpeak.operators.peak import format_peak


def _json_string(text: Column) -> Column:
    """A string as JSON in pure ASCII: a one-element array less its brackets."""
    encoded = F.to_json(F.array(text), {"writeNonAsciiCharacterAsCodePoint": "true"})
    return F.substring(encoded, F.lit(2), F.length(encoded) - 2)


def output_lines(peaks: DataFrame) -> DataFrame:
    """``line``: the output text of each peak. Words are a-z, so quotes suffice."""
    return format_peak(peaks).select(
        F.concat(
            F.lit('"'), F.col("word"), F.lit('"\t'), _json_string(F.col("peak"))
        ).alias("line")
    )


def write_peaks(peaks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write peaks as lines of text; the order of the lines means nothing."""
    output_lines(peaks).write.mode(mode).text(path)


def read_peaks(spark: SparkSession, path: str) -> DataFrame:
    """``word`` and ``peak`` of lines written by :func:`write_peaks`."""
    parts = F.split(F.col("value"), "\t", 2)

    def text(part: Column) -> Column:
        whole = F.concat(F.lit("["), part, F.lit("]"))
        options = {"mode": "FAILFAST", "maxStringLen": "2147483647"}
        return F.get(F.from_json(whole, "array<string>", options), F.lit(0))

    lines = spark.read.text(path, lineSep="\n")
    return lines.select(text(parts[0]).alias("word"), text(parts[1]).alias("peak"))
