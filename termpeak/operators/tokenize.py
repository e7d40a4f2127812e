"""Documents to normalised text and to one row per word."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpeak.functions.text import normalize, words


def normalize_documents(
    docs: DataFrame, keep: Sequence[str] = ("filename",), content: str = "content"
) -> DataFrame:
    """``keep`` columns and ``normalized``, the text with only a-z and spaces."""
    return docs.select(*keep, normalize(F.col(content)).alias("normalized"))


def tokenize(
    docs: DataFrame, keep: Sequence[str] = ("filename",), content: str = "content"
) -> DataFrame:
    """``keep`` columns and ``word``, one row per occurrence; no shuffle.

    A text without letters gives no row.
    """
    return docs.select(*keep, F.explode(words(F.col(content))).alias("word")).where(
        F.col("word") != ""
    )
