"""Count each word within each record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpeak.functions.text import term_counts


def term_frequency(
    docs: DataFrame, keep: Sequence[str] = ("filename",), content: str = "content"
) -> DataFrame:
    """``keep`` columns, ``word`` and ``n``: one row per record and distinct word.

    Counts are per input row, not per filename: two records that share a
    filename stay apart and later compete for a word. Because a row is a record,
    this needs neither a record id nor a shuffle, and a filename shared by a
    third of all records is no hot key.
    """
    return docs.select(*keep, F.inline(term_counts(F.col(content)))).where(
        F.col("word") != ""
    )
