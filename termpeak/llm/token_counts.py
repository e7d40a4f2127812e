"""Token counts of a document's sections from one encoding of the whole document.

Method. The document is encoded once. Its tokens lie end to end over its bytes, so
each has a span; the spans are joined to the sections' spans by binary search. A
token that lies over a boundary goes to one section by an explicit rule: ``first``,
the section of its first character; ``most``, the section with most of its bytes,
the earlier one of equals. So sections' counts always add up to the document's.

Sections are given as character offsets where each begins, in order; without them
they are the lines, each with the newline that ends it. What stands before the first
given offset is a section of its own.

Scale. One scan, no shuffle; a task holds one batch and one vocabulary, whose size
is checked before it is broadcast.

Defined results: null text counts as empty; an empty text is one section without
tokens; sections without characters have none; offsets past the end, negative,
null, repeated or out of order are put in order and within the text. Rows repeat
as documents do. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpeak.llm.vocabularies import FOLDER, BytePairs, VocabularyFile

VOCABULARY = "byte_bpe_50k.tiktoken"
RULE = "most"
RULES = ("first", "most")
_RESULT = "struct<n_tokens:bigint,sections:array<struct<section:int,first_char:bigint,n_chars:bigint,n_tokens:bigint,n_crossing:bigint>>>"


def line_starts(text: str) -> np.ndarray:
    """Offsets at which the lines of a text begin."""
    starts, at = [0], text.find("\n")
    while at >= 0:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(starts, np.int64)


def section_starts(offsets: list | None, text: str) -> np.ndarray:
    if offsets is None:
        return line_starts(text)
    # pandas has nulls among whole numbers as not-a-number
    inside = [min(max(int(k), 0), len(text)) for k in offsets if k is not None and k == k]
    inside.sort()
    return np.array(inside if inside and inside[0] == 0 else [0, *inside], np.int64)


def byte_offsets(encoded: bytes, characters: np.ndarray) -> np.ndarray:
    """Offsets in UTF-8 of offsets in characters."""
    lead = np.flatnonzero((np.frombuffer(encoded, np.uint8) & 0xC0) != 0x80)
    return np.append(lead, len(encoded))[characters]


def attribute(
    widths: np.ndarray, starts: np.ndarray, end: int, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them lie over a boundary.

    ``widths``: bytes of the tokens; ``starts``: first bytes of the sections.
    """
    last = np.cumsum(widths)  # a token's bytes are [first, last)
    first = last - widths
    # of sections that begin at one place, only the last has characters
    home = np.searchsorted(starts, first, "right") - 1
    until = np.searchsorted(starts, last - 1, "right") - 1
    crossing = until > home
    if rule == "most":
        stops = np.append(starts[1:], end)
        for k in np.flatnonzero(crossing):
            inside = np.arange(home[k], until[k] + 1)
            share = np.minimum(stops[inside], last[k]) - np.maximum(starts[inside], first[k])
            home[k] = inside[int(np.argmax(share))]
    counts = np.bincount(home, minlength=len(starts))
    return counts, np.bincount(home[crossing], minlength=len(starts))


def count_sections(
    vocabulary: BytePairs, text: str | None, offsets: list | None, rule: str
) -> tuple[int, list[tuple]]:
    text = text or ""
    starts = section_starts(offsets, text)
    encoded = text.encode("utf-8", "replace")
    widths = vocabulary.width[vocabulary.ids(text)] if text else np.zeros(0, np.int64)
    counts, crossing = attribute(widths, byte_offsets(encoded, starts), len(encoded), rule)
    sizes = np.diff(np.append(starts, len(text)))
    rows = zip(starts.tolist(), sizes.tolist(), counts.tolist(), crossing.tolist(), strict=True)
    return len(widths), [(k, *row) for k, row in enumerate(rows)]


def section_tokens(
    docs: DataFrame,
    text: Column,
    offsets: Column | None = None,
    rule: str = RULE,
    vocabulary: str = f"{FOLDER}/{VOCABULARY}",
) -> Column:
    """``n_tokens`` and ``sections`` of each text, for the rows of ``docs``."""
    if rule not in RULES:
        raise ValueError(f"rule {rule!r}; one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(VocabularyFile.read(vocabulary))

    @F.pandas_udf(_RESULT)
    def count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tokenizer = shared.value.load()
        for texts, all_offsets in batches:
            rows = [
                count_sections(tokenizer, t, None if o is None else list(o), rule)
                for t, o in zip(texts, all_offsets, strict=True)
            ]
            yield pd.DataFrame(
                {
                    "n_tokens": [n for n, _ in rows],
                    "sections": [
                        [dict(zip(_FIELDS, s, strict=True)) for s in own] for _, own in rows
                    ],
                }
            )

    none = F.lit(None).cast("array<bigint>")
    return count(text, none if offsets is None else offsets.cast("array<bigint>"))


_FIELDS = ("section", "first_char", "n_chars", "n_tokens", "n_crossing")


def token_counts_query(docs: DataFrame, vocabulary: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """A row for every line of every document."""
    counted = docs.select(
        "doc_id",
        section_tokens(docs, F.col("text"), vocabulary=vocabulary).alias("counted"),
    )
    return counted.select(
        "doc_id", F.col("counted.n_tokens").alias("doc_tokens"), F.inline("counted.sections")
    )
