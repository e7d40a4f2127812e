"""Quality rules from a tokeniser's fertility, with bands per language.

Method. Every text is encoded whole with public vocabularies. Of each vocabulary
three figures count: characters per token, the share of tokens that stand for bare
bytes, and the entropy of the tokens in bits. What is usual depends on the language
and on the length, so every language and length class (words, by powers of two) has
its own band about the median, ``SPREADS`` robust deviations (the quartiles' distance
over 1.349) wide on the sides that speak against a text: characters per token on both
sides, bare bytes above, entropy below. A text outside any band goes, and so does one
that fails the base rules. Texts that fail these have no part in the bands.

Every other text is judged, at any size of the table. A class with fewer than
``FEWEST`` texts is too thin for quartiles of its own: it takes the band of the nearest
class of its language that has as many (of two as near, the one of longer texts), else
that of its whole language, else that of all texts of its script, else that of all texts,
however few they are. A text's script is that of most of its letters.

Scale. One scan encodes; its figures, about a hundred bytes for each document, are
written to the checkpoint folder, so that nothing is encoded twice. The bands come from
exact counts over fine steps: a figure falls into one of ``STEPS`` to the unit,
counted with a map-side stage, so no group ever holds the figures of a class, and a
quartile is the lower end of its step. The table of bands has a row for each language,
script and length class.

Defined results: null text counts as empty, has no words and fails the base rules;
null languages are a language of their own. Rows that repeat give rows that repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termpeak.llm.common import checkpointed
from termpeak.llm.vocabularies import FOLDER, Vocabulary, VocabularyFile

VOCABULARIES = ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r "
SPREADS = 4.5
FEWEST = 30
FEWEST_WORDS = 50
REPEATED_PERCENT = 50
SALTS = 64

# Least deviation that counts, so that very even classes do not reject at a hair.
_FLOORS = {"chars_per_token": 0.02, "byte_share": 0.01, "entropy": 0.05}
# Steps to the unit in which quartiles are found, 20 to the least deviation or more.
STEPS = {"chars_per_token": 1000, "byte_share": 2000, "entropy": 400}

# Where blocks of letters begin, and the script of each block.
_BLOCKS = (
    (0x80, ""), (0xC0, "latin"), (0x250, ""), (0x370, "greek"), (0x400, "cyrillic"),
    (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, ""),
    (0x900, "devanagari"), (0x980, "bengali"), (0xA00, ""), (0xB80, "tamil"), (0xC00, ""),
    (0xE00, "thai"), (0xE80, ""), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, ""),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, ""),
    (0x3400, "han"), (0xA000, ""), (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"),
    (0xFB00, ""), (0x20000, "han"), (0x32000, ""),
)
_SCRIPTS = sorted({name for _, name in _BLOCKS} - {""})
_STARTS = np.array([start for start, _ in _BLOCKS], np.uint32)
_OF_BLOCK = np.array([_SCRIPTS.index(n) if n else len(_SCRIPTS) for _, n in _BLOCKS])
_ASCII = bytes(range(128))
_NO_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, words in repeated windows."""
    words = text.encode("utf-8", "surrogatepass").split()
    characters = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line in seen:
            repeated_lines += 1
        elif line.strip(SPACES):
            seen.add(line)
    return len(words), characters, symbols, repeated_lines, repeated_window_words(words)


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of ``width`` words that the text has twice or more."""
    if len(words) < width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    windows = ids[: len(ids) - width + 1]
    for k in range(1, width):
        pair = windows * len(number) + ids[k : len(ids) - width + 1 + k]
        windows, counts = np.unique(pair, return_inverse=True, return_counts=True)[1:]
    again = counts[windows] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(width):
        covered[k : len(again) + k] |= again
    return int(covered.sum())


def script_of(text: str) -> str:
    """The script of most letters, the first by name of equals; ``""`` without letters."""
    raw = text.encode("utf-8", "surrogatepass")
    letters = np.zeros(len(_SCRIPTS) + 1, np.int64)
    others = raw.translate(None, _ASCII).decode("utf-8", "surrogatepass")
    if others:
        points = np.frombuffer(others.encode("utf-32-le", "surrogatepass"), np.uint32)
        block = np.searchsorted(_STARTS, points, "right") - 1
        letters += np.bincount(_OF_BLOCK[block], minlength=len(letters))
    letters[_SCRIPTS.index("latin")] += len(raw.translate(None, _NO_LETTERS))
    letters = letters[:-1]
    return _SCRIPTS[int(letters.argmax())] if letters.any() else ""


def fertility(vocabulary: Vocabulary, text: str) -> tuple[float, float, float]:
    """Characters per token, share of bare bytes, entropy of the tokens."""
    ids = vocabulary.ids(text)
    if not len(ids):
        return 0.0, 0.0, 0.0
    counts = np.unique(ids, return_counts=True)[1]
    share = counts / len(ids)
    entropy = float(-(share * np.log2(share)).sum())
    return len(text) / len(ids), float(vocabulary.bare_byte[ids].mean()), max(0.0, entropy)


_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FIGURES = ("chars_per_token", "byte_share", "entropy")


def measure(docs: DataFrame, text: Column, paths: list[str]) -> Column:
    """The base counts, and the three figures of each vocabulary as ``f0_…``, ``f1_…``."""
    files = [VocabularyFile.read(p) for p in paths]
    shared = docs.sparkSession.sparkContext.broadcast(files)
    names = [f"f{k}_{name}" for k in range(len(files)) for name in _FIGURES]
    counts = [f"{n}:bigint" for n in _BASE]
    schema = ",".join([*counts, "script:string", *(f"{n}:double" for n in names)])

    @F.pandas_udf(f"struct<{schema}>")
    def figures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabularies = [f.load() for f in shared.value]
        for texts in batches:
            rows = [
                (
                    *base_counts(t),
                    script_of(t),
                    *(x for v in vocabularies for x in fertility(v, t)),
                )
                for t in texts
            ]
            yield pd.DataFrame(rows, columns=[*_BASE, "script", *names])

    return figures(F.coalesce(text, F.lit("")))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < FEWEST_WORDS) | (
        100 * m["n_repeat_words"] > REPEATED_PERCENT * m["n_words"]
    )


_CLASS = ["language", "script", "size_class"]


def class_bands(judged: DataFrame, names: list[str]) -> DataFrame:
    """The quartiles ``q_…`` that each (language, script, length class) is held against."""
    steps = [F.lit(STEPS[name.split("_", 1)[1]]) for name in names]
    bins = [
        F.struct(F.lit(k).alias("figure"), F.floor(F.col(f"m.{n}") * step).alias("bin"))
        for k, (n, step) in enumerate(zip(names, steps, strict=True))
    ]
    counts = checkpointed(
        judged.select(*_CLASS, F.inline(F.array(*bins))).groupBy(*_CLASS, "figure", "bin").count()
    )
    # a text counts for its class, its language, its script and for all
    whole = F.lit(None).cast("int")
    kinds = [("language", F.col("size_class")), ("language", whole), ("script", whole)]
    keys = F.array(
        *(
            F.struct(F.lit(k).alias("kind"), key.alias("key"), size.alias("size_class"))
            for k, (key, size) in enumerate(
                [*((F.col(c), size) for c, size in kinds), (F.lit(""), whole)]
            )
        )
    )
    summed = (
        counts.select(keys.alias("keys"), "figure", "bin", "count")
        .select(F.inline("keys"), "figure", "bin", "count")
        .groupBy("kind", "key", "size_class", "figure", "bin")
        .agg(F.sum("count").alias("n"))
    )
    group = Window.partitionBy("kind", "key", "size_class", "figure")
    placed = summed.select(
        "*", F.sum("n").over(group.orderBy("bin")).alias("until"), F.sum("n").over(group).alias("texts")
    )

    def quartiles(k: int, step: Column) -> Column:
        own = F.col("figure") == k
        return F.array(
            *(
                F.min(F.when(own & (F.col("until") >= F.ceil(F.col("texts") * p)), F.col("bin")))
                / step
                for p in (0.25, 0.5, 0.75)
            )
        )

    bands = checkpointed(
        placed.groupBy("kind", "key", "size_class").agg(
            F.max("texts").alias("texts"),
            F.struct(
                *(
                    quartiles(k, step).alias(f"q_{n}")
                    for k, (n, step) in enumerate(zip(names, steps, strict=True))
                )
            ).alias("band"),
        )
    )
    enough = bands.where((F.col("texts") >= FEWEST) | (F.col("kind") == 3))

    def of(kind: int, *columns: str) -> DataFrame:
        return enough.where(F.col("kind") == kind).select(*columns, F.col("band").alias(f"band{kind}"))

    near = of(0, F.col("key").alias("language"), F.col("size_class").alias("other"))
    distance = F.struct(F.abs(F.col("other") - F.col("size_class")), -F.col("other"))
    classes = counts.select(*_CLASS).distinct()
    nearest = (
        classes.join(near, "language")  # a language has one class for each power of two
        .groupBy(*_CLASS)
        .agg(F.min_by("band0", distance).alias("band0"))
    )
    chosen = (
        classes.withColumn("every", F.lit(""))
        .join(nearest, _CLASS, "left")
        .join(of(1, F.col("key").alias("language")), "language", "left")
        .join(of(2, F.col("key").alias("script")), "script", "left")
        .join(of(3, F.col("key").alias("every")), "every", "left")
    )
    band = F.coalesce("band0", "band1", "band2", "band3")
    return chosen.select(*_CLASS, band.alias("band")).select(*_CLASS, "band.*")


def judge(
    docs: DataFrame,
    vocabularies: tuple[str, ...] = VOCABULARIES,
    folder: str = FOLDER,
    spreads: float = SPREADS,
) -> DataFrame:
    """``doc_id``, ``lang``, ``m`` (counts and figures), ``base_failed``, ``kept``."""
    paths = [f"{folder}/{name}" for name in vocabularies]
    measured = checkpointed(
        docs.select("doc_id", "lang", measure(docs, F.col("text"), paths).alias("m"))
    )
    language = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    size = F.floor(F.log2(F.greatest(F.col("m.n_words"), F.lit(1)))).cast("int")
    marked = measured.select(
        "*",
        base_failed(F.col("m")).alias("base_failed"),
        language.alias("language"),
        F.col("m.script").alias("script"),
        size.alias("size_class"),
    )
    names = [f"f{k}_{name}" for k in range(len(paths)) for name in _FIGURES]
    bands = class_bands(marked.where(~F.col("base_failed")), names)
    outside = F.lit(False)
    for name in names:
        figure = name.split("_", 1)[1]
        value, q = F.col(f"m.{name}"), F.col(f"q_{name}")
        spread = F.greatest((q[2] - q[0]) / 1.349, F.lit(_FLOORS[figure]))
        if figure != "entropy":
            outside |= value > q[1] + spreads * spread
        if figure != "byte_share":
            outside |= value < q[1] - spreads * spread
    # a band can be that of a third of all texts: deal both sides out over salts
    salted = bands.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id", "m"), F.lit(SALTS)).cast("int")
    joined = marked.withColumn("salt", salt).join(salted, [*_CLASS, "salt"], "left")
    kept = ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))
    return joined.select("doc_id", "lang", "m", "base_failed", kept.alias("kept"))


def quality_query(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id",
        *(F.col(f"m.{name}").alias(name) for name in _BASE),
        "base_failed",
        "kept",
        F.col("m.f0_chars_per_token").alias("chars_per_token"),
        F.col("m.f1_byte_share").alias("byte_share"),
        F.col("m.f0_entropy").alias("token_entropy"),
    )
