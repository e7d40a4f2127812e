"""Collocations: phrases whose words stand together more often than apart.

Method, the stripes pattern. A stripe is a prefix of one or more words with an
associative counter of the word that comes next; the end of a piece counts as a next
word of its own. Tasks count stripes over chunks of text, stripes of one prefix are
merged by adding their counters elementwise, and the merged stripe has everything:
its entries are the counts of the phrases one word longer, their sum is the count of
the prefix, and its largest entry is what may subsume the prefix. Phrases of up to
three words need stripes of one word and of two. The second level follows the first:
it counts only where both the prefix and the last words are frequent, since a phrase is
never more frequent than its parts.

Scale. A chunk's words are numbered and its phrases counted by sorting numbers, so a
word costs no Python step of its own. A stripe is dealt out over ``PIECES`` pieces by
its next words, and a (language, prefix, piece) goes to one of as many buckets as the
text needs for about ``BUCKET_BYTES`` each; a chunk sends a phrase at most once, however
common it is. No bucket holds a language or a hot prefix whole. What is frequent is sent
to the tasks of the next level as one bitmap of hashes, of 64 MiB at most: a phrase that
it lets through by chance is counted and dropped, so its size bears on cost alone. Joins
after that are between frequent phrases only; one word meets at most one row for each
other word of the vocabulary. The first of a language are ranked in parts, then the first
of those; the last rank sees ``PARTS`` times ``top`` rows of a language at most.

Defined results: null and empty texts have no words; a null language is ``und`` and one
with the same name; repeated rows count as often as they stand there; ties go by the
order the ranking names, down to the bytes of the phrase, so there are none left; texts
of any length are cut only where pieces end; an empty table, or one without a frequent
phrase, gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termpeak.llm.common import LOWER, small_batches, written

LEAST = 10
LONGEST = 3
SUBSUMED = 50  # per cent of a phrase's count that a longer one must have
TOP = 2000
SCALE = 1_000_000
PIECES = 8
PARTS = 32  # of a language, that are ranked by themselves first
CHUNK_BYTES = 4 << 20  # text of one language that is counted at a time
HELD_BYTES = 4 * CHUNK_BYTES  # of all languages that a task holds back
BUCKET_BYTES = 4 << 20  # text whose stripes share a bucket
MAP_BITS = 1 << 29  # 64 MiB

# What ends a piece, and what parts words within one.
ENDS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(GAPS)] = 1
_KIND[list(ENDS)] = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STRIPES = "lang string, bucket int, words binary, prefixes binary, nexts binary, counts binary"


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its first words and that of its last."""
    value = (first ^ (first >> np.uint64(29))) * _MIX + then
    return value ^ (value >> np.uint64(32))


def cut_words(data: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word numbers in order, the piece of each, and the words that the numbers mean.

    Every piece ends within ``data``, or at its end.
    """
    raw = np.frombuffer(data.translate(LOWER), np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    at = np.flatnonzero(starts)
    if not len(at):
        return at, at, []
    piece = np.cumsum(kind == 2, dtype=np.int32)[at]
    letters = raw[inside]
    offsets = np.append(np.cumsum(inside, dtype=np.int32)[at] - 1, len(letters)).astype(np.int32)
    array = pa.BinaryArray.from_buffers(
        pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    ).dictionary_encode()
    return array.indices.to_numpy().astype(np.int64), piece, array.dictionary.to_pylist()


class FrequentMap:
    """Bits at the hashes of the frequent phrases of one length, of every language."""

    def __init__(self, bits: np.ndarray, power: int) -> None:
        self.bits, self.power = bits, power

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(64 - self.power)
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def chunk_stripes(
    lang: str, data: bytes, size: int, buckets: int, frequent: FrequentMap | None
) -> Iterator[tuple[str, int, bytes, bytes, bytes, bytes]]:
    """The stripes of ``size``-word prefixes of one chunk, by bucket.

    Words of a bucket are joined by spaces, which no word has; prefixes and next words
    are their numbers there, and the end of a piece is the next word -1.
    """
    numbers, piece, words = cut_words(data)
    if len(numbers) < size:
        return
    hashes = word_hashes(words)
    seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    count = len(numbers) - size + 1
    whole = piece[size - 1 :] == piece[:count]
    following = np.full(count, -1, np.int64)
    more = piece[size:] == piece[size - 1 : -1]
    following[: count - 1][more] = numbers[size:][more]
    if frequent is not None:
        # both the prefix and what the phrase has but its first word must be frequent
        parts = _phrase_hashes(hashes[numbers], size, seed)
        is_frequent = frequent.has(parts)
        whole &= following >= 0
        whole[: count - 1] &= is_frequent[:-1] & is_frequent[1:]
    at = np.flatnonzero(whole)
    if not len(at):
        return
    # number the prefixes, then count (prefix, next word)
    key = numbers[at]
    for k in range(1, size):
        _, key = np.unique(key, return_inverse=True)
        key = key * len(words) + numbers[at + k]
    _, first, prefix = np.unique(key, return_index=True, return_inverse=True)
    entry, n = np.unique(prefix * (len(words) + 1) + following[at] + 1, return_counts=True)
    prefix, after = entry // (len(words) + 1), entry % (len(words) + 1) - 1
    members = np.stack([numbers[at[first] + k] for k in range(size)], 1)[prefix]
    spread = seed * np.ones(len(members), np.uint64)
    for k in range(size):
        spread = mixed(spread, hashes[members[:, k]])
    part = np.where(after < 0, np.uint64(0), hashes[after] % np.uint64(PIECES))
    bucket = (mixed(spread, part) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for start, stop in pairwise(edges.tolist()):
        rows = order[start:stop]
        used, local = np.unique(
            np.concatenate([members[rows].ravel(), after[rows]]), return_inverse=True
        )
        ended = int(used[0] == -1)
        local = (local - ended).astype(np.int32)
        yield (
            lang,
            int(bucket[rows[0]]),
            b" ".join(words[k] for k in used[ended:].tolist()),
            local[: len(rows) * size].tobytes(),
            local[len(rows) * size :].tobytes(),
            n[rows].astype(np.int32).tobytes(),
        )


def _phrase_hashes(words: np.ndarray, size: int, seed: np.uint64) -> np.ndarray:
    """The hash of every run of ``size`` words."""
    count = len(words) - size + 1
    value = np.full(count, seed, np.uint64)
    for k in range(size):
        value = mixed(value, words[k : k + count])
    return value


def _cuts(data: bytes) -> Iterator[bytes]:
    """A long text in parts that end where pieces end."""
    start = 0
    while len(data) - start > CHUNK_BYTES:
        stop = max(data.rfind(bytes([e]), start, start + CHUNK_BYTES) for e in ENDS)
        if stop < 0:  # a piece longer than that stays whole
            found = [data.find(bytes([e]), start + CHUNK_BYTES) for e in ENDS]
            stop = min((f for f in found if f >= 0), default=len(data) - 1)
        yield data[start : stop + 1]
        start = stop + 1
    yield data[start:]


def stripes(
    docs: DataFrame, size: int, buckets: int, frequent: FrequentMap | None = None
) -> DataFrame:
    """Stripes of ``size``-word prefixes of ``lang`` and binary ``text``, by chunk."""
    context = docs.sparkSession.sparkContext
    sent = None if frequent is None else context.broadcast((frequent.bits, frequent.power))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = None if sent is None else FrequentMap(*sent.value)
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flushed(langs: list[str]) -> Iterator[pd.DataFrame]:
            for lang in langs:
                sizes.pop(lang)
                data = b"\n".join(held.pop(lang))
                rows = list(chunk_stripes(lang, data, size, buckets, known))
                if rows:
                    names = [c.split()[0] for c in _STRIPES.split(", ")]
                    yield pd.DataFrame(rows, columns=names, dtype=object)

        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                for part in _cuts(text):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= CHUNK_BYTES:
                        yield from flushed([lang])
                    elif sum(sizes.values()) >= HELD_BYTES:
                        yield from flushed(list(sizes))
        yield from flushed(list(sizes))

    return docs.mapInPandas(count, _STRIPES)


def merge_stripes(stripes_: DataFrame, size: int, least: int) -> DataFrame:
    """``lang``, ``phrase``, ``n`` from stripes merged elementwise.

    Phrases one word longer than the prefix come with their whole count, if it is at
    least ``least``; with ``size`` 1 the prefixes come too, each with its share of the
    count in every bucket that holds a piece of its stripe.
    """

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        lang = frame["lang"].iloc[0]
        every, ids, known = [], [], {}
        for row in frame.itertuples(index=False):
            own = row.words.split(b" ")
            number = np.fromiter(
                (known.setdefault(w, len(known)) for w in own), np.int64, len(own)
            )
            number = np.append(number, -1)  # so that -1 stays
            every.append(number[np.frombuffer(row.prefixes, np.int32)].reshape(-1, size))
            ids.append(
                (number[np.frombuffer(row.nexts, np.int32)], np.frombuffer(row.counts, np.int32))
            )
        words = np.array(list(known), object)
        members = np.concatenate(every)
        after = np.concatenate([a for a, _ in ids])
        n = np.concatenate([c for _, c in ids]).astype(np.int64)
        key = members[:, 0]
        for k in range(1, size):
            _, key = np.unique(key, return_inverse=True)
            key = key * len(words) + members[:, k]
        _, first, prefix = np.unique(key, return_index=True, return_inverse=True)
        entry, place = np.unique(prefix * (len(words) + 1) + after + 1, return_inverse=True)
        # sums of longs; weights of bincount would be doubles
        total = np.zeros(len(entry), np.int64)
        np.add.at(total, place, n)
        prefix, after = entry // (len(words) + 1), entry % (len(words) + 1) - 1
        keep = (total >= least) & (after >= 0)
        columns = [words[members[first[prefix[keep]], k]] for k in range(size)]
        phrases = [b" ".join(p) for p in zip(*columns, words[after[keep]], strict=True)]
        counts = [total[keep]]
        if size == 1:
            sums = np.zeros(len(first), np.int64)
            np.add.at(sums, prefix, total)
            phrases += words[members[first, 0]].tolist()
            counts.append(sums)
        return pd.DataFrame(
            {
                "lang": np.full(len(phrases), lang, object),
                "phrase": np.array([p.decode("utf-8", "replace") for p in phrases], object),
                "length": np.repeat([size + 1, 1], [len(counts[0]), len(phrases) - len(counts[0])]),
                "n": np.concatenate(counts),
            }
        )

    return stripes_.groupBy("lang", "bucket").applyInPandas(
        merge, "lang string, phrase string, length int, n long"
    )


def frequent_map(spark: SparkSession, phrases: DataFrame) -> FrequentMap:
    """The bitmap of ``lang`` and ``phrase``: 16 bits or more a phrase up to 64 MiB."""
    power = min(max(16, (16 * phrases.count()).bit_length()), MAP_BITS.bit_length() - 1)
    slice_bits = 1 << 16

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = []
            for lang, phrase in zip(frame["lang"], frame["phrase"], strict=True):
                words = word_hashes(phrase.encode().split(b" "))
                seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
                values.append(_phrase_hashes(words, len(words), seed))
            if values:
                slots = np.unique(np.concatenate(values) >> np.uint64(64 - power))
                yield from _slices(slots, slice_bits)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(slice_bits // 8, np.uint8)
        for piece in frame["bits"]:
            bits |= np.frombuffer(piece, np.uint8)
        return pd.DataFrame({"slice": frame["slice"].iloc[:1], "bits": [bits.tobytes()]})

    schema = "slice long, bits binary"
    slices = phrases.mapInPandas(mark, schema).groupBy("slice").applyInPandas(merge, schema)
    bits = np.zeros((1 << power) // 8, np.uint8)
    for row in slices.toLocalIterator():  # 8 KiB each, 64 MiB in all at most
        bits[row["slice"] * slice_bits // 8 :][: slice_bits // 8] = np.frombuffer(
            row["bits"], np.uint8
        )
    return FrequentMap(bits, power)


def _slices(slots: np.ndarray, slice_bits: int) -> Iterator[pd.DataFrame]:
    which = (slots // np.uint64(slice_bits)).astype(np.int64)
    for start, stop in pairwise(np.flatnonzero(np.diff(which, prepend=-1, append=-1)).tolist()):
        marked = np.zeros(slice_bits, np.uint8)
        marked[(slots[start:stop] % np.uint64(slice_bits)).astype(np.int64)] = 1
        bits = np.packbits(marked, bitorder="little").tobytes()
        yield pd.DataFrame({"slice": which[start : start + 1], "bits": [bits]})


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase``, ``length``, ``n`` of phrases found ``least`` times or more,
    and ``lang``, ``n``: all words of each language.

    ``docs`` has ``lang`` and ``text``. Phrases of one word are among the first.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    ).where(F.octet_length("text") > 0)
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, ceil(size / BUCKET_BYTES))

    with small_batches(spark):
        first = written(merge_stripes(stripes(texts, 1, buckets), 1, least), "stripes-1")
    words = first.where("length = 1")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    sums = words.groupBy("lang", "phrase", "length").agg(F.sum("n").alias("n"))
    counts = written(sums.where(F.col("n") >= least), "words")
    level = first.where("length = 2")
    counts = counts.unionAll(level)
    for length in range(2, longest):
        known = frequent_map(spark, level)
        merged = merge_stripes(stripes(texts, length, buckets, known), length, least)
        with small_batches(spark):
            level = written(merged, f"stripes-{length}")
        counts = counts.unionAll(level)
    return counts, totals


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a a / (left right)) with integers of any size."""

    @F.pandas_udf("long")
    def compute(whole: pd.Series, first: pd.Series, rest: pd.Series) -> pd.Series:
        triples = zip(whole.tolist(), first.tolist(), rest.tolist(), strict=True)
        return pd.Series([SCALE * x * x // (y * z) for x, y, z in triples], dtype="int64")

    return compute(a, left, right)


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    subsumed: int = SUBSUMED,
    top: int = TOP,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the two parts of its weakest
    cut. A phrase goes if a longer frequent phrase around it has ``subsumed`` per cent
    of its count or more; of the rest each language's first ``top`` stay.
    """
    counts, totals = phrase_counts(docs, longest, least)
    candidates = counts.where("length >= 2")
    words = F.split("phrase", " ")
    width = F.size("words")

    def run(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    around = (
        candidates.where("length > 2")
        .select("lang", "n", words.alias("words"))
        .select(
            "lang",
            "n",
            F.explode(
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(2), width - 1),
                        lambda m: F.transform(
                            F.sequence(F.lit(1), width - m + 1), lambda k: run(k, m)
                        ),
                    )
                )
            ).alias("phrase"),
        )
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("most"))
    )
    kept = candidates.join(around, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (100 * F.col("most") < subsumed * F.col("n"))
    )
    parts = counts.select("lang", "phrase", "n")
    cuts = (
        kept.select("lang", "phrase", F.col("n").alias("a"), words.alias("words"))
        .select("*", F.explode(F.sequence(F.lit(1), width - 1)).alias("k"))
        .select("lang", "phrase", "a", "k", run(1, F.col("k")).alias("left"),
                run(F.col("k") + 1, width - F.col("k")).alias("right"))
        .join(parts.toDF("lang", "left", "l"), ["lang", "left"])
        .join(parts.toDF("lang", "right", "r"), ["lang", "right"])
    )
    weakest = F.min(F.struct(cut_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    scored = (
        cuts.groupBy("lang", "phrase", "a")
        .agg(weakest.alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    # first within parts of a language, so that no task ranks a whole one
    order = (F.desc("score"), F.desc("a"), "phrase")
    part = Window.partitionBy("lang", "part").orderBy(*order)
    first = (
        scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
        .withColumn("rank", F.row_number().over(part))
        .where(F.col("rank") <= top)
    )
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = first.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"
    )


def collocation_query(docs: DataFrame) -> DataFrame:
    return collocations(docs.select("lang", "text"))


COLLOCATION_SQL = """
    WITH RECURSIVE texts AS (
        SELECT coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ),
    pieces AS (
        SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
    ),
    cut AS (
        SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda w: w <> '') AS words
        FROM pieces
    ),
    placed AS (
        SELECT lang, words, unnest(range(1, len(words) + 1)) AS k FROM cut WHERE len(words) > 0
    ),
    grams AS (
        SELECT lang, 1 AS length, words[k] AS phrase FROM placed
        UNION ALL
        SELECT lang, 2, words[k] || ' ' || words[k + 1] FROM placed WHERE k + 1 <= len(words)
        UNION ALL
        SELECT lang, 3, words[k] || ' ' || words[k + 1] || ' ' || words[k + 2]
        FROM placed WHERE k + 2 <= len(words)
    ),
    counts AS (
        SELECT lang, length, phrase, count(*) AS f FROM grams GROUP BY lang, length, phrase
    ),
    totals AS (SELECT lang, sum(f) AS n FROM counts WHERE length = 1 GROUP BY lang),
    candidates AS (
        SELECT lang, length, phrase, f AS a, string_split(phrase, ' ') AS w
        FROM counts WHERE length >= 2 AND f >= 10
    ),
    around AS (
        SELECT lang, phrase, max(a) AS most FROM (
            SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE length = 3
            UNION ALL
            SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE length = 3
        ) GROUP BY lang, phrase
    ),
    cuts AS (
        SELECT lang, phrase, a, 1 AS k, w[1] AS head,
               CASE length WHEN 2 THEN w[2] ELSE w[2] || ' ' || w[3] END AS tail
        FROM candidates
        UNION ALL
        SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE length = 3
    ),
    scored AS (
        SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
               (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
        FROM cuts c
        JOIN counts x ON x.lang = c.lang AND x.phrase = c.head
        JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
    ),
    weakest AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place
            FROM scored
        ) WHERE place = 1
    ),
    ranked AS (
        SELECT w.*, row_number() OVER (
            PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
        FROM weakest w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
        WHERE o.most IS NULL OR 100 * o.most < 50 * w.a
    )
    SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a,
           CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
           CAST(score AS BIGINT) AS score
    FROM ranked r JOIN totals USING (lang)
    WHERE rank <= 2000"""
