"""Collocations against counting every phrase in plain Python."""

import random
import re
import tracemalloc
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from termpeak.llm import collocations as module
from termpeak.llm.collocations import (
    COLLOCATION_SQL,
    FrequentMap,
    chunk_stripes,
    collocation_query,
    collocations,
    cut_words,
    phrase_counts,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=3, least=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for length in range(1, longest + 1):
                for k in range(len(words) - length + 1):
                    f[lang, tuple(words[k : k + length])] += 1
    frequent = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    found = []
    for (lang, phrase), a in frequent.items():
        within = [
            b
            for (other, longer), b in frequent.items()
            if other == lang
            and len(longer) > len(phrase)
            and any(longer[k : k + len(phrase)] == phrase for k in range(len(longer)))
        ]
        if any(100 * b >= 50 * a for b in within):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            left, right = f[lang, phrase[:k]], f[lang, phrase[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, -score, -a, " ".join(phrase).encode(), left, right))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made_rows():
    draw = random.Random(3)
    vocabulary = ["The", "law", "of", "large", "numbers", "é", "ß", "A\x00b", "日本", "x", "Of"]
    rows = []
    for k in range(160):
        words = draw.choices(vocabulary, weights=[9, 3, 6, 2, 2, 1, 1, 1, 1, 1, 1], k=k % 37)
        gaps = draw.choices([" ", "  ", "\t", ", ", ".", "\n", "\r\n", "; "], k=len(words))
        text = "".join(w + g for w, g in zip(words, gaps, strict=True))
        rows.append((draw.choice(["en", "de", None, "und"]), text))
    rows += [("en", None), ("en", ""), (None, None), ("fr", " .,;"), ("en", "New York City")] * 12
    rows += [("en", "New York")] * 9 + [("de", "new york")] * 9
    return rows


def answer(frame):
    return sorted(tuple(r) for r in frame.select(COLUMNS).collect())


@pytest.mark.parametrize("partitions", [1, 5])
def test_equals_counting_every_phrase(spark, partitions):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(partitions)
    assert answer(collocation_query(docs)) == brute(rows)


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths_limits_and_cuts(spark, longest):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations(docs, longest=longest, least=4, top=7)
    assert answer(got) == brute(rows, longest, 4, 7)


def test_small_chunks_and_buckets_change_nothing(spark, monkeypatch):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    data = "\n".join(t or "" for _, t in rows).encode() * 3
    monkeypatch.setattr(module, "CHUNK_BYTES", 64)
    parts = list(module._cuts(data))
    assert b"".join(parts) == data and len(parts) > 20
    assert all(p[-1:] in [bytes([e]) for e in module.ENDS] for p in parts[:-1])
    monkeypatch.setattr(module, "BUCKET_BYTES", 200)
    # workers take these values with the functions that use them
    got = sorted(tuple(r) for r in phrase_counts(docs)[0].collect())
    monkeypatch.undo()
    assert got == sorted(tuple(r) for r in phrase_counts(docs)[0].collect())


def test_words_of_odd_bytes():
    numbers, piece, words = cut_words("A b\tB,é\x00 a.\n\nÄ".encode())
    assert [words[k].decode() for k in numbers] == ["a", "b", "b", "é\x00", "a", "Ä"]
    assert piece.tolist() == [0, 0, 0, 1, 1, 4]
    assert cut_words(b" ,\t") [2] == [] and cut_words(b"")[2] == []


def test_a_map_that_lets_all_through_only_costs(spark):
    everything = FrequentMap(np.full(1 << 13, 255, np.uint8), 16)
    text = b"a b c d. a b c"
    rows = list(chunk_stripes("en", text, 2, 1, everything))
    assert [r[2] for r in rows] == [b"a b c d"] or sorted(rows[0][2].split()) == list(b"abcd")
    assert sum(np.frombuffer(r[5], np.int32).sum() for r in rows) == 3
    nothing = FrequentMap(np.zeros(1 << 13, np.uint8), 16)
    assert not list(chunk_stripes("en", text, 2, 1, nothing))


def test_counts_past_64_bits_when_multiplied(spark):
    rows = [(3 * 10**12, 3 * 10**12 + 1, 3 * 10**12 + 2), (2, 3, 4)]
    frame = spark.createDataFrame(rows, "a long, l long, r long")
    got = frame.select(module.cut_score(frame.a, frame.l, frame.r)).collect()
    assert [r[0] for r in got] == [10**6 * a * a // (x * y) for a, x, y in rows]


def test_one_long_text_without_a_break(spark):
    rows = [("en", "yes no " * 200_000), ("en", " " * 300_000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = answer(collocation_query(docs))
    assert [r[2] for r in got] == ["no yes no", "yes no yes"]
    assert got == brute(rows)


def test_empty_table_and_clashing_names(spark):
    schema = "lang string, text string, bucket int, n long, phrase string, words string"
    assert collocation_query(spark.createDataFrame([], schema)).count() == 0
    rows = [("en", "so long", 1, 2, "x", "y")] * 11
    got = answer(collocation_query(spark.createDataFrame(rows, schema)))
    assert got == [("en", 1, "so long", 11, 11, 11, 22, 1_000_000)]


def test_equals_its_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    context = duckdb.connect()
    context.sql(f"CREATE VIEW documents AS SELECT * FROM '{Path(sf_dir) / 'documents.parquet'}'")
    expected = context.sql(f"SELECT {', '.join(COLUMNS)} FROM ({COLLOCATION_SQL})").fetchall()
    assert answer(collocation_query(docs)) == sorted(expected)


def test_a_full_chunk_is_counted_in_little_memory():
    """A task holds this beside its batch, and an executor has one for each core."""
    numbers = random.Random(5).choices(range(10_000, 30_000), k=module.CHUNK_BYTES // 10)
    text = b" ".join(b"word%d" % k for k in numbers)
    tracemalloc.start()
    try:
        assert sum(1 for _ in chunk_stripes("en", text, 1, 8, None)) == 8
        assert tracemalloc.get_traced_memory()[1] + module.HELD_BYTES < 100 << 20
    finally:
        tracemalloc.stop()
