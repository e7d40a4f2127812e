"""Automaton hits against looking for every window in every document."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termpeak.llm.decontaminate import (
    SuffixAutomaton,
    decontaminate,
    decontamination_query,
    find_hits,
    without_spans,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return re.findall(pattern, (text or "").translate(LOWER))


def brute(text, items, window=13):
    words = words_of(text)
    marked, found = set(), set()
    for name, item in items:
        own = words_of(item)
        size = min(window, len(own))
        runs = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if size else set()
        for k in range(len(words) - size + 1):
            if size and tuple(words[k : k + size]) in runs:
                marked |= set(range(k, k + size))
                found.add(name)
    return len(words), len(marked), found


def row_of(doc_id, text, items):
    n, hit, found = brute(text, items)
    names = sorted(str(x) for x in found if x is not None)
    digest = hashlib.sha256(",".join(names).encode()).hexdigest()
    return (doc_id, n, hit, len(names), digest, hit > 0 and 20 * hit >= n)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab ", max_size=14), max_size=5), st.text("ab ", max_size=60), st.integers(1, 4))
def test_automaton_finds_every_window(items, text, window):
    named = [(str(k), t) for k, t in enumerate(items)]
    spans, found = SuffixAutomaton(named, window).hits([w.encode() for w in words_of(text)])
    n, hit, expected = brute(text, named, window)
    assert sum(b - a + 1 for a, b in spans) == hit and found == expected
    assert all(x[1] + 1 < y[0] for x, y in zip(spans, spans[1:]))


def test_whole_small_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r[0], r[1]) for r in bench.select("item_id", "text").collect()]
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, decontamination_query(docs, bench).collect()))
    assert got == sorted(row_of(i, t, items) for i, t in rows)
    assert any(r[-1] for r in got)


def odd_tables(spark):
    draw = random.Random(3)
    long = [draw.choice("abcdefgh") for _ in range(400)]
    items = [(10, " ".join(long[:40])), (9, "Kurz, Satz!"), (9, "anders hier"), (None, "namenlos ganz"),
             (8, None), (7, " .,"), (9, "Kurz, Satz!")]
    docs = [(1, " ".join(long)), (2, None), (3, ""), (4, "kurz satz"), (4, "kurz satz"), (None, "so kurz-Satz da"),
            (5, "namenlos ganz allein"), (6, "x " * 30000 + "kurz satz"), (7, "É kurz satz")]
    return (
        spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, hits int"),
        spark.createDataFrame(items, "item_id long, text string"),
        docs,
        items,
    )


def test_odd_rows_in_one_block_and_in_several(spark):
    docs, bench, texts, items = odd_tables(spark)
    key = lambda r: tuple((x is not None, x) for x in r)
    expected = sorted((row_of(i, t, items) for i, t in texts), key=key)
    assert sorted(map(tuple, decontamination_query(docs, bench).collect()), key=key) == expected
    split = find_hits(docs.drop("hits"), bench, block_bytes=60).selectExpr(
        "doc_id", "hits.n_words", "hits.n_hit", "cast(size(hits.items) as bigint)",
        "sha2(array_join(hits.items, ','), 256)", "hits.n_hit > 0 and 20 * hits.n_hit >= hits.n_words",
    )
    assert sorted(map(tuple, split.collect()), key=key) == expected


def test_stage_drops_only_contaminated(spark):
    docs, bench, texts, items = odd_tables(spark)
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns
    clean = [(i, t) for i, t in texts if not row_of(i, t, items)[-1]]
    assert sorted(map(str, ((r[0], r[1]) for r in kept.collect()))) == sorted(map(str, clean))


def test_spans_are_cut_out():
    text = "Ä, b; c-d (e) f."
    assert without_spans(text, [(1, 2)]) == "Ä, \n-d (e) f."
    assert without_spans(text, [(4, 5), (0, 1), (1, 1)]) == "\n; c-d (\n."
    assert without_spans(text, [(0, 5)]) == "\n." and without_spans(text, []) == text


def test_hits_below_the_coverage_are_cut(spark, monkeypatch):
    docs, bench, texts, items = odd_tables(spark)
    filler = "lang und breit " * 400
    texts = [*texts, (8, f"{filler}Kurz, Satz! {filler}{items[0][1]}. Ende"), (8, None)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], docs.schema)
    for block in (4 << 20, 60):
        monkeypatch.setattr("termpeak.llm.decontaminate.find_hits", lambda d, b: find_hits(d, b, block_bytes=block))
        kept = decontaminate(docs, bench, cut=True)
        got = [tuple(r) for r in kept.collect()]
        assert kept.columns == docs.columns
        assert all(brute(t, items)[1] == 0 for _, t, _ in got)
        clean = [(i, t, 1) for i, t in texts if not brute(t, items)[1]]
        changed = {6: "x " * 30000 + "\n", 8: f"{filler}\n! {filler}\n. Ende"}
        expected = clean + [(i, t, 1) for i, t in changed.items()]
        assert sorted(map(str, got)) == sorted(map(str, expected))


@pytest.mark.parametrize("block", [4 << 20, 60])
def test_what_a_cut_brings_together_is_cut_too(spark, monkeypatch, block):
    """Half a window, a whole item, the other half: after one cut the halves are a hit."""
    one = [f"one{k}" for k in range(13)]
    two = [f"two{k}" for k in range(13)]
    filler = "lang und breit " * 600
    text = f"{filler}{' '.join(one[:6])} {' '.join(two)} {' '.join(one[6:])} {filler}"
    items = [(1, " ".join(one)), (2, " ".join(two)), (3, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, text), (2, filler), (3, None)], "doc_id long, text string")
    monkeypatch.setattr("termpeak.llm.decontaminate.BLOCK_BYTES", block)
    monkeypatch.setattr("termpeak.llm.decontaminate.find_hits", lambda d, b: find_hits(d, b, block_bytes=block))
    got = {r[0]: r[1] for r in decontaminate(docs, bench, cut=True).collect()}
    assert brute(got[1], items)[1] == 0 and "one" not in got[1] and "two" not in got[1]
    assert got[1].split() == (filler * 2).split() and got[2] == filler and got[3] is None


def test_empty_tables(spark):
    docs, bench, texts, _ = odd_tables(spark)
    assert find_hits(docs.drop("hits").limit(0), bench).count() == 0
    none = find_hits(docs.drop("hits"), bench.limit(0))
    assert none.where("hits.n_hit > 0").count() == 0 and none.count() == len(texts)
