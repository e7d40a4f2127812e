"""Token attribution and quality rules against plain loops over the same tokenizers."""

import collections
import math
import re
import statistics
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termpeak.llm.quality_rules import base_counts, judge, quality_query, script_of
from termpeak.llm.token_counts import count_sections, section_tokens, token_counts_query
from termpeak.llm.vocabularies import FOLDER, VocabularyFile

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tokenizers here")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def byte_pairs():
    return VocabularyFile.read(f"{FOLDER}/byte_bpe_50k.tiktoken").load()


@pytest.fixture(scope="module")
def pieces():
    return VocabularyFile.read(f"{FOLDER}/piece_bpe_32k.model").load()


def brute_sections(vocabulary, text, starts, rule):
    """Counts by giving every byte its section, then every token its section."""
    owner = []
    for k, c in enumerate(text):
        section = max(j for j, s in enumerate(starts) if s <= k)
        owner += [section] * len(c.encode())
    counts, crossing, at = [0] * len(starts), [0] * len(starts), 0
    for token in vocabulary.ids(text):
        mine = owner[at : at + vocabulary.width[token]]
        at += len(mine)
        shares = collections.Counter(mine)
        best = max(shares.values())
        home = mine[0] if rule == "first" else min(s for s, n in shares.items() if n == best)
        counts[home] += 1
        crossing[home] += len(shares) > 1
    assert at == len(owner)
    return counts, crossing


@settings(max_examples=150, deadline=None)
@given(st.text("ab \n.é漢😀", max_size=40), st.lists(st.integers(-2, 45), max_size=5), st.sampled_from(["first", "most"]))
def test_sections_equal_plain_loops(byte_pairs, text, offsets, rule):
    n, rows = count_sections(byte_pairs, text, offsets, rule)
    starts = [r[1] for r in rows]
    counts, crossing = brute_sections(byte_pairs, text, starts, rule)
    assert [r[3] for r in rows] == counts and [r[4] for r in rows] == crossing
    assert sum(counts) == n == len(byte_pairs.ids(text)) if text else n == 0
    assert sum(r[2] for r in rows) == len(text)


def test_query_over_the_whole_small_table(spark, sf_dir, byte_pairs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = collections.defaultdict(list)
    for r in token_counts_query(docs).collect():
        got[r["doc_id"]].append((r["section"], r["first_char"], r["n_chars"], r["n_tokens"], r["n_crossing"], r["doc_tokens"]))
    for doc_id, text in docs.select("doc_id", "text").collect():
        starts = [0] + [k + 1 for k, c in enumerate(text) if c == "\n"]
        rows = sorted(got.pop(doc_id))
        assert [r[1] for r in rows] == starts
        if len(text) < 5000:
            assert ([r[3] for r in rows], [r[4] for r in rows]) == brute_sections(byte_pairs, text, starts, "most")
        assert sum(r[3] for r in rows) == rows[0][5] == len(byte_pairs.ids(text))
    assert not got


def test_odd_sections(spark):
    rows = [(1, None, None), (2, "", [1]), (3, "a b\n", [9, None, 2, 2]), (3, "a b\n", [9, None, 2, 2]), (None, "x " * 40000, [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, section array<long>")
    out = docs.select("doc_id", section_tokens(docs, docs.text, docs.section).alias("c")).collect()
    assert sum(r["c"]["n_tokens"] == 0 for r in out) == 2 and len(out) == 5
    assert [s["n_tokens"] for s in out[2]["c"]["sections"]] == [2, 0, 1, 0]
    assert token_counts_query(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        section_tokens(docs, docs.text, rule="last")


def brute_base(text):
    words = WORDS.findall(text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            repeated += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(hit))


@settings(max_examples=200, deadline=None)
@given(st.text("ab #|\n\t\x0b\x85　é", max_size=60))
def test_base_counts_equal_plain_loops(text):
    assert base_counts(text) == brute_base(text)


def entropy(ids):
    counts = collections.Counter(ids.tolist()).values()
    return -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts)


def brute_script(text):
    named = collections.Counter()
    for c in text or "":
        o = ord(c)
        if c.isascii() and c.isalpha() or 0xC0 <= o < 0x250 or 0x1E00 <= o < 0x1F00:
            named["latin"] += 1
        elif 0x370 <= o < 0x400:
            named["greek"] += 1
        elif 0x400 <= o < 0x530:
            named["cyrillic"] += 1
        elif 0x3400 <= o < 0xA000:
            named["han"] += 1
    return min(named, key=lambda n: (-named[n], n)) if named else ""


def brute_judgement(rows, vocabularies, spreads=4.5, fewest=30):
    floors, steps = (0.02, 0.01, 0.05), (1000, 2000, 400)
    measured = []
    for lang, text in rows:
        base = brute_base(text)
        figures = []
        for v in vocabularies:
            ids = v.ids(text or "")
            n = len(ids)
            figures += [len(text) / n, sum(bool(v.bare_byte[k]) for k in ids) / n, entropy(ids)] if n else [0.0] * 3
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        key = (lang or "", int(math.log2(max(1, base[0]))), brute_script(text))
        measured.append((base, figures, failed, key))
    judged = [m for m in measured if not m[2]]

    def band_of(key):
        lang, size, script = key
        own = collections.defaultdict(list)
        for m in judged:
            if m[3][0] == lang:
                own[m[3][1]].append(m[1])
        large = [s for s in own if len(own[s]) >= fewest]
        if large:
            return own[min(large, key=lambda s: (abs(s - size), -s))]
        for same in (lambda k: k[0] == lang, lambda k: k[2] == script):
            found = [m[1] for m in judged if same(m[3])]
            if len(found) >= fewest:
                return found
        return [m[1] for m in judged]

    def quartiles(k, values):
        step = steps[k % 3]
        ordered = sorted(math.floor(x * step) for x in values)
        return [ordered[max(0, math.ceil(p * len(ordered)) - 1)] / step for p in (0.25, 0.5, 0.75)]

    bands = {}
    for key in {m[3] for m in judged}:
        bands[key] = [quartiles(k, x) for k, x in enumerate(zip(*band_of(key)))]
    out = []
    for base, figures, failed, key in measured:
        kept = not failed
        for k, (x, q) in enumerate(zip(figures, bands.get(key, []))):
            spread = max((q[2] - q[0]) / 1.349, floors[k % 3])
            if k % 3 != 2 and x > q[1] + spreads * spread or k % 3 != 1 and x < q[1] - spreads * spread:
                kept = False
        out.append((*base, failed, kept, figures))
    return out


def test_judgement_equals_plain_loops(spark, byte_pairs, pieces):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "lang", "text").collect()
    expected = brute_judgement([(r[1], r[2]) for r in rows], [byte_pairs, pieces])
    got = {r["doc_id"]: r for r in quality_query(docs).collect()}
    for row, e in zip(rows, expected):
        g = got[row[0]]
        assert tuple(g[1:8]) == e[:7], row[0]
        assert np.allclose([g["chars_per_token"], g["token_entropy"], g["byte_share"]], [e[7][0], e[7][2], e[7][4]])
    assert 0 < sum(e[6] for e in expected) < len(expected)
    assert any(not e[5] and not e[6] for e in expected)


def test_thin_classes_are_judged_by_the_next_band(spark, byte_pairs, pieces):
    """Garbage goes whatever its language, length and script, on a table of any size."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    garbage = " ".join(f"{k * 7919 % 10**9:x}{chr(0x4E00 + k)}zq{k}" for k in range(90))
    words = " ".join(f"слово{k % 97} и{k}" for k in range(120))
    rows += [("xx", garbage), ("en", " ".join([garbage, *(f"{k:x}#q" for k in range(9000))])), (None, garbage), ("ru", words)]
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    expected = brute_judgement(rows, [byte_pairs, pieces])
    got = {r["doc_id"]: r["kept"] for r in quality_query(frame).collect()}
    assert [got[k] for k in range(len(rows))] == [e[6] for e in expected]
    assert not any(e[6] for e in expected[-4:-1])
    few = brute_judgement(rows[-4:], [byte_pairs, pieces])
    small = quality_query(frame.where(frame.doc_id >= len(rows) - 4)).orderBy("doc_id").collect()
    assert [r["kept"] for r in small] == [e[6] for e in few]


@pytest.mark.parametrize("text", ["", "123 !", "abc дом", "дом б a", "漢字 ab", "éß", "αβγ ab", "a\ud800b"])
def test_scripts(text):
    assert script_of(text) == brute_script(text)


def test_odd_documents(spark):
    rows = [(1, None, None, 1), (2, "", "en", 1), (None, "word " * 60, "en", 1), (3, "x" * 100000, None, 1), (3, "x" * 100000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int")
    out = judge(docs).collect()
    assert len(out) == 5 and all(r["base_failed"] and not r["kept"] for r in out)
    assert quality_query(docs.limit(0)).count() == 0
    assert statistics.mean(r["m"]["n_words"] for r in out) == (0 + 0 + 60 + 1 + 1) / 5


@settings(max_examples=300, deadline=None)
@given(st.text(" \n\t\x85\u2003\x1ca'1.é", max_size=30))
def test_runs_taken_out_give_the_same_tokens(byte_pairs, text):
    whole = byte_pairs._encoding.encode_ordinary(text)
    for longest in (2, 3, 7):
        assert byte_pairs._tokens(text, longest) == whole


@pytest.mark.parametrize("character", [" ", "\n", "x", "\u3000", "é"])
def test_runs_of_two_million(spark, byte_pairs, pieces, character):
    text = f"a{character * 2_000_000}b"
    assert len(byte_pairs.ids(text)) > 60_000 and byte_pairs.width[byte_pairs.ids(text)].sum() == len(text.encode())
    assert len(pieces.ids(text)) > 2
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    rows = token_counts_query(docs).groupBy().sum("n_tokens").first()
    assert rows[0] == len(byte_pairs.ids(text))
    (row,) = quality_query(docs).collect()
    assert row["base_failed"] and row["word_chars"] == len(re.sub("[\x20\x09-\x0d]", "", text))
