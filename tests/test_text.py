from collections import Counter

import pytest
from brute import frequencies_of, words_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termpeak import normalize_documents, term_frequency, tokenize
from termpeak.functions.text import term_counts, text_pieces

CASES = [
    ("a\tb\nc d", ["abc", "d"]),
    ("don't", ["dont"]),
    ("ÉA", ["a"]),
    ("İX", ["ix"]),
    ("Kelvin K", ["kelvin", "k"]),
    (" x y", ["x", "y"]),
    ("a\0b", ["ab"]),
    ("ＡＢ", []),
    ("ΑΣ", []),
    ("ẞ ß", []),
    ("   ", []),
    ("", []),
    (" b  a b ", ["b", "a", "b"]),
    ("one\r\ntwo three", ["onetwo", "three"]),
]


@pytest.mark.parametrize(("content", "expected"), CASES)
def test_brute_force_agrees_with_the_cases(content, expected):
    assert words_of(content) == expected


def test_tokenize(docs_of):
    rows = [(str(i), content) for i, (content, _) in enumerate(CASES)]
    got = {str(i): [] for i in range(len(CASES))}
    for row in tokenize(docs_of(rows)).collect():
        got[row.filename].append(row.word)
    # one partition: words come in the order of the text
    assert got == {str(i): expected for i, (_, expected) in enumerate(CASES)}


def test_normalize_keeps_every_space(docs_of):
    (row,) = normalize_documents(docs_of([("f", " A-1  b\n c ")])).collect()
    assert (row.filename, row.normalized) == ("f", " a  b c ")


def test_capitals_are_lowered_before_the_filter(docs_of):
    (row,) = normalize_documents(docs_of([("f", "ABC")])).collect()
    assert row.normalized == "abc"


def test_term_frequency_counts_per_record(docs_of):
    rows = [("f", "b a b"), ("f", "b"), ("g", "  "), ("h", "z")]
    got = sorted(tuple(r) for r in term_frequency(docs_of(rows)).collect())
    assert got == [("f", "a", 1), ("f", "b", 1), ("f", "b", 2), ("h", "z", 1)]


def test_other_columns_can_be_kept(spark):
    docs = spark.createDataFrame([(7, "f", "x x")], "id long, name string, body string")
    got = term_frequency(docs, keep=("id", "name"), content="body").collect()
    assert [tuple(r) for r in got] == [(7, "f", "x", 2)]
    assert tokenize(docs, keep=("id",), content="body").columns == ["id", "word"]


def test_null_content_gives_no_rows(docs_of):
    docs = docs_of([("f", None), ("g", "x")])
    assert [tuple(r) for r in term_frequency(docs).collect()] == [("g", "x", 1)]
    assert [tuple(r) for r in tokenize(docs).collect()] == [("g", "x")]


def test_long_text_is_counted_whole(docs_of):
    content = "the " * 300_000 + "end " + "the " * 300_000
    got = {r.word: r.n for r in term_frequency(docs_of([("f", content)])).collect()}
    assert got == {"the": 600_000, "end": 1}


texts = st.text(
    st.one_of(
        st.sampled_from("ab AB  \n\t'éKİ"),
        st.characters(exclude_categories=["Cs"]),
    ),
    max_size=60,
)


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.tuples(st.sampled_from("pqr"), texts), max_size=30))
def test_any_text_matches_brute_force(docs_of, rows):
    docs = docs_of(rows)
    got = sorted(tuple(r) for r in term_frequency(docs).collect())
    assert got == frequencies_of(rows)
    tokens = sorted(r.word for r in tokenize(docs).collect())
    assert tokens == sorted(w for _, content in rows for w in words_of(content))


@pytest.mark.parametrize("piece, batch", [(1, 1), (3, 2), (7, 32), (64, 3)])
def test_pieces_count_as_the_whole_text(spark, piece, batch):
    texts = [
        "", " ", "a", "  a  b a ", "no-space-at-all-in-this-one", "é ü ß É a é", "x\ny z\tx y",
        "日本 語 a 日本 b", "A b C a B c " * 20, " " * 50, None, "ends in space ", "a\u00a0b a b",
    ]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, content string")
    got = docs.select("k", F.inline(term_counts(F.col("content"), piece, batch))).where("word <> ''")
    expected = sorted(
        (k, w, n) for k, t in enumerate(texts) if t for w, n in Counter(words_of(t)).items()
    )
    assert sorted(tuple(r) for r in got.collect()) == expected
    pieces = docs.select("content", text_pieces(F.col("content"), piece).alias("p")).collect()
    for content, parts in pieces:
        assert parts is None if content is None else "".join(parts) == content
        assert all(p.endswith(" ") for p in (parts or [""])[:-1])


def test_a_text_of_many_pieces(spark):
    text = " ".join(f"w{'abcdefghij'[k % 10]}{'klmnopq'[k % 7]}" for k in range(700_000))
    docs = spark.createDataFrame([("f", text)], "filename string, content string")
    assert docs.select(F.size(text_pieces(F.col("content")))).first()[0] > 2
    got = sorted(tuple(r) for r in term_frequency(docs).collect())
    assert got == frequencies_of([("f", text)])
