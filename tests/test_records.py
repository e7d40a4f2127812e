import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from termpeak import decode_documents, encode_documents, quarantine_documents

GOOD = '{"filename":"a","content":"x"}'
ACCEPTED = {
    '{"filename":"a","content":"x y"}': ("a", "x y"),
    '{"filename":"a","filename":"b","content":"x"}': ("b", "x"),
    '{"filename":null,"filename":"b","content":"x"}': ("b", "x"),
    '{"content":{"k":1,"k":2},"content":"x","filename":"q"}': ("q", "x"),
    '  {"content":"x","filename":"a"}\t\r': ("a", "x"),
    '{"filename":"","content":""}': ("", ""),
    '{"filename":"true","content":"12"}': ("true", "12"),
    '{"filename":"a","content":"2020-01-01"}': ("a", "2020-01-01"),
    '{"filename":"a","content":"}]"}': ("a", "}]"),
    '{"filename":"a","content":"\\u00c9\\/\\n\\u0000"}': ("a", "É/\n\0"),
    '{"filename":"a","content":"x","more":[1,{"filename":2}],"":NaN}': ("a", "x"),
    '{"filename":"a","content":"x","more":{"k":1,"k":2}}': ("a", "x"),
    '{"filename":"a","content":"x","more":-Infinity}': ("a", "x"),
    '{"filename":"a","content":"x","more":' + "1" * 3000 + "}": ("a", "x"),
    '{"filename":"a","content":"x","more":' + "[" * 999 + "]" * 999 + "}": ("a", "x"),
    '{"filename":"a","content":"x","more":' + "[" * 5000 + "]" * 5000 + "}": ("a", "x"),
    '{"filename":"a","content":"x","more":1.' + "1" * 100_002 + "}": ("a", "x"),
    '{"filename":"a","content":"x","more":{"' + "k" * 50_000 + '":1}}': ("a", "x"),
    '{"more":{"filename":"z"},"filename":"a","content":"x"}': ("a", "x"),
}
REJECTED = [
    '{"filename":"a"}',
    '{"content":"a"}',
    '{"Filename":"a","content":"x"}',
    '{"filename":"a","content":null}',
    '{"filename":"b","filename":null,"content":"x"}',
    '{"filename":"a","content":{"k":1}}',
    '{"filename":"a","content":["x"]}',
    '{"filename":"a","content":true}',
    '{"filename":5,"content":"x"}',
    "",
    " ",
    '{"filename":"a"',
    '["a"]',
    '"a"',
    "5",
    "null",
    "{}",
    f"[{GOOD}]",
    f"{GOOD} junk",
    f"{GOOD},",
    f"{GOOD},{GOOD}",
    f"{GOOD}{GOOD}",
    f"{GOOD}}}",
    f"{GOOD}]",
    f"{GOOD}] junk",
    f"{GOOD}\n]",
    f"{GOOD}],[1]",
    f'{GOOD},{{"end":true}}]',
    f"{GOOD} // note",
    f"﻿{GOOD}",
    f" {GOOD}",
    f"{GOOD}\0",
    "{'filename':'a','content':'x'}",
    '{filename:"a","content":"x"}',
    '{"filename":"a" "content":"x"}',
    '{"filename":"a","content":"x",}',
    '{"filename":"a","content":"x","more":01}',
    '{"filename":"a","content":"x","more":.5}',
    '{"filename":"a","content":"x","more":tru}',
    '{"filename":"a","content":"x","more":[1,]}',
    '{"filename":"a","content":"x","more":"\\u12"}',
    '{"filename":"a","content":"x\ty"}',
    '{"filename":"a","content":"x\\qy"}',
]


def python_verdict(line):
    """What a plain reading in Python makes of a line: the fields, or None."""
    try:
        record = json.loads(line)
        filename, content = record["filename"], record["content"]
    except (ValueError, KeyError, TypeError):
        return None
    both_text = isinstance(filename, str) and isinstance(content, str)
    return (filename, content) if both_text else None


def lines_df(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_the_cases_follow_python():
    assert {line: python_verdict(line) for line in ACCEPTED} == ACCEPTED
    assert [python_verdict(line) for line in REJECTED] == [None] * len(REJECTED)


def test_well_formed_lines_are_decoded(spark):
    got = decode_documents(lines_df(spark, ACCEPTED)).collect()
    assert sorted(tuple(r) for r in got) == sorted(ACCEPTED.values())


@pytest.mark.parametrize(
    ("more", "accepted"),
    [
        ("[" * 19_990 + "]" * 19_990, True),
        ("[" * 20_000 + "]" * 20_000, False),
        ("1." + "1" * 999_990, True),
        ("1." + "1" * 1_000_001, False),
        ("1" * 5000, True),
        ('{"' + "k" * 50_000 + '":1}', True),
        ('{"' + "k" * 50_001 + '":1}', False),
        ("-INF", True),
        ("+INF", True),
    ],
)
def test_limits_that_stay(spark, more, accepted):
    """Both sides of each limit of Spark's parser named in the README."""
    line = f'{{"filename":"a","content":"x","more":{more}}}'
    docs, rejects = quarantine_documents(lines_df(spark, [line]))
    assert (docs.count(), rejects.count()) == ((1, 0) if accepted else (0, 1))


def test_quarantine_splits_good_from_bad(spark):
    docs, rejects = quarantine_documents(lines_df(spark, [*ACCEPTED, *REJECTED]))
    assert sorted(tuple(r) for r in docs.collect()) == sorted(ACCEPTED.values())
    assert sorted(r.line for r in rejects.collect()) == sorted(REJECTED)


@pytest.mark.parametrize("bad", ["", '{"filename":"a"}', f"{GOOD}] junk"])
def test_one_malformed_line_fails_the_job(spark, bad):
    docs = decode_documents(lines_df(spark, [GOOD, bad, GOOD]))
    with pytest.raises(PySparkException, match="malformed document record"):
        docs.collect()


def test_counting_checks_the_lines_too(spark):
    docs = decode_documents(lines_df(spark, [GOOD, "{}"]))
    with pytest.raises(PySparkException, match="malformed document record"):
        docs.count()


def long_line(spark, before, unit, repeats, after):
    """One line, built on the executor: a constant would be written into the plan."""
    body = F.repeat(F.lit(unit), (F.col("id") + repeats).cast("int"))
    start = F.lit(f'{{"filename":"a","content":{before}')
    line = F.concat(start, body, F.lit(f"{after}}}"))
    return spark.range(1).select(line.alias("value"))


def test_content_far_beyond_the_parser_default_is_whole(spark):
    repeats = 40 * 131072
    docs = decode_documents(long_line(spark, '"', "abcdefg ", repeats, '"'))
    assert docs.select(F.length("content").alias("n")).first().n == 8 * repeats


@pytest.mark.parametrize("limit", [0, 2**31 - 1])
def test_short_and_long_lines_get_the_same_verdicts(spark, monkeypatch, limit):
    monkeypatch.setattr("termpeak.functions.records.VARIANT_LIMIT", limit)
    docs, rejects = quarantine_documents(lines_df(spark, [*ACCEPTED, *REJECTED]))
    assert sorted(tuple(r) for r in docs.collect()) == sorted(ACCEPTED.values())
    assert sorted(r.line for r in rejects.collect()) == sorted(REJECTED)


@pytest.mark.parametrize(
    ("before", "unit", "after", "valid"),
    [
        ('"', "abcdefg ", '"', True),
        ('["', "abcdefg ", '"]', False),
        ('{"k":"', "abcdefg ", '"}', False),
        ("1", "23456789", "", False),
    ],
)
def test_fields_beyond_the_variant_limit(spark, before, unit, after, valid):
    repeats = 129 * 2**17
    docs, rejects = quarantine_documents(long_line(spark, before, unit, repeats, after))
    lengths = [r.n for r in docs.select(F.length("content").alias("n")).collect()]
    assert lengths == ([8 * repeats] if valid else [])
    assert rejects.select(F.length("line")).count() == (0 if valid else 1)


json_values = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(), st.floats(), st.text("a}]{[,\":é ")),
    lambda inner: st.lists(inner, max_size=2)
    | st.dictionaries(st.sampled_from(["filename", "content", "k"]), inner, max_size=3),
    max_leaves=5,
)
tails = st.sampled_from(["", "", "", " ", "]", "}", "] x", ",", ",{}", ',{"k":true}]', '"'])


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(
            st.dictionaries(st.sampled_from(["filename", "content", "k"]), json_values),
            tails,
        ),
        min_size=1,
        max_size=40,
    )
)
def test_verdicts_match_python(spark, parts):
    lines = [json.dumps(value) + tail for value, tail in parts]
    lines += [
        json.dumps({"filename": "f", "content": "c", **value}) + tail
        for value, tail in parts
    ]
    docs, rejects = quarantine_documents(lines_df(spark, lines))
    verdicts = [python_verdict(line) for line in lines]
    assert sorted(tuple(r) for r in docs.collect()) == sorted(v for v in verdicts if v)
    assert sorted(r.line for r in rejects.collect()) == sorted(
        line for line, verdict in zip(lines, verdicts, strict=True) if verdict is None
    )


def test_encode_then_decode_is_the_identity(spark, docs_of):
    rows = [("a", 'q" \\ / \n\t\r\0 é \U0001f600'), ("b", ""), ("", "x")]
    docs = decode_documents(encode_documents(docs_of(rows)))
    assert sorted(tuple(r) for r in docs.collect()) == sorted(rows)
