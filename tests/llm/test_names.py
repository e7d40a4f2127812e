"""Columns that go along keep their names and values, whatever they are called."""

import pytest
from pyspark.sql import functions as F

from termpeak.llm.decontaminate import decontaminate
from termpeak.llm.line_dedup import dedup_lines
from termpeak.llm.mixing import sample_mix
from termpeak.llm.simhash import drop_near_duplicates
from termpeak.llm.toxicity import drop_toxic, labelled_sample

NAMES = [
    "a.b", "x`y", "row", "hits", "__hits", "__docs_hits", "__removed", "removed", "fp",
    "__simhash_fp", "probability", "draw", "cell", "d", "h", "n h", "find_hits",
]


@pytest.fixture
def docs(spark):
    text = "first line of this text\nsecond line number {k} is quite another\nfirst line of this text"
    rows = [(k, text.format(k=k * 7919), "en", "web") for k in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extra = [F.concat(F.lit(f"{n}:"), F.col("doc_id")).alias(n) for n in NAMES]
    return frame.select("*", *extra)


OPERATORS = {
    "decontaminate": lambda docs, bench, labels: decontaminate(docs, bench),
    "decontaminate_cut": lambda docs, bench, labels: decontaminate(docs, bench, cut=True),
    "dedup_lines": lambda docs, bench, labels: dedup_lines(docs),
    "drop_near_duplicates": lambda docs, bench, labels: drop_near_duplicates(docs),
    "sample_mix": lambda docs, bench, labels: sample_mix(docs, share=1.0),
    "drop_toxic": lambda docs, bench, labels: drop_toxic(docs, labels),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_names_and_values_pass_through(spark, docs, name):
    bench = spark.createDataFrame([(1, "nothing of this occurs")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = OPERATORS[name](docs, bench, labels)
    more = ["mix_probability"] if name == "sample_mix" else []
    assert out.columns == [*docs.columns, *more]
    rows = out.collect()
    assert rows and all(
        r[4 + k] == f"{n}:{r['doc_id']}" for r in rows for k, n in enumerate(NAMES)
    )


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_and_nulls(spark, docs, name):
    bench = spark.createDataFrame([(None, None)], "item_id long, text string")
    labels = spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int")
    assert OPERATORS[name](docs.limit(0), bench, labels).count() == 0
    nulls = docs.select(*(F.lit(None).cast(t).alias(c) for c, t in docs.dtypes)).limit(2)
    out = OPERATORS[name](nulls, bench, labels)
    assert out.count() <= 2 and out.columns[:4] == docs.columns[:4]


def test_copies_of_one_labelled_id_are_one_row_to_learn_from(spark):
    many = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("idiot").alias("text"))
    others = spark.range(100, 160).select(F.col("id").alias("doc_id"), F.lit("fine").alias("text"))
    labels = spark.createDataFrame(
        [(k, 1, int(k == 7)) for k in [7, *range(100, 160)]], "doc_id long, quality int, toxic int"
    )
    sample = labelled_sample(many.unionAll(others), labels, size=50)
    assert sample.count() <= 51 and sample.where("toxic = 1").count() <= 1
