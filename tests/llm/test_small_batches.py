"""What a Python worker is sent at a time."""

import pandas as pd
import pytest

from termpeak.llm import decontaminate, simhash
from termpeak.llm.common import BATCH_ROWS, small_batches
from termpeak.llm.mixing import sample_mix

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def sizes_of(spark):
    def count(frames):
        yield pd.DataFrame({"n": [len(f) for f in frames]})

    return [r["n"] for r in spark.range(0, 5000, 1, 1).mapInPandas(count, "n int").collect()]


def test_batches_are_small_within_only(spark):
    before = spark.conf.get(ROWS)
    assert max(sizes_of(spark)) == 5000
    with small_batches(spark):
        found = sizes_of(spark)
        assert sum(found) == 5000
        assert max(found) <= BATCH_ROWS
    assert spark.conf.get(ROWS) == before


def test_a_smaller_setting_stays(spark):
    spark.conf.set(ROWS, "7")
    try:
        with small_batches(spark):
            assert max(sizes_of(spark)) == 7
        assert spark.conf.get(ROWS) == "7"
    finally:
        spark.conf.unset(ROWS)


@pytest.fixture
def noted(monkeypatch):
    """The modules that ran something in small batches."""
    found = []
    for module in (decontaminate, simhash):

        def batches(session, name=module.__name__):
            found.append(name)
            return small_batches(session)

        monkeypatch.setattr(module, "small_batches", batches)
    return found


def test_stages_send_whole_texts_in_small_batches(spark, noted):
    docs = spark.createDataFrame([(1, "some words"), (2, "others"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    cut = decontaminate.decontaminate(docs, items, cut=True)
    assert noted == [decontaminate.__name__]
    assert "Python" not in cut._jdf.queryExecution().toString()
    assert sorted(cut.collect(), key=str) == sorted(docs.collect(), key=str)
    assert simhash.drop_near_duplicates(docs).count() == 3
    assert noted[1:] == [simhash.__name__]


def test_mixing_runs_no_python_worker(spark):
    """Its small table came out of Python workers, beside those idle from the stages before."""
    docs = spark.range(20).selectExpr("id AS doc_id", "'a b' AS text", "'src0' AS source", "'en' AS lang")
    plan = sample_mix(docs)._jdf.queryExecution().toString()
    assert "LocalTableScan" in plan or "LocalRelation" in plan
    assert "ExistingRDD" not in plan and "Python" not in plan
