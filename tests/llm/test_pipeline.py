"""The pipeline, stage by stage, against brute force on the smallest tables."""

import pytest
from test_decontaminate import brute as brute_hits
from test_line_dedup import brute as brute_lines
from test_mixing import brute as brute_mix
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from termpeak.llm.mixing import TARGETS, mixing_query
from termpeak.llm.toxicity import toxicity_query

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(frame):
    return {r["doc_id"]: r.asDict() for r in frame.collect()}


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The frame before each stage and the one after it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        path = str(tmp_path_factory.mktemp("stages") / name)
        after.write.parquet(path)
        out[name] = docs, docs = docs, spark.read.parquet(path)
    return out


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "decontamination", "mixing"]
    assert all(b.columns == COLUMNS for b, _ in stages.values())


def test_toxicity(spark, stages, sf_dir):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = toxicity_query(before, labels).where("predicted = 0").select("doc_id")
    kept = rows_of(after)
    assert set(kept) == {r[0] for r in clean.collect()} != set()
    assert all(kept[k] == v for k, v in rows_of(before).items() if k in kept)


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    old, new = rows_of(before), rows_of(after)
    texts = brute_lines([(k, v["text"]) for k, v in old.items()])
    assert new == {
        k: v | {"text": texts[k][0], "n_chars": len(texts[k][0])} for k, v in old.items()
    }
    assert any(texts[k][1] for k in texts)


def test_simhash(stages):
    before, after = stages["simhash"]
    old = rows_of(before)
    component = brute_components([(k, brute_fingerprint(v["text"])) for k, v in old.items()])
    assert rows_of(after) == {k: v for k, v in old.items() if component[k] == k}


def test_decontamination(spark, stages, sf_dir):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = {}
    for k, v in rows_of(before).items():
        n, hit, _ = brute_hits(v["text"], items)
        if not (hit and 20 * hit >= n):
            expected[k] = v
    assert rows_of(after) == expected


def test_decontamination_cuts_hits_below_its_coverage(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 20").first()["text"]
    text = "filler " * 20000 + item
    docs = spark.createDataFrame([(1, text, "en", "src0", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = corpus_pipeline.decontamination(spark, docs, sf_dir).collect()
    assert row["text"].startswith("filler " * 20000) and item not in row["text"]
    assert row["n_chars"] == len(row["text"]) < len(text)


def test_mixing(stages):
    before, after = stages["mixing"]
    cells = mixing_query(before).collect()
    chance = brute_mix([((r["source"], r["lang"], r["topic"]), r["n_tokens"]) for r in cells], TARGETS)
    assert rows_of(after).keys() == {r["doc_id"] for r in cells if r["sampled"]}
    by_id = {r["doc_id"]: chance.get((r["source"], r["lang"], r["topic"]), 1.0) for r in cells}
    for k, v in rows_of(after).items():
        assert v["probability"] == pytest.approx(by_id[k], rel=1e-4)


def test_run_gives_the_last_stage(spark, stages, sf_dir):
    got = rows_of(corpus_pipeline.run(spark, sf_dir))
    assert got.keys() == rows_of(stages["mixing"][1]).keys()


def tables_in(spark, folder, docs, items, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_over_nulls_and_odd_names(spark, tmp_path):
    text = "a line of some words here\nanother line with other words in it\n"
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, None, "en", "s", 0)]
    rows += [(2, "", None, "s", 0), (3, text, None, None, None), (None, text + "its own end of it all", "xx", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS `a.b`", "1 AS hits", "2 AS row")
    out = corpus_pipeline.run(spark, tables_in(spark, tmp_path, docs, [(None, None)], [(None, None, None)]))
    assert out.columns == [*docs.columns, "probability"]
    got = out.collect()
    assert len(got) <= 4 and all(r["a.b"] == "x" and r["row"] == 2 for r in got)
    assert {r["doc_id"] for r in got} <= {None, 1, 2, 3}


def test_run_over_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    assert corpus_pipeline.run(spark, tables_in(spark, tmp_path, docs, [], [])).count() == 0
