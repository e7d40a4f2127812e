"""Hard negatives against scoring every pair in plain Python."""

import math
import random
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from termpeak.llm import hard_negatives as module
from termpeak.llm.hard_negatives import (
    HARD_NEGATIVE_SQL,
    LEVELS,
    Block,
    Scorer,
    hard_negative_query,
    mine_hard_negatives,
    segments,
    summaries,
)

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = [
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
]


def brute(rows, every=50):
    ready = []
    for name, vector, label in rows:
        if name is None or label is None or not vector:
            continue
        if not all(x is not None and math.isfinite(x) for x in vector):
            continue
        if name % 7 == 0:
            label = (label + 1) % 10
        own = (name, tuple(math.floor(256 * float(np.float32(x))) for x in vector), label)
        if own not in ready:
            ready.append(own)
    out = []
    for name, vector, label in ready:
        if name % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, v, strict=True)), n, own)
            for n, v, own in ready
            if len(v) == len(vector)
        ]
        positives = sorted((s, n) for s, n, own in scored if own == label and n != name)[:5]
        for p, positive in positives:
            fits = sorted(
                (s, n)
                for s, n, own in scored
                if own != label and 50 * -p <= 100 * -s <= 95 * -p
            )
            out += [
                (name, positive, k + 1, n, -p, -s) for k, (s, n) in enumerate(fits[:3])
            ]
    return sorted(out)


def made_rows(seed, number=600, length=20):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 0.2) for _ in range(length)] for _ in range(6)]
    rows = []
    for k in range(number):
        centre = draw.choice(centres)
        vector = [x + draw.gauss(0, draw.choice([0.02, 0.2])) for x in centre]
        if k % 11 == 0:  # coarse values make ties
            vector = [round(4 * x) / 4 for x in vector]
        rows.append((k, [float(np.float32(x)) for x in vector], draw.choice([0, 0, 1, 2, 9])))
    return rows


def answer(frame):
    return sorted(tuple(r) for r in frame.select(COLUMNS).collect())


@pytest.mark.parametrize(("row_bytes", "anchor_bytes"), [(8 << 20, 2 << 20), (9000, 500)])
def test_equals_scoring_every_pair(spark, row_bytes, anchor_bytes):
    rows = made_rows(row_bytes)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = mine_hard_negatives(
        frame.withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")),
        F.col("vec_id") % 10 == 0,
        row_bytes=row_bytes,
        anchor_bytes=anchor_bytes,
    )
    expected = brute(rows, 10)
    assert len(expected) > 300 and answer(got) == expected


@pytest.mark.parametrize("length", [1, 3, 16, 50])
def test_bounds_hold_at_every_level(length):
    draw = np.random.default_rng(length)
    one, two = np.floor(256 * draw.normal(size=(2, 60, length)))
    exact = one @ two.T
    width = np.full(exact.shape, np.inf)
    for level in LEVELS:
        (mean, deviation), (means, deviations) = summaries(one, level), summaries(two, level)
        middle, reach = mean @ means.T, deviation @ deviations.T + 1e-6
        assert (np.abs(exact - middle) <= reach).all()
        assert (reach <= width + 1e-6).all()  # a finer level never bounds worse
        width = reach
    assert segments(length, 16)[0] == 0 and len(segments(length, 16)) == min(16, length)


def test_levels_rule_out_rows_before_exact_scoring():
    """Rows far below the limit are gone before the last level."""
    draw = np.random.default_rng(4)
    rows = np.floor(256 * np.repeat(draw.normal(size=(200, 4)), 16, axis=1))

    def block(part):
        whole = np.concatenate([s for level in LEVELS for s in summaries(part, level)], axis=1)
        return Block(
            pd.DataFrame(
                {
                    "vec_id": range(len(part)), "label": 0,
                    "vector": [r.tobytes() for r in part], "summary": [r.tobytes() for r in whole],
                }
            )
        )

    scorer = Scorer(block(rows[:1]), block(rows))
    exact = (rows[:1] @ rows.T)[0]
    low = np.sort(exact)[-5:][:1].astype(np.int64)
    who = np.zeros(1, np.int64)
    _, found, scores = scorer.scores(who, np.arange(200), low, np.array([2**62]))
    assert sorted(found) == sorted(np.argsort(-exact)[:5]) and set(scores) == set(exact[found])
    assert scorer.pruned[1] > 0.5


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 1), (0, [1.0, 0.0], 2),
        (1, [1.0, 0.0], 2), (1, [1.0, 0.0], 2), (2, [1.0, 0.0], 2), (3, [0.9, 0.0], 2),
        (4, [0.8, 0.1], 1), (5, [0.8, 0.1], 3), (6, [0.8, 0.1], 3), (8, [0.7, 0.1], 3),
        (9, None, 1), (10, [], 1), (11, [nan, 1.0], 1), (12, [inf, 1.0], 2), (13, [None, 1.0], 2),
        (None, [1.0, 0.0], 1), (15, [1.0, 0.0], None), (16, [1.0, 0.0, 0.0], 1),
        (50, [0.0, 0.0], 1), (100, [-1.0, 0.0], 4), (101, [1.0, 0.0], 4),
    ]
    got = hard_negative_query(spark.createDataFrame(rows, SCHEMA))
    expected = brute(rows)
    assert expected and answer(got) == expected


def test_large_components(spark):
    rows = [(0, [1e6, 3.0], 1), (1, [1e6, 5.0], 2), (2, [1e6, 1.0], 2), (3, [6e5, 1.0], 3)]
    doubles = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert answer(hard_negative_query(doubles)) == brute(rows)
    beyond = spark.createDataFrame([(0, [1e12], 1), (1, [1e12], 2)], doubles.schema)
    with pytest.raises(PythonException, match="do not fit 64 bits"):
        hard_negative_query(beyond).collect()


def test_a_label_of_most_rows_and_clashing_names(spark):
    rows = made_rows(8, 300)
    rows = [(n, v, 0 if n % 3 else label) for n, v, label in rows]
    frame = spark.createDataFrame(rows, SCHEMA).select(
        "*", F.lit(1).alias("key"), F.lit("x").alias("scores"), F.lit(2).alias("a.b")
    )
    got = hard_negative_query(frame)
    assert got.columns == COLUMNS and answer(got) == brute(rows)
    assert module.hard_negative_query(frame).dtypes[2] == ("rank", "int")


def test_empty_tables(spark):
    assert hard_negative_query(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negative_query(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)).count() == 0
    assert hard_negative_query(spark.createDataFrame([(50, [1.0], 1)], SCHEMA)).count() == 0


def test_equals_its_sql(spark, sf_dir):
    path = Path(sf_dir) / "embeddings.parquet"
    context = duckdb.connect()
    context.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    expected = context.sql(f"SELECT {', '.join(COLUMNS)} FROM ({HARD_NEGATIVE_SQL})").fetchall()
    assert answer(hard_negative_query(spark.read.parquet(str(path)))) == sorted(expected)
