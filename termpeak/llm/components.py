"""Connected components of a graph given as edges between longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpeak.llm.common import checkpointed


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (smallest node of its component) of every node in ``edges``.

    ``edges`` has ``src`` and ``dst``. Large-star and small-star steps in turn:
    each round hangs every node's larger neighbours, then its smaller ones, below
    the smallest node it sees, until the graph is a set of stars. All of it is
    joins and minima with a map-side stage; each round is checkpointed, so a lost
    executor costs at most one round. No edges give no rows.
    """
    forest = checkpointed(
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
        .distinct()
    )
    if forest.isEmpty():
        return forest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    state = _state(forest)
    for _ in range(rounds):
        forest = checkpointed(_small_star(_large_star(forest)))
        after = _state(forest)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = forest.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return forest.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _state(forest: DataFrame) -> tuple:
    row = forest.agg(
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
    ).first()
    return tuple(row)


def _large_star(forest: DataFrame) -> DataFrame:
    both = forest.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        forest.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
        .distinct()
    )


def _small_star(forest: DataFrame) -> DataFrame:
    least = forest.groupBy("a").agg(F.min("b").alias("m"))
    joined = forest.join(least, "a")
    return (
        joined.where("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionAll(least.select("a", F.col("m").alias("b")))
        .distinct()
    )
