"""Mixing sources to target weights by iterative proportional fitting.

Method. Documents fall into cells, one for each combination of source, language and
topic. The tokens of the cells are raked: scaled to the target share of each source,
then of each language, then of each topic, again and again until all three hold. A
document is then kept with the probability of its cell, which is the raked weight
over the tokens the cell has. The weights add up to ``SHARE`` of all tokens, and none
is more than its cell's tokens: a cell that would need more is kept whole. So the
expected tokens of the sample have the target shares, as far as there are tokens.

The draw is a hash of the id and the text, not a random number: any rerun, and any
recomputation after a lost executor, keeps the same documents.

Scale. Two scans. Tokens are summed by cell with a map-side stage, so a source with
a third of all rows is one row per task. Categories that no target names fall into
``OTHER``; so there are at most as many cells as combinations of targets, which is
checked against ``MAX_CELLS`` before they reach the driver or are broadcast.

Defined results: null categories are ``OTHER``; null and empty texts have no tokens
and are kept with the probability of their cell, or with ``1`` if the whole cell has
none. Targets need not add up to one, and those for which there are no tokens are
left out of the sum. A category whose target is zero, or that falls into ``OTHER``
where no target for that is given, has probability zero. Repeated rows fare alike.
"""

from __future__ import annotations

from functools import reduce
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpeak.functions.binding import let
from termpeak.llm.common import carried, checkpointed

OTHER = "*"
MAX_CELLS = 100_000
ROUNDS = 500
SHARE = 0.7  # of all tokens, in the sample
TOLERANCE = 1e-10
SEED = 20_240

Targets = dict[str, dict[str, float]]

# Production weights: the large source and English give way to the others.
TARGETS: Targets = {
    "source": {"src0": 0.25} | {f"src{k}": 0.0375 for k in range(1, 20)} | {OTHER: 0.0375},
    "lang": {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11, OTHER: 0.02},
    "topic": {"legal": 0.05, "contact": 0.05, "symbols": 0.05, "prose": 0.85},
}


# In lower case, what every match of the words of the law contains: a search for plain
# substrings costs far less than the pattern, which only the texts with one of them need.
_LAW_PARTS = ("licen", "rights reserved", "copyright")
_LAW = r"(?i)\b(?:licen[cs]ed?|rights reserved|copyright)\b"
_SIGNS = "#*$%&|<>=!"


def topic(text: Column) -> Column:
    """A topic by rule, the first that applies: words of the law, an address or a
    number to call, one sign among ten characters or more, else prose."""
    text = F.coalesce(text, F.lit(""))

    def has(lowered: Column) -> Column:
        return reduce(Column.__or__, [F.contains(lowered, F.lit(p)) for p in _LAW_PARTS])

    law = let(F.lower(text), has) & text.rlike(_LAW)
    touch = (F.contains(text, F.lit("@")) & text.rlike(r"[\w.+-]@[\w-]+\.\w")) | (
        F.contains(text, F.lit("(")) & text.rlike(r"\(\d{3}\) \d{3}-\d{4}")
    )
    # signs are one byte each; taking them out one by one is cheaper than a pattern
    plain = reduce(lambda t, sign: F.replace(t, F.lit(sign), F.lit("")), _SIGNS, text)
    signs = F.octet_length(text) - F.octet_length(plain)
    return (
        F.when(law, "legal")
        .when(touch, "contact")
        .when(let(signs, lambda n: (n > 0) & (10 * n >= F.length(text))), "symbols")
        .otherwise("prose")
    )


def token_count(text: Column) -> Column:
    """Words of a text, as runs of anything but white space."""
    return F.coalesce(
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)
    ).cast("bigint")


def rake(
    tokens: np.ndarray, targets: list[np.ndarray], share: float = SHARE, rounds: int = ROUNDS
) -> np.ndarray:
    """Weights of the cells of a table, at most their tokens, with margins as the targets.

    All weights together are ``share`` of the tokens. A cell that would need more than
    it has gets all it has, and the others of its margin make up for it if they can.
    """
    weights = share * tokens.astype(float)
    total = weights.sum()
    axes = range(weights.ndim)
    goals = []
    for axis in axes:
        there = tokens.sum(axis=tuple(a for a in axes if a != axis)) > 0
        goal = np.where(there, targets[axis], 0.0)
        goals.append(total * goal / goal.sum() if goal.sum() else goal)
    for _ in range(rounds):
        before = weights
        for axis, goal in zip(axes, goals, strict=True):
            margin = weights.sum(axis=tuple(a for a in axes if a != axis))
            factor = np.divide(goal, margin, out=np.zeros_like(goal), where=margin > 0)
            shape = [1] * weights.ndim
            shape[axis] = -1
            weights = np.minimum(weights * factor.reshape(shape), tokens)
        if np.abs(weights - before).max(initial=0.0) <= TOLERANCE * total:
            break
    return weights


def _category(column: Column, names: list[str]) -> Column:
    return F.when(column.isin(names), column).otherwise(F.lit(OTHER))


def cell_probabilities(
    cells: list[tuple], targets: Targets, share: float = SHARE
) -> list[tuple]:
    """Cells with their tokens, in any order, as cells with their probability."""
    names = [[*dict.fromkeys([*goal, OTHER])] for goal in targets.values()]
    places = [{name: k for k, name in enumerate(own)} for own in names]
    tokens = np.zeros([len(own) for own in names])
    for *cell, n in cells:
        tokens[tuple(p[c] for p, c in zip(places, cell, strict=True))] += n
    goals = [
        np.array([goal.get(name, 0.0) for name in own])
        for goal, own in zip(targets.values(), names, strict=True)
    ]
    weights = rake(tokens, goals, share)
    ratio = np.divide(weights, tokens, out=np.zeros_like(weights), where=tokens > 0)
    out = []
    for *cell, _ in cells:
        at = tuple(p[c] for p, c in zip(places, cell, strict=True))
        wanted = all(g[k] > 0 for g, k in zip(goals, at, strict=True))
        chance = float(ratio[at]) if tokens[at] else float(wanted)
        out.append((*cell, chance))
    return out


def _cells(docs: DataFrame, targets: Targets) -> Column:
    """The category of each dimension."""
    sizes = [len({*goal, OTHER}) for goal in targets.values()]
    if prod(sizes) > MAX_CELLS:
        raise ValueError(f"{prod(sizes)} combinations of targets; at most {MAX_CELLS}")
    return F.struct(
        *(
            _category(
                topic(F.col("text")) if name == "topic" else F.col(name).cast("string"),
                [c for c in goal if c != OTHER],
            ).alias(name)
            for name, goal in targets.items()
        )
    )


def _draw(seed: int) -> Column:
    """A number from 0 to 1 that depends on the id and the text alone."""
    hashed = F.xxhash64(F.lit(seed), "doc_id", "text")
    return F.shiftrightunsigned(hashed, 11) / F.lit(2.0**53)


def _with_probability(
    marked: DataFrame, targets: Targets, share: float, cell: str, chance: str
) -> DataFrame:
    """``marked`` with the probability of its cell, from the tokens of all its rows."""
    names = list(targets)
    sums = marked.groupBy(*(F.col(f"{cell}.{n}").alias(n) for n in names)).agg(
        F.sum(f"{cell}_tokens").alias("n")
    )
    chances = cell_probabilities([tuple(r) for r in sums.collect()], targets, share)
    kind = pa.struct([(n, pa.string()) for n in names])
    cells = pa.array([dict(zip(names, c, strict=False)) for c in chances], kind)
    values = pa.array([c[-1] for c in chances], pa.float64())
    # as Arrow: a list of rows would be read by Python workers, with the texts' join to come
    table = marked.sparkSession.createDataFrame(
        pa.table({"__mix_cell": cells, chance: values})
    )
    # at most MAX_CELLS rows
    joined = marked.join(F.broadcast(table), F.col(cell) == F.col("__mix_cell"))
    return joined.drop("__mix_cell")


def sample_mix(
    docs: DataFrame, targets: Targets = TARGETS, share: float = SHARE, seed: int = SEED
) -> DataFrame:
    """The sampled documents, with the chance that each had in a column of its own.

    That column is ``probability``, after all others; where ``docs`` has a column of
    this name, it is ``mix_probability``, with as many ``mix_`` before it as it takes.
    ``targets`` has, for each dimension, the wanted share of each category. The
    dimension ``topic`` is found by :func:`topic`; any other is a column of ``docs``.
    """
    name = "probability"
    while name in docs.columns:
        name = f"mix_{name}"
    needed = dict.fromkeys(["doc_id", "text", *(t for t in targets if t != "topic")])
    marked = carried(docs, *needed).select(
        "row",
        _draw(seed).alias("draw"),
        _cells(docs, targets).alias("cell"),
        token_count(F.col("text")).alias("cell_tokens"),
    )
    mixed = _with_probability(marked, targets, share, "cell", "chance")
    kept = mixed.where(F.col("draw") < F.col("chance"))
    return kept.select("row.*", F.col("chance").alias(name))


def mix(
    docs: DataFrame, targets: Targets = TARGETS, share: float = SHARE, seed: int = SEED
) -> DataFrame:
    """Of every document: its categories, ``n_tokens``, ``probability``, ``sampled``.

    The texts are read once; what is needed of each is kept in the checkpoint folder.
    """
    marked = checkpointed(
        docs.select(
            "doc_id",
            _cells(docs, targets).alias("cell"),
            token_count(F.col("text")).alias("cell_tokens"),
            _draw(seed).alias("draw"),
        )
    )
    mixed = _with_probability(marked, targets, share, "cell", "probability")
    return mixed.select(
        "doc_id",
        *(F.col(f"cell.{name}").alias(name) for name in targets),
        F.col("cell_tokens").alias("n_tokens"),
        "probability",
        (F.col("draw") < F.col("probability")).alias("sampled"),
    )


def mixing_query(docs: DataFrame) -> DataFrame:
    return mix(docs)
