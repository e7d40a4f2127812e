"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

Method. The unit is a token of the text, or a run of single letters written apart
(``i d i o t``), lower-cased and with signs dropped. Two units are compared by the
gap-weighted subsequence kernel: every choice of ``ORDER`` characters in order
counts ``DECAY`` to the power of the length it spans, so that inserted or swapped
characters lower the likeness but do not end it. A bounded set of landmark units
gives each unit its Nyström features, a support vector machine is fitted on them,
and a document's margin is the largest among its units; a logistic curve fitted on
labelled documents turns it into a score.

A document's label says only that some unit is bad. Units far more frequent in
toxic sentences than in clean ones are the positive examples, units of clean
documents the negative ones; in a second round those clean units that the first
machine found worst are added.

Scoring is exact in primal form: the margin is linear in the kernel's features, so
landmarks and weights fold into one table over character triples of fixed size.

Scale. Scoring reads each document once and shuffles nothing. Training reads a
sample of at most ``SAMPLE`` labelled rows of each label, those with the smallest
hashes of their ids; units are counted in Spark and only ``SEEDS`` and
``NEGATIVES`` of them reach the driver.

Defined results: null and empty texts have no unit and get the smallest margin.
With no labelled row of either label nothing can be learned and every score is 0.
Rows of ``labels`` without a label or id are passed over; if rows for one id
disagree, toxic wins. Repeated rows give repeated rows; of rows that share an id one
is learnt from.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termpeak.llm.common import checkpointed, small_batches, written

ORDER = 3
DECAY = 0.6
LONGEST = 24  # longer tokens are cut into windows that overlap by half
SAMPLE = 6_000
SEEDS = 2_000
NEGATIVES = 6_000
LANDMARKS = 192
EVIDENCE = 10.83  # likelihood ratio of a unit and the label, one in a thousand by chance
FLOOR = -2.0  # margin of a text without units
_CACHE = 150_000  # units whose margin a worker remembers
_TEXTS = 200  # whose units are held at a time

_LETTERS = 28  # a-z, one code for digits, and the start of a unit
_ALPHABET = 41  # and twelve for all other characters
_SIGNS = re.compile(r"[\W_]+")
_APART = re.compile(r"(?<!\S)\w(?:[^\S\n]+\w){2,}(?!\S)")


def units_of(text: str | None) -> set[str]:
    """Raw units of a text: its tokens and its runs of single letters."""
    if not text:
        return set()
    lowered = text.lower()
    found = set(lowered.split())
    for run in _APART.findall(lowered):
        found.add("".join(run.split()))
    return found


def windows_of(unit: str) -> list[str]:
    """The strings a unit is compared as: without signs, long ones in windows."""
    plain = _SIGNS.sub("", unit)
    if len(plain) <= LONGEST:
        return [plain] if len(plain) >= ORDER else []
    half = LONGEST // 2
    return [plain[k : k + LONGEST] for k in range(0, len(plain) - half, half)]


def _code(character: str) -> int:
    if "a" <= character <= "z":
        return ord(character) - 97
    if character.isdigit():
        return 26
    return _LETTERS + ord(character) % (_ALPHABET - _LETTERS)


def _codes(strings: list[str]) -> np.ndarray:
    """Strings of equal length as rows of codes, with the start marked."""
    start = _LETTERS - 1
    return np.array([[start, *map(_code, s)] for s in strings], np.int64)


def kernel(left: np.ndarray, right: np.ndarray, paired: bool = False) -> np.ndarray:
    """Subsequence kernel of rows of codes; of row k with row k if ``paired``."""
    same = left[:, :, None] == right[:, None, :] if paired else (
        left[:, None, :, None] == right[None, :, None, :]
    )
    same = same.astype(np.float64)
    n, m = left.shape[1], right.shape[1]
    rows, columns = _steps(n), _steps(m)
    weight = DECAY**2 * same
    for _ in range(ORDER - 1):
        weight = same * (rows.T @ weight @ columns)
    return weight.sum(axis=(-2, -1))


def _steps(n: int) -> np.ndarray:
    apart = np.arange(n)[None, :] - np.arange(n)[:, None]
    return np.where(apart > 0, DECAY ** np.maximum(apart, 0), 0.0)


def _by_length(strings: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and codes of the strings of each length, in bounded pieces."""
    lengths = np.array([len(s) for s in strings])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        piece = max(1, 2_000_000 // int(n + 1) ** 3)
        for k in range(0, len(at), piece):
            yield at[k : k + piece], _codes([strings[i] for i in at[k : k + piece]])


def kernel_matrix(left: list[str], right: list[str]) -> np.ndarray:
    """Normalised kernel of every string of ``left`` with every one of ``right``."""
    out = np.zeros((len(left), len(right)))
    for a, one in _by_length(left):
        own = np.sqrt(kernel(one, one, paired=True))
        for b, two in _by_length(right):
            other = np.sqrt(kernel(two, two, paired=True))
            step = max(1, 2_000_000 // (len(b) * one.shape[1] * two.shape[1]))
            for k in range(0, len(a), step):
                values = kernel(one[k : k + step], two)
                out[np.ix_(a[k : k + step], b)] = values / np.outer(own[k : k + step], other)
    return out


@dataclass(frozen=True)
class Model:
    """A weight for each character triple, the bias, and the logistic curve."""

    table: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, strings: list[str]) -> np.ndarray:
        out = np.empty(len(strings))
        for at, codes in _by_length(strings):
            n = codes.shape[1]
            i, j, k = _triples(n)
            ids = (codes[:, i] * _ALPHABET + codes[:, j]) * _ALPHABET + codes[:, k]
            weights = (DECAY ** (k - i + 1)).astype(np.float32)
            own = np.sqrt(kernel(codes, codes, paired=True))
            out[at] = self.table[ids] @ weights / own
        return out + self.bias

    def unit_margins(self, units: list[str]) -> list[float]:
        """The largest margin of each unit's strings; ``FLOOR`` if it has none."""
        strings = [windows_of(u) for u in units]
        distinct = list({s for own in strings for s in own})
        margin = dict(zip(distinct, self.margins(distinct).tolist(), strict=True))
        return [max((margin[s] for s in own), default=FLOOR) for own in strings]

    def text_margins(self, texts: Iterator[str | None], cache: dict[str, float]) -> np.ndarray:
        units = [units_of(t) for t in texts]
        if len(cache) > _CACHE:
            cache.clear()
        fresh = [u for u in set().union(*units) if u not in cache]
        cache.update(zip(fresh, self.unit_margins(fresh), strict=True))
        get = cache.__getitem__
        return np.array([max(map(get, own), default=FLOOR) for own in units])

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, j, k = np.indices((n, n, n)).reshape(3, -1)
    ordered = (i < j) & (j < k)
    return i[ordered], j[ordered], k[ordered]


def spread_landmarks(strings: list[str], count: int) -> list[str]:
    """Up to ``count`` strings, each the one least like those chosen before."""
    if len(strings) <= count:
        return strings
    likeness = np.zeros(len(strings))
    chosen = [0]
    while len(chosen) < count:
        near = kernel_matrix(strings, [strings[chosen[-1]]])[:, 0]
        likeness = np.maximum(likeness, near)
        chosen.append(int(np.argmin(likeness)))
    return [strings[k] for k in dict.fromkeys(chosen)]


def fit_machine(positive: list[str], negative: list[str], ridge: float = 3e-4) -> Model:
    """A squared-hinge SVM on Nyström features, folded into a table of triples."""
    half = LANDMARKS // 2
    marks = spread_landmarks(positive[: 4 * half], half) + spread_landmarks(
        negative[: 4 * half], half
    )
    marks = list(dict.fromkeys(marks))
    values, vectors = np.linalg.eigh(kernel_matrix(marks, marks))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    features = kernel_matrix(positive + negative, marks) @ root
    features = np.hstack([features, np.ones((len(features), 1))])
    sign = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    # between equal weight for each example and equal weight for each side
    middle = 0.5 / math.sqrt(len(positive) * len(negative))
    weight = np.where(sign > 0, 0.5 / len(positive), middle)
    solved = np.zeros(features.shape[1])
    penalty = ridge * np.eye(features.shape[1])
    penalty[-1, -1] = 0
    active = np.ones(len(sign), bool)
    for _ in range(50):
        used = features[active] * weight[active, None]
        solved = np.linalg.solve(
            used.T @ features[active] + penalty + 1e-9 * np.eye(len(solved)), used.T @ sign[active]
        )
        now = sign * (features @ solved) < 1
        if np.array_equal(now, active):
            break
        active = now
    table = np.zeros(_ALPHABET**ORDER)
    for mark, beta in zip(marks, root @ solved[:-1], strict=True):
        codes = _codes([mark])
        own = math.sqrt(kernel(codes, codes, paired=True)[0])
        i, j, k = _triples(codes.shape[1])
        row = codes[0]
        ids = (row[i] * _ALPHABET + row[j]) * _ALPHABET + row[k]
        np.add.at(table, ids, beta / own * DECAY ** (k - i + 1))
    return Model(table.astype(np.float32), float(solved[-1]))


def fit_curve(model: Model, margins: np.ndarray, toxic: np.ndarray, ridge: float = 1e-3) -> Model:
    """The model with a logistic curve of the margin, both labels weighing the same."""
    inputs = np.column_stack([margins, np.ones(len(margins))])
    weight = np.where(toxic == 1, 0.5 / (toxic == 1).sum(), 0.5 / (toxic == 0).sum())
    solved = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(inputs @ solved, -30, 30)))
        gradient = inputs.T @ (weight * (p - toxic)) + ridge * np.array([solved[0], 0])
        bend = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + np.diag([ridge, 1e-9])
        move = np.linalg.solve(bend, gradient)
        solved -= move
        if np.abs(move).max() < 1e-9:
            break
    return Model(model.table, model.bias, float(solved[0]), float(solved[1]))


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``text``, ``toxic`` of up to ``size`` training documents of each label.

    One row to an id, however many rows of ``docs`` share it: that with the smallest
    text, which pre-aggregates where the rows are. So no more than ``2 * size`` rows are
    ever learnt from.
    """
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .where(remainder(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    totals = dict(known.groupBy("toxic").count().collect())
    chosen = None
    for value in (0, 1):
        # about twice as many by their hashes, so that few are left to be put in order
        share = min(1.0, 2 * size / max(1, totals.get(value, 0)))
        hashed = F.xxhash64("doc_id")
        drawn = F.shiftrightunsigned(hashed, 11) / F.lit(2.0**53) <= F.lit(share)
        part = known.where((F.col("toxic") == value) & drawn)
        part = part.orderBy(F.shiftrightunsigned(hashed, 11), "doc_id").limit(size)
        chosen = part if chosen is None else chosen.unionAll(part)
    # at most 2 * size rows of an id and a label: broadcast whatever the input
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model | None:
    """A model from the labelled training rows, or None if one label is missing."""
    sample = checkpointed(labelled_sample(docs, labels, size))
    totals = dict(sample.groupBy("toxic").count().collect())
    bad, clean = totals.get(1, 0), totals.get(0, 0)
    if not bad or not clean:
        return None

    counts = checkpointed(
        sample.select("toxic", F.explode(_strings(F.col("text"))).alias("unit"))
        .groupBy("unit")
        .agg(F.sum("toxic").alias("in_bad"), F.sum(1 - F.col("toxic")).alias("in_clean"))
    )
    positive = explaining_units(sample.where("toxic = 1"), counts, bad, clean)
    innocent = counts.where(F.col("in_clean") > 0)
    frequent = innocent.orderBy(F.desc("in_clean"), "unit").limit(NEGATIVES // 3)
    others = innocent.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES // 3)
    negative = [r["unit"] for r in frequent.select("unit").union(others.select("unit")).collect()]
    negative = [u for u in dict.fromkeys(negative) if u not in set(positive)]
    if not positive or not negative:
        return None
    model = fit_machine(positive, negative)

    worst = (
        innocent.select("unit", _unit_margin(model, F.col("unit")).alias("margin"))
        .orderBy(F.desc("margin"), "unit")
        .limit(NEGATIVES // 3)
    )
    hard = [r["unit"] for r in worst.collect() if r["unit"] not in set(positive)]
    model = fit_machine(positive, list(dict.fromkeys(negative + hard)))
    scored = sample.select("toxic", text_margin(model, F.col("text")).alias("margin")).toPandas()
    return fit_curve(model, scored["margin"].to_numpy(), scored["toxic"].to_numpy())


def _strings(text: Column) -> Column:
    """The distinct strings of a text's units."""

    @F.pandas_udf("array<string>")
    def strings(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({s for u in units_of(t) for s in windows_of(u)}) for t in texts])

    return strings(F.coalesce(text, F.lit("")))


def explaining_units(toxic: DataFrame, counts: DataFrame, bad: int, clean: int) -> list[str]:
    """Units that explain the toxic documents, the strongest first.

    The unit with the most evidence is taken and the documents that have it are set
    aside; then evidence is weighed anew. So words that only stand beside an insult,
    or in many copies of one text, are not taken for insults themselves.
    """
    evidence = _ratio(F.col("in_bad"), F.col("in_clean"), bad, clean)
    best = counts.orderBy(F.desc(evidence), "unit").limit(SEEDS).collect()
    names = [r["unit"] for r in best if r["in_bad"] * clean > r["in_clean"] * bad]
    if not names:
        return []
    place = {name: k for k, name in enumerate(names)}
    harmless = np.array([r["in_clean"] for r in best if r["unit"] in place], float)

    # at most SAMPLE documents and SEEDS units
    known = F.array_intersect(_strings(F.col("text")), F.lit(names))
    rows = toxic.select(known.alias("units")).collect()
    has = np.zeros((len(rows), len(names)), bool)
    for k, row in enumerate(rows):
        has[k, [place[u] for u in row["units"]]] = True

    left = np.ones(len(rows), bool)
    found = has.sum(0).astype(float)
    whole = _numpy_ratio(found, harmless, len(rows), clean)
    chosen: list[str] = []
    while left.any():
        ratio = _numpy_ratio(found, harmless, left.sum(), clean)
        k = int(np.argmax(ratio))
        if ratio[k] < EVIDENCE and chosen:
            break
        chosen.append(names[k])
        explained = left & has[:, k]
        if not explained.any():
            break
        left &= ~explained
        found -= has[explained].sum(0)
    # others as strong as the strongest, which happened to stand beside them only
    strongest = max(whole[place[name]] for name in chosen)
    return chosen + [n for n, r in zip(names, whole, strict=True) if 4 * r >= strongest and n not in chosen]


def _ratio(in_bad: Column, in_clean: Column, bad: int, clean: int) -> Column:
    """Likelihood ratio of a unit's documents against all documents' labels."""
    n, share = in_bad + in_clean, bad / (bad + clean)

    def term(k: Column, p: float) -> Column:
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)

    leans = in_bad * clean > in_clean * bad
    return F.when(leans, 2 * (term(in_bad, share) + term(in_clean, 1 - share))).otherwise(0.0)


def _numpy_ratio(in_bad: np.ndarray, in_clean: np.ndarray, bad: int, clean: int) -> np.ndarray:
    n, share = in_bad + in_clean, bad / (bad + clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        one = np.where(in_bad > 0, in_bad * np.log(in_bad / (n * share)), 0)
        two = np.where(in_clean > 0, in_clean * np.log(in_clean / (n * (1 - share))), 0)
    return np.where(in_bad * clean > in_clean * bad, 2 * (one + two), 0)


def _unit_margin(model: Model, unit: Column) -> Column:
    shared = _share(model)

    @F.pandas_udf("double")
    def margin(units: pd.Series) -> pd.Series:
        return pd.Series(shared.value.unit_margins(list(units)), dtype="float64")

    return margin(unit)


def _share(model: Model) -> Broadcast:
    return SparkSession.active().sparkContext.broadcast(model)


def text_margin(model: Model, text: Column) -> Column:
    """The largest margin of each text's units."""
    shared = _share(model)

    @F.pandas_udf("double")
    def margin(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, float] = {}
        for texts in batches:
            parts = [
                shared.value.text_margins(texts.iloc[k : k + _TEXTS], cache)
                for k in range(0, len(texts), _TEXTS)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return margin(F.coalesce(text, F.lit("")))


def score(model: Model | None, text: str = "text") -> Column:
    """Score of each text, from 0 to 1; 0 throughout without a model."""
    if model is None:
        return F.lit(0.0)
    raw = F.lit(model.slope) * text_margin(model, F.col(text)) + F.lit(model.offset)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), raw))))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents whose score is 0.5 or more; written and read again."""
    with small_batches(docs.sparkSession):
        model = train(docs, labels)
        return written(docs.where(score(model) < 0.5), "not-toxic")


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), score(model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
