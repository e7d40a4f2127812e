"""Hard negatives: for an anchor and each of its positives, rows of another label that
score close to the positive, but not too close.

Method, segment summary filtering. Every vector is stored with the mean and the deviation
(the norm of what is left without the mean) of each of its segments, at three levels of
1, 4 and 16 segments. Over a segment of ``d`` components the inner product of two vectors
is ``d`` times the product of their means, give or take the product of their deviations.
Summed over segments this bounds a score from above and below. A tile of anchors and rows
starts with the coarse bounds; only the rows that some anchor may still want are looked at
with the next level, and what is left is scored exactly. What an anchor wants is what may
come into its best positives, or into a window of negatives, as found so far.

Scale. The anchors are the stated query set: each meets all rows, in blocks. Rows and
anchors are dealt by hash into blocks of bounded bytes, and a group is one block of each,
so a label, id or vector that a third of the rows share makes no group larger. Anchors
are sent once for each block of rows and rows once for each block of anchors. A group
returns no more than the places asked for, for each anchor. No data is broadcast or
collected.

Defined results: rows with a null id, a null label, a null or empty vector, or one with a
null or not finite component take no part; rows that are equal in all three count once;
rows that share only an id are different rows, but not each other's positives; vectors of
different lengths do not compare; ties go to the smaller id. Positives with a score below
zero have no negatives, as their window is empty. Scores are 64-bit integers; a pair of
blocks whose vectors are so large that a score could pass that raises an error. An empty
table, or one without anchors, gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from termpeak.llm.common import written

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # per cent of the positive's score
SCALE = 256
LEVELS = (1, 4, 16)
ROW_BYTES = 8 << 20  # of the vectors of a block of rows
ANCHOR_BYTES = 2 << 20
_ROWS = 1024  # rows of a block that are compared at a time
_NEVER = np.iinfo(np.int64).min


def segments(length: int, level: int) -> np.ndarray:
    """Where the segments of a vector start; at most ``level`` of them."""
    return np.unique(np.arange(level) * length // level)


def summaries(rows: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Means, times the root of the segment's length, and deviations of every segment."""
    starts = segments(rows.shape[1], level)
    sizes = np.diff(np.append(starts, rows.shape[1]))
    sums = np.add.reduceat(rows, starts, axis=1)
    left = rows - np.repeat(sums / sizes, sizes, axis=1)
    return sums / np.sqrt(sizes), np.sqrt(np.add.reduceat(left * left, starts, axis=1))


def packed(vector: Column, scale: int) -> Column:
    """``vector``: components as integers, in bytes of doubles; ``summary``: those of all
    levels, in bytes. Both null where the vector takes no part."""

    @F.pandas_udf("vector binary, summary binary")
    def compute(vectors: pd.Series) -> pd.DataFrame:
        out: list[tuple[bytes | None, bytes | None]] = [(None, None)] * len(vectors)
        lengths = np.array([0 if v is None else len(v) for v in vectors])
        for length in set(lengths.tolist()) - {0}:
            at = np.flatnonzero(lengths == length)
            rows = np.floor(scale * np.stack([vectors.iloc[k] for k in at])) + 0.0
            parts = [part for level in LEVELS for part in summaries(rows, level)]
            whole = np.concatenate(parts, axis=1)
            for k, row, summary in zip(at.tolist(), rows, whole, strict=True):
                if np.isfinite(row).all():
                    out[k] = (row.tobytes(), summary.tobytes())
        return pd.DataFrame(out, columns=["vector", "summary"], dtype=object)

    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    whole = F.when(finite, vector.cast("array<double>"))
    return compute(F.coalesce(whole, F.array().cast("array<double>")))


class Block:
    """Rows of one vector length: ids, labels, vectors and summaries of every level."""

    def __init__(self, frame: pd.DataFrame) -> None:
        self.ids = frame["vec_id"].to_numpy()
        self.labels = frame["label"].to_numpy()
        self.rows = np.frombuffer(b"".join(frame["vector"])).reshape(len(frame), -1)
        whole = np.frombuffer(b"".join(frame["summary"])).reshape(len(frame), -1)
        self.levels = []
        start = 0
        for level in LEVELS:
            width = len(segments(self.rows.shape[1], level))
            self.levels.append(
                (whole[:, start : start + width], whole[:, start + width : start + 2 * width])
            )
            start += 2 * width
        self.most = np.abs(self.rows).max(initial=0)
        self.norm = np.sqrt((self.rows * self.rows).sum(1)).max(initial=0)


class Scorer:
    """Exact scores of a block of anchors with rows whose bounds do not rule them out."""

    def __init__(self, anchors: Block, rows: Block) -> None:
        self.anchors, self.rows = anchors, rows
        largest = rows.rows.shape[1] * float(anchors.most) * float(rows.most)
        if largest >= 2.0**62:
            raise ValueError(f"scores up to {largest:.3g} do not fit 64 bits")
        self.whole = np.int64 if largest >= 2.0**53 else np.float64
        self.slack = 1e-9 * (1 + float(anchors.norm) * float(rows.norm))
        self.pruned = [1.0] * len(LEVELS)  # share that a level ruled out when last used

    def scores(
        self, who: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and score of the pairs of ``who`` and ``at`` within the limits.

        ``low`` and ``high`` go with ``who``. A level that rules out less than its cost
        is left out for the next rows; that bears on time alone.
        """
        alive = np.ones((len(who), len(at)), bool)
        length = self.rows.rows.shape[1]
        for k, level in enumerate(LEVELS):
            if 2 * level >= length or self.pruned[k] < 2 * level / length:
                self.pruned[k] += 0.01  # to be tried again some time
                continue
            (mean, deviation), (means, deviations) = self.anchors.levels[k], self.rows.levels[k]
            middle = mean[who] @ means[at].T
            reach = deviation[who] @ deviations[at].T + self.slack
            alive &= (middle + reach >= low[:, None]) & (middle - reach <= high[:, None])
            keep = alive.any(0)
            self.pruned[k] = 1 - keep.mean() if len(keep) else 1.0
            alive, at = alive[:, keep], at[keep]
            if not len(at):
                break
        exact = self.anchors.rows[who].astype(self.whole) @ self.rows.rows[at].astype(self.whole).T
        exact = exact.astype(np.int64)
        a, r = np.nonzero(alive & (exact >= low[:, None]) & (exact <= high[:, None]))
        return who[a], at[r], exact[a, r]


class Best:
    """The first ``places`` rows of every key: by score, then by smaller id."""

    def __init__(self, keys: int, places: int) -> None:
        self.places = places
        self.key, self.row, self.id, self.score = (np.empty(0, np.int64) for _ in range(4))
        self.last = np.full(keys, _NEVER)  # score of the last place, once it is taken

    def add(self, key: np.ndarray, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(key):
            return
        columns = [
            np.concatenate(c)
            for c in ((self.key, key), (self.row, row), (self.id, ids), (self.score, score))
        ]
        order = np.lexsort((columns[2], -columns[3], columns[0]))
        key = columns[0][order]
        fresh = np.flatnonzero(np.diff(key, prepend=-1))
        place = np.arange(len(key)) - np.repeat(fresh, np.diff(np.append(fresh, len(key))))
        chosen = order[place < self.places]
        self.key, self.row, self.id, self.score = (c[chosen] for c in columns)
        full = place == self.places - 1
        self.last[key[full]] = columns[3][order[full]]


def block_positives(anchors: Block, rows: Block, places: int) -> Best:
    """For each anchor its best rows of the same label and another id."""
    best, scorer = Best(len(anchors.ids), places), Scorer(anchors, rows)
    top = np.iinfo(np.int64).max
    for label in np.unique(anchors.labels).tolist():
        who = np.flatnonzero(anchors.labels == label)
        same = np.flatnonzero(rows.labels == label)
        for k in range(0, len(same), _ROWS):
            a, r, score = scorer.scores(
                who, same[k : k + _ROWS], best.last[who], np.full(len(who), top)
            )
            other = anchors.ids[a] != rows.ids[r]
            a, r, score = a[other], r[other], score[other]
            best.add(a, r, rows.ids[r], score)
    return best


def block_negatives(
    anchors: Block, rows: Block, low: np.ndarray, high: np.ndarray, places: int
) -> Best:
    """For each anchor and window its best rows of another label.

    ``low`` and ``high``: limits of each window, a row to an anchor; empty where there is
    none. Keys are anchor times windows plus window.
    """
    number, windows = low.shape
    best, scorer = Best(number * windows, places), Scorer(anchors, rows)
    open_ = low <= high
    for label in np.unique(anchors.labels).tolist():
        who = np.flatnonzero((anchors.labels == label) & open_.any(1))
        others = np.flatnonzero(rows.labels != label)
        if not len(who):
            continue
        for k in range(0, len(others), _ROWS):
            last = best.last.reshape(number, windows)[who]
            wanted = np.where(open_[who], np.maximum(low[who], last), np.iinfo(np.int64).max)
            until = np.where(open_[who], high[who], _NEVER)
            limits = wanted.min(1), until.max(1)
            a, r, score = scorer.scores(who, others[k : k + _ROWS], *limits)
            for w in range(windows):
                fits = (low[a, w] <= score) & (score <= high[a, w])
                fits &= score >= best.last[a * windows + w]
                best.add(a[fits] * windows + w, r[fits], rows.ids[r[fits]], score[fits])
    return best


def _blocks(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, Block, Block]]:
    """Anchors and rows of one group, by vector length."""
    lengths = frame["vector"].map(len)
    for length in lengths.unique().tolist():
        own = frame[lengths == length]
        anchors = own[own["is_anchor"]].reset_index(drop=True)
        rows = own[~own["is_anchor"]].reset_index(drop=True)
        if len(anchors) and len(rows):
            yield anchors, Block(anchors), Block(rows)


def _concat(frames: list[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
    return pd.concat(frames) if frames else pd.DataFrame({c: [] for c in columns}, dtype="int64")


def _meeting(
    rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int
) -> GroupedData:
    """Every block of anchors with every block of rows, as groups."""

    def dealt(frame: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        key = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return frame.withColumn(own, key).withColumn(other, every)

    sides = [
        dealt(rows, "row_block", row_blocks, "anchor_block", anchor_blocks),
        dealt(anchors, "anchor_block", anchor_blocks, "row_block", row_blocks),
    ]
    group = ["row_block", "anchor_block"]
    order = [*group, "is_anchor", "key", "vec_id", "label", "vector", "summary", "scores"]
    return sides[0].select(order).unionAll(sides[1].select(order)).groupBy(*group)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    row_bytes: int = ROW_BYTES,
    anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score`` for ``vectors`` with ``vec_id``, ``label`` and ``embedding``.

    Anchors are the rows where ``is_anchor`` holds. A negative of a positive with score
    ``p`` has a score ``s`` with ``low p <= 100 s <= high p``.
    """
    spark = vectors.sparkSession
    pack = packed(F.col("embedding"), scale)
    marks = F.coalesce(is_anchor, F.lit(False))
    ready = vectors.select("vec_id", "label", marks.alias("asks"), pack.alias("packed")).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), "asks",
        "packed.vector", "packed.summary",
    )
    ready = ready.where("vec_id is not null and label is not null and vector is not null")
    rows = written(
        ready.dropDuplicates(["vec_id", "label", "vector"]).withColumn(
            "key", F.xxhash64("vec_id", "label", "vector")
        ),
        "vectors",
    )
    size = rows.agg(
        F.count("*").alias("rows"),
        F.count_if("asks").alias("anchors"),
        F.max(F.octet_length("vector")).alias("bytes"),
    ).first()
    width = max(8, size["bytes"] or 0)
    # blocks of bounded bytes; of fewer where that keeps more cores busy
    row_blocks = max(
        1,
        ceil(size["rows"] * width / row_bytes),
        min(2 * spark.sparkContext.defaultParallelism, size["rows"] // 2048),
    )
    anchor_blocks = max(1, ceil(size["anchors"] * width / anchor_bytes))

    no_scores = F.lit(None).cast("array<long>").alias("scores")
    columns = ["key", "vec_id", "label", "vector", "summary"]
    plain = rows.select(*columns, F.lit(False).alias("is_anchor"), no_scores)
    asking = rows.where("asks").select(*columns, F.lit(True).alias("is_anchor"))

    def first_step(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for anchors, block, others in _blocks(frame):
            best = block_positives(block, others, positives)
            found.append(
                pd.DataFrame(
                    {
                        "key": anchors["key"].to_numpy()[best.key],
                        "anchor_id": block.ids[best.key],
                        "positive_id": best.id,
                        "positive_score": best.score,
                    }
                )
            )
        return _concat(found, ["key", "anchor_id", "positive_id", "positive_score"])

    found = _meeting(plain, asking.withColumn("scores", no_scores), row_blocks, anchor_blocks)
    of_anchor = Window.partitionBy("key", "anchor_id").orderBy(
        F.desc("positive_score"), "positive_id"
    )
    pairs = written(
        found.applyInPandas(
            first_step, "key long, anchor_id long, positive_id long, positive_score long"
        )
        .withColumn("place", F.row_number().over(of_anchor))
        .where(F.col("place") <= positives)
        .drop("place"),
        "positives",
    )

    # at most ``positives`` scores to an anchor
    wanted = pairs.groupBy("key", F.col("anchor_id").alias("vec_id")).agg(
        F.collect_set("positive_score").alias("scores")
    )
    windowed = asking.join(wanted, ["key", "vec_id"])

    def second_step(frame: pd.DataFrame) -> pd.DataFrame:
        result = []
        for anchors, block, others in _blocks(frame):
            lower = np.ones((len(anchors), positives), np.int64)
            upper = np.zeros((len(anchors), positives), np.int64)
            scores = np.zeros((len(anchors), positives), np.int64)
            for k, own in enumerate(anchors["scores"]):
                for w, score in enumerate(int(s) for s in own):
                    scores[k, w] = score
                    lower[k, w] = -(-low * score // 100)
                    upper[k, w] = high * score // 100
            best = block_negatives(block, others, lower, upper, negatives)
            at, window = best.key // positives, best.key % positives
            result.append(
                pd.DataFrame(
                    {
                        "key": anchors["key"].to_numpy()[at],
                        "anchor_id": block.ids[at],
                        "positive_score": scores[at, window],
                        "negative_id": best.id,
                        "negative_score": best.score,
                    }
                )
            )
        names = ["key", "anchor_id", "positive_score", "negative_id", "negative_score"]
        return _concat(result, names)

    met = _meeting(plain, windowed, row_blocks, anchor_blocks).applyInPandas(
        second_step,
        "key long, anchor_id long, positive_score long, negative_id long, negative_score long",
    )
    of_positive = Window.partitionBy("key", "anchor_id", "positive_score").orderBy(
        F.desc("negative_score"), "negative_id"
    )
    ranked = met.withColumn("rank", F.row_number().over(of_positive)).where(
        F.col("rank") <= negatives
    )
    return pairs.join(ranked, ["key", "anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def hard_negative_query(embeddings: DataFrame) -> DataFrame:
    """Anchors have ids divisible by 50; ids divisible by 7 a label moved on by one."""
    moved = (F.col("label").cast("long") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label").cast("long"))
    noisy = embeddings.select("vec_id", label.alias("label"), "embedding")
    return mine_hard_negatives(noisy, F.col("vec_id") % 50 == 0)


HARD_NEGATIVE_SQL = """
    WITH checked AS (
        SELECT DISTINCT vec_id,
               CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
               list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    numbered AS (SELECT row_number() OVER () AS row, * FROM checked),
    scored AS (
        SELECT a.row, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
               CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM numbered a JOIN numbered b ON len(a.v) = len(b.v)
        WHERE a.vec_id % 50 = 0
    ),
    positives AS (
        SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, other_id) AS place
        FROM scored WHERE same AND other_id <> anchor_id
    ),
    found AS (
        SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
               p.score AS positive_score, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.row, p.place
                                  ORDER BY n.score DESC, n.other_id) AS rank
        FROM positives p JOIN scored n ON n.row = p.row AND NOT n.same
        WHERE place <= 5
          AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
           negative_score
    FROM found WHERE rank <= 3"""
