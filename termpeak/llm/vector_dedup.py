"""Near-duplicate vectors: an exact metric range join over pivot cells.

Method. Vectors are scaled to length one, where a cosine of ``threshold`` or more is a
distance of ``r = sqrt(2 - 2 threshold)`` or less. A sample of vectors serves as pivots;
a vector is a member of the cell of its nearest pivot. Let ``y`` be a member of cell
``b`` and ``x`` one of cell ``a``, no further than ``r`` apart. By the triangle
inequality ``d(y, a) <= d(y, b) + 2r`` and ``d(y, a) <= R_a + r``, ``R_a`` being the
distance of the furthest member of ``a``; and since ``x`` is nearer to ``a`` than to
``b``, ``y`` is at most ``r`` beyond the plane between them. So ``y`` is replicated to
those cells of a smaller number where all three hold, and every link lies within one
cell, where it is found once. Cells join independently and exactly.

Scale. Equal vectors meet first and are compared as one, with their number. A cell is
cut into tiles of bounded bytes, and each pair of tiles is a group of its own, so no task
holds a cell, however many near copies share it. A group returns a count for each vector
and the links as a spanning forest, never as all pairs. The driver holds the pivots (at
most ``PIVOT_BYTES``) and three figures for each cell. In the worst case, vectors with no
structure in many dimensions, nearly all cells are neighbours; then it is a comparison of
all pairs in blocks, each pair once, and no more than that.

Defined results: vectors that are null or zero, or that hold a null or a component that
is not finite, link with nothing; vectors of different lengths do not link; equal rows
are different vectors that link, also if they share a ``vec_id``. A null ``vec_id`` is
never a component's id unless all its members have none. Pairs within 1e-12 of the
threshold are judged by a correctly rounded sum. Extra columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpeak.llm.common import written
from termpeak.llm.components import connected_components
from termpeak.llm.simhash import spanning_links

THRESHOLD = 0.95
CELL = 4096  # members to a pivot, on average
PIVOT_BYTES = 16 << 20
TILE_BYTES = 4 << 20
SPLITS = 16  # of large components and of vectors with very many copies
_ROWS = 256  # rows of a tile that are compared at a time
_SLACK = 1e-6  # of distances, for rounding
_CLOSE = 1e-12  # to the threshold


def unit_vector(vector: Column) -> Column:
    """The vector scaled to length one, as bytes of doubles; null if it has no direction."""

    @F.pandas_udf("binary")
    def compute(vectors: pd.Series) -> pd.Series:
        return pd.Series([_unit(v) for v in vectors], dtype=object)

    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    # what has no direction goes as an empty vector, so that no null reaches numpy
    whole = F.when(finite, vector.cast("array<double>"))
    return compute(F.coalesce(whole, F.array().cast("array<double>")))


def _unit(vector: np.ndarray | None) -> bytes | None:
    if vector is None or not len(vector):
        return None
    most = np.abs(vector).max()
    if most == 0:
        return None
    scaled = vector / most
    return (scaled / math.sqrt(scaled @ scaled) + 0.0).tobytes()  # no negative zeros


class Pivots:
    """Pivots of every length, with what is known of their cells."""

    def __init__(self, units: list[bytes], radius: float) -> None:
        self.radius = radius
        self.by_length: dict[int, np.ndarray] = {}
        for length in {len(u) for u in units}:
            rows = sorted(u for u in units if len(u) == length)
            self.by_length[length] = np.frombuffer(b"".join(rows)).reshape(len(rows), -1)

    def homes(self, length: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each row, and its cosine with every pivot."""
        pivots = self.by_length.get(length)
        if pivots is None:  # a length without a pivot is one cell
            return np.zeros(len(rows), np.int64), np.zeros((len(rows), 1))
        cosines = rows @ pivots.T
        return cosines.argmax(1), cosines

    def neighbours(
        self, length: int, home: np.ndarray, rows: np.ndarray, reach: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Row and cell of every replica. ``reach``: the radius of each cell."""
        pivots = self.by_length.get(length)
        if pivots is None:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        cosines = rows @ pivots.T
        away = distance(cosines)
        own = np.take_along_axis(away, home[:, None], 1)
        near = away <= np.minimum(own + 2 * self.radius, reach[None, :] + self.radius) + _SLACK
        apart = distance(pivots @ pivots.T)[home]
        beyond = np.take_along_axis(cosines, home[:, None], 1) - cosines
        near &= beyond <= self.radius * apart + _SLACK
        near &= np.arange(len(pivots))[None, :] < home[:, None]
        return np.nonzero(near)


def distance(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def _by_length(frame: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length in bytes, positions in the frame, and rows, at most 4096 at a time."""
    lengths = frame["unit"].map(len).to_numpy()
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        for k in range(0, len(at), 4096):
            some = at[k : k + 4096]
            data = b"".join(frame["unit"].iloc[some])
            yield length, some, np.frombuffer(data).reshape(len(some), -1)


def _over(
    nodes: DataFrame, step: Callable[[pd.DataFrame], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield from step(frame)

    return nodes.mapInPandas(run, schema)


def link_counts_and_forest(
    nodes: DataFrame,
    threshold: float = THRESHOLD,
    cell: int = CELL,
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """``src``, ``dst``, ``links``: for every node with a link its number of linked
    vectors, in parts with ``dst`` null; and the links of a spanning forest.

    ``nodes`` has ``node`` (a distinct long), ``unit`` (distinct) and ``n``, the number of
    vectors it stands for.
    """
    radius = math.sqrt(2 - 2 * threshold)
    size = nodes.agg(F.count("*").alias("n"), F.max(F.octet_length("unit")).alias("most")).first()
    number = ceil(size["n"] / cell)
    number = max(1, min(number, PIVOT_BYTES // (size["most"] or 8)))
    sample = nodes.orderBy(F.xxhash64("unit"), "unit").select("unit").limit(number)
    pivots = Pivots([bytes(r["unit"]) for r in sample.collect()], radius)

    def settle(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for length, some, rows in _by_length(frame):
            home, cosines = pivots.homes(length, rows)
            far = distance(np.take_along_axis(cosines, home[:, None], 1))[:, 0]
            yield frame.iloc[some].assign(length=length, cell=home, far=far)

    # written, so that a vector's cell is the same wherever it is asked for
    columns = "node long, unit binary, n long, length long, cell long, far double"
    placed = written(_over(nodes.select("node", "unit", "n"), settle, columns), "cells")
    cells = placed.groupBy("length", "cell").agg(F.max("far").alias("reach"), F.count("*").alias("n"))
    own: dict[tuple[int, int], tuple[float, int]] = {
        (r["length"], r["cell"]): (r["reach"], r["n"]) for r in cells.collect()
    }
    # a cell without members has nothing to be near to
    reach = {
        length: np.array([own.get((length, k), (-9.0, 0))[0] for k in range(len(p))])
        for length, p in pivots.by_length.items()
    }

    def replicas(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for length, some, rows in _by_length(frame):
            home = frame["cell"].to_numpy()[some]
            _, at = pivots.neighbours(length, home, rows, reach.get(length))
            found, n = np.unique(at, return_counts=True)
            yield pd.DataFrame({"length": length, "cell": found, "n": n})

    visits = _over(placed, replicas, "length long, cell long, n long").groupBy("length", "cell")
    guests = {
        (r["length"], r["cell"]): r["n"] for r in visits.agg(F.sum("n").alias("n")).collect()
    }

    def tiles(length: int, n: int) -> int:
        return ceil(n * length / tile_bytes)

    def deal(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Every vector to the pairs of tiles that it takes part in."""
        node = frame["node"].to_numpy()
        spread = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        for length, some, rows in _by_length(frame):
            home = frame["cell"].to_numpy()[some]
            guest, at = pivots.neighbours(length, home, rows, reach.get(length))
            out: list[tuple[int, int, int, int, int]] = []  # row, cell, i, j, own tile
            for k, c in enumerate(home.tolist()):
                inner = tiles(length, own[length, c][1])
                outer = tiles(length, guests.get((length, c), 0))
                mine = int(spread[some[k]]) % inner
                out += [(k, c, min(mine, o), max(mine, o), mine) for o in range(inner)]
                out += [(k, c, mine, inner + o, mine) for o in range(outer)]
            for k, c in zip(guest.tolist(), at.tolist(), strict=True):
                inner = tiles(length, own[length, c][1])
                mine = inner + int(spread[some[k]]) % tiles(length, guests[length, c])
                out += [(k, c, i, mine, mine) for i in range(inner)]
            for k in range(0, len(out), 4096):
                row, c, i, j, mine = np.array(out[k : k + 4096], np.int64).T
                picked = frame.iloc[some[row]]
                yield pd.DataFrame(
                    {
                        "length": length, "cell": c, "i": i, "j": j, "tile": mine,
                        "node": picked["node"].to_numpy(), "n": picked["n"].to_numpy(),
                        "unit": picked["unit"].to_numpy(),
                    }
                )

    pairs = "length long, cell long, i long, j long, tile long, node long, n long, unit binary"
    dealt = _over(placed, deal, pairs)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame[frame["tile"] == frame["i"].iloc[0]]
        same = frame["i"].iloc[0] == frame["j"].iloc[0]
        second = first if same else frame[frame["tile"] == frame["j"].iloc[0]]
        return tile_links(first, second, same, threshold)

    return dealt.groupBy("length", "cell", "i", "j").applyInPandas(
        compare, "src long, dst long, links long"
    )


def tile_links(
    first: pd.DataFrame, second: pd.DataFrame, same: bool, threshold: float
) -> pd.DataFrame:
    """Counts and forest of the links of one tile with another, or within itself."""
    sides = []
    for side in (first, second):
        units = np.frombuffer(b"".join(side["unit"])).reshape(len(side), -1) if len(side) else None
        sides.append((side["node"].to_numpy(), side["n"].to_numpy(), units))
    (nodes, n, units), (others, m, vectors) = sides
    degree, other_degree = np.zeros(len(nodes), np.int64), np.zeros(len(others), np.int64)
    lefts, rights = [], []
    for k in range(0, len(nodes) if len(others) else 0, _ROWS):
        rows = units[k : k + _ROWS]
        start = k if same else 0  # of a tile with itself, only what follows
        scores = rows @ vectors[start:].T
        near = scores >= threshold
        for a, b in zip(*np.nonzero(np.abs(scores - threshold) <= _CLOSE), strict=True):
            near[a, b] = math.fsum(rows[a] * vectors[start + b]) >= threshold
        if same:
            near &= np.arange(near.shape[1])[None, :] > np.arange(len(rows))[:, None]
        if not near.any():
            continue
        degree[k : k + _ROWS] += near @ m[start:]
        other_degree[start:] += n[k : k + _ROWS] @ near
        a, b = np.nonzero(near)
        left, right = spanning_links(nodes[k + a], others[start + b])
        lefts.append(left)
        rights.append(right)
    if same:
        degree += other_degree
        other_degree[:] = 0
    left = np.concatenate(lefts or [nodes[:0]])
    right = np.concatenate(rights or [nodes[:0]])
    if len(left):
        left, right = spanning_links(left, right)
    counted = np.concatenate([nodes[degree > 0], others[other_degree > 0]])
    links = np.concatenate([degree[degree > 0], other_degree[other_degree > 0]])
    nothing = [None] * max(len(counted), len(left))
    return pd.DataFrame(
        {
            "src": np.concatenate([counted, left]),
            "dst": pd.array(nothing[: len(counted)] + right.tolist(), "Int64"),
            "links": pd.array(links.tolist() + nothing[: len(left)], "Int64"),
        }
    )


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    cell: int = CELL,
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row of ``vectors``."""
    rows = written(
        vectors.select(
            F.col(f"`{vec_id}`").alias("vec_id"), unit_vector(F.col(f"`{vector}`")).alias("unit")
        ),
        "units",
    )
    # ids that stay, as they are written once
    nodes = written(
        rows.where("unit is not null")
        .groupBy("unit")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    found = written(
        link_counts_and_forest(nodes.select("node", "unit", "n"), threshold, cell, tile_bytes),
        "links",
    )
    degrees = found.where("dst is null").groupBy("src").agg(F.sum("links").alias("links"))
    edges = found.where("dst is not null").select("src", "dst")
    roots = connected_components(edges).withColumnRenamed("node", "src")
    linked = (
        degrees.join(roots, "src")
        .join(nodes.select(F.col("node").alias("src"), "first_id"), "src")
        .select("src", "links", "root", "first_id", F.pmod("src", F.lit(SPLITS)).alias("split"))
    )
    # a component may hold a third of all: its members are split over several keys
    least = (
        linked.groupBy("root")
        .agg(F.min("first_id").alias("least"))
        .select("root", "least", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))).alias("split"))
    )
    named = linked.join(least, ["root", "split"]).select(
        F.col("src").alias("node"), "links", "least"
    )
    marked = nodes.join(named, "node", "left").select(
        "unit",
        "n",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("least", "first_id").alias("component_id"),
    )
    whole = F.when(F.col("unit").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        _spread(rows, marked)
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            whole.alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _spread(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """Rows with what is known of their vector; one with very many copies is split.

    At most 1,000 vectors can have more than a thousandth of all copies, so those are
    few enough to be sent to every task.
    """
    many = max(10_000, ceil((marked.agg(F.sum("n")).first()[0] or 0) / 1000))
    hot = F.broadcast(marked.where(F.col("n") > many).select("unit", F.lit(SPLITS).alias("splits")))
    dealt = rows.join(hot, "unit", "left").select(
        "vec_id",
        "unit",
        F.pmod(F.monotonically_increasing_id(), F.coalesce("splits", F.lit(1))).alias("split"),
    )
    last = F.when(F.col("n") > many, F.lit(SPLITS - 1)).otherwise(F.lit(0)).cast("long")
    splits = F.explode(F.sequence(F.lit(0).cast("long"), last))
    copies = marked.select("unit", "n_links", "component_id", splits.alias("split"))
    return dealt.join(copies, ["unit", "split"], "left")


def vector_dedup_query(embeddings: DataFrame) -> DataFrame:
    return near_duplicate_vectors(embeddings)


VECTOR_DEDUP_SQL = """
    WITH RECURSIVE checked AS (
        SELECT row_number() OVER () AS row, vec_id,
               CASE WHEN len(embedding) > 0 AND len(list_filter(embedding,
                        lambda x: x IS NULL OR NOT isfinite(x))) = 0
                    THEN CAST(embedding AS DOUBLE[]) END AS v
        FROM embeddings
    ),
    sized AS (
        SELECT row, vec_id, v, CASE WHEN v IS NOT NULL THEN
                   sqrt(list_sum(list_transform(v, lambda x: x * x))) END AS norm
        FROM checked
    ),
    good AS (SELECT * FROM sized WHERE norm > 0),
    links AS (
        SELECT a.row AS src, b.row AS dst
        FROM good a JOIN good b ON a.row <> b.row AND len(a.v) = len(b.v)
        WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.95
    ),
    reach AS (
        SELECT row AS src, row AS dst FROM checked
        UNION
        SELECT r.src, l.dst FROM reach r JOIN links l ON r.dst = l.src
    ),
    roots AS (
        SELECT r.src, min(c.vec_id) AS component_id
        FROM reach r JOIN checked c ON c.row = r.dst GROUP BY r.src
    ),
    degrees AS (SELECT src, count(*) AS n FROM links GROUP BY src)
    SELECT c.vec_id, coalesce(d.n, 0) AS n_links, component_id,
           c.vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM checked c JOIN roots r ON r.src = c.row LEFT JOIN degrees d ON d.src = c.row"""
