"""SimHash near-duplicates by exact comparison of fingerprints in tiles.

Method. A fingerprint has one bit for each bit of a 64-bit shingle hash: set if
more than half of the text's shingle hashes have it. Two texts are linked if
their fingerprints differ in at most ``radius`` bits, and linked texts form
components. Links are found exactly: cut the 64 bits into ``blocks`` blocks; two
fingerprints within the radius agree in at least ``blocks - radius`` of them, so
comparing all fingerprints that share such a choice of blocks misses nothing.
Within a choice, fingerprints are compared tile against tile with numpy's
exclusive-or and bit counts; tile pairs whose population counts differ by more
than the radius are skipped, as every differing bit moves that count by one.

Scale. Copies meet in one fingerprint before anything is compared. A bucket of
more than ``tile`` fingerprints is dealt out over pairs of tiles, each its own
group of at most two tiles, so no task holds a whole bucket. A task returns the
links of a tile pair as a spanning forest, never as all pairs. Only fingerprints
and links are shuffled, not texts.

Defined results: null text counts as empty; texts without a word have
fingerprint zero, which links like any other; a null ``doc_id`` is never a
component's id unless all its members have none; equal rows give equal rows.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpeak.llm.common import (
    carried,
    checkpointed,
    digest_hex,
    lower_words,
    restored,
    small_batches,
)
from termpeak.llm.components import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 1024
BITS = 64
_PIECE = 1 << 16  # shingles whose bits are counted at a time
_SMALL = 48  # groups up to this size are compared by shifting the whole batch


def shingle_hashes(words: list[bytes], width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``width`` words, space-joined; of all if fewer."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(joined[s:e], seed) for s, e in spans], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes; zero for none."""
    if len(hashes) == 0:
        return 0
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), _PIECE):
        piece = hashes[k : k + _PIECE]
        bits = np.unpackbits(piece.view(np.uint8), bitorder="little").reshape(-1, BITS)
        # sums of up to 255 rows fit a byte, and adding bytes is quick
        whole = len(bits) // 255 * 255
        if whole:
            counts += bits[:whole].reshape(-1, 255, BITS).sum(1, np.uint8).sum(0, np.int64)
        counts += bits[whole:].sum(0, np.int64)
    majority = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def text_fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    return majority_bits(shingle_hashes(lower_words(text), width))


def fingerprint(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint as a signed long, in Arrow batches."""

    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        values = [text_fingerprint(t, width) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return compute(F.coalesce(text, F.lit("")))


def block_masks(blocks: int, radius: int) -> list[int]:
    """One mask of bits for every choice of ``blocks - radius`` blocks."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    pieces = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(pieces, blocks - radius)]


def blocks_for(fingerprints: int, radius: int) -> int:
    """Enough blocks for buckets of about 64 evenly spread fingerprints or fewer.

    A matter of speed only: the links are the same for any number above the radius.
    """
    blocks = radius + 1
    while blocks < radius + 4 and fingerprints / 2.0 ** (
        BITS * (blocks - radius) / blocks
    ) > 64:
        blocks += 1
    return blocks


def spanning_links(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a star forest with the same components as the given links."""
    nodes, index = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = index[: len(left)], index[len(left) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(label, before):
            break
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def tile_links(
    one: np.ndarray, two: np.ndarray | None, radius: int, side: int = 256
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius, of ``one`` with ``two`` or of ``one`` with itself.

    Both are put in order of population count and cut into small tiles; tiles
    whose counts are further apart than the radius are not compared.
    """
    same = two is None
    one = one[np.argsort(np.bitwise_count(one), kind="stable")]
    two = one if same else two[np.argsort(np.bitwise_count(two), kind="stable")]
    count_one = np.bitwise_count(one).astype(int)
    count_two = np.bitwise_count(two).astype(int)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(0, len(one), side):
        top = min(i + side, len(one))
        low = np.searchsorted(count_two, count_one[i] - radius, "left")
        high = np.searchsorted(count_two, count_one[top - 1] + radius, "right")
        if same:
            low = max(low, i)
        for j in range(low, high, side):
            end = min(j + side, high)
            apart = np.bitwise_count(one[i:top, None] ^ two[None, j:end])
            a, b = np.nonzero(apart <= radius)
            a, b = one[i:top][a], two[j:end][b]
            keep = a != b
            if keep.any():
                found.append(spanning_links(a[keep], b[keep]))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(side_) for side_ in zip(*found, strict=True))


def _group_links(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links within every group of a frame that is sorted by group."""
    value = frame["fp"].to_numpy().view(np.uint64)
    columns = [frame[c].to_numpy() for c in ("choice", "bucket", "i", "j")]
    change = np.zeros(len(frame), bool)
    change[0] = True
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(change)
    sizes = np.diff(np.append(starts, len(frame)))
    lefts, rights = [], []

    small = np.repeat(sizes <= _SMALL, sizes)
    left_in_group = np.repeat(starts + sizes, sizes) - np.arange(len(frame))
    at = np.flatnonzero(small & (left_in_group > 1))
    shift = 1
    while len(at):
        near = np.bitwise_count(value[at] ^ value[at + shift]) <= radius
        lefts.append(value[at[near]])
        rights.append(value[at[near] + shift])
        shift += 1
        at = at[left_in_group[at] > shift]

    tile, i, j = frame["tile"].to_numpy(), columns[2], columns[3]
    for k in np.flatnonzero(sizes > _SMALL):
        rows = slice(starts[k], starts[k] + sizes[k])
        own, side = value[rows], tile[rows]
        if i[starts[k]] == j[starts[k]]:
            a, b = tile_links(own, None, radius)
        else:
            first = side == i[starts[k]]
            a, b = tile_links(own[first], own[~first], radius)
        lefts.append(a)
        rights.append(b)

    left, right = np.concatenate(lefts or [value[:0]]), np.concatenate(rights or [value[:0]])
    if len(left):
        left, right = spanning_links(left, right)
    return pd.DataFrame({"src": left.view(np.int64), "dst": right.view(np.int64)})


def fingerprint_links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``src``, ``dst``: links whose components are those of all pairs in the radius.

    ``fingerprints`` has distinct longs in ``fp``.
    """
    masks = block_masks(blocks_for(fingerprints.count(), radius), radius)
    keyed = fingerprints.select(
        "fp",
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(k).alias("choice"),
                        F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"),
                    )
                    for k, m in enumerate(masks)
                )
            )
        ),
    )
    # only buckets over a tile need their number of tiles; there are few of them
    large = (
        keyed.groupBy("choice", "bucket")
        .count()
        .where(F.col("count") > tile)
        .select("choice", "bucket", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    )
    tiles = F.coalesce(F.col("tiles"), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), tiles - 1),
        lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")),
    )
    dealt = keyed.join(large, ["choice", "bucket"], "left").select(
        "choice", "bucket", "fp", own.alias("tile"), F.inline(pairs)
    )
    group = ["choice", "bucket", "i", "j"]

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for frame in frames:
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            last = frame[group].iloc[-1]
            open_ = np.ones(len(frame), bool)
            for name in group:
                open_ &= frame[name].to_numpy() == last[name]
            rest = frame[open_].reset_index(drop=True)
            done = frame[~open_].reset_index(drop=True)
            if len(done):
                yield _group_links(done, radius)
        if rest is not None and len(rest):
            yield _group_links(rest, radius)

    return (
        dealt.repartition(*group)
        .sortWithinPartitions(*group)
        .mapInPandas(compare, "src long, dst long")
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` that links lead to.
    """
    with small_batches(docs.sparkSession):
        marked = checkpointed(
            docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), width).alias("fp"))
        )
    firsts = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = fingerprint_links(firsts.select("fp"), radius)
    roots = connected_components(links)
    rooted = firsts.join(
        roots.withColumnRenamed("node", "fp"), "fp", "left"
    ).select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id.

    Rows that repeat this ``doc_id`` and text stay once; a component without any
    ``doc_id`` keeps one row as well.
    """
    verdicts = near_duplicates(docs, width=width, radius=radius)
    kept = verdicts.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rows = carried(docs, "doc_id", "text")
    one = rows.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    nameless = verdicts.where("component_id is null").select("fp").distinct()
    without = (
        rows.where("doc_id is null")
        .withColumn("fp", fingerprint(F.col("text"), width))
        .join(nameless, "fp", "left_semi")
        .dropDuplicates(["fp"])
    )
    return restored(one.select("row").unionAll(without.select("row")))


def simhash_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", digest_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )
