"""SimHash links and components against comparing every pair."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from termpeak.llm.components import connected_components
from termpeak.llm.simhash import (
    block_masks,
    drop_near_duplicates,
    fingerprint_links,
    near_duplicates,
    simhash_query,
    text_fingerprint,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """Component of every (name, fingerprint), by flooding."""
    out = {}
    for name, _ in sorted(pairs):
        if name in out:
            continue
        todo, seen = [name], {name}
        value = dict(pairs)
        while todo:
            here = todo.pop()
            for other, f in pairs:
                if other not in seen and (value[here] ^ f).bit_count() <= 3:
                    seen.add(other)
                    todo.append(other)
        out |= {n: min(seen) for n in seen}
    return out


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n", "One", "one TWO", "a b c", "Ä É x y z w", "z " * 700, "\x1f a\x00b c d"],
)
def test_fingerprint_of_odd_texts(text):
    assert text_fingerprint(text) == brute_fingerprint(text)


def test_query_over_the_whole_small_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    expected = brute_components(prints)
    got = {r[0]: (r[1], r[2]) for r in simhash_query(docs).collect()}
    assert got == {i: (f"{f:016x}", expected[i]) for i, f in prints}


@pytest.mark.parametrize("tile", [3, 1024])
def test_links_are_complete_in_split_buckets(spark, tile):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(12)]
    values = {0, (1 << 64) - 1}
    for b in base:
        for _ in range(25):
            values.add(b ^ sum(1 << k for k in draw.sample(range(64), draw.randint(0, 4))))
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {
        r["node"]: r["root"]
        for r in connected_components(fingerprint_links(frame, tile=tile)).collect()
    }
    expected = brute_components([(v, v % (1 << 64)) for v in signed])
    assert {v: roots.get(v, v) for v in signed} == expected


def test_any_two_within_the_radius_share_a_mask():
    draw = random.Random(1)
    for blocks in range(4, 8):
        masks = block_masks(blocks, 3)
        for _ in range(300):
            flips = sum(1 << k for k in draw.sample(range(64), 3))
            assert any(flips & m == 0 for m in masks)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "lone words are here", "z"), (7, "  ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((r[0] or -1, r[1], r[2]) for r in simhash_query(docs).collect())
    lone = f"{brute_fingerprint('lone words are here'):016x}"
    zero = "0" * 16
    assert got == [(-1, lone, None), (1, zero, 1), (2, zero, 1), (2, zero, 1), (7, zero, 1)]
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] or -1 for r in kept.collect()) == [-1, 1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0
    assert drop_near_duplicates(docs).count() == 0


def test_long_chain_is_one_component(spark):
    edges = spark.range(200).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    rows = connected_components(edges).collect()
    assert len(rows) == 201 and {r["root"] for r in rows} == {0}
