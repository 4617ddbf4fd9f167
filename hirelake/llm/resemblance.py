"""Texts whose sets of word shingles resemble each other: what SimHash alone cannot reach.

At a Jaccard similarity of 0.8 most fingerprints of 64 bits differ in 5 to 15 bits, where shared
bytes guarantee nothing. Candidates therefore come from bands of minima of permuted shingle
hashes (32 bands of 7: a pair at 0.8 shares one with a chance of 0.9995, at 0.5 with 0.22), and
every candidate is compared by its two whole sets.

Texts of equal sets are one node. The jobs are few, and as many whatever the bands hold:

1. each node is compared with the least node of each of its bands, which connects most of what is
   alike, and the links found are joined with those known already;
2. in bands whose nodes are not all connected, every node outside the band's largest connected
   part is compared with all nodes of other parts. Nothing is capped.

Before two sets are brought together, two exact tests on the nodes alone sort out nearly all pairs
that are not alike: sizes, as the smaller set must have the similarity's share of the larger; and
parities, the number of shingles modulo 2 in each of 1024 cells, as sets in which so many cells
differ in parity differ in as many shingles at least. Both are conditions of the join on the band,
so such pairs are never rows.

Defined cases: the empty set is in no band (texts without words are linked by their fingerprints);
a node alone in its bands is compared with none; no nodes give no labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import mixed, slices, stage
from hirelake.llm.components import components

BANDS, MINIMA = 32, 7
CELLS = 1024
PARITIES = [f"p{i}" for i in range(CELLS // 64)]
MARKS_DDL = ", ".join(["size int", *(f"{p} long" for p in PARITIES)])
_FACTORS = mixed(np.arange(1, BANDS * MINIMA + 1, dtype=np.uint64)) | np.uint64(1)
_PLACES = mixed(np.arange(1001, 1001 + MINIMA, dtype=np.uint64)) | np.uint64(1)
_STEP = 256


def set_name(distinct: np.ndarray) -> int:
    """A signed 64-bit name of a sorted set of hashes."""
    return int(np.uint64(xxhash.xxh64_intdigest(distinct.tobytes())).view(np.int64))


def band_keys(distinct: np.ndarray) -> np.ndarray:
    """One key for each band; none for the empty set."""
    if not len(distinct):
        return np.zeros(0, np.int64)
    least = np.full(len(_FACTORS), ~np.uint64(0))
    for start in range(0, len(distinct), _STEP):
        block = np.multiply.outer(distinct[start:start + _STEP], _FACTORS)
        np.minimum(least, block.min(axis=0), out=least)
    keys = (mixed(least).reshape(BANDS, MINIMA) * _PLACES).sum(axis=1, dtype=np.uint64)
    return mixed(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def parities(distinct: np.ndarray) -> np.ndarray:
    """A bit for each cell, set if an odd number of the hashes fall into it."""
    odd = np.bincount((distinct % np.uint64(CELLS)).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def marks(sets: list[np.ndarray]) -> dict[str, pa.Array]:
    """Size and parities of each set, as columns."""
    bits = np.array([parities(s) for s in sets], np.int64).reshape(-1, len(PARITIES))
    return {"size": pa.array([len(s) for s in sets], pa.int32())} | {
        name: pa.array(bits[:, i]) for i, name in enumerate(PARITIES)}


def shingle_sets(texts: DataFrame, hashes_of) -> DataFrame:
    """(node, shingles) of texts(text): the distinct hashes."""
    def sets(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            distinct = [np.unique(hashes_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([set_name(d) for d in distinct], pa.int64()),
                "shingles": pa.array([d.view(np.int64) for d in distinct], pa.list_(pa.int64()))})

    return texts.mapInArrow(sets, "node long, shingles array<long>")


def _may_resemble(a: str, b: str, similarity: float) -> Column:
    """What two sets of that similarity must fulfil, by their sizes and parities."""
    size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
    near = F.least(size_a, size_b) >= similarity * F.greatest(size_a, size_b) - 1e-6
    odd = reduce(add, [F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in PARITIES])
    # |A - B| + |B - A| is (1 - s) / (1 + s) of |A| + |B| at a similarity of s, less above
    return near & (odd <= (1 - similarity) / (1 + similarity) * (size_a + size_b) + 1e-6)


def _resembling(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs(a, b) whose sets have at least the similarity."""
    left, right = (sets.select(F.col("node").alias(n), F.col("shingles").alias(f"of_{n}"))
                   for n in "ab")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return pairs.join(left, "a").join(right, "b").where(common / union >= similarity).select("a", "b")


def shared_bands(nodes: DataFrame) -> DataFrame:
    """(band, node) of nodes(node, bands), bands of more than one node only."""
    posts = nodes.select("node", F.explode("bands").alias("band"))
    several = posts.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("b")).where(
        "a != b").select("band")
    return posts.join(several, "band", "left_semi")


def connected(posts: DataFrame, labels: DataFrame, known: DataFrame, sets: DataFrame,
              similarity: float) -> DataFrame:
    """(node, label): the connected parts of the known links and those among posts.

    posts(band, node, size, parities); labels(node, label) of all nodes tell which are connected by
    the known links(a, b) already.
    """
    def relabelled(links: DataFrame) -> DataFrame:
        roots = components(links)
        return stage(labels.select("node").join(roots, "node", "left").select(
            "node", F.coalesce("root", "node").alias("label")), "labels")

    own = [c for c in posts.columns if c not in ("band", "node")]
    named = posts.join(labels, "node")
    least = named.groupBy("band").agg(F.min(F.struct("node", "label", *own)).alias("least")).select(
        "band", "least.*")
    apart = named.alias("x").join(least.alias("y"), (F.col("x.band") == F.col("y.band")) & (
        F.col("x.label") != F.col("y.label")) & _may_resemble("x", "y", similarity)).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    links = stage(known.union(_resembling(apart, sets, similarity)), "alike")
    labels = relabelled(links)

    named = stage(posts.join(labels, "node"), "posts")
    parts = named.groupBy("band", "label").agg(F.count("*").alias("n"))
    largest = parts.groupBy("band").agg(
        F.max(F.struct("n", "label")).getField("label").alias("main"), F.count("*").alias("parts"))
    rest = named.join(largest.where("parts > 1"), "band").where("label != main")
    # Of two nodes that are both outside the largest part, one asks.
    asks = (F.col("x.label") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    pairs = named.alias("x").join(rest.alias("y"), (F.col("x.band") == F.col("y.band")) & (
        F.col("x.label") != F.col("y.label")) & asks & _may_resemble("x", "y", similarity)).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    found = stage(_resembling(pairs, sets, similarity), "alike")
    if found.isEmpty():
        return labels
    # The parts found before stand for their links.
    joined = labels.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return relabelled(joined.union(found))
