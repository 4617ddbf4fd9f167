"""SimHash near-dedup over a byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes. Two fingerprints that differ in at most
`max_bits` = 4 bits differ in at most four bytes, so they share at least four: the guaranteed
minimum. The tally of shared positional bytes is taken by the index itself: its postings are
keyed by every four positions with their bytes, so two fingerprints meet in a posting exactly if
their tally reaches the minimum, and lists stay short (32 bits of key) at any size. Members of a
list are then verified bit by bit.

Fingerprints are made distinct first, so copies cost nothing. A list is read as a sorted stream
and yields one link per member to the first of its local component, never all pairs. A list of
over LONGEST fingerprints is sent on under finer keys: eight half-bytes are left, of which at
least four are shared again; such a list has at most 65,536 distinct fingerprints.

Shingles are taken from the words between the six ASCII white-space bytes, A-Z lower-cased;
repeats count. A text of fewer words is one shingle. Defined cases: a null or empty text has
fingerprint zero and is linked like any other; rows repeated under one id get the same result;
null ids stay null and never name a component unless all its ids are null; other columns are
not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import resemblance
from hirelake.llm.common import documents, keep_rows, mark, slices, stage
from hirelake.llm.components import components

LONGEST = 1 << 16
SEED = 42


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each run of so many words, joined by one space; of all words if there are fewer."""
    own = text.encode().lower().split()  # bytes: A-Z and the six white-space bytes only
    line = b" ".join(own)
    ends = list(itertools.accumulate(len(w) + 1 for w in own))
    starts = [0, *ends]
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(line[a:b - 1], SEED) for a, b in
                     zip(starts, ends[words - 1:] or ends[-1:])], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8192):
        part = hashes[start:start + 8192].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _masks(bits: int) -> list[int]:
    """The 70 choices of four fields of eight, as masks over 8 * bits bits."""
    field = (1 << bits) - 1
    return [sum(field << bits * i for i in four) for four in itertools.combinations(range(8), 4)]


BYTE_MASKS = _masks(8)


def _finer(mask: int) -> list[int]:
    """mask with four of the eight half-bytes that it leaves open."""
    free = [0xF << 4 * i for i in range(16) if not mask >> 4 * i & 1]
    return [mask | sum(four) for four in itertools.combinations(free, 4)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def local_links(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A link from each member to the first one of its component within the list."""
    links = []
    left = members
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= max_bits
            if near.any():
                queue.extend(left[near])
                links.extend((root, x) for x in left[near])
                left = left[~near]
    return links


class Postings:
    """Reads posting lists, sorted by mask and key, and links their members."""

    def __init__(self, max_bits: int, longest: int | None):
        self.max_bits, self.longest = max_bits, longest

    def __call__(self, batches) -> Iterator[pa.RecordBatch]:
        open_key, held, size, passed_on = None, [], 0, False
        for batch in batches:
            mask, key, fp = (batch.column(c).to_numpy() for c in ("mask", "key", "fp"))
            if not len(fp):
                continue
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
            edges = np.concatenate([[0], cuts, [len(fp)]])
            a: list[int] = []
            b: list[int] = []
            # lists of two that lie within the batch, all at once
            pairs = edges[:-1][np.diff(edges) == 2]
            pairs = pairs[(pairs > 0) & (pairs + 2 < len(fp))]
            near = np.bitwise_count((fp[pairs] ^ fp[pairs + 1]).view(np.uint64)) <= self.max_bits
            two = [(fp[pairs[near]], fp[pairs[near] + 1])]
            # the others: longer ones, and those that the batch's ends may cut
            sizes = np.diff(edges)
            wanted = np.flatnonzero(sizes > 2)
            for i in sorted({0, len(sizes) - 1, *wanted.tolist()}):
                x, y = edges[i], edges[i + 1]
                if open_key != (mask[x], key[x]):
                    yield from self._close(held, passed_on)
                    open_key, held, size, passed_on = (mask[x], key[x]), [], 0, False
                held.append(fp[x:y])
                size += y - x
                if self.longest and (size > self.longest or passed_on):
                    yield from self._pass_on(held, open_key[0])
                    held, passed_on = [], True
                if i + 1 < len(sizes) and not passed_on and len(held) == 1:
                    links = local_links(held[0].view(np.uint64), self.max_bits)
                    held = []
                    if links:
                        left, right = zip(*links)
                        a += left
                        b += right
            a, b = (np.array(x, np.uint64).view(np.int64) for x in (a, b))
            a, b = np.concatenate([two[0][0], a]), np.concatenate([two[0][1], b])
            if len(a):
                yield self._rows(a, b)
        yield from self._close(held, passed_on)

    @staticmethod
    def _rows(a, b, mask=None) -> pa.RecordBatch:
        masks = pa.nulls(len(a), pa.int64()) if mask is None else pa.array(
            np.full(len(a), mask, np.int64))
        return pa.RecordBatch.from_pydict({"a": a, "b": b, "mask": masks})

    def _pass_on(self, held, mask):
        for fp in held:
            yield self._rows(fp, fp, mask)

    def _close(self, held, passed_on):
        if held and not passed_on:
            links = local_links(np.concatenate(held).view(np.uint64), self.max_bits)
            if links:
                a, b = np.array(links, np.uint64).view(np.int64).T
                yield self._rows(a.copy(), b.copy())


def _lists(rows: DataFrame, masks, postings: Postings) -> DataFrame:
    """Rows (fp, masks) to links, through the posting lists of each mask."""
    keyed = rows.select("fp", F.explode(masks).alias("mask")).withColumn(
        "key", F.col("fp").bitwiseAND(F.col("mask")))
    dealt = keyed.repartition("key", "mask").sortWithinPartitions("key", "mask")
    return dealt.mapInArrow(postings, "a long, b long, mask long")


def links(fingerprints: DataFrame, max_bits: int = 4, longest: int = LONGEST) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints(fp) within so many bits of each other."""
    literal = lambda masks: F.array(*(F.lit(_signed(m)) for m in masks))
    found = stage(_lists(fingerprints, literal(BYTE_MASKS), Postings(max_bits, longest)), "links")
    done = found.where("mask is null").select("a", "b")
    hot = found.where("mask is not null").select(F.col("a").alias("fp"), F.col("mask").alias("wide"))
    if hot.isEmpty():
        return done
    finer = F.create_map(*(x for m in BYTE_MASKS for x in (
        F.lit(_signed(m)), literal(_finer(m)))))[F.col("wide")]
    return done.union(_lists(hot, finer, Postings(max_bits, None)).select("a", "b"))


def _grouped(docs: DataFrame, words: int, max_bits: int, longest: int, id_col: str,
             text_col: str) -> DataFrame:
    """(id, mark, fp, root, component_id) of each row."""
    if max_bits > 4:
        raise ValueError("over four differing bits, four shared bytes are not guaranteed")

    def prints(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [_signed(fingerprint(shingle_hashes(t or "", words)))
                    for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "mark": batch.column("mark"),
                "fp": pa.array(made, pa.int64())})

    texts = documents(docs, id_col, text_col).withColumn("mark", mark(F.col("text")))
    rows = stage(texts.mapInArrow(prints, "id long, mark long, fp long"), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(distinct.select("fp"), max_bits, longest))
    linked = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = stage(linked, "linked-fingerprints")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def simhash_dedup(docs: DataFrame, words: int = 4, max_bits: int = 4, longest: int = LONGEST,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): component_id is the smallest id linked, directly or not."""
    return _grouped(docs, words, max_bits, longest, id_col, text_col).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def _resembling(docs: DataFrame, words: int, max_bits: int, similarity: float, longest: int,
                id_col: str, text_col: str) -> DataFrame:
    """(id, mark, label) of each row: groups by fingerprints, joined by those of like shingle sets."""
    def hashes(text: str | None) -> np.ndarray:
        return shingle_hashes(text or "", words)

    def prints(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [hashes(t) for t in batch.column("text").to_pylist()]
            sets = [np.unique(h) for h in made]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "mark": batch.column("mark"),
                "fp": pa.array([_signed(fingerprint(h)) for h in made], pa.int64()),
                "node": pa.array([resemblance.set_name(s) for s in sets], pa.int64()),
                "bands": pa.array([resemblance.band_keys(s) for s in sets], pa.list_(pa.int64())),
                **resemblance.marks(sets)})

    texts = documents(docs, id_col, text_col).withColumn("mark", mark(F.col("text")))
    rows = stage(texts.mapInArrow(prints, "id long, mark long, fp long, node long, bands array<long>, "
                                  + resemblance.MARKS_DDL), "fingerprints")
    # Sets under one fingerprint, or under linked ones, are connected through the least of them.
    roots = components(links(rows.select("fp").distinct(), max_bits, longest))
    held = rows.select("fp", "node").distinct()
    held = stage(held.join(roots, held.fp == roots.node, "left").select(
        held.node, F.coalesce("root", "fp").alias("root")), "linked-sets")
    least = held.groupBy("root").agg(F.min("node").alias("least"))
    known = stage(held.join(least, "root").select(F.col("node").alias("a"), F.col("least").alias("b")),
                  "links")
    labels = stage(known.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "labels")

    one_each = rows.groupBy("node").agg(F.first("bands").alias("bands"))
    posts = stage(resemblance.shared_bands(one_each), "posts")
    # What is known of the nodes that share a band; one row of each stands for it.
    own = ["size", *resemblance.PARITIES]
    nodes = rows.join(posts.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.min(F.struct("id", "mark", *own)).alias("one")).select("node", "one.*")
    nodes = stage(nodes, "nodes")
    wanted = nodes.select(F.col("id").alias("own_id"), F.col("mark").alias("own_mark"))
    posts = posts.join(nodes.drop("id", "mark"), "node")
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark"))
    sets = resemblance.shingle_sets(texts.join(wanted, same, "left_semi").select("text"), hashes)
    sets = stage(sets.dropDuplicates(["node"]), "shingle-sets")
    labels = resemblance.connected(posts, labels, known, sets, similarity)
    return rows.select("id", "mark", "node").join(labels, "node").select("id", "mark", "label")


def keep_one_of_each(docs: DataFrame, words: int = 5, max_bits: int = 4, similarity: float = 0.8,
                     longest: int = LONGEST, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The row of the smallest id of each group, with all its columns; null ids come last.

    Rows are linked if their fingerprints are, or if the Jaccard similarity of their sets of
    shingles is at least `similarity`; texts without words have equal sets.
    """
    rows = _resembling(docs, words, max_bits, similarity, longest, id_col, text_col)
    alike = rows.groupBy("label", "id", "mark").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark", "n")).alias("w")
    return keep_rows(docs, alike.groupBy("label").agg(first).select("w.*"), id_col, text_col)
