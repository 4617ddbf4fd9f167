"""Line dedup with sharded minimal perfect hashes.

Distinct line keys are counted by documents (pre-aggregated in each task, then by Spark). The
hashes that reach the limit go into a minimal perfect hash per shard: bit arrays of a cascade of
levels, each key owning one bit; the rank of its bit indexes a compact array of fingerprints
(the other 64 bits of the line's 128-bit hash) and one of counts. Documents probe these arrays.
The arrays are broadcast only while their measured size is below `most_bytes`. Beyond that the
hashes of lines, never the lines, are sent to the shards, which are replicated over salts so
that a line in a third of the documents is probed in many tasks.

A line's key is the line without the six ASCII white-space bytes at both ends, A-Z lower-cased.
Keys shorter than `min_chars` code points are never dropped. Defined cases: a null or empty text is one empty line; a
repeated row counts as one more document; null ids stay null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import documents, list_parts, mixed, slices, stage

SHARD_KEYS = 1 << 18  # keys of a shard, on average
SALTS = 16
MOST_BYTES = 16 << 20
_SPACE = b" \t\n\r\x0b\x0c"
_RESULT = "n_lines long, n_dropped long, kept string"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key by which a line is counted, or None if it always stays."""
    key = line.strip(_SPACE).lower()  # bytes.lower() knows A-Z only
    if len(key) < min_chars or (min_chars > 1 and len(key.decode()) < min_chars):
        return None
    return key


def hash_pair(key: bytes) -> tuple[int, int]:
    both = xxhash.xxh3_128_intdigest(key)
    return _signed(both >> 64), _signed(both)


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


# --- the minimal perfect hash of one shard -----------------------------------------------


@dataclass
class Shard:
    """Bits of all levels end to end, ranks of their 64-bit words, and the arrays they index."""
    sizes: np.ndarray  # bits of each level
    bits: np.ndarray  # uint64 words
    fingerprints: np.ndarray
    counts: np.ndarray

    def __post_init__(self):
        ones = np.bitwise_count(self.bits).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else ones

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return mixed(hashes.view(np.uint64) + seed) % np.uint64(size)

    @classmethod
    def build(cls, hashes: np.ndarray, fingerprints: np.ndarray, counts: np.ndarray) -> Shard:
        """A key falls through to the next level while it shares its bit with another.

        Keys with the same 64-bit hash never part; they are told apart by `hashes` being unique.
        """
        sizes, words, left, places = [], [], np.arange(len(hashes)), np.zeros(len(hashes), np.int64)
        base = 0
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            at = cls._place(hashes[left], len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            own = alone[at]
            places[left[own]] = base + at[own]
            left, base = left[~own], base + size
            sizes.append(size)
        order = np.argsort(places)
        bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), bits, fingerprints[order], counts[order])

    def counts_of(self, hashes: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
        """The count of each key, 0 if it isn't in the shard."""
        out, left, base = np.zeros(len(hashes), np.int64), np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = self._place(hashes[left], level, size).astype(np.int64) + base
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            found = (word >> bit) & np.uint64(1) == 1
            lower = word & ((np.uint64(1) << bit) - np.uint64(1))
            index = self.ranks[at >> 6] + np.bitwise_count(lower)
            own = np.flatnonzero(found)
            same = own[self.fingerprints[index[own]] == fingerprints[left[own]]]
            out[left[same]] = self.counts[index[same]]
            left, base = left[~found], base + size
            if not len(left):
                break
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.bits), len(self.counts)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.sizes, self.bits, self.fingerprints,
                                              self.counts))

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        parts = np.frombuffer(data, np.int64)
        a, b, c = parts[:3].tolist()
        sizes, bits, marks, counts = np.split(parts[3:], np.cumsum([a, b, c]))
        return cls(sizes, bits.view(np.uint64), marks, counts)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes.view(np.uint64) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _build_shards(batches) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; each shard is built when its last row has come."""
    held: list[pa.RecordBatch] = []

    def built() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        h, f, n = (rows.column(c).to_numpy() for c in ("h", "f", "n"))
        one = np.sort(np.unique(h, return_index=True)[1])
        shards = [Shard.build(h[one], f[one], n[one])]
        again = np.setdiff1d(np.arange(len(h)), one)
        while len(again):  # equal 64-bit hashes with other fingerprints: further arrays
            one = np.unique(h[again], return_index=True)[1]
            shards.append(Shard.build(h[again][one], f[again][one], n[again][one]))
            again = np.delete(again, one)
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([rows.column("shard")[0].as_py()] * len(shards), pa.int64()),
            "arrays": pa.array([s.to_bytes() for s in shards], pa.binary())})

    for batch in batches:
        ids = batch.column("shard").to_numpy()
        cuts = np.flatnonzero(np.diff(ids)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(ids)]):
            if b > a:
                if held and held[0].column("shard")[0].as_py() != ids[a]:
                    yield built()
                    held = []
                held.append(batch.slice(a, b - a))
    if held:
        yield built()


# --- counting, probing, dropping ---------------------------------------------------------


class LineDedup:
    def __init__(self, min_docs: int = 10, min_chars: int = 1, most_bytes: int = MOST_BYTES):
        self.min_docs, self.min_chars, self.most_bytes = min_docs, min_chars, most_bytes

    def _hashes(self, text: str | None) -> list[tuple[int, int] | None]:
        keys = (line_key(x, self.min_chars) for x in (text or "").encode().split(b"\n"))
        return [None if k is None else hash_pair(k) for k in keys]

    def counted(self, batches) -> Iterator[pa.RecordBatch]:
        """Distinct line hashes of a slice with the number of its documents that have them."""
        for batch in slices(batches):
            counts: dict[tuple[int, int], int] = {}
            for text in batch.column("text").to_pylist():
                for pair in {*self._hashes(text)} - {None}:
                    counts[pair] = counts.get(pair, 0) + 1
            if counts:
                h, f = zip(*counts)
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(h, pa.int64()), "f": pa.array(f, pa.int64()),
                    "n": pa.array(counts.values(), pa.int64())})

    def index(self, docs: DataFrame) -> tuple[DataFrame, int]:
        """(shard, arrays), and the number of shards: all lines that enough documents have."""
        counts = docs.mapInArrow(self.counted, "h long, f long, n long").groupBy("h", "f").agg(
            F.sum("n").alias("n")).where(F.col("n") >= self.min_docs)
        frequent = stage(counts, "frequent-lines")
        shards = 1 + frequent.count() // SHARD_KEYS
        shard = F.expr(f"cast(shiftrightunsigned(h, 32) % {shards} as long)")
        rows = frequent.withColumn("shard", shard).repartition(shards, "shard")
        built = rows.sortWithinPartitions("shard").mapInArrow(
            _build_shards, "shard long, arrays binary")
        return stage(built, "line-shards"), shards

    def _drop(self, texts: pa.Array, frequent) -> dict[str, pa.Array]:
        """frequent: from (row, pair) lists to a flag each."""
        rows, pairs, lines = [], [], []
        for row, text in enumerate(texts.to_pylist()):
            lines.append((text or "").split("\n"))
            for at, pair in enumerate(self._hashes(text)):
                if pair is not None:
                    rows.append((row, at))
                    pairs.append(pair)
        gone: list[set[int]] = [set() for _ in lines]
        if pairs:
            both = np.array(pairs, np.int64)
            at_row = np.array(rows, np.int64)
            for row, at in at_row[frequent(at_row[:, 0], both[:, 0], both[:, 1])].tolist():
                gone[row].add(at)
        return {"n_lines": pa.array([len(x) for x in lines], pa.int64()),
                "n_dropped": pa.array([len(x) for x in gone], pa.int64()),
                "kept": pa.array(["\n".join(x for i, x in enumerate(own) if i not in out)
                                  for own, out in zip(lines, gone)], pa.string())}

    def probe_local(self, arrays, shards: int):
        """A task that probes arrays it holds in full."""
        def task(batches):
            held: dict[int, list[Shard]] = {}
            for shard, data in arrays.value:
                held.setdefault(shard, []).append(Shard.from_bytes(data))

            def frequent(_, h, f):
                found, own = np.zeros(len(h), bool), shard_of(h, shards)
                for shard in np.unique(own):
                    mine = np.flatnonzero(own == shard)
                    for part in held.get(int(shard), []):
                        found[mine] |= part.counts_of(h[mine], f[mine]) > 0
                return found

            for batch in slices(batches):
                yield pa.RecordBatch.from_pydict({"id": batch.column("id")} |
                                                 self._drop(batch.column("text"), frequent))
        return task

    def probes(self, shards: int):
        """A task that makes (shard, salt, h, f, key) for the distinct lines of each document."""
        def task(batches):
            for batch in slices(batches):
                keys, pairs = [], []
                for key, text in zip(batch.column("key").to_pylist(),
                                     batch.column("text").to_pylist()):
                    own = {*self._hashes(text)} - {None}
                    pairs += own
                    keys += [key] * len(own)
                if pairs:
                    both = np.array(pairs, np.int64)
                    h, key = both[:, 0].copy(), np.array(keys, np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "shard": shard_of(h, shards),
                        "salt": (mixed(key.view(np.uint64).copy()) % np.uint64(SALTS)).view(np.int64),
                        "h": h, "f": both[:, 1].copy(), "key": key})
        return task

    @staticmethod
    def probe_sorted(batches) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard and salt, the shard's arrays before its probes."""
        own, held = None, []
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            is_array = batch.column("arrays").is_valid().to_numpy(False)
            cuts = np.flatnonzero(np.diff(shard) | np.diff(is_array.astype(np.int8))) + 1
            for a, b in zip([0, *cuts], [*cuts, len(shard)]):
                if b == a:
                    continue
                if own != shard[a]:
                    own, held = shard[a], []
                part = batch.slice(a, b - a)
                if is_array[a]:
                    held = [Shard.from_bytes(x) for x in {*part.column("arrays").to_pylist(),
                                                           *(s.to_bytes() for s in held)}]
                    continue
                h, f = (part.column(c).to_numpy() for c in ("h", "f"))
                found = np.zeros(len(h), bool)
                for s in held:
                    found |= s.counts_of(h, f) > 0
                yield pa.RecordBatch.from_pydict({
                    "key": part.column("key").to_numpy()[found], "h": h[found], "f": f[found]})

    def finish(self, batches) -> Iterator[pa.RecordBatch]:
        """Drop by the lists of frequent hashes that came with each document."""
        for batch in slices(batches):
            hs, at = list_parts(batch.column("hs"))
            fs, _ = list_parts(batch.column("fs"))

            def frequent(rows, h, f, hs=hs, fs=fs, at=at):
                found = np.zeros(len(h), bool)
                for row in np.unique(rows):
                    mine = np.flatnonzero(rows == row)
                    known = {*zip(hs[at[row]:at[row + 1]].tolist(), fs[at[row]:at[row + 1]].tolist())}
                    found[mine] = [p in known for p in zip(h[mine].tolist(), f[mine].tolist())]
                return found

            yield pa.RecordBatch.from_pydict({"id": batch.column("id")} |
                                             self._drop(batch.column("text"), frequent))

    def run(self, docs: DataFrame) -> DataFrame:
        spark = docs.sparkSession
        index, shards = self.index(docs)
        size = index.agg(F.sum(F.length("arrays"))).first()[0] or 0
        if size <= self.most_bytes:
            arrays = spark.sparkContext.broadcast([(r.shard, bytes(r.arrays)) for r in index.collect()])
            return docs.mapInArrow(self.probe_local(arrays, shards), f"id long, {_RESULT}")
        copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = docs.mapInArrow(self.probes(shards), "shard long, salt long, h long, f long, key long")
        both = rows.unionByName(copies.withColumn("salt", F.col("salt").cast("long")),
                                allowMissingColumns=True)
        dealt = both.repartition("shard", "salt").sortWithinPartitions(
            "shard", "salt", F.col("arrays").isNull())
        hits = dealt.mapInArrow(self.probe_sorted, "key long, h long, f long").distinct()
        lists = hits.groupBy("key").agg(F.collect_list(F.struct("h", "f")).alias("p")).select(
            "key", F.col("p.h").alias("hs"), F.col("p.f").alias("fs"))
        return docs.join(lists, "key", "left").mapInArrow(self.finish, f"id long, {_RESULT}")


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
               text_col: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """(id, n_lines, n_dropped, kept): kept is the lines that stay, joined by line feeds."""
    found = LineDedup(min_docs, min_chars, most_bytes).run(documents(docs, id_col, text_col))
    return found.withColumnRenamed("id", id_col)
