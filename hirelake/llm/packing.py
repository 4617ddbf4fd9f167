"""Packing documents into sequences by minimum bin slack.

Texts are tokenized once; a document is its ids and an end id, and only one that is longer than
a sequence is cut: into full pieces, the first of which may be shorter. Pieces of one length
are interchangeable, so the packing is planned on the number of pieces per length alone (at
most `capacity` numbers, whatever the corpus): per bin, the longest piece left and the fullest
combination that a subset-sum over a bitset of reachable lengths finds for the rest. The
combination is removed as often as its pieces last, which leaves a plan of a few thousand lines.

Each piece finds its place from its rank among the pieces of its length: its rank within its
task plus the pieces of earlier tasks, so no length is gathered anywhere. Defined cases: a null
text is empty, and an empty document is its end id; repeated rows are packed each; null ids
stay null; other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import documents, slices, stage

CAPACITY = 2048
END = 0
_tokenizers: dict[str, "Tokens"] = {}


class Tokens:
    """ids of a text, as the public tokenizer file gives them without special tokens added.

    The same vocabulary as ranks is several times faster and is used for all texts but those
    that spell one of the file's special tokens.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def load(cls, name: str) -> Tokens:
        if name not in _tokenizers:
            _tokenizers[name] = cls(name)
        return _tokenizers[name]

    def ids(self, text: str) -> np.ndarray:
        if any(t in text for t in self.special):
            own = self.exact.encode(text, add_special_tokens=False).ids
        else:
            own = self.fast.encode_ordinary(text)
        return np.array([*own, END], "<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


# --- the plan ------------------------------------------------------------------------------


def fullest(counts: dict[int, int], room: int) -> Counter:
    """Pieces, at most counts[length] of each length, that fill room as far as possible."""
    reach, steps = 1, []
    limit = (1 << room + 1) - 1
    for length in sorted((n for n in counts if n <= room and counts[n]), reverse=True):
        left, many = min(counts[length], room // length), 1
        while left:
            many = min(many, left)
            steps.append((length, many, reach))
            reach |= reach << length * many & limit
            left -= many
            many *= 2
        if reach >> room:
            break
    at, chosen = reach.bit_length() - 1, Counter()
    for length, many, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += many
            at -= length * many
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """(pieces of a bin, number of such bins), until no piece is left."""
    counts = {n: c for n, c in counts.items() if c}
    bins = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        pieces = fullest(counts, capacity - longest)
        counts[longest] += 1
        pieces[longest] += 1
        times = min(counts[n] // k for n, k in pieces.items())
        for n, k in pieces.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        bins.append((pieces, times))
    return bins


class Places:
    """From a length and a rank among its pieces to a sequence and an offset."""

    def __init__(self, bins: list[tuple[Counter, int]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        used: Counter = Counter()
        sequence = 0
        for pieces, times in bins:
            offset = 0
            for length, many in sorted(pieces.items(), reverse=True):
                rows.setdefault(length, []).append((used[length], many, sequence, offset))
                used[length] += many * times
                offset += many * length
            sequence += times
        self.rows = {n: np.array(r, np.int64).T for n, r in rows.items()}

    def find(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, many, sequence, offset = self.rows[length]
        at = np.searchsorted(first, ranks, side="right") - 1
        nth = ranks - first[at]
        return sequence[at] + nth // many[at], offset[at] + nth % many[at] * length


# --- what tasks do -------------------------------------------------------------------------


def _pieces(tokenizer: str, capacity: int, with_ids: bool):
    def task(batches) -> Iterator[pa.RecordBatch]:
        tokens, ranks = Tokens.load(tokenizer), Counter()
        task_id = TaskContext.get().partitionId()
        names = ["id", "piece", "start", "length", "crc", "rank", "task"] + ["ids"] * with_ids
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = tokens.ids(text)
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start:start + length]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own.tobytes()),
                                 ranks[length], task_id) + (own.tolist(),) * with_ids)
                    ranks[length] += 1
            yield pa.RecordBatch.from_pydict({
                n: pa.array(list(c), _TYPES.get(n, pa.int64())) for n, c in zip(names, zip(*rows))})
    return task


_TYPES = {"piece": pa.int32(), "task": pa.int32(), "ids": pa.list_(pa.int64())}


def _placed(places):
    def task(batches) -> Iterator[pa.RecordBatch]:
        found = places.value
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros((2, len(ranks)), np.int64)
            order = np.argsort(lengths, kind="stable")
            edges = np.flatnonzero(np.diff(lengths[order])) + 1
            for own in np.split(order, edges):
                if len(own):
                    sequence[own], offset[own] = found.find(int(lengths[own[0]]), ranks[own])
            columns = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": sequence, "offset": offset})
    return task


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = CAPACITY,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, [ids,] sequence_id, offset), one row per piece."""
    ids = ", ids array<long>" if with_ids else ""
    rows = documents(docs, id_col, text_col).mapInArrow(
        _pieces(tokenizer, capacity, with_ids), "id long, piece int, start long, length long, "
        f"crc long, rank long, task int{ids}")
    pieces = stage(rows, "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = stage(counts, "piece-counts")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0))
                           .alias("before"))
    # one row per length, at most as many as a sequence has places
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places(plan_bins(totals, capacity)))
    ranked = pieces.join(before.hint("merge"), ["length", "task"]).select(
        "id", "piece", "start", "length", "crc", *["ids"] * with_ids,
        (F.col("rank") + F.col("before")).alias("rank"))
    placed = ranked.mapInArrow(_placed(places), "id long, piece int, start long, length long, "
                               f"crc long{ids}, sequence_id long, offset long")
    return placed.withColumnsRenamed({"id": id_col, "crc": "ids_crc32"})
