"""Repeated fixed-length windows over all documents, found level by level.

A window is `window` consecutive elements (words or bytes) of one document. Two equal windows
have the same smallest hash among their stretches of `anchor` elements (about half a window),
so neighbouring windows that share this smallest stretch form a *run*, known by that hash.
There is a run for every (window - anchor) / 2 elements or so, which is what is shuffled:

1. runs are grouped by their hash; a hash seen once ends there: nothing longer can repeat;
2. where all runs of a hash are equal in full, all their windows are decided at once;
3. only where runs differ are their windows compared at full length.

Elements are compared by 64-bit hashes of the stretch; groups of a hash are pre-aggregated in
each task and again before the shuffle, and the joins on it are plain inner joins that
adaptive execution can split, so a passage shared by a third of the documents is no hot task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import (
    Rolling, list_parts, slices, stage, text_bytes)

# From text bytes and row ends to a hash per element and the first element of each row.
Elements = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
# From texts and the covered elements to the columns of the result.
Finish = Callable[[pa.Array, np.ndarray, np.ndarray], dict[str, pa.Array]]

_FAR = np.iinfo(np.int64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def only(column: pa.Array, where: np.ndarray) -> pa.Array:
    """The column with nulls elsewhere."""
    return column.take(pa.array(np.arange(len(column)), mask=~where))


@dataclass
class Runs:
    """Runs of windows of one slice: first and last window start, row, anchor hash."""
    starts: np.ndarray
    stops: np.ndarray  # last window start, inclusive
    rows: np.ndarray
    anchors: np.ndarray
    rolling: Rolling
    tied: np.ndarray | None = None  # the anchor occurs twice, so windows may repeat within

    def of_row(self, row: int) -> slice:
        return slice(*np.searchsorted(self.rows, [row, row + 1]))


def find_runs(elements: np.ndarray, first: np.ndarray, window: int, anchor: int,
              ties: bool = False) -> Runs:
    rolling = Rolling(elements)
    count = len(elements) - window + 1
    long = np.flatnonzero(np.diff(first) >= window)
    if count <= 0 or not len(long):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, rolling, none.astype(bool))
    pieces = rolling.all(anchor)
    width = window - anchor + 1
    least = sliding_min(pieces, width)
    change = np.zeros(count + 1, np.int8)
    change[first[long]] = 1
    change[first[long + 1] - window + 1] = -1
    valid = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    differs = np.empty(count + 1, bool)
    differs[0] = differs[-1] = True
    differs[1:-1] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    starts = np.flatnonzero(differs[:-1] & valid)
    stops = np.flatnonzero(differs[1:] & valid)
    tied = None
    if ties:
        least_valid = np.where(valid, least, np.uint64(0))
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least_valid,
                                 np.zeros(width - 1, np.uint64)])
        most = ~sliding_min(~padded, width)
        chosen = np.flatnonzero(pieces == most)
        values = pieces[chosen]
        again = (values[1:] == values[:-1]) & (np.diff(chosen) < window)
        tied = np.isin(least[starts], values[1:][again])
    rows = np.searchsorted(first, starts, side="right") - 1
    return Runs(starts, stops, rows, least[starts].view(np.int64), rolling, tied)


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorting order, where each distinct value begins in it, and the distinct values."""
    order = np.argsort(values)
    ordered = values[order]
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return order, at, ordered[at]


@dataclass
class RepeatFinder:
    """Marks the elements of windows that also start anywhere else, same document included."""
    elements: Elements
    finish: Finish
    result: str  # DDL of the columns that finish makes
    window: int
    anchor: int

    # --- what tasks do ---

    def _runs(self, batch: pa.RecordBatch, ties: bool = False) -> Runs:
        return find_runs(*self.elements(*text_bytes(batch.column("text"))),
                         self.window, self.anchor, ties)

    def run_rows(self, batches) -> Iterator[pa.RecordBatch]:
        """One row for each anchor hash of a slice: smallest and largest run, number of runs."""
        for batch in slices(batches):
            runs = self._runs(batch, ties=True)
            if not len(runs.starts):
                continue
            spans = runs.rolling.between(runs.starts, runs.stops + self.window).view(np.int64)
            order, at, values = grouped(runs.anchors)
            low = np.where(runs.tied, _FAR.min, spans)[order]
            high = np.where(runs.tied, _FAR.max, spans)[order]
            n = 1 + runs.tied[order].astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "v": values, "low": np.minimum.reduceat(low, at),
                "high": np.maximum.reduceat(high, at), "n": np.add.reduceat(n, at)})

    def row_anchors(self, batches) -> Iterator[pa.RecordBatch]:
        """The distinct anchor hashes of each document."""
        for batch in slices(batches):
            runs = self._runs(batch)
            if not len(runs.starts):
                continue
            order = np.lexsort((runs.anchors, runs.rows))
            rows, values = runs.rows[order], runs.anchors[order]
            new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])])
            yield pa.RecordBatch.from_pydict({
                "v": values[new], "key": batch.column("key").to_numpy(False)[rows[new]]})

    def _covered(self, batch, decided, windows) -> tuple[np.ndarray, np.ndarray]:
        """Which elements lie in a repeated window, and the first element of each row."""
        values, first = self.elements(*text_bytes(batch.column("text")))
        change = np.zeros(len(values) + 1, np.int32)
        flags, at = list_parts(decided)
        full, full_at = list_parts(windows) if windows is not None else (None, None)
        if len(flags) or (full is not None and len(full)):
            runs = find_runs(values, first, self.window, self.anchor)
            for row in np.flatnonzero(np.diff(at)):
                own = runs.of_row(row)
                hit = np.isin(runs.anchors[own], flags[at[row]:at[row + 1]])
                np.add.at(change, runs.starts[own][hit], 1)
                np.add.at(change, runs.stops[own][hit] + self.window, -1)
        if full is not None and len(full):
            every = runs.rolling.all(self.window).view(np.int64)
            for row in np.flatnonzero(np.diff(full_at)):
                mine = every[first[row]:first[row + 1] - self.window + 1]
                hit = np.flatnonzero(np.isin(mine, full[full_at[row]:full_at[row + 1]]))
                change[first[row] + hit] += 1
                np.add.at(change, first[row] + hit + self.window, -1)
        return np.cumsum(change[:-1], dtype=np.int32) > 0, first

    def decide(self, batches) -> Iterator[pa.RecordBatch]:
        """Finish the documents that runs decide; pass on those whose windows differ."""
        names = [f.split()[0] for f in self.result.split(",")]
        for batch in slices(batches):
            open_runs = batch.column("open")
            waits = np.diff(list_parts(open_runs)[1]) > 0
            covered, first = self._covered(batch, batch.column("decided"), None)
            made = self.finish(batch.column("text"), covered, first)
            out = {n: batch.column(n) for n in ("key", "id")}
            out |= {n: only(batch.column(n), waits) for n in ("text", "decided", "open")}
            out |= {n: only(made[n], ~waits) for n in names} | {"waits": pa.array(waits)}
            yield pa.RecordBatch.from_pydict(out)

    def window_rows(self, batches, per_key: bool) -> Iterator[pa.RecordBatch]:
        """Full-length hashes of the windows in undecided runs: per document, or per slice."""
        for batch in slices(batches):
            runs = self._runs(batch)
            open_runs, at = list_parts(batch.column("open"))
            every = runs.rolling.all(self.window).view(np.int64)
            rows, values = [], []
            for row in np.flatnonzero(np.diff(at)):
                own = runs.of_row(row)
                hit = np.flatnonzero(np.isin(runs.anchors[own], open_runs[at[row]:at[row + 1]]))
                if len(hit):
                    some = [every[a:b + 1] for a, b in
                            zip(runs.starts[own][hit], runs.stops[own][hit])]
                    values.append(np.concatenate(some))
                    rows.append(np.full(len(values[-1]), row))
            if not values:
                continue
            rows, values = np.concatenate(rows), np.concatenate(values)
            order = np.lexsort((rows, values))
            rows, values = rows[order], values[order]
            new = np.concatenate([[True], values[1:] != values[:-1]])
            if per_key:
                new[1:] |= rows[1:] != rows[:-1]
                yield pa.RecordBatch.from_pydict({
                    "w": values[new], "key": batch.column("key").to_numpy(False)[rows[new]]})
            else:
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_pydict({
                    "w": values[at], "n": np.diff(np.append(at, len(values)))})

    def complete(self, batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            covered, first = self._covered(batch, batch.column("decided"), batch.column("full"))
            made = self.finish(batch.column("text"), covered, first)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id")} | made)

    # --- what Spark does ---

    def repeated_runs(self, docs: DataFrame) -> DataFrame:
        """(v, uniform): anchor hashes seen more than once."""
        rows = docs.mapInArrow(self.run_rows, "v long, low long, high long, n long")
        groups = rows.groupBy("v").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                       F.sum("n").alias("n"))
        return groups.where("n > 1").select("v", F.expr("low = high").alias("uniform"))

    def flags(self, docs: DataFrame, repeated: DataFrame) -> DataFrame:
        """(key, decided, open): per document the repeated hashes, by whether they are settled."""
        hits = docs.mapInArrow(self.row_anchors, "v long, key long").join(repeated, "v")
        return hits.groupBy("key").agg(
            F.collect_set(F.expr("if(uniform, v, null)")).alias("decided"),
            F.collect_set(F.expr("if(uniform, null, v)")).alias("open"))

    def repeated_windows(self, waiting: DataFrame) -> DataFrame:
        """(key, full): per undecided document the hashes of its repeated windows."""
        rows = waiting.mapInArrow(lambda b: self.window_rows(b, False), "w long, n long")
        groups = rows.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w")
        hits = waiting.mapInArrow(lambda b: self.window_rows(b, True), "w long, key long")
        return hits.join(groups, "w").groupBy("key").agg(F.collect_set("w").alias("full"))

    def run(self, docs: DataFrame) -> DataFrame:
        """docs(key, id, text) → (id, columns of finish), one row per input row."""
        repeated = stage(self.repeated_runs(docs), "repeated-runs")
        flags = stage(self.flags(docs, repeated), "run-flags")
        names = ", ".join(["key long, id long, text string, decided array<long>, "
                           "open array<long>", self.result, "waits boolean"])
        joined = docs.join(flags, "key", "left")
        both = stage(joined.mapInArrow(self.decide, names), "decided-texts", ("waits",))
        results = [f.split()[0] for f in self.result.split(",")]
        done = both.where("not waits").select("id", *results)
        waiting = both.where("waits").select("key", "id", "text", "decided", "open")
        full = stage(self.repeated_windows(waiting), "window-flags")
        rest = waiting.drop("open").join(full, "key", "left").mapInArrow(
            self.complete, f"id long, {self.result}")
        return done.unionByName(rest)
