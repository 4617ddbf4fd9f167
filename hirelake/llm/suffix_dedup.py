"""Suffix dedup: remove bytes of strings that an earlier document has.

Prefix doubling, up to the threshold of 50 bytes. First every position would get a name of 25 bytes, a
64-bit hash; only one in a run of windows with an equal minimum is named (see `repeats`), as a name
for every byte would move 16 bytes per byte of text. Spark shuffles the named positions and drops
those that no other document has. Where all runs of a name are equal to their ends, they are
decided: all but the first document's go. Where they differ, Spark sorts the positions by name, with
their bytes, and each stretch of the sort is ranked: strings of 25 bytes (BASE) first, compared by
content, then pairs of the ranks of a place and of the one 25 bytes on, and so on with doubled
offsets for longer thresholds. Places whose rank no second document has leave; at the threshold the
ranks are left with the documents to keep. Names with over GROUP positions are not gathered: their
strings are dealt out one by one and compared by name and hash.

Chance collisions: two names that collide are told apart by what follows. Only runs of one name that
differ and have equal hashes of 64 bits (of the whole run; of the string in names over GROUP) would
be taken for equal.

Defined cases: a null or empty text has no bytes; a row given twice under one id is no earlier
document; a null id counts as the largest, and null ids never precede each other; matches stop
at document ends; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import BYTE_VALUES, Rolling, documents, list_parts, slices, stage, text_bytes
from hirelake.llm.repeats import RepeatFinder, Runs, grouped, only

GROUP = 1 << 17  # positions of a name that are compared in one place, some 10 MB
BASE = 25  # ranking starts at no more bytes
CHUNK = 1 << 15  # positions that a task compares at a time, and the rest of a name

_LAST = np.iinfo(np.int64).max


def byte_values(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[data], ends


def kept_bytes(texts: pa.Array, covered: np.ndarray, first: np.ndarray) -> dict[str, pa.Array]:
    data, _ = text_bytes(texts)
    total = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])
    begins = covered.copy()
    begins[1:] &= ~covered[:-1]
    inner = first[1:-1]
    inner = inner[inner < len(covered)]
    begins[inner] = covered[inner]
    spans = np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])
    left = data[~covered]
    at = first - total[first]
    kept = [left[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
    return {"n_bytes": pa.array(np.diff(first), pa.int64()),
            "n_removed": pa.array(np.diff(total[first]), pa.int64()),
            "n_spans": pa.array(np.diff(spans[first]), pa.int64()),
            "kept": pa.array(kept, pa.binary())}


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("id").fill_null(_LAST).to_numpy(False)


def dense_ranks(values: np.ndarray) -> np.ndarray:
    """Place of each value among the distinct ones."""
    order = np.argsort(values)
    ordered = values[order]
    out = np.zeros(len(values), np.uint64)
    if len(values):
        out[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
    return out


def string_ranks(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the strings of that length: equal exactly where the bytes are.

    Strings are sorted by hash; neighbours of one hash are compared byte by byte, and should two
    differ, the strings are sorted by their bytes instead.
    """
    values = Rolling(BYTE_VALUES[data]).all(length)[places]
    order = np.argsort(values)
    ordered, at = values[order], places[order]
    same = np.flatnonzero(ordered[1:] == ordered[:-1])
    width = 8 if length >= 8 else 1
    words = np.ndarray(max(0, len(data) - width + 1), f"<u{width}", np.ascontiguousarray(data),
                       strides=(1,))
    parts = sorted({*range(0, length - width + 1, width), length - width})
    if any((words[at[same] + o] != words[at[same + 1] + o]).any() for o in parts):
        keys = [words[places + o] for o in parts]
        order = np.lexsort(keys)
        new = np.zeros(len(places) - 1, bool)
        for key in keys:
            new |= key[order[1:]] != key[order[:-1]]
    else:
        new = ordered[1:] != ordered[:-1]
    out = np.zeros(len(places), np.uint64)
    out[order[1:]] = np.cumsum(new)
    return out


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of stretches, one stretch after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class EarlierFinder(RepeatFinder):
    """Marks the elements of windows that also start in a document with a smaller id."""

    def run_rows(self, batches) -> Iterator[pa.RecordBatch]:
        """One row for each name of a slice: least and greatest pair and id, number of runs."""
        for batch in slices(batches):
            runs = self._runs(batch)
            if not len(runs.starts):
                continue
            order, at, values = grouped(runs.anchors)
            pairs = runs.rolling.between(runs.starts, runs.stops + self.window).view(np.int64)[order]
            ids = _ids(batch)[runs.rows][order]
            yield pa.RecordBatch.from_pydict({
                "v": values, "low": np.minimum.reduceat(pairs, at),
                "high": np.maximum.reduceat(pairs, at), "first": np.minimum.reduceat(ids, at),
                "last": np.maximum.reduceat(ids, at), "n": np.diff(np.append(at, len(order)))})

    def repeated_runs(self, docs: DataFrame) -> DataFrame:
        """(v, kind, first): names that several documents have; kind 0 is decided, 2 is large."""
        rows = docs.mapInArrow(
            self.run_rows, "v long, low long, high long, first long, last long, n long")
        groups = rows.groupBy("v").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.min("first").alias("first"),
            F.max("last").alias("last"), F.sum("n").alias("n")).where("first < last")
        kind = F.expr(f"case when low = high then 0 when n <= {GROUP} then 1 else 2 end")
        return groups.select("v", kind.alias("kind"), "first")

    def flags(self, docs: DataFrame, repeated: DataFrame) -> DataFrame:
        """(key, decided, open, large): per document the names that it shares, by kind."""
        hits = docs.mapInArrow(self.row_anchors, "v long, key long, id long").join(repeated, "v")
        hits = hits.where("kind > 0 or id > first")
        return hits.groupBy("key").agg(*(
            F.collect_set(F.expr(f"if(kind = {kind}, v, null)")).alias(name)
            for kind, name in enumerate(("decided", "open", "large"))))

    def row_anchors(self, batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            runs = self._runs(batch)
            if not len(runs.starts):
                continue
            order = np.lexsort((runs.anchors, runs.rows))
            rows, values = runs.rows[order], runs.anchors[order]
            new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])])
            rows = rows[new]
            yield pa.RecordBatch.from_pydict({
                "v": values[new], "key": batch.column("key").to_numpy(False)[rows],
                "id": _ids(batch)[rows]})

    def decide(self, batches) -> Iterator[pa.RecordBatch]:
        """Finish the documents that runs decide; pass on the others with their spans so far."""
        names = [f.split()[0] for f in self.result.split(",")]
        for batch in slices(batches):
            waits = sum(np.diff(list_parts(batch.column(c))[1]) for c in ("open", "large")) > 0
            covered, first = self._covered(batch, batch.column("decided"), None)
            made = self.finish(batch.column("text"), covered, first)
            out = {"row": batch.column("row"), "id": batch.column("id")}
            out |= {n: only(batch.column(n), waits) for n in ("text", "decided", "open", "large")}
            out |= {n: only(made[n], ~waits) for n in names} | {"waits": pa.array(waits)}
            yield pa.RecordBatch.from_pydict(out)

    def _chosen(self, batch: pa.RecordBatch, column: str) -> tuple[Runs, np.ndarray]:
        """The runs of a slice whose names are listed for their document."""
        runs = self._runs(batch)
        names, at = list_parts(batch.column(column))
        chosen = np.zeros(len(runs.starts), bool)
        for row in np.flatnonzero(np.diff(at)):
            own = runs.of_row(row)
            chosen[own] = np.isin(runs.anchors[own], names[at[row]:at[row + 1]])
        return runs, np.flatnonzero(chosen)

    def span_rows(self, batches) -> Iterator[pa.RecordBatch]:
        """(v, id, row, start, bytes) of each run that is open."""
        for batch in slices(batches):
            runs, chosen = self._chosen(batch, "open")
            if not len(chosen):
                continue
            data, first = text_bytes(batch.column("text"))
            starts, rows = runs.starts[chosen], runs.rows[chosen]
            sizes = runs.stops[chosen] - starts + self.window
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            held = data[_stretches(starts, sizes)]
            yield pa.RecordBatch.from_pydict({
                "v": runs.anchors[chosen], "id": _ids(batch)[rows],
                "row": batch.column("row").to_numpy(False)[rows], "start": starts - first[rows],
                "bytes": pa.BinaryArray.from_buffers(
                    pa.binary(), len(chosen), [None, pa.py_buffer(ends), pa.py_buffer(held)])})

    def compare(self, batches) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by name; the spans of their windows that an earlier document has."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK:
                rows = pa.Table.from_batches(held)
                names = rows.column("v").to_numpy()
                whole = int(np.searchsorted(names, names[-1]))  # the last name may go on
                if whole:
                    yield self._compared(rows.slice(0, whole))
                    held, size = rows.slice(whole).to_batches(), len(names) - whole
        if held:
            yield self._compared(pa.Table.from_batches(held))

    def _compared(self, rows: pa.Table) -> pa.RecordBatch:
        data, ends = text_bytes(rows.column("bytes").combine_chunks())
        counts = np.diff(ends) - self.window + 1
        at = _stretches(ends[:-1], counts)
        run = np.repeat(np.arange(len(counts)), counts)
        ids = rows.column("id").to_numpy()
        gone = np.append(self.has_earlier(data, at, ids[run]), False)
        edge = np.concatenate([[True], run[1:] != run[:-1]])
        begins = np.flatnonzero(gone[:-1] & (edge | ~np.concatenate([[False], gone[:-2]])))
        stops = np.flatnonzero(gone[:-1] & (np.append(edge[1:], True) | ~gone[1:]))
        mine = run[begins]
        origin = rows.column("start").to_numpy()[mine] - ends[:-1][mine]
        return pa.RecordBatch.from_pydict({
            "row": rows.column("row").to_numpy()[mine], "id": ids[mine],
            "begin": at[begins] + origin, "end": at[stops] + origin + self.window})

    def has_earlier(self, data: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which strings of the threshold's length, starting at `at`, a smaller id has too.

        Prefix doubling: the rank of a longer string is that of the pair of ranks of its head and of
        its tail; places whose string only one id has are ranked no further.
        """
        lengths = [self.window]
        while lengths[0] > BASE:
            lengths.insert(0, (lengths[0] + 1) // 2)
        rank = np.zeros(len(data), np.uint64)
        live = np.arange(len(at))
        for n, length in enumerate(lengths):
            # tails lie at sums of the offsets of the rounds that are left
            needed = np.zeros(len(data), bool)
            offsets = [0]
            for shorter, longer in zip(lengths[n:], lengths[n + 1:]):
                offsets += [o + longer - shorter for o in offsets]
            for o in offsets:
                needed[at[live] + o] = True
            places = np.flatnonzero(needed)
            if n:
                pairs = rank[places] << np.uint64(32)
                pairs |= rank[places + length - lengths[n - 1]]
                rank[places] = dense_ranks(pairs)
            else:
                rank[places] = string_ranks(data, places, length)
            mine = rank[at[live]].astype(np.int64)
            least = np.full(len(places), _LAST)
            most = np.full(len(places), np.iinfo(np.int64).min)
            np.minimum.at(least, mine, ids[live])
            np.maximum.at(most, mine, ids[live])
            several = least[mine] < most[mine]
            live, mine = live[several], mine[several]
        gone = np.zeros(len(at), bool)
        gone[live] = ids[live] > least[mine]
        return gone

    def string_rows(self, batches, places: bool) -> Iterator[pa.RecordBatch]:
        """Strings of runs with large names: (v, w, row, id, begin), or least and greatest id of v, w.

        Hashes w are compared among strings of one name only, so chance collisions stay as rare as
        names are short of strings.
        """
        for batch in slices(batches):
            runs, chosen = self._chosen(batch, "large")
            if not len(chosen):
                continue
            sizes = runs.stops[chosen] - runs.starts[chosen] + 1
            at, rows = _stretches(runs.starts[chosen], sizes), np.repeat(runs.rows[chosen], sizes)
            values, ids = runs.rolling.all(self.window)[at].view(np.int64), _ids(batch)[rows]
            names = np.repeat(runs.anchors[chosen], sizes)
            if places:
                first = text_bytes(batch.column("text"))[1]
                yield pa.RecordBatch.from_pydict({
                    "v": names, "w": values, "row": batch.column("row").to_numpy(False)[rows], "id": ids,
                    "begin": at - first[rows]})
            else:
                order = np.lexsort((values, names))
                names, values = names[order], values[order]
                new = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1])
                                                     | (values[1:] != values[:-1])]))
                yield pa.RecordBatch.from_pydict({
                    "v": names[new], "w": values[new], "first": np.minimum.reduceat(ids[order], new),
                    "last": np.maximum.reduceat(ids[order], new)})

    def earlier_spans(self, waiting: DataFrame) -> DataFrame:
        """(row, id, begins, ends) of what undecided documents lose to earlier ones."""
        some = waiting.where(F.size("open") > 0).mapInArrow(
            self.span_rows, "v long, id long, row long, start long, bytes binary")
        spans = some.repartition("v").sortWithinPartitions("v").mapInArrow(
            self.compare, "row long, id long, begin long, end long")
        large = waiting.where(F.size("large") > 0)
        strings = large.mapInArrow(lambda b: self.string_rows(b, False),
                                   "v long, w long, first long, last long").groupBy("v", "w").agg(
            F.min("first").alias("first"), F.max("last").alias("last")).where("first < last")
        places = large.mapInArrow(lambda b: self.string_rows(b, True),
                                  "v long, w long, row long, id long, begin long")
        others = places.join(strings.drop("last"), ["v", "w"]).where("id > first").select(
            "row", "id", "begin", (F.col("begin") + self.window).alias("end"))
        return spans.unionByName(others).groupBy("row", "id").agg(
            F.collect_list(F.struct("begin", "end")).alias("s")).select(
            "row", "id", F.col("s.begin").alias("begins"), F.col("s.end").alias("ends"))

    def complete(self, batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            covered, first = self._covered(batch, batch.column("decided"), None)
            (begins, at), (ends, _) = (list_parts(batch.column(c)) for c in ("begins", "ends"))
            origin = np.repeat(first[:-1], np.diff(at))
            change = np.zeros(len(covered) + 1, np.int32)
            np.add.at(change, begins + origin, 1)
            np.add.at(change, ends + origin, -1)
            covered |= np.cumsum(change[:-1], dtype=np.int32) > 0
            made = self.finish(batch.column("text"), covered, first)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id")} | made)

    def run(self, docs: DataFrame) -> DataFrame:
        repeated = stage(self.repeated_runs(docs), "repeated-names")
        flags = stage(self.flags(docs, repeated), "name-flags")
        # Places in a text need a row, not just an id: rows alike in id and text are alike here.
        joined = docs.withColumn("row", F.xxhash64("key", "text")).join(flags, "key", "left")
        lists = "decided array<long>, open array<long>, large array<long>"
        both = stage(joined.mapInArrow(self.decide, f"row long, id long, text string, {lists}, "
                                       f"{self.result}, waits boolean"), "decided-texts", ("waits",))
        results = [f.split()[0] for f in self.result.split(",")]
        waiting = both.where("waits").select(
            "row", "id", "text", *lists.replace(" array<long>", "").split(", "))
        spans = stage(self.earlier_spans(waiting), "earlier-spans")
        known = waiting.drop("open", "large").withColumn("by", F.coalesce("id", F.lit(_LAST)))
        spans = spans.withColumnsRenamed({"row": "of", "id": "by"})
        rest = known.join(spans, (known["row"] == spans["of"]) & (known["by"] == spans["by"]), "left")
        rest = rest.select("id", "text", "decided", "begins", "ends").mapInArrow(
            self.complete, f"id long, {self.result}")
        return both.where("not waits").select("id", *results).unionByName(rest)


def suffix_dedup(docs: DataFrame, threshold: int = 50, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): kept is the bytes that stay (may be no UTF-8)."""
    finder = EarlierFinder(byte_values, kept_bytes,
                           "n_bytes long, n_removed long, n_spans long, kept binary",
                           threshold, (threshold + 1) // 2)
    return finder.run(documents(docs, id_col, text_col)).withColumnRenamed("id", id_col)
