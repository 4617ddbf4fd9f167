"""Benchmark decontamination with suffix arrays of the training texts.

Each task builds suffix arrays over shards of its documents: the words of a shard become ranks
in the benchmark's vocabulary, and suffixes are sorted by them four words at a time. Every
benchmark suffix is binary-searched in the first four words; suffixes outside all intervals
found cannot match on and leave the array, the others are sorted and searched by the next four,
and so on until nothing is left, which gives the interval of each benchmark window, equal ones taken
once: a place of the text has one window of each length at most, however often the benchmark and the
text repeat it. How far the text goes on as the benchmark does is then found for each place from the
sorted suffixes of the benchmark, by intervals of stretches of 1, 2, 4, ... words. Suffixes that do not begin with two words in the
benchmark's order are left out of the array from the start: they match one word at most, which
is looked up as such.

The benchmark is the stated query set. It is read in blocks of `block_words` words, and the
arrays are searched for one block after the other; only a block is held by a task at a time.

Words are runs of A-Z (lower-cased), a-z, 0-9 and bytes above 7F. A window is `window`
consecutive words of an item, or the whole item if it has fewer. Defined cases: a null or empty
text has no words, and an item without words never occurs; repeated rows count for themselves;
items with a null id are searched but not counted or named; other columns are not read. Words are
compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import (
    documents, slices, stage, text_bytes, word_spans, word_values)

STEP = 4  # words compared in one round
BLOCK_WORDS = 1 << 18

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_WORD = ((_BYTES >= 48) & (_BYTES <= 57) | (_BYTES >= 65) & (_BYTES <= 90)
         | (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the first word of each row (one entry more than rows)."""
    starts, stops, first = word_spans(data, ends, _WORD)
    return word_values(_LOWER[data], starts, stops), first


def _ranks_of(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """1 + place in the sorted table, 0 if absent."""
    if not len(table):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at + 1, 0)


@dataclass
class Benchmark:
    """A block of items: the ranks of all words end to end, and the first word of each item."""
    ids: list
    vocabulary: np.ndarray
    ranks: np.ndarray
    first: np.ndarray
    window: int

    @classmethod
    def of(cls, ids: list, texts: list[str | None], window: int) -> Benchmark:
        hashes, first = word_hashes(*text_bytes(pa.array(texts, pa.string())))
        vocabulary = np.unique(hashes)
        return cls(ids, vocabulary, _ranks_of(hashes, vocabulary), first, window)

    def __post_init__(self):
        item = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        ends = self.first[1:][item]
        begin = np.arange(len(self.ranks))
        need = np.minimum(self.window, (self.first[1:] - self.first[:-1])[item])
        starts_window = ends - begin >= need
        self.suffixes = begin[starts_window]  # where a window starts
        self.ends, self.need = ends[starts_window], need[starts_window]
        self.word_item, self.word_end = item, ends
        self._distinct_windows(item[starts_window])
        self._sort_suffixes()
        width = len(self.vocabulary) + 1
        inner = begin[:-1][begin[1:] < ends[:-1]]
        self.pairs = np.unique(self.ranks[inner] * width + self.ranks[inner + 1])
        self.singles = np.unique(self.ranks[self.suffixes[self.need == 1]])


    def _distinct_windows(self, items: np.ndarray) -> None:
        """Equal windows under one number, one suffix for each, and the items of each."""
        at = self.suffixes[:, None] + np.arange(self.window)
        inside = np.arange(self.window) < self.need[:, None]
        words = np.where(inside, self.ranks[np.minimum(at, max(len(self.ranks) - 1, 0))], 0) \
            if len(self.suffixes) else np.zeros((0, self.window), np.int64)
        _, chosen, number = np.unique(words, axis=0, return_index=True, return_inverse=True)
        number = number.reshape(-1)
        self.window_of = np.full(len(self.suffixes), -1)
        self.window_of[chosen] = number[chosen]  # other suffixes of a window stand back
        self.window_need = self.need[chosen]
        pairs = np.unique(np.stack([number, items], 1).reshape(-1, 2), axis=0)
        self.window_items = pairs[:, 1]
        self.window_first = np.searchsorted(pairs[:, 0], np.arange(len(chosen) + 1))

    def _sort_suffixes(self) -> None:
        """All suffixes in order (of equal ones the first comes first), and the place of each."""
        n = len(self.ranks)
        rank, size = self.ranks.copy(), 1
        longest = int(np.diff(self.first).max(initial=0))
        while size < longest:
            after = np.arange(n) + size
            there = after < self.word_end
            following = np.where(there, rank[np.minimum(after, max(n - 1, 0))], 0)
            _, rank = np.unique(rank * (n + len(self.vocabulary) + 2) + following, return_inverse=True)
            rank = rank.reshape(-1) + 1
            size *= 2
        self.order = np.argsort(rank, kind="stable")
        self.place = np.empty(n, np.int64)
        self.place[self.order] = np.arange(n)
        # intervals of suffixes that start with a word
        sorted_words = self.ranks[self.order]
        self.word_low = np.searchsorted(sorted_words, np.arange(len(self.vocabulary) + 2))

    def _rest(self, at: np.ndarray, skipped: np.ndarray) -> np.ndarray:
        """Place of what follows the first words of the suffixes at places of the order; -1 if none."""
        after = self.order[at] + skipped
        return np.where(after < self.word_end[self.order[at]],
                        self.place[np.minimum(after, len(self.place) - 1)], -1)

    def _narrow(self, low, high, skipped, value):
        """First place within [low, high) whose rest is at least value; rests are in order."""
        low, high = low.copy(), high.copy()
        while True:
            on = np.flatnonzero(low < high)
            if not len(on):
                return low
            middle = (low[on] + high[on]) // 2
            less = self._rest(middle, skipped[on]) < value[on]
            low[on[less]] = middle[less] + 1
            high[on[~less]] = middle[~less]

    def extend(self, low, high, skipped, low2, high2):
        """Intervals of suffixes that start with `skipped` words of one and go on as the other."""
        return (self._narrow(low, high, skipped, low2), self._narrow(low, high, skipped, high2))

    def longest(self, ranks: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word of a text: the longest match from there, and a word of the benchmark where
        it is found. ranks are those of the words, ends the end of each one's document."""
        n = len(ranks)
        every = np.arange(n)
        known = (ranks > 0)
        levels = [(np.where(known, self.word_low[ranks], 0), np.where(known, self.word_low[ranks + 1], 0))]
        size = 1
        while True:  # intervals of 2 * size words from those of size
            low, high = levels[-1]
            on = np.flatnonzero((high > low) & (every + 2 * size <= ends))
            on = on[high[on + size] > low[on + size]]
            new_low, new_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if len(on):
                new_low[on], new_high[on] = self.extend(
                    low[on], high[on], np.full(len(on), size), low[on + size], high[on + size])
            if not (new_high > new_low).any():
                break
            levels.append((new_low, new_high))
            size *= 2
        length = np.zeros(n, np.int64)
        low, high = np.zeros(n, np.int64), np.full(n, len(self.order))
        for level in range(len(levels) - 1, -1, -1):
            step = 1 << level
            on = np.flatnonzero(every + length + step <= ends)
            at = on + length[on]
            a, b = levels[level]
            on, at = on[b[at] > a[at]], at[b[at] > a[at]]
            if not len(on):
                continue
            new_low, new_high = self.extend(low[on], high[on], length[on], a[at], b[at])
            fits = new_high > new_low
            on = on[fits]
            low[on], high[on], length[on] = new_low[fits], new_high[fits], length[on] + step
        return length, self.order[np.minimum(low, max(len(self.order) - 1, 0))]


def packed(ranks: np.ndarray, at: np.ndarray, ends: np.ndarray, bits: int) -> np.ndarray:
    """The next words of each suffix as one number that sorts like them; 0 after its end."""
    out = np.zeros(len(at), np.uint64)
    for i in range(STEP if bits <= 16 else 2 if bits <= 32 else 1):
        word = np.where(at + i < ends, ranks[np.minimum(at + i, len(ranks) - 1)], 0)
        out = (out << np.uint64(bits)) | word.astype(np.uint64)
    return out


def occurrences(bench: Benchmark, ranks: np.ndarray, first: np.ndarray):
    """(place, window): each occurrence of a window; place is a word of the shard."""
    none = np.zeros(0, np.int64)
    if not len(ranks) or not len(bench.suffixes):
        return none, none
    row_end = np.repeat(first[1:], np.diff(first))
    width = len(bench.vocabulary) + 1
    following = np.append(ranks[1:], 0)
    following[row_end == np.arange(1, len(ranks) + 1)] = 0
    both = np.flatnonzero((ranks > 0) & (following > 0))
    both = both[_ranks_of(ranks[both] * width + following[both], bench.pairs) > 0]
    if len(bench.singles):
        both = np.union1d(both, np.flatnonzero(np.isin(ranks, bench.singles)))
    bits = int(width).bit_length()
    step = STEP if bits <= 16 else 2 if bits <= 32 else 1
    # The array: places in suffix order; groups: equal so far, one for each prefix in common.
    array = both
    group = np.zeros(len(array), np.int64)
    wanted = np.flatnonzero(bench.window_of >= 0)
    wanted_group = np.zeros(len(wanted), np.int64)
    found = []
    depth = 0
    while len(array) and len(wanted):
        own = packed(ranks, array + depth, row_end[array], bits)
        order = np.lexsort((own, group))
        array, group, own = array[order], group[order], own[order]
        starts = bench.suffixes[wanted] + depth
        theirs = packed(bench.ranks, starts, bench.ends[wanted], bits)
        # Windows that end within this step: an interval of the shorter prefix.
        due = np.flatnonzero((bench.window_of[wanted] >= 0) & (bench.need[wanted] > depth)
                             & (bench.need[wanted] <= depth + step))
        for left in range(step):
            some = due[bench.need[wanted[due]] == depth + step - left]
            if not len(some):
                continue
            shift = np.uint64(bits * left)
            a, b = _interval(group, own >> shift, wanted_group[some], theirs[some] >> shift)
            n = b - a
            at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append((array[at], np.repeat(bench.window_of[wanted[some]], n)))
        a, b = _interval(group, own, wanted_group, theirs)
        on = (b > a) & (bench.need[wanted] > depth + step)
        wanted, a, b = wanted[on], a[on], b[on]
        spans, wanted_group = np.unique(np.stack([a, b], 1).reshape(-1, 2), axis=0, return_inverse=True)
        n = spans[:, 1] - spans[:, 0]
        at = np.repeat(spans[:, 0], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        array, group = array[at], np.repeat(np.arange(len(spans)), n)
        wanted_group = wanted_group.reshape(-1)
        depth += step
    if not found:
        return none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _interval(group, own, wanted_group, theirs):
    """First and last place of each wanted (group, value) in the sorted array of (group, own)."""
    values, own_rank = np.unique(own, return_inverse=True)
    at = np.minimum(np.searchsorted(values, theirs), len(values) - 1)
    there = values[at] == theirs
    key = group * len(values) + own_rank.reshape(-1)
    want = wanted_group * len(values) + at
    a = np.searchsorted(key, want, "left")
    return a, np.where(there, np.searchsorted(key, want, "right"), a)


def _covered_words(n: int, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of n words lie in one of the stretches."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + size, -1)
    return np.cumsum(change[:-1]) > 0


class _Found:
    """What one block has in a shard of documents."""

    def __init__(self, block: Benchmark, column: pa.Array):
        hashes, self.first = word_hashes(*text_bytes(column))
        ranks = _ranks_of(hashes, block.vocabulary)
        self.block = block
        self.place, self.window = occurrences(block, ranks, self.first)
        self.rows = np.searchsorted(self.first, self.place, side="right") - 1
        self.covered = _covered_words(len(ranks), self.place, block.window_need[self.window])
        self.ranks = ranks

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, begin, end) of the covered stretches within their documents."""
        edge = np.zeros(len(self.covered) + 1, bool)
        edge[self.first] = True
        before = np.concatenate([[False], self.covered[:-1]]) & ~edge[:-1]
        after = np.concatenate([self.covered[1:], [False]]) & ~edge[1:]
        begins, ends = np.flatnonzero(self.covered & ~before), np.flatnonzero(self.covered & ~after) + 1
        rows = np.searchsorted(self.first, begins, side="right") - 1
        return rows, begins - self.first[rows], ends - self.first[rows]

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, item): distinct."""
        if not len(self.place):
            return self.place, self.place
        pairs = np.unique(np.stack([self.rows, self.window], 1), axis=0)
        a, b = (self.block.window_first[pairs[:, 1] + k] for k in (0, 1))
        at = np.repeat(a, b - a) + np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
        both = np.stack([np.repeat(pairs[:, 0], b - a), self.block.window_items[at]], 1)
        return tuple(np.unique(both, axis=0).T)

    def matches(self) -> list[tuple]:
        """(row, word, times, item_word, length, item) of the longest match from each place where a
        window occurs; `times` neighbouring places that have the same are one entry."""
        if not len(self.place):
            return []
        # A match of a window's length is covered; a shorter one ends within a window's length.
        reach = np.minimum(self.block.window, self.first[self.rows + 1] - self.place)
        some = np.flatnonzero(self.covered | _covered_words(len(self.covered), self.place, reach))
        row = np.searchsorted(self.first, some, side="right") - 1
        last = np.concatenate([(np.diff(some) > 1) | (np.diff(row) > 0), [True]])
        ends = np.flatnonzero(last)[np.searchsorted(np.flatnonzero(last), np.arange(len(some)))] + 1
        length, where = self.block.longest(self.ranks[some], ends)
        at = np.searchsorted(some, np.unique(self.place))
        length, where, word, row = length[at], where[at], some[at], row[at]
        new = np.ones(len(at), bool)
        new[1:] = ((np.diff(word) != 1) | (np.diff(row) != 0) | (np.diff(length) != 0)
                   | (np.diff(where) != 0))
        begins = np.flatnonzero(new)
        times = np.diff(np.append(begins, len(at)))
        item = self.block.word_item[where[begins]]
        return list(zip(row[begins].tolist(), (word - self.first[row])[begins].tolist(), times.tolist(),
                        (where[begins] - self.block.first[item]).tolist(), length[begins].tolist(),
                        item.tolist()))


def _search(bench, last: bool):
    """A task that searches one block; spans holds what earlier blocks have covered."""
    def task(batches) -> Iterator[pa.RecordBatch]:
        block = bench.value
        for batch in slices(batches):
            found = _Found(block, batch.column("text"))
            spans, items, hits = (batch.column(c).to_pylist() for c in ("spans", "items", "matches"))
            for row, a, b in zip(*(x.tolist() for x in found.runs())):
                spans[row] += (a, b)
            for row, item in zip(*(x.tolist() for x in found.items())):
                if block.ids[item] is not None:
                    items[row].append(block.ids[item])
            for row, word, times, item_word, length, item in found.matches():
                hits[row].append({"item_id": block.ids[item], "word": word, "item_word": item_word,
                                  "length": length, "times": times})
            out = {"id": batch.column("id")}
            if last:
                out |= {"n_words": pa.array(np.diff(found.first), pa.int64()),
                        "n_hit": pa.array(map(_covered, spans), pa.int64())}
            else:
                out |= {"text": batch.column("text"), "spans": pa.array(spans, pa.list_(pa.int64()))}
            out["items"] = pa.array(items, pa.list_(pa.string()))
            out["matches"] = pa.array(hits, _MATCHES)
            yield pa.RecordBatch.from_pydict(out)
    return task


def _covered(spans: list[int]) -> int:
    """Words in the union of the spans, given as begin, end, begin, end, ..."""
    total = reach = 0
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


_MATCHES = pa.list_(pa.struct([("item_id", pa.string()), ("word", pa.int64()), ("item_word", pa.int64()),
                               ("length", pa.int64()), ("times", pa.int64())]))
_DDL = "array<struct<item_id: string, word: bigint, item_word: bigint, length: bigint, times: bigint>>"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int,
            block_words: int) -> Iterator[Benchmark]:
    """The items in blocks of so many words at most, one block on the driver at a time."""
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"),
                             benchmark[text_col].cast("string").alias("text"))
    ids, texts, size = [], [], 0
    for item, text in items.toLocalIterator():
        words = len(text or "") // 2 + 1  # an upper bound
        if texts and size + words > block_words:
            yield Benchmark.of(ids, texts, window)
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += words
    if texts:
        yield Benchmark.of(ids, texts, window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                       id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, n_words, n_hit, items, matches), one row per document.

    items: the distinct ids of items with a window in the document. matches: (item_id, word,
    item_word, length, times) of the longest verbatim match from each word where a window starts,
    and one place of the benchmark that has it; of the same in neighbouring words, the first and
    how often.
    """
    spark = docs.sparkSession
    rows = documents(docs, id_col, text_col).select(
        "id", "text", F.expr("cast(array() as array<bigint>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
        F.expr(f"cast(array() as {_DDL})").alias("matches"))
    blocks = _blocks(benchmark, item_col, item_text_col, window, block_words)
    block = next(blocks, None) or Benchmark.of([], [], window)
    while (following := next(blocks, None)) is not None:
        task = _search(spark.sparkContext.broadcast(block), False)
        rows = stage(rows.mapInArrow(
            task, f"id long, text string, spans array<bigint>, items array<string>, matches {_DDL}"), "searched")
        block = following
    task = _search(spark.sparkContext.broadcast(block), True)
    return rows.mapInArrow(task, f"id long, n_words long, n_hit long, items array<string>, matches {_DDL}"
                           ).withColumnRenamed("id", id_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs in which no window occurs, with all their columns."""
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    for block in _blocks(benchmark, item_col, item_text_col, window, block_words):
        rows = rows.mapInArrow(_clean(spark.sparkContext.broadcast(block)), rows.schema)
    return rows.select("row.*")


def _clean(bench):
    """A task that passes on the rows without a match in one block."""
    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            clean = np.ones(batch.num_rows, bool)
            clean[_Found(bench.value, batch.column("text")).rows] = False
            yield batch.filter(pa.array(clean))
    return task
