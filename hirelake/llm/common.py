"""Helpers of the operators: Arrow buffers, rolling hashes, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.session import materialize

# Text bytes worked on at a time inside a task. A longer document is a slice of its own.
SLICE_BYTES = 1 << 20

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write df to the shared folder and read it back; its shuffle files go once it is written.

    The table outlives lost executors, so the shuffle behind it is not needed any more.
    """
    conf = df.sparkSession.conf
    before = conf.get(_FREE_SHUFFLES)
    conf.set(_FREE_SHUFFLES, "true")
    try:
        return materialize(df, label, partition_by)
    finally:
        conf.set(_FREE_SHUFFLES, before)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, text): the two columns under fixed names; a null text is empty.

    key is the id, or a hash of the text where the id is null, so that rows without id spread.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    doc_id = docs[id_col].cast("long")
    return docs.select(F.coalesce(doc_id, F.xxhash64(text)).alias("key"), doc_id.alias("id"),
                       text.alias("text"))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most so many bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins (one entry more than rows)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if not len(column) or where is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(where, np.int64 if large else np.int32)
    ends = ends[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column end to end, and where each row's begin; null is empty."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(False)
    return (column.flatten().to_numpy(False),
            np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]))


# --- rolling hashes ----------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next call."""
    table = _powers.get(base, np.ones(1, np.uint64))
    while len(table) < n:
        step = np.uint64(pow(base, len(table), 1 << 64))
        table = np.concatenate([table, table * step])
    _powers[base] = table
    return table[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others; works in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# A random number for each byte value.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit numbers, from one running sum."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values * powers(_BASE, self.n), out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """Hash of every stretch of that length."""
        count = max(0, self.n - length + 1)
        out = self.sums[length:length + count] - self.sums[:count]
        out *= powers(_INVERSE, self.n + 1)[:count]
        return mixed(out)

    def between(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Hash of each stretch [start, stop); its length counts too."""
        out = self.sums[stops] - self.sums[starts]
        out *= powers(_INVERSE, self.n + 1)[starts]
        out += (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mixed(out)


# Longer words are hashed one by one: two long words may well collide modulo 2 ** 64 in a rolling
# hash, whatever its base (complementary Thue-Morse words of 1024 letters always do).
LONG_WORD = 32


def word_values(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word [start, stop) of the bytes."""
    out = Rolling(BYTE_VALUES[data]).between(starts, stops)
    for i in np.flatnonzero(stops - starts > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:stops[i]].tobytes())
    return out


def word_spans(data: np.ndarray, ends: np.ndarray, is_word: np.ndarray):
    """(starts, stops, first): byte range of each word, and the first word of each row.

    is_word tells for each byte value if it belongs to a word; words end where rows end.
    """
    inside = is_word[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside
    begins = inside & ~before[:-1]
    after = np.empty(len(data) + 1, bool)
    after[-1] = False
    after[:-1] = inside
    stops = inside & ~after[1:]
    edges = ends[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, ends)


# The six white-space bytes 20 and 09 to 0D; all others belong to words.
SPACE_WORDS = ~np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def sha256_hex(column: Column) -> Column:
    return F.sha2(column, 256)


def mark(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def keep_rows(docs: DataFrame, winners: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of docs that winners(id, mark, n) name, one of each, with all their columns.

    n is how many rows of docs are alike in id and mark; only those above one are shuffled again.
    """
    rows = docs.select(F.struct("*").alias("row"), docs[id_col].cast("long").alias("own_id"),
                       mark(docs[text_col]).alias("own_mark"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_mark") == F.col("mark"))
    once = rows.join(winners.where("n = 1"), same, "left_semi").select("row")
    again = rows.join(winners.where("n > 1"), same, "left_semi")
    return once.union(again.dropDuplicates(["own_id", "own_mark"]).select("row")).select("row.*")
