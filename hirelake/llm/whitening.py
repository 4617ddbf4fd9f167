"""Whitening of embeddings by polarisation of variances.

Entries are laid on a grid of integers, x = floor(64 c) + 1000000, so every sum below is exact. The
fit list is each distinct x vector once. For every dimension and for every sum of two dimensions
tasks add up the squares of the centred values; as Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b), the
differences of these variances are the covariances, all of them, and numpy's eigh takes the matrix.
Centring is by the mean rounded to an integer m, and the sums of y = x - m are corrected for the
rest exactly: n sum(y^2) - (sum y)^2 is n^2 times the variance.

What reaches the driver is one number for each dimension and pair of dimensions, whatever the number
of rows; what goes to the tasks is the mean and sixteen components. The fit list is made by a plain
distinct, so copies of a vector are one row per task before the shuffle.

Defined cases: a vector that is null, empty, or holds a null, NaN or infinite entry is dropped; so is
one whose length is not `dimension`, by default the length that most rows have (of several, the
longest); entries beyond 2^34 in size count as that; rows repeated are whitened each, but fitted once;
null ids stay null; components of no variance (beyond rounding) cannot be whitened and are left out,
so one distinct vector, or none, gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import stage, text_bytes

COMPONENTS = 16
_LIMIT = 1 << 40
_SHIFT = 1_000_000
_CELLS = 1 << 20  # numbers worked on at a time
_DDL = ("id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double")
_WIDEST = 10 ** 38


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """vectors with an array<double> `vec` that is neither empty nor holds a null, NaN or infinity."""
    vec = vectors[vec_col].cast("array<double>")
    fine = F.forall("vec", lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    rows = vectors.select(vec.alias("vec"), *[vectors[c] for c in vectors.columns if c != "vec"])
    return rows.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & fine)


def grid(column: pa.Array, d: int) -> np.ndarray:
    """The x vectors of a column of vectors of length d, a row each."""
    c = column.flatten().to_numpy(False).reshape(-1, d)
    return np.clip(np.floor(64 * c), -_LIMIT, _LIMIT).astype(np.int64) + _SHIFT


def _chunks(batches, d: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, _CELLS // d)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _packed(d: int):
    """A task from vec to the bytes of x: 4 for each entry, or 8 where an entry needs them."""
    def rows(x: np.ndarray) -> pa.RecordBatch:
        data = np.ascontiguousarray(x)
        ends = np.arange(len(x) + 1, dtype=np.int32) * (x.itemsize * d)
        return pa.RecordBatch.from_pydict({"x": pa.BinaryArray.from_buffers(
            pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(data)])})

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, d):
            x = grid(batch.column("vec"), d)
            narrow = (np.abs(x) < 1 << 31).all(axis=1)
            yield rows(x[narrow].astype("<i4"))
            yield rows(x[~narrow].astype("<i8"))
    return task


def unpacked(column: pa.Array, d: int) -> np.ndarray:
    data, ends = text_bytes(column)
    wide = np.diff(ends) == 8 * d
    out = np.empty((len(column), d), np.int64)
    of_byte = np.repeat(wide, np.diff(ends))
    out[~wide] = data[~of_byte].view("<i4").reshape(-1, d)
    out[wide] = data[of_byte].view("<i8").reshape(-1, d)
    return out


def _exact(x: np.ndarray, rows: int) -> np.ndarray:
    """x such that the squares of sums of two of its entries can be added up over so many rows."""
    most = int(np.abs(x).max(initial=0))
    return x if 4 * most * most * rows < 1 << 63 else x.astype(object)


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(d: int):
    """A task that adds up each dimension: (dim, total, n)."""
    def task(batches) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, object), 0
        for batch in _chunks(batches, d):
            x = unpacked(batch.column("x"), d)  # at most 2^41 each, 2^20 of them
            total, n = total + x.sum(axis=0).astype(object), n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({
                "dim": np.arange(d, dtype=np.int32), "total": _decimals(total), "n": np.full(d, n)})
    return task


def pair_squares(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of y_i^2 for each dimension, and of (y_i + y_j)^2 for each pair i < j in row order."""
    y = _exact(y, len(y))
    pairs = [((y[:, i:i + 1] + y[:, i + 1:]) ** 2).sum(axis=0) for i in range(y.shape[1] - 1)]
    return (y ** 2).sum(axis=0), np.concatenate([*pairs, np.zeros(0, y.dtype)])


def _squares(d: int, mean: np.ndarray):
    """A task that adds up the squares: (i, j, total), j = i for a dimension alone."""
    def task(batches) -> Iterator[pa.RecordBatch]:
        alone, both, seen = np.zeros(d, object), np.zeros(d * (d - 1) // 2, object), False
        for batch in _chunks(batches, d):
            if batch.num_rows:
                one, two = pair_squares(unpacked(batch.column("x"), d) - mean)
                alone, both, seen = alone + one.astype(object), both + two.astype(object), True
        if seen:
            i, j = np.triu_indices(d, 1)
            own = np.arange(d)
            yield pa.RecordBatch.from_pydict({
                "i": np.concatenate([own, i]).astype(np.int32),
                "j": np.concatenate([own, j]).astype(np.int32),
                "total": _decimals([*alone, *both])})
    return task


@dataclass
class Whitener:
    """What a fit knows; n = 0 if there was nothing to fit."""
    d: int
    n: int
    mean: np.ndarray           # rounded to integers
    rest: np.ndarray           # S - n * mean, exact
    covariance: np.ndarray
    values: np.ndarray         # of the components, falling
    components: np.ndarray     # unit eigenvectors as columns
    identity_error: float = 0.0

    def white(self, y: np.ndarray) -> np.ndarray:
        """y = x - mean, projected and scaled."""
        return (y - self.rest / max(self.n, 1)) @ (self.components / np.sqrt(self.values))

    def deviations(self, y: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact, for each row."""
        y = _exact(y, self.d)
        rest = self.rest
        if y.dtype != object and int(np.abs(y).max(initial=0)) * self.n * self.d >= 1 << 63:
            y, rest = y.astype(object), rest.astype(object)
        own, cross = (y * y).sum(axis=1), (y * rest).sum(axis=1)
        n, last = self.n, sum(int(t) ** 2 for t in self.rest)
        return [n * n * int(a) - 2 * n * int(b) + last for a, b in zip(own, cross)]


def covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The matrix, from sums of squares about the rounded mean and what that leaves over."""
    d = len(rest)
    # n^2 times the variance of a dimension, or of the sum of two
    spread = {(i, j): n * total - (rest[i] + (rest[j] if i != j else 0)) ** 2
              for (i, j), total in squares.items()}
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = spread[i, i] / (n * n)
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = (spread[i, j] - spread[i, i] - spread[j, j]) / (2 * n * n)
    return out


def _principal(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    real = values > max(matrix.trace(), 0) * len(matrix) * np.finfo(float).eps
    values, vectors = values[real], vectors[:, real]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[largest, np.arange(len(values))])


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS,
        dimension: int | None = None) -> Whitener | None:
    """The whitener of all distinct vectors; None if there are none."""
    rows = usable(vectors, vec_col)
    if dimension is None:
        lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
        first = lengths.orderBy(F.col("n").desc(), F.col("d").desc()).first()
        if first is None:
            return None
        dimension = first.d
    d = dimension
    distinct = rows.where(F.size("vec") == d).select("vec").mapInArrow(_packed(d), "x binary").distinct()
    distinct = stage(distinct, "distinct-vectors")
    sums = distinct.mapInArrow(_sums(d), "dim int, total decimal(38,0), n long").groupBy("dim").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("dim").collect()
    if not sums:
        return None
    n, totals = sums[0].n, [int(r.total) for r in sums]
    mean = np.array([(2 * t + n) // (2 * n) for t in totals], np.int64)
    rest = [t - n * int(m) for t, m in zip(totals, mean)]
    squares = distinct.mapInArrow(_squares(d, mean), "i int, j int, total decimal(38,0)").groupBy(
        "i", "j").agg(F.sum("total").alias("total")).collect()
    matrix = covariance(n, rest, {(r.i, r.j): int(r.total) for r in squares})
    values, vectors = _principal(matrix, components)
    made = Whitener(d, n, mean, np.array(rest, np.int64), matrix, values, vectors)
    made.identity_error = _identity_error(distinct, made)
    return made


def _identity_error(distinct: DataFrame, made: Whitener) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(made.values)
    if not k:
        return 0.0
    i, j = np.triu_indices(k)

    def task(batches) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in _chunks(batches, made.d):
            w = made.white(unpacked(batch.column("x"), made.d) - made.mean)
            total, square = total + w.sum(axis=0), square + w.T @ w
        yield pa.RecordBatch.from_pydict({
            "i": np.concatenate([np.arange(k), i]).astype(np.int32),
            "j": np.concatenate([np.full(k, -1), j]).astype(np.int32),
            "total": np.concatenate([total, square[i, j]])})

    sums = {(r.i, r.j): r.total for r in distinct.mapInArrow(task, "i int, j int, total double")
            .groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    n = made.n
    return max(abs(sums[a, b] / n - sums[a, -1] / n * (sums[b, -1] / n) - (a == b)) for a, b in zip(i, j))


def whiten(vectors: DataFrame, made: Whitener | None, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each usable vector.

    deviation is null where it needs more than 38 digits.
    """
    if made is None or not len(made.values):
        return vectors.sparkSession.createDataFrame([], _DDL).withColumnRenamed("id", id_col)
    d, k = made.d, len(made.values)
    shares = made.values / made.covariance.trace()

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, d):
            m = batch.num_rows
            y = grid(batch.column("vec"), d) - made.mean
            far = [v if v < _WIDEST else None for v in made.deviations(y)]
            exact = pa.array([None if v is None else Decimal(v) for v in far], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_pydict({
                "id": pc.take(batch.column("id"), each),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                "n": np.full(m * k, made.n), "deviation": pc.take(exact, each),
                "whitened": made.white(y).reshape(-1), "explained": np.tile(shares, m),
                "identity_error": np.full(m * k, made.identity_error)})

    rows = usable(vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col]), vec_col)
    return rows.where(F.size("vec") == d).select("id", "vec").mapInArrow(
        task, _DDL).withColumnRenamed("id", id_col)
