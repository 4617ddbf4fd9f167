"""Language ID: averaged embeddings of hashed subwords and a linear softmax.

A text is the average of the embeddings of its subwords: byte strings of 2, 3 and 4 that lie in
one word, with its boundaries, hashed into buckets. Embeddings and softmax are trained on the
driver by stochastic gradient descent over a sample of at most `per_language` labelled texts of
each label that is not held out, whatever their length or the number of labels; what reaches the
driver of a text are its bucket counts, made in Spark tasks. Every such label is learned. Part of
the sample calibrates a temperature, so that scores are probabilities, and the rejection threshold:
no calibration text that was classified rightly is rejected, and nothing of score 0.5 or more.

Since the softmax is linear, embeddings are folded into one number per bucket and language
before they are broadcast, unless there are more languages than dimensions; each text is then
read whole, once. Defined cases: a null text, or
one without any letter, is `und` with score 0, as is every text if nothing is labelled; ties go
to the first label in alphabetical order; repeated rows and null ids are predicted like others;
other columns are never an input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import slices, stage, text_bytes

ORDERS = (2, 3, 4)
BUCKETS = 1 << 14  # for each order
NOTHING = len(ORDERS) * BUCKETS  # the bucket of what is no subword
UNKNOWN = "und"

_BYTES = np.arange(256)
# Lower-case letters and bytes above 7F stand for themselves, all else for a word boundary.
_FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32,
                 np.where((_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128), _BYTES, 32)
                 ).astype(np.uint32)


def subwords(data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the bucket of the subword that starts at each byte."""
    folded = _FOLD[data]
    boundary = folded == 32
    stops = ends[1:]
    packed = folded.copy()
    inner = np.zeros(len(data), bool)
    for order, n in enumerate(ORDERS):
        for i in range(ORDERS[order - 1] if order else 1, n):
            packed[:-i] |= folded[i:] << np.uint32(8 * i)
        for i in range(ORDERS[order - 1] - 1 if order else 1, n - 1):
            inner[:-i] |= boundary[i:]
        bucket = ((packed * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int32)
        bucket += order * BUCKETS
        nothing = inner.copy()
        if n == 2:
            nothing[:-1] |= boundary[:-1] & boundary[1:]
        for i in range(1, n):
            at = stops - i
            nothing[at[at >= 0]] = True
        bucket[nothing] = NOTHING
        yield bucket


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.add.reduceat(np.append(values, 0), np.minimum(ends[:-1], len(values)))
    return np.where(np.diff(ends) > 0, sums, 0)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # of each bucket, for each language; the last bucket is nothing
    bias: np.ndarray
    softmax: np.ndarray | None = None  # if given, weights are embeddings: one row per dimension
    temperature: float = 1.0
    threshold: float = 0.0

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language index and score of each text."""
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts))
        data, ends = text_bytes(texts)
        total = np.zeros((len(texts), len(self.weights)))
        count = np.zeros(len(texts))
        for bucket in subwords(data, ends):
            count += _row_sums((bucket != NOTHING).astype(np.int64), ends)
            for k in range(len(self.weights)):
                total[:, k] += _row_sums(self.weights[k][bucket], ends)
        mean = total / np.maximum(count, 1)[:, None]
        return self.scores((mean if self.softmax is None else mean @ self.softmax) + self.bias)

    def scores(self, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scaled = (logits - logits.max(axis=1, keepdims=True)) / self.temperature
        odds = np.exp(scaled)
        best = logits.argmax(axis=1)
        return best, np.take_along_axis(odds, best[:, None], 1)[:, 0] / odds.sum(axis=1)


def bucket_counts(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text, its distinct buckets and how often each occurs."""
    data, ends = text_bytes(texts)
    orders = list(subwords(data, ends))
    found = []
    for a, b in zip(ends[:-1], ends[1:]):
        own = np.concatenate([x[a:b] for x in orders])
        buckets, n = np.unique(own[own != NOTHING], return_counts=True)
        found.append((buckets.astype(np.uint16), n.astype(np.uint32)))
    return found


def train(found: list[tuple[np.ndarray, np.ndarray]], labels: list[str], dim: int = 16,
          steps: int = 400, batch: int = 64, rate: float = 4.0, seed: int = 7) -> Model:
    """About so many steps of stochastic gradient descent over bucket counts.

    Every fifth text calibrates, unless it is all that the others have left of its label.
    """
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((0, NOTHING + 1)), np.zeros(0))
    number = {x: i for i, x in enumerate(languages)}
    wanted = np.array([number[x] for x in labels])
    random = np.random.default_rng(seed)
    order = random.permutation(len(found))
    held, own = order[:len(found) // 5], order[len(found) // 5:]
    only = ~np.isin(wanted[held], wanted[own])
    held, own = held[~only], np.concatenate([own, held[only]])
    embeddings = random.normal(0, 0.1, (NOTHING, dim))
    softmax = random.normal(0, 0.1, (dim, len(languages)))
    bias = np.zeros(len(languages))

    def averages(some: np.ndarray):
        rows = np.repeat(np.arange(len(some)), [len(found[i][0]) for i in some])
        buckets = np.concatenate([found[i][0] for i in some])
        shares = np.concatenate([found[i][1] / max(1, found[i][1].sum()) for i in some])
        out = np.stack([np.bincount(rows, shares * embeddings[buckets, d], len(some))
                        for d in range(dim)], 1)
        return out, rows, buckets, shares

    batches = max(1, len(own) // batch)
    epochs = -(-steps // batches)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(random.permutation(own), batches):
            mean, rows, buckets, shares = averages(part)
            logits = mean @ softmax + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(part)), wanted[part]] -= 1
            error /= len(part)
            back = error @ softmax.T
            softmax -= step * mean.T @ error
            bias -= 0.1 * step * error.sum(axis=0)
            # A bucket's share of a text is small: its step is larger by the number of texts.
            at, place = np.unique(buckets, return_inverse=True)
            embeddings[at] -= step * len(part) * np.stack(
                [np.bincount(place, shares * back[rows, d], len(at)) for d in range(dim)], 1)
    folded = len(languages) <= dim
    weights = embeddings @ softmax if folded else embeddings
    weights = np.vstack([weights, np.zeros(weights.shape[1])]).T.copy()
    model = Model(languages, weights, bias, None if folded else softmax)
    if len(held):
        parts = np.array_split(held, -(-len(held) // 512))
        means = np.vstack([averages(part)[0] for part in parts])
        _calibrate(model, means @ softmax + bias, wanted[held])
    return model


def _calibrate(model: Model, logits: np.ndarray, wanted: np.ndarray) -> None:
    """The temperature of least log loss; the lowest score of a right answer as threshold."""
    rows = np.arange(len(wanted))

    def loss(t: float) -> float:
        z = logits / t
        z -= z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[rows, wanted]).mean())

    model.temperature = min(np.geomspace(0.05, 20, 121).tolist(), key=loss)
    best, score = model.scores(logits)
    right = score[best == wanted]
    model.threshold = min(0.5, float(right.min())) if len(right) else 0.0


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = 600
           ) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[str]]:
    """Bucket counts and labels of texts that are not held out: so many of each label, or all.

    One pass names the rows by a hash of id and text (rows alike in both count once) and counts
    each label's names. Names below their label's share are drawn, the surplus is cut by hash
    order. A second pass reads the drawn rows; only their bucket counts leave the tasks.
    """
    usable = docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull()
                        & ~held_out(docs[id_col])).select(
        docs[id_col].cast("string").alias("id"), docs[lang_col].alias("lang"),
        docs[text_col].alias("text")).select("lang", "text", F.xxhash64("id", "text").alias("name"))
    names = stage(usable.select("lang", "name").distinct(), "label-names")
    counts = names.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.pmod("name", F.lit(1 << 20)) / float(1 << 20)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("name"))
    drawn = names.join(F.broadcast(counts), "lang").where(place < 3 * per_language / F.col("n"))
    drawn = drawn.withColumn("nth", nth).where(F.col("nth") <= per_language).select("lang", "name")
    rows = usable.join(F.broadcast(drawn), ["lang", "name"], "left_semi")

    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = bucket_counts(batch.column("text"))
            yield pa.RecordBatch.from_pydict({
                "lang": batch.column("lang"), "name": batch.column("name"),
                "buckets": pa.array([x.tobytes() for x, _ in found], pa.binary()),
                "counts": pa.array([n.tobytes() for _, n in found], pa.binary())})

    lang_type = rows.schema["lang"].dataType.simpleString()
    picked = rows.mapInArrow(task, f"lang {lang_type}, name long, buckets binary, counts binary"
                             ).dropDuplicates(["lang", "name"]).collect()
    picked.sort(key=lambda r: (r.lang, r.name))
    return ([(np.frombuffer(r.buckets, np.uint16), np.frombuffer(r.counts, np.uint32))
             for r in picked], [r.lang for r in picked])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        **bounds: int) -> Model:
    return train(*sample(docs, id_col, text_col, lang_col, **bounds))


def _inputs(docs: DataFrame, text_col: str) -> list[Column]:
    text = docs[text_col].cast("string")
    return [text.alias("text"),
            F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters")]


def _predicted(model: Model, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Language index, -1 where it is unknown, and score."""
    best, score = model.predict(batch.column("text"))
    known = batch.column("letters").to_numpy(False) & (best >= 0)
    return np.where(known, best, -1), np.where(known, score, 0.0)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected): rejected texts have no letter or too low a score."""
    rows = docs.select(docs[id_col].alias("id"), *_inputs(docs, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = pa.array([*own.languages, UNKNOWN], pa.string())
        for batch in slices(batches):
            best, score = _predicted(own, batch)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"),
                "lang_pred": names.take(pa.array(np.where(best < 0, len(names) - 1, best))),
                "score": score, "rejected": pa.array((best < 0) | (score < own.threshold))})

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(task, f"id {id_type}, lang_pred string, score double, rejected boolean"
                           ).withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that identify() would not reject, with all their columns.

    A model without languages rejects only texts without a letter.
    """
    rows = docs.select(F.struct("*").alias("row"), *_inputs(docs, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            if own.languages:
                best, score = _predicted(own, batch)
                keep = (best >= 0) & (score >= own.threshold)
            else:
                keep = batch.column("letters").to_numpy(False)
            yield batch.select(["row"]).filter(pa.array(keep))

    return rows.mapInArrow(task, rows.select("row").schema).select("row.*")
