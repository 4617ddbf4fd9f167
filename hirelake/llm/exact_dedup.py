"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. A batch is reduced to one row per
digest (combined on the map side, so a group of any size is one row per task), its digests meet
the index in a sort-merge anti-join that shuffles only the batch, and the new ones are appended
with their batch number; how often the batch has those that the index holds goes to a second
table of the same buckets. A batch counts once its number is committed, which is the last thing
written: what a job leaves that dies before is passed over by all readers, and its number is not
used again. The index has a bucket for every ROWS_A_BUCKET rows of the documents it is made for, or as
many as a caller says. Documents can be added as several batches, largest ids first; groups
are read from the index after the last. Only DataFrame operations; texts are read once and never
shuffled.

Texts are equal if identical after lower-casing A-Z only; a null text is empty. Of equal texts
in a batch the largest id stays; one that an earlier batch holds keeps the index's id. Null ids
lose to any other; if all are null, keep_id is null and the row counts as kept. Rows repeated
under one id are all marked alike. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import keep_rows, mark, stage
from hirelake.session import scratch_path

_DDL = "digest BINARY, keep_id BIGINT, n BIGINT, batch BIGINT"
_MORE_DDL = "digest BINARY, n BIGINT, batch BIGINT"
# Digests that one task of an index sorts and compares.
ROWS_A_BUCKET = 4_000_000
LEAST_BUCKETS = 64
# Batches that the documents of one call are added as.
BATCHES = 2


def digest(text: Column) -> Column:
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")),
                        string.ascii_uppercase, string.ascii_lowercase)
    return F.unhex(F.sha2(plain, 256))


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class DigestIndex:
    """The digests seen so far, below one folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = LEAST_BUCKETS):
        """buckets counts for a new index; one that is there keeps its own number."""
        self.spark, self.path = spark, path
        self.buckets = buckets = self._kept_buckets(buckets)
        self.name = f"digests_{hashlib.md5(path.encode()).hexdigest()}"
        self.more_path, self.more_name = f"{path}-more", f"{self.name}_more"
        for name, ddl, at in ((self.name, _DDL, path), (self.more_name, _MORE_DDL, self.more_path)):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet CLUSTERED BY "
                      f"(digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{at}'")

    def _kept_buckets(self, buckets: int) -> int:
        made = _read_small(self.spark, f"{self.path}-buckets", "buckets int")
        if made:
            return made[0].buckets
        self.spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(
            f"{self.path}-buckets")
        return buckets

    def _committed(self) -> set[int]:
        return {r.batch for r in _read_small(self.spark, f"{self.path}-commits", "batch long")}

    def _commit(self, batch: int) -> None:
        self.spark.createDataFrame([(batch,)], "batch long").coalesce(1).write.mode("append").parquet(
            f"{self.path}-commits")

    def keep_new(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 batches: int = 1) -> DataFrame:
        """Append likewise, and the rows of docs that stay: one for each new text."""
        decided = self._decide(docs, id_col, text_col, batches).where("kept")
        alike = decided.groupBy("text_sha256", "id", "mark").agg(F.count("*").alias("n"))
        winners = alike.groupBy("text_sha256").agg(F.max(F.struct("id", "mark", "n")).alias("w"))
        return keep_rows(docs, winners.select("w.*"), id_col, text_col)

    def read(self) -> DataFrame:
        return self._valid(self.spark.table(self.name))

    def _valid(self, rows: DataFrame) -> DataFrame:
        """The rows of committed batches. Numbers that never were are few, if any."""
        done = self._committed()
        failed = sorted(set(range(1, max(done, default=0) + 1)) - done)
        rows = rows.where(F.col("batch") <= max(done, default=0))
        return rows.where(~F.col("batch").isin(failed)) if failed else rows

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            batches: int = 1) -> DataFrame:
        """Append the digests of docs that are new, in so many batches; one decision per row of docs.

        (id, keep_id, group_size, kept, text_sha256); group_size counts earlier batches too.
        """
        return self._decide(docs, id_col, text_col, batches).drop("mark").withColumnRenamed("id", id_col)

    def forget(self) -> None:
        """Take the two tables out of the catalog; their files stay, and so do frames that read them."""
        for name in (self.name, self.more_name):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _last_batch(self) -> int:
        tables = (self.spark.table(self.name), self.spark.table(self.more_name))  # failed ones too
        return max(t.agg(F.max("batch")).first()[0] or 0 for t in tables)

    def _write(self, rows: DataFrame, name: str, path: str) -> None:
        # One file per bucket, whatever the number of tasks: rows go to their bucket's number.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        with _setting(self.spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
            (rows.repartitionById(self.buckets, bucket).write.mode("append").format("parquet")
             .option("path", path).bucketBy(self.buckets, "digest").sortBy("digest")
             .saveAsTable(name))

    def _append(self, rows: DataFrame, batch: int) -> None:
        """The digests of rows(id, digest) that are new, and how often rows has the others."""
        groups = rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("n"))
        number = F.lit(batch).cast("long").alias("batch")
        known = self.read().where(F.col("batch") < batch).select("digest").hint("merge")
        self._write(groups.join(known, "digest", "left_semi").select("digest", "n", number),
                    self.more_name, self.more_path)
        self._write(groups.join(known, "digest", "left_anti").select("digest", "keep_id", "n", number),
                    self.name, self.path)
        self._commit(batch)

    def _decide(self, docs: DataFrame, id_col: str, text_col: str, batches: int) -> DataFrame:
        rows = stage(docs.select(
            docs[id_col].cast("long").alias("id"), mark(docs[text_col]).alias("mark"),
            digest(docs[text_col]).alias("digest")), "digests")
        before = last = self._last_batch()
        for part in _largest_first(rows, batches):
            last += 1
            self._append(part, last)
        own = F.col("batch") <= last
        more = self._valid(self.spark.table(self.more_name)).where(own).groupBy("digest").agg(
            F.sum("n").alias("more"))
        now = self.read().where(own).join(more, "digest", "left").select(
            "digest", "keep_id", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"),
            (F.col("batch") > before).alias("fresh"))
        kept = F.col("fresh") & F.col("id").eqNullSafe(F.col("keep_id"))
        return rows.join(now, "digest").select(
            "id", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"), "mark")


def _read_small(spark: SparkSession, path: str, ddl: str) -> list:
    """The rows of a small table of the index; none if it is not there."""
    try:
        return spark.read.schema(ddl).parquet(path).collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _buckets_for(docs: DataFrame) -> int:
    return max(LEAST_BUCKETS, -(-docs.count() // ROWS_A_BUCKET))


def _largest_first(rows: DataFrame, batches: int) -> list[DataFrame]:
    """Rows by ranges of ids of about one size, the largest first; null ids go with the smallest."""
    shares = [i / batches for i in range(1, batches)]
    cuts = shares and rows.agg(F.percentile_approx("id", shares)).first()[0]
    parts, left = [], F.lit(True)
    for cut in sorted(set(cuts or []), reverse=True):
        parts.append(rows.where(left & (F.col("id") >= cut)))
        left = F.coalesce(F.col("id") < cut, F.lit(True))
    return [*parts, rows.where(left)]


@contextmanager
def _index(docs: DataFrame, path: str | None, buckets: int | None) -> Iterator[DigestIndex]:
    """The index at path, or one of this call's own, which leaves nothing in the catalog."""
    spark = docs.sparkSession
    index = DigestIndex(spark, path or scratch_path(spark, "digest-index"), buckets or _buckets_for(docs))
    try:
        yield index
    finally:
        if path is None:
            index.forget()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                batches: int = BATCHES, path: str | None = None,
                buckets: int | None = None) -> DataFrame:
    """The decisions of some batches against the index at path, or one of its own."""
    with _index(docs, path, buckets) as index:
        return index.add(docs, id_col, text_col, batches)


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  batches: int = BATCHES, path: str | None = None,
                  buckets: int | None = None) -> DataFrame:
    """One row of docs for each distinct text that the index at path, if given, did not hold."""
    with _index(docs, path, buckets) as index:
        return index.keep_new(docs, id_col, text_col, batches)
