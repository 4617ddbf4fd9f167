"""The repeated run as a stream: each micro-batch of landed attempts is one run."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hirelake.plans.scrape import run_scrape
from hirelake.schemas import PROBE_ATTEMPTS
from hirelake.session import materialize
from hirelake.sources.state_store import StateStore

# Landed attempts carry their time, so that a replayed batch gives the same rows.
FEED_SCHEMA = T.StructType([*PROBE_ATTEMPTS.fields, T.StructField("probed_at", T.LongType())])


def read_feed(spark: SparkSession, path: str, file_format: str = "parquet",
              files_per_batch: int | None = None) -> DataFrame:
    """Stream of probe attempts from files landing below path."""
    reader = spark.readStream.schema(FEED_SCHEMA).format(file_format)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def once_only(feed: DataFrame, within: str = "2 days") -> DataFrame:
    """The feed without repeats of an attempt, as collectors land a file again after a failure.

    An attempt is (ats, slug, probed_at, attempt); probed_at is the event time. Repeats are known for
    `within` after it, and attempts older than the newest one by more are dropped as too late
    (late_rows counts them). Attempts without probed_at belong to no run and are dropped too. Each
    look at a batch shuffles the feed, so take its places if it has large answers.
    """
    timed = feed.where(F.col("probed_at").isNotNull()).withColumn(
        "_time", F.timestamp_seconds("probed_at")).withWatermark("_time", within)
    return timed.dropDuplicatesWithinWatermark(["ats", "slug", "probed_at", "attempt"]).drop("_time")


def places(feed: DataFrame) -> DataFrame:
    """The attempts of a feed of Parquet files without what they answered: by file and row.

    once_only then deals out these narrow rows; start_feed reads the answers of those that stay.
    """
    return feed.select("ats", "slug", "attempt", "probed_at", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))


def landed_rows(placed: DataFrame) -> DataFrame:
    """The landed attempts that placed(_file, _row) names.

    Files all of whose rows are named are read as they are; rows of the others are looked up.
    """
    spark = placed.sparkSession
    file, row = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")

    def read(files: list[str]) -> DataFrame:
        if not files:
            return spark.createDataFrame([], FEED_SCHEMA)
        return spark.read.schema(FEED_SCHEMA).parquet(*map(unquote, files))  # named as URLs

    named = dict(placed.groupBy("_file").count().collect())  # one entry a file of the batch
    held = dict(read(list(named)).select(file).groupBy("_file").count().collect()) if named else {}
    whole = [f for f, n in named.items() if n == held[f]]
    mixed = [f for f in named if f not in set(whole)]
    if not mixed:
        return read(whole)
    some = read(mixed).select("*", file, row).join(
        placed.where(F.col("_file").isin(mixed)), ["_file", "_row"], "left_semi")
    return read(whole).unionByName(some.select(*FEED_SCHEMA.names))


def late_rows(query: StreamingQuery) -> int:
    """Attempts that a query dropped as too late, over its recent batches."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def start_feed(feed: DataFrame, store: StateStore, checkpoint: str,
               hash_mode: str = "reference", stream: str | None = None,
               **trigger) -> StreamingQuery:
    """Merge every micro-batch into the state; trigger as for DataStreamWriter.trigger.

    probed_at is the time of the run an attempt belongs to. The runs of a micro-batch (a few)
    are merged one after the other, oldest first, each as a version of its own; a run older
    than what is stored brings new jobs and companies only. The commit log names stream,
    batch and run, so that a replay after the commit is skipped and nothing else is; a run
    that died before it overwrites its own unfinished folder. The stream's name is its
    checkpoint unless given; keep a name over a lost checkpoint only if the source will
    deal out the same batches again. feed may be the places of a feed.
    """
    name = stream or checkpoint

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if "_file" in batch.columns:
            batch = landed_rows(materialize(batch, "places"))
        runs = batch.select("probed_at").distinct().orderBy("probed_at").collect()
        if runs and runs[0].probed_at is None:
            raise ValueError("an attempt without probed_at belongs to no run")
        for now in [r.probed_at for r in runs]:
            if not store.has(name, batch_id, now):
                own = batch.where(F.col("probed_at") == now).drop("probed_at")
                run_scrape(own, store, now, hash_mode=hash_mode, step=(name, batch_id, now))

    return (feed.writeStream.foreachBatch(merge_batch)
            .option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True})
            .start())
