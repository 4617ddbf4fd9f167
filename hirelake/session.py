"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for. Shuffle partition counts stay with the cluster:
# AQE coalesces from whatever upper bound it sets.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Recording a call site for every Column costs more than building the Column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a local one only for a local master."""
    shared = spark.conf.get(_CHECKPOINT_KEY, None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"{_CHECKPOINT_KEY} must name a folder all executors can reach")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="hirelake-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = (),
                compression: str = "snappy") -> DataFrame:
    """Write df once to the scratch folder and read it back.

    Cuts lineage with files that outlive any executor, and lets several consumers read
    just the columns they need instead of recomputing df.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", compression).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Results of a few independent Spark jobs submitted together.

    While one job is down to its last tasks the others use the free cores.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        # One wrapper per job: threads must not share the copied local properties.
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [f.result() for f in futures]
