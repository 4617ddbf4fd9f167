"""Scratch folder and helpers of the session module."""

import pytest
from pyspark.sql import functions as F

from hirelake.session import materialize, scratch_dir, scratch_path, side_by_side


class Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_cluster_folder_is_used():
    assert scratch_dir(Session(spark_checkpoint_dir="s3a://shared/x/", spark_master="yarn")) == "s3a://shared/x"
    assert scratch_path(Session(spark_checkpoint_dir="/shared"), "a").startswith("/shared/a-")


def test_local_folder_for_local_masters_only():
    local = scratch_dir(Session(spark_master="local[2]"))
    assert scratch_dir(Session(spark_master="local[4]")) == local
    with pytest.raises(RuntimeError):
        scratch_dir(Session(spark_master="yarn"))


def test_materialize_cuts_lineage(spark):
    df = materialize(spark.range(10).withColumn("k", F.col("id") % 2), "test", ("k",))
    assert df.columns == ["id", "k"]
    assert df.agg(F.sum("id"), F.count("*")).first()[:] == (45, 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan" in plan
    empty = materialize(spark.range(0), "empty")
    assert empty.count() == 0


def test_side_by_side(spark):
    assert side_by_side(spark, lambda: spark.range(3).count(), lambda: "x") == [3, "x"]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda: 1 / 0, lambda: 1)
