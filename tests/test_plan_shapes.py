"""What the physical plans must and must not hold, whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.operators import coverage, discovery, merge, probes
from hirelake.plans import scrape
from hirelake.schemas import JOBS
from hirelake.sources import boards, url_index
from hirelake.sources.landed import read_landed
from hirelake.sources.state_store import StateStore
from workload import inputs
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def stored(spark, tmp_path):
    """Whole stored jobs in files by system."""
    path = str(tmp_path / "state")
    inputs.order_state(spark, FOLDER).write.partitionBy("ats").parquet(path)
    return spark.read.schema(JOBS.schema).parquet(path)


# Queries that run jobs on the way to their result; their parts are covered below.
WRITERS = {"incremental_feed_jobs", "full_run", "full_run_stats", "full_run_totals", "incremental_feed", "discovery_run_index",
           "discovery_run_aggregator", "validation_run", "state_snapshot", "raw_set_roundtrip",
           "slug_files", "url_index_scan"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_cross_joins_and_no_python(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for word in ("Cartesian", "NestedLoop", "EvalPython", "InPandas", "InArrow"):
        assert word not in plan


def test_merge_shuffles(spark, no_broadcast, stored):
    """Batch by (job_id, hash), state pairs likewise, batch and state by job_id: no more."""
    batch = inputs.line_batch(spark, FOLDER)
    plan = plan_of(merge.merge_jobs(stored, merge.fold_batch(batch, stored)))
    assert exchanges(plan) == 4
    # both batch shuffles come after a map-side aggregate
    assert len(re.findall(r"partial_max", plan)) >= 2


def test_merge_reads_two_state_columns_to_classify(spark, no_broadcast, stored):
    batch = inputs.line_batch(spark, FOLDER)
    plan = plan_of(merge.fold_batch(batch, stored))
    schemas_read = re.findall(r"ReadSchema: (struct<\S+)", plan)
    assert "struct<job_id:string,content_hash:string>" in schemas_read


def test_purge_filter_reaches_the_scan(spark, stored):
    plan = plan_of(merge.purge_stale(stored, 5).select("job_id"))
    assert "GreaterThanOrEqual(last_seen_at,5)" in plan
    assert "ReadSchema: struct<job_id:string,last_seen_at:bigint>" in plan


def test_one_system_reads_its_partition(spark, stored):
    plan = plan_of(stored.where(F.col("ats") == "lever").select("job_id"))
    assert re.search(r"PartitionFilters: \[isnotnull\(ats#\d+\), \(ats#\d+ = lever\)\]", plan)


def test_probe_boards_shuffles_payloads_once(spark, no_broadcast, tmp_path):
    path = str(tmp_path / "attempts")
    inputs.run_attempts(spark, FOLDER, True).write.partitionBy("ats").parquet(path)
    attempts = read_landed(spark, "probe_attempts", path)
    companies = spark.createDataFrame([], schemas.COMPANIES.schema)
    plan = plan_of(scrape.probe_boards(attempts, companies, boards.LEVER))
    assert exchanges(plan) <= 2  # payloads, and the stored companies
    assert plan.count("from_json") >= 1 and "PartitionFilters: [isnotnull(ats" in plan


def test_bodies_are_parsed_once(spark):
    read = boards.with_postings(inputs.lever_bodies(spark, FOLDER), boards.LEVER)
    plan = plan_of(boards.project_jobs(boards.postings_of(read), boards.LEVER, 1))
    assert plan.count("from_json(StructField(jobs") == 1


def test_set_reports_shuffle_by_slug_once(spark, no_broadcast):
    a, b = (inputs.page_slugs(spark, FOLDER, s) for s in ("http", "https"))
    assert exchanges(plan_of(coverage.membership(a, b))) == 1
    assert exchanges(plan_of(discovery.merge_slugs(a, b))) == 1


def test_first_row_per_key_is_an_aggregate(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select("user_id", "ts", "event_id")
    plan = plan_of(discovery.first_hits(events, "user_id", ["ts", "event_id"]))
    assert "Window" not in plan and "partial_min" in plan


def test_index_scan_filters_before_patterns(spark, tmp_path):
    path = str(tmp_path / "records")
    inputs.index_records(spark, FOLDER).write.text(path)
    plan = plan_of(url_index.slugs_in_records(url_index.read_index_records(spark, path)))
    assert "StringContains(value,jobs.lever.co/)" in plan


def test_retry_collapse_combines_on_the_map_side(spark):
    attempts = inputs.event_attempts(spark, FOLDER).withColumn("outcome", F.lit("alive"))
    assert "partial_min_by" in plan_of(probes.collapse_attempts(attempts, "body"))
