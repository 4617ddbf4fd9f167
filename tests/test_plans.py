"""Whole runs: scrape, discovery, validation, stream."""

import json

import pytest

from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.plans import discovery, validation
from hirelake.plans.scrape import run_scrape
from hirelake.schemas import COMPANIES, JOBS, META
from hirelake.sources import slug_lists
from hirelake.sources.state_store import StateStore
from hirelake.streaming import feed

DAY = 86_400
T0 = 1_700_000_000


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def lever(*jobs):
    return json.dumps([{"id": i, "text": t, "descriptionPlain": d} for i, t, d in jobs])


def green(*jobs):
    return json.dumps({"jobs": [{"id": i, "title": t, "company_name": n} for i, t, n in jobs]})


def ashby(*ids):
    return json.dumps({"jobs": [{"id": i, "title": "Designer"} for i in ids]})


RUN1 = [
    ("lever", "acme", 0, 500, None),
    ("lever", "acme", 1, 200, lever(("1", "Engineer", None), ("2", "Sales", "text"))),
    ("lever", "gone", 0, 404, None),
    ("lever", "empty", 0, 200, "[]"),
    ("greenhouse", "disc", 0, 200, green((10, "A", ""), (11, "B", "Discord"), (12, "C", None))),
    ("greenhouse", "flaky", 0, 503, None), ("greenhouse", "flaky", 1, None, None),
    ("greenhouse", "flaky", 2, 200, "<html>"),
    ("ashby", "ramp", 0, 200, ashby("x")),
    ("ashby", "none", 0, 200, '{"jobs":[]}'),
]
RUN2 = [
    ("lever", "acme", 0, 200, lever(("1", "Engineer", None), ("2", "Sales", None), ("3", "New", None))),
    ("lever", "empty", 0, 404, None),
    ("greenhouse", "disc", 0, 200, green((10, "A2", None))),
    ("greenhouse", "flaky", 0, 200, green((20, "Z", None))),
    ("ashby", "ramp", 0, 404, None),
]


def attempts(spark, data):
    return spark.createDataFrame(data, schemas.PROBE_ATTEMPTS)


def test_full_run(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    one = run_scrape(attempts(spark, RUN1), store, T0)
    assert one.version == store.latest() == 1
    assert rows(one.stats, "ats", "companies", "dead", "errors", "jobs_new", "jobs_updated") == [
        ("ashby", 1, 1, 0, 1, 0), ("greenhouse", 1, 0, 1, 3, 0), ("lever", 2, 1, 0, 2, 0)]
    assert rows(one.totals, "companies", "jobs_new", "jobs_updated", "purged") == [(4, 6, 0, 0)]
    assert rows(store.read(COMPANIES), "company_id", "name", "last_probed_at", "is_dead") == [
        ("ashby:ramp", "ramp", T0, 0), ("greenhouse:disc", "Discord", T0, 0),
        ("lever:acme", "acme", T0, 0), ("lever:empty", "empty", T0, 0)]
    assert rows(store.read(JOBS), "job_id", "company_name") == [
        ("ashby:x", "ramp"), ("greenhouse:10", "Discord"), ("greenhouse:11", "Discord"),
        ("greenhouse:12", "Discord"), ("lever:1", "acme"), ("lever:2", "acme")]

    two = run_scrape(attempts(spark, RUN2), store, T0 + DAY)
    assert rows(two.stats, "ats", "companies", "dead", "errors", "jobs_new", "jobs_updated") == [
        ("ashby", 0, 1, 0, 0, 0), ("greenhouse", 2, 0, 0, 1, 1), ("lever", 1, 1, 0, 1, 1)]
    jobs = {r.job_id: r for r in store.read(JOBS).collect()}
    assert len(jobs) == 8
    assert (jobs["lever:1"].first_seen_at, jobs["lever:1"].last_seen_at) == (T0, T0 + DAY)
    assert jobs["lever:2"].description_text == "text"       # kept, as the new one is null
    assert jobs["greenhouse:10"].title == "A2"
    assert jobs["greenhouse:11"].last_seen_at == T0         # not seen, kept until the purge
    assert jobs["greenhouse:20"].company_name == "flaky"
    dead = rows(store.read(COMPANIES), "company_id", "is_dead", "last_probed_at")
    assert ("ashby:ramp", 1, T0) in dead and ("lever:empty", 1, T0) in dead
    assert rows(store.read(META), "key", "value") == [("last_scrape_at", str(T0 + DAY))]

    # One system only; the purge covers all: what run 1 saw last is now too old.
    three = run_scrape(attempts(spark, RUN2), store, T0 + 8 * DAY - DAY // 2, only=["lever"])
    assert rows(three.totals, "jobs_new", "jobs_updated", "purged") == [(0, 0, 3)]
    assert rows(store.read(JOBS), "job_id") == [
        ("greenhouse:10",), ("greenhouse:20",), ("lever:1",), ("lever:2",), ("lever:3",)]
    assert len(store.read(JOBS, 1).collect()) == 6          # earlier versions are untouched


def test_repeated_run_is_stable(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    run_scrape(attempts(spark, RUN1), store, T0)
    again = run_scrape(attempts(spark, RUN1), store, T0 + 60)
    total = again.stats.agg({"jobs_new": "sum"}).first()[0]
    assert total == 0
    cols = [c for c in JOBS.columns if c != "last_seen_at"]
    assert rows(store.read(JOBS, 1), *cols) == rows(store.read(JOBS, 2), *cols)


def test_full_hash_mode(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    run_scrape(attempts(spark, RUN1), store, T0)
    again = run_scrape(attempts(spark, RUN1), store, T0 + 60, hash_mode="full")
    assert rows(again.totals, "jobs_new", "jobs_updated") == [(0, 0)]


def test_listed_slugs_only_and_dropped_postings(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    data = RUN1 + [("lever", "odd", 0, 200, '[{"text":"no id"},{"id":"9"},{"id":null}]')]
    listed = spark.createDataFrame([("lever", "odd"), ("lever", "gone"), ("ashby", "ramp"),
                                    ("greenhouse", "never")], schemas.SLUGS)
    result = run_scrape(attempts(spark, data), store, T0, slugs=listed)
    assert rows(result.stats, "ats", "companies", "dead", "errors", "jobs_new") == [
        ("ashby", 1, 0, 0, 1), ("lever", 1, 1, 0, 1)]
    assert rows(result.dropped, "ats", "postings_dropped") == [("ashby", 0), ("lever", 2)]
    assert rows(store.read(JOBS), "job_id") == [("ashby:x",), ("lever:9",)]


def test_unfinished_version_is_overwritten(spark, tmp_path):
    """A run that died before its commit leaves files its retry replaces."""
    store = StateStore(spark, str(tmp_path / "state"))
    run_scrape(attempts(spark, RUN1), store, T0)
    before = store.read(JOBS, 1).count()
    store.write(store.read(JOBS, 1).limit(1), JOBS, 2)
    assert (store.latest(), store.read(JOBS).count()) == (1, before)
    run_scrape(attempts(spark, RUN1), store, T0 + 60)
    assert (store.latest(), store.read(JOBS).count()) == (2, before)


def test_stream_equals_batches(spark, tmp_path):
    landed, streamed = str(tmp_path / "landed"), StateStore(spark, str(tmp_path / "s"))
    batched = StateStore(spark, str(tmp_path / "b"))
    for i, run in enumerate((RUN1, RUN2)):
        now = T0 + i * DAY
        data = spark.createDataFrame([(*r, now) for r in run], feed.FEED_SCHEMA)
        data.coalesce(1).write.mode("append").parquet(landed)
        run_scrape(attempts(spark, run), batched, now)
        query = feed.start_feed(feed.read_feed(spark, landed), streamed, str(tmp_path / "cp"))
        query.awaitTermination(300)
        assert query.exception() is None
    assert streamed.latest() == 2
    for table in (COMPANIES, JOBS, META):
        assert rows(streamed.read(table), *table.columns) == rows(batched.read(table), *table.columns)


def land(spark, path, *runs):
    data = [(*r, now) for now, run in runs for r in run]
    spark.createDataFrame(data, feed.FEED_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def follow(spark, path, store, checkpoint, **options):
    query = feed.start_feed(feed.read_feed(spark, path), store, str(checkpoint), **options)
    query.awaitTermination(300)
    assert query.exception() is None


def test_replayed_batch_is_skipped_and_no_other(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), StateStore(spark, str(tmp_path / "s"))
    run_scrape(attempts(spark, RUN1), store, T0 - DAY)
    land(spark, landed, (T0, RUN2))
    for checkpoint in ("cp1", "cp2"):  # a lost checkpoint under the same name
        follow(spark, landed, store, tmp_path / checkpoint, stream="boards")
        assert store.latest() == 2
    follow(spark, landed, store, tmp_path / "cp3", stream="other")
    assert store.latest() == 3
    assert store.read(JOBS).agg(F.max("last_seen_at")).first()[0] == T0


def test_two_runs_in_one_batch_equal_two_batches(spark, tmp_path):
    landed, streamed = str(tmp_path / "landed"), StateStore(spark, str(tmp_path / "s"))
    batched = StateStore(spark, str(tmp_path / "b"))
    for i, run in enumerate((RUN1, RUN2)):
        run_scrape(attempts(spark, run), batched, T0 + i * DAY)
    land(spark, landed, (T0 + DAY, RUN2), (T0, RUN1))  # the newer one first
    follow(spark, landed, streamed, tmp_path / "cp")
    for table in (COMPANIES, JOBS, META):
        assert rows(streamed.read(table), *table.columns) == rows(batched.read(table), *table.columns)


def test_late_run_never_moves_back(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    for i, run in enumerate((RUN1, RUN2)):
        run_scrape(attempts(spark, run), store, T0 + i * DAY)
    before = {t.name: rows(store.read(t), *t.columns) for t in (COMPANIES, META)}
    seen = {r.job_id: r for r in store.read(JOBS).collect()}
    run_scrape(attempts(spark, RUN1), store, T0)
    after = {r.job_id: r for r in store.read(JOBS).collect()}
    newest = [j for j, r in seen.items() if r.last_seen_at == T0 + DAY]
    assert newest and all(after[j] == seen[j] for j in newest)
    assert rows(store.read(META), *META.columns) == before[META.name]
    assert max(r.last_probed_at for r in store.read(COMPANIES).collect()) == T0 + DAY


def test_discovery_from_index(spark, tmp_path):
    records = spark.createDataFrame(
        [(f'x {{"url":"{u}"}}',) for u in (
            "https://jobs.lever.co/figma/1", "https://jobs.lever.co/newco",
            "https://jobs.ashbyhq.com/ramp/x", "https://jobs.lever.co/embed")], "line string")
    existing = spark.createDataFrame([("lever", "figma"), ("lever", "777")], schemas.SLUGS)
    out, snap = str(tmp_path / "out"), str(tmp_path / "snap")
    result = discovery.discover_from_index(records, existing, out, snap)
    assert rows(result.counts, "ats", "new_count", "total") == [("ashby", 1, 1), ("lever", 1, 3)]
    assert rows(spark.read.parquet(out), "ats", "slug") == [
        ("ashby", "ramp"), ("lever", "777"), ("lever", "figma"), ("lever", "newco")]
    assert rows(slug_lists.read_snapshot(spark, snap, "cc"), "ats", "slug") == [
        ("ashby", "ramp"), ("lever", "figma"), ("lever", "newco")]


def test_discovery_and_validation(spark, tmp_path):
    postings = spark.createDataFrame([("c1", "A", "p1", 0), ("c1", "A", "p2", 1), ("c2", "B", "p3", 0)],
                                     schemas.POSTINGS)
    redirects = spark.createDataFrame(
        [("p1", "https://jobs.lever.co/figma/x"), ("p2", "https://jobs.lever.co/unused"),
         ("p3", "https://boards.greenhouse.io/disc")], schemas.REDIRECTS)
    existing = spark.createDataFrame([], schemas.SLUGS)
    snap = str(tmp_path / "snap")
    result = discovery.discover_from_aggregator(postings, redirects, existing,
                                                str(tmp_path / "out"), snap)
    assert rows(result.found, "ats", "slug") == [("greenhouse", "disc"), ("lever", "figma")]
    slug_lists.write_snapshot(spark.createDataFrame([("lever", "figma"), ("lever", "b2")],
                                                    schemas.SLUGS), "cc", snap)
    jobs = spark.createDataFrame([("A",)] * 9 + [("B",)] * 2 + [(None,)], "company_name string")
    external = spark.createDataFrame([("A", 2, False)], schemas.EXTERNAL_COUNTS)
    report = validation.validate(slug_lists.read_snapshot(spark, snap), jobs, external)
    assert rows(report.coverage, "ats", "cc", "simplify", "both", "union") == [
        ("ashby", 0, 0, 0, 0), ("greenhouse", 0, 1, 0, 1), ("lever", 2, 1, 1, 2)]
    assert rows(report.coverage_totals, "cc_only", "simplify_only", "both") == [(1, 1, 1)]
    assert rows(report.comparison, "company", "diff", "is_outlier") == [("A", 7, 1), ("B", 2, 0)]
    assert report.summary.first()["avg_diff"] == pytest.approx(4.5)
