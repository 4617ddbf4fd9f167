"""Orders, pages, patterns, blocks, buckets and feeds: results by brute force, and plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from hirelake.operators import coverage, discovery, merge, ordering, sampling
from hirelake.plans import discovery as discovery_plan
from hirelake.plans.scrape import run_scrape
from hirelake.schemas import JOBS
from hirelake.sources import url_index
from hirelake.sources.state_store import StateStore
from hirelake.streaming import feed
from test_plan_shapes import exchanges, plan_of
from test_plans import DAY, RUN1, RUN2, T0, attempts, land, rows
from workload import inputs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_previous_rows(spark, no_broadcast):
    own = random.Random(1)
    lines = [own.choice("abcdefgh") * own.randrange(1, 4) + str(own.randrange(60)) for _ in range(500)]
    frame = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "line string, n int").repartition(5)
    got = ordering.previous_rows(frame, "line")
    ordered = sorted(lines)
    assert sorted((r.line, r.previous or "") for r in got.collect()) == sorted(
        zip(ordered, ["", *ordered[:-1]]))
    plan = plan_of(got)
    assert "SinglePartition" not in plan and "Window" in plan
    assert ordering.previous_rows(frame.where("false"), "line").collect() == []
    assert [r.previous for r in ordering.previous_rows(frame.limit(1), "line").collect()] == [None]


def test_pages(spark, tmp_path):
    values = sorted((f"k{i % 37}", i) for i in range(1000))
    frame = spark.createDataFrame(values, "k string, n int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pages = ordering.PageDirectory.of(frame, ["k", "n"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert pages.total == 1000 and len(pages.parts) > 1
    for number in (1, 2, 17, 50, 51, 900):
        want = values[(number - 1) * 20:number * 20]
        assert [tuple(r) for r in pages.page(number, 20).collect()] == want
    for key in (("", 0), ("k1", 500), values[-2], values[-1], ("zz", 0)):
        assert [tuple(r) for r in pages.after(key, 20).collect()] == [v for v in values if v > key][:20]
    for number in (1, 50):  # the first and the last page read as few files
        read = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(pages.page(number, 20)))[1]
        assert re.search(r"_part#\d+ (= \d+|IN \(\d+,\d+\))", read), read
    empty = ordering.PageDirectory.of(frame.where("false"), ["k"])
    assert empty.total == 0 and empty.page(1).collect() == empty.after(("a",)).collect() == []


def test_host_patterns(spark, no_broadcast):
    own = random.Random(2)
    word = lambda n: "".join(own.choices("abcd.-", k=n))
    patterns = [(i, word(own.randrange(1, 9))) for i in range(10_000)] + [(-1, ""), (5, None), (-9, "dddddddd")]
    patterns = [(i, p) for i, p in patterns if p is None or len(p) != 1 or i % 7 == 0]
    hosts = [word(own.randrange(0, 40)) for _ in range(200)] + [None, "", "xyz", "äöü" + "d" * 9]
    made = spark.createDataFrame([(h,) for h in hosts + hosts], "host string")
    table = spark.createDataFrame(patterns, "rank long, pattern string")
    for some in (patterns, [(i, p) for i, p in patterns if p and len(p) > 5]):
        chosen = table if some is patterns else spark.createDataFrame(some, table.schema)
        got = discovery.match_hosts(made, chosen)
        want = {(h, *min((i, p) for i, p in some if p and p in h)) for h in hosts
                if h is not None and any(p and p in h for _, p in some)}
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert discovery.match_hosts(made, table.where("false")).collect() == []
    pages = spark.createDataFrame([(h, i) for i, h in enumerate(hosts * 2 + [None, "a.hot"] * 40)], "host string, page long")
    for chosen, first in ((table, min), (table.where("false"), None)):
        got = {(r.host, r.page, r.rank, r.pattern) for r in discovery.with_first_pattern(pages, chosen).collect()}
        best = lambda h: min(((i, p) for i, p in patterns if first and h and p and p in h), default=(None, None))
        assert got == {(h, i, *best(h)) for h, i in pages.collect()}


def test_head_and_tail_in_one_pass(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "counts")
    counts = [(f"c{i}", i % 11) for i in range(300)]
    spark.createDataFrame(counts, "company_name string, job_count long").repartition(4).write.parquet(path)
    frame = spark.read.parquet(path)
    sample = sampling.head_tail_sample(frame, 40, seed=3)
    plan = plan_of(sample)
    assert plan.count("FileScan") == 1
    assert "WindowGroupLimit" in plan  # each task passes on the first few rows only
    got = [tuple(r) for r in sample.collect()]
    import hashlib
    head = sorted(counts, key=lambda c: (-c[1], c[0]))[:20]
    rest = sorted(set(counts) - set(head), key=lambda c: hashlib.sha256(f"3|{c[0]}".encode()).hexdigest())
    assert sorted(got) == sorted(head + rest[:20])
    for n in (0, 1, 39, 40):
        few = frame.orderBy("company_name").limit(n)
        assert rows(sampling.head_tail_sample(few, 40), "company_name") == rows(few, "company_name")


def test_rollups_take_one_shuffle(spark, no_broadcast):
    a, b = (inputs.page_slugs(spark, FOLDER, s) for s in ("http", "https"))
    assert exchanges(plan_of(coverage.coverage_rollup(a, b))) == 2  # slugs, then systems with the total
    report = {r.ats: r for r in coverage.coverage_rollup(a, b).collect()}
    assert report[None].union == sum(r.union for ats, r in report.items() if ats)
    assert {r.level for ats, r in report.items() if ats} == {0} and report[None].level == 1


def test_lookup_in_buckets_leaves_the_state_in_place(spark, tmp_path, no_broadcast):
    state = inputs.order_state(spark, FOLDER)
    kept = merge.write_bucketed(state, "lookup_test", str(tmp_path / "lookup"), 4)
    batch = inputs.line_batch(spark, FOLDER)
    found = merge.existing_in_buckets(batch, kept)
    cols = ("job_id", "content_hash", "has_desc")
    assert rows(found, *cols) == rows(merge.existing_jobs(batch, state), *cols)
    plan = plan_of(found)
    side = plan[:plan.index("lookup_test")].splitlines()
    assert exchanges(plan) == 1 and "SortMergeJoin" in plan
    assert not any("Exchange" in line for line in side), plan
    spark.sql("DROP TABLE lookup_test")


def test_blocks_prune_the_records(spark, tmp_path):
    path = str(tmp_path / "records")
    inputs.block_records(spark, "/root/testdata/sf0.01").write.partitionBy("shard").parquet(path)
    records = spark.read.schema("offset long, line string, shard string").parquet(path)
    index = url_index.parse_block_lines(inputs.index_lines(spark, "/root/testdata/sf0.01"))
    blocks = discovery_plan.find_blocks(index, ["com,example,t"])
    near = url_index.in_blocks(records, blocks)
    shards = {r.shard for r in blocks.collect()}
    read = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(near))[1]
    assert shards and all(s in read for s in shards) and {r.shard for r in near.collect()} == shards
    wanted = {(r.shard, r.offset) for r in blocks.collect()}
    assert {(r.shard, r.offset) for r in near.collect()} <= wanted
    assert url_index.in_blocks(records, blocks.where("false")).collect() == []


def test_only_chosen_systems_are_discovered(spark, tmp_path):
    index = spark.createDataFrame([("co,lever,jobs)/a 1\ts1\t0\t9\t1",), ("com,ashbyhq,jobs)/b 1\ts1\t9\t9\t2",)],
                                  "line string")
    records = spark.createDataFrame(
        [("s1", 0, "https://jobs.lever.co/figma"), ("s1", 9, "https://jobs.ashbyhq.com/ramp"),
         ("s2", 0, "https://jobs.lever.co/elsewhere")], "shard string, offset long, line string")
    existing = spark.createDataFrame([], "ats string, slug string")
    prefixes = {"lever": ["co,lever,jobs)"], "ashby": ["com,ashbyhq,jobs)"]}
    for only, want in ((None, [("ashby", "ramp"), ("lever", "figma")]), (["lever"], [("lever", "figma")])):
        got = discovery_plan.discover_from_blocks(
            url_index.parse_block_lines(index), records, prefixes, existing,
            str(tmp_path / f"out{only}"), str(tmp_path / f"snap{only}"), only=only)
        assert rows(got.found, "ats", "slug") == want


def test_replayed_files_and_late_attempts(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), StateStore(spark, str(tmp_path / "s"))
    checkpoint = str(tmp_path / "cp")

    def follow():
        query = feed.start_feed(feed.once_only(feed.read_feed(spark, landed), "2 days"), store, checkpoint)
        query.awaitTermination(300)
        assert query.exception() is None
        return feed.late_rows(query)

    land(spark, landed, (T0, RUN1))
    land(spark, landed, (T0, RUN1))      # twice in one batch
    assert follow() == 0 and store.latest() == 1
    land(spark, landed, (T0, RUN1))      # and once more
    assert follow() == 0 and store.latest() == 1
    land(spark, landed, (T0 + 5 * DAY, RUN2))
    assert follow() == 0 and store.latest() == 2
    before = rows(store.read(JOBS), *JOBS.columns)
    land(spark, landed, (T0, RUN1), (T0 + DAY, RUN1))  # beyond the watermark
    assert follow() == 2 * len(RUN1) and store.latest() == 2
    assert rows(store.read(JOBS), *JOBS.columns) == before


def test_repeats_are_dropped_by_place(spark, tmp_path):
    """The answers are not dealt out with the keys; files with some new rows are looked up."""
    landed, store = str(tmp_path / "landed files"), StateStore(spark, str(tmp_path / "s"))
    whole = StateStore(spark, str(tmp_path / "w"))

    def follow():
        placed = feed.once_only(feed.places(feed.read_feed(spark, landed)), "2 days")
        query = feed.start_feed(placed, store, str(tmp_path / "cp"))
        query.awaitTermination(300)
        assert query.exception() is None

    land(spark, landed, (T0, RUN1[:4]))
    assert "body" not in feed.places(feed.read_feed(spark, landed)).columns
    follow()
    land(spark, landed, (T0, RUN1[:4]))                        # the file again: nothing new
    follow()
    assert store.latest() == 1
    land(spark, landed, (T0, RUN1[:4]), (T0 + DAY, RUN2))      # repeats and new rows in one file
    land(spark, landed, (T0 + DAY, RUN2))                      # and those new rows once more
    follow()
    assert store.latest() == 2
    for i, run in enumerate((RUN1[:4], RUN2)):
        run_scrape(attempts(spark, run), whole, T0 + i * DAY)
    assert rows(store.read(JOBS), *JOBS.columns) == rows(whole.read(JOBS), *JOBS.columns)


def test_reasons_of_failed_redirects(spark):
    postings = spark.createDataFrame([(f"p{i}",) for i in range(7)] + [("p1",)], "posting_id string")
    hops = spark.createDataFrame(
        [("p0", "https://jobs.lever.co/figma/1"), ("p1", "https://x.com/"), ("p1", "https://jobs.lever.co/a1"),
         ("p2", "https://jobs.lever.co/embed"), ("p3", "https://x.com/"), ("p4", None), ("p9", "https://x.com")],
        "posting_id string, final_url string")
    got = discovery.redirect_failures(postings, hops, {"lever.co": "lever"})
    assert rows(got, "reason", "postings") == [
        ("bad_slug", 1), ("no_board", 1), ("no_redirect", 3), ("resolved", 2)]
