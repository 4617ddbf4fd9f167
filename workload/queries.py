"""The registered queries: operators applied to inputs derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions import labels, location, slugs, text
from hirelake.operators import (
    blocks, checks, coverage, discovery, merge, ordering, probes, sampling)
from hirelake.plans import discovery as discovery_plan
from hirelake.plans import scrape, validation
from hirelake.schemas import COMPANIES, JOBS
from hirelake.session import scratch_path
from hirelake.sources import boards, landed, slug_lists, url_index
from hirelake.sources.state_store import StateStore
from hirelake.streaming import feed
from workload import inputs
from workload.inputs import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- slugs and URLs ---------------------------------------------------------------------


@query
def slug_by_family(spark, folder):
    """Boards behind URLs, counted per system."""
    targets = slugs.redirect_targets(F.col("board_url"), boards.host_patterns())
    hits = inputs.board_urls(spark, folder).select(F.inline(targets))
    return hits.groupBy("ats", "slug").agg(F.count("*").alias("n")).groupBy("ats").agg(
        F.count("*").alias("slugs"), F.sum("n").alias("pages"))


@query
def host_match(spark, folder):
    """First host pattern contained in a URL's host, and the stricter domain match."""
    families = {"example.co": "co", "example.net": "net", "blog": "blog"}
    parts = slugs.url_parts(F.col("url"))
    pages = table(spark, folder, "pages").select("page_id", parts.alias("u"))
    host = F.col("u.host")
    return pages.select(
        "page_id", "u.host", "u.path", slugs.match_host(host, families).alias("family"),
        slugs.match_domain(host, families).alias("domain"))


@query
def slug_valid(spark, folder):
    """Validity of every piece of every URL and of made-up variants of its label."""
    label = F.col("label")
    pieces = F.concat(F.split("url", "/"), F.array(
        label, F.concat(F.lit("api-"), label), F.concat(F.lit("static"), label),
        F.concat(F.lit("Assets"), label), F.lit("EMBED"), F.lit("robots.txt"),
        F.col("page_id").cast("string"), F.concat(label, F.lit(" x")),
        F.concat(label, F.lit("#top")), F.substring(label, 1, 1)))
    rows = inputs.board_urls(spark, folder).select(
        "page_id", F.posexplode(pieces).alias("pos", "slug"))
    return rows.withColumn("is_valid", slugs.is_valid_slug(F.col("slug")).cast("int"))


@query
def slug_decode(spark, folder):
    raw = F.concat(F.replace("label", F.lit("."), F.lit("%2E")), F.lit("%20+"), F.upper("label"),
                   F.lit("%zz%C3%A9%"))
    return inputs.board_urls(spark, folder).select(
        "page_id", slugs.decode_slug(raw).alias("mixed"),
        slugs.decode_slug(F.col("board_url")).alias("plain"))


@query
def url_index_scan(spark, folder):
    """Index records through a gzip text file, and the slugs found in them."""
    path = scratch_path(spark, "records")
    inputs.index_records(spark, folder).write.option("compression", "gzip").text(path)
    return url_index.slugs_in_records(url_index.read_index_records(spark, path))


@query
def block_lookup(spark, folder):
    index = url_index.parse_block_lines(inputs.index_lines(spark, folder))
    prefixes = ["com,example,", "net,example,th", "org,example,thther,", "net,example,zzz",
                "dd", "a", "zz", "com,example,tionsh,blog)"]
    return blocks.find_blocks(index, prefixes)


@query
def redirect_resolve(spark, folder):
    return discovery.resolve_redirects(
        inputs.aggregator_postings(spark, folder), inputs.redirects(spark, folder),
        boards.host_patterns())


@query
def first_hit_per_group(spark, folder):
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    return discovery.first_hits(events, "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type")


# --- scalar functions -------------------------------------------------------------------


@query
def location_parse(spark, folder):
    raw = inputs.filled(inputs.LOCATIONS, F.col("c_custkey"), F.col("c_mktsegment"))
    return table(spark, folder, "customer").select("c_custkey", raw.alias("raw")).select(
        "c_custkey", "raw", location.parse_location(F.col("raw")).alias("p")).select(
        "c_custkey", "raw", "p.*")


@query
def experience_level(spark, folder):
    title = inputs.filled(inputs.TITLES, F.col("o_orderkey"), F.col("o_orderpriority"))
    return table(spark, folder, "orders").select("o_orderkey", title.alias("title")).withColumn(
        "level", labels.experience_level(F.col("title")))


@query
def employment_type(spark, folder):
    raw = inputs.filled(inputs.COMMITMENTS, F.col("o_orderkey"), F.lit(""))
    return table(spark, folder, "orders").select("o_orderkey", raw.alias("raw")).withColumn(
        "employment_type", labels.employment_type(F.col("raw")))


@query
def label_rules_text(spark, folder):
    """Both label rules over whole text columns, and over the literals of employment_type."""
    part, docs = table(spark, folder, "part"), table(spark, folder, "documents")
    parts = [
        part.select(F.lit("p_type").alias("source"), F.col("p_partkey").alias("id"), F.col("p_type").alias("raw")),
        part.select(F.lit("p_name"), "p_partkey", "p_name"),
        docs.select(F.lit("text"), "doc_id", F.substring_index("text", "\n", 1)),
        spark.createDataFrame([("literal", i, x) for i, x in enumerate(inputs.COMMITMENTS)],
                              "source string, id long, raw string")]
    return reduce(DataFrame.union, parts).select(
        "source", "id", "raw", labels.employment_type(F.col("raw")).alias("employment_type"),
        labels.experience_level(F.col("raw")).alias("level"))


@query
def content_hash(spark, folder):
    title = F.substring_index("text", "\n", 1)
    return table(spark, folder, "documents").select(
        "doc_id", text.content_hash(title, F.upper("source"), F.col("lang"), F.col("text"))
        .alias("content_hash"))


@query
def html_text(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", text.html_to_text(F.col("html")).alias("body"))


# --- slug sets --------------------------------------------------------------------------


@query
def slug_merge(spark, folder):
    merged = discovery.merge_slugs(inputs.page_slugs(spark, folder, "http"),
                                   inputs.page_slugs(spark, folder, "https"))
    return discovery.merge_counts(merged)


@query
def slug_membership(spark, folder):
    """Union, both differences and intersection in one frame."""
    return coverage.membership(inputs.page_slugs(spark, folder, "http"),
                               inputs.page_slugs(spark, folder, "https"))


@query
def slug_cleaning(spark, folder):
    pieces = inputs.board_urls(spark, folder).select(
        "ats", F.explode(F.split("rest", "[/.]")).alias("slug"))
    return discovery.cleaning_report(pieces, boards.REGISTRY)


@query
def coverage_report(spark, folder):
    return coverage.coverage(inputs.page_slugs(spark, folder, "http"),
                             inputs.page_slugs(spark, folder, "https"), boards.REGISTRY)


@query
def coverage_totals(spark, folder):
    return coverage.coverage_totals(coverage_report(spark, folder))


@query
def slugs_per_source(spark, folder):
    found = inputs.board_urls(spark, folder).select(
        F.col("scheme").alias("source"), "ats", F.col("label").alias("slug"))
    return discovery.slug_counts(found)


@query
def slug_files(spark, folder):
    """Slug lists through text files."""
    path = scratch_path(spark, "slugs")
    found = inputs.board_urls(spark, folder).select("ats", F.col("label").alias("slug"))
    slug_lists.write_slug_lists(found, path)
    return slug_lists.read_slug_lists(spark, path)


@query
def raw_set_roundtrip(spark, folder):
    """Discovery snapshots through the table and the JSON lines form."""
    rows, lines = scratch_path(spark, "snapshot"), scratch_path(spark, "snapshot-json")
    for source, scheme in (("cc", "http"), ("simplify", "https")):
        slug_lists.write_snapshot(inputs.page_slugs(spark, folder, scheme), source, rows)
    slug_lists.write_snapshot_json(slug_lists.read_snapshot(spark, rows), lines, per_line=50)
    return slug_lists.read_snapshot_json(spark, lines)


# --- probes and payloads ----------------------------------------------------------------


def _event_boards(spark, folder, *columns):
    attempts = inputs.event_attempts(spark, folder)
    return boards.union_all([
        boards.with_postings(attempts, s).withColumn("n_postings", F.size("postings"))
        .select(*columns) for s in boards.REGISTRY.values()])


@query
def probe_outcome(spark, folder):
    return _event_boards(spark, folder, "event_id", "ats", "outcome", "n_postings")


@query
def retry_collapse(spark, folder):
    attempts = _event_boards(spark, folder, "ats", "slug", "attempt", "outcome")
    return probes.collapse_attempts(attempts)


@query
def run_stats(spark, folder):
    return probes.outcome_stats(retry_collapse(spark, folder))


def _payload(bodies, spark, folder, ats):
    source = boards.REGISTRY[ats]
    read = boards.with_postings(bodies(spark, folder), source)
    jobs = boards.project_jobs(boards.postings_of(read), source, inputs.RUN_1)
    return jobs.select(*schemas.JOB_SCHEMA.names)


@query
def payload_lever(spark, folder):
    return _payload(inputs.lever_bodies, spark, folder, "lever")


@query
def payload_greenhouse(spark, folder):
    return _payload(inputs.greenhouse_bodies, spark, folder, "greenhouse")


@query
def payload_ashby(spark, folder):
    return _payload(inputs.ashby_bodies, spark, folder, "ashby")


@query
def board_union(spark, folder):
    """Jobs of all systems in one frame, counted by seniority and workplace."""
    jobs = boards.union_all([payload_lever(spark, folder), payload_greenhouse(spark, folder),
                             payload_ashby(spark, folder)])
    return jobs.groupBy("ats", "experience_level", "is_remote").agg(
        F.count("*").alias("jobs"), F.count("country").alias("with_country"))


@query
def batch_first_name(spark, folder):
    """First non-empty name per order, in line order."""
    name = F.when(F.col("l_returnflag") == "A", "").when(
        F.col("l_returnflag") == "R", F.concat(F.lit("P"), F.col("l_partkey").cast("string")))
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("company_id"), name.alias("company_name"),
        F.struct("l_linenumber", "l_partkey").alias("pos"))
    return probes.first_names(lines)


# --- state ------------------------------------------------------------------------------


@query
def existence_lookup(spark, folder):
    return merge.existing_jobs(inputs.line_batch(spark, folder), inputs.order_state(spark, folder))


@query
def change_classify(spark, folder):
    """Line items against stored orders: rows per job and action."""
    rows = merge.classify(inputs.line_batch(spark, folder), inputs.order_state(spark, folder))
    return rows.groupBy("job_id", "action").agg(F.count("*").alias("n"))


@query
def name_fallback(spark, folder):
    """Names of a run's companies, from the batch, the stored company or the slug."""
    probed = inputs.customer_probes(spark, folder).select(
        "ats", "slug", F.col("name").alias("company_name"))
    return probes.resolve_names(probed, inputs.customer_state(spark, folder))


@query
def company_upsert(spark, folder):
    run = inputs.customer_probes(spark, folder)
    marked = merge.mark_dead(inputs.customer_state(spark, folder), run.where("outcome = 'dead'"))
    return merge.upsert_companies(marked, run.where("outcome = 'alive'").drop("outcome"))


@query
def state_snapshot(spark, folder):
    """Two committed versions of the company table; the second is read back."""
    store = StateStore(spark, scratch_path(spark, "state"))
    store.write(inputs.customer_state(spark, folder), COMPANIES, 1)
    store.commit(1)
    run = inputs.customer_probes(spark, folder).where("outcome = 'alive'").drop("outcome")
    store.write(merge.upsert_companies(store.read(COMPANIES), run), COMPANIES, 2)
    store.commit(2)
    return store.read(COMPANIES)


def _merged_lines(spark, folder):
    state = inputs.order_state(spark, folder)
    return merge.merge_jobs(state, merge.fold_batch(
        inputs.line_batch(spark, folder), state, order=inputs.LINE_ORDER))


@query
def job_upsert(spark, folder):
    return _merged_lines(spark, folder).select(
        "job_id", "title", "company_name", "description_text", "department", "min_salary",
        "max_salary", "first_seen_at", "last_seen_at", "content_hash")


@query
def job_upsert_counts(spark, folder):
    return _merged_lines(spark, folder).agg(
        *[F.sum(c).alias(c) for c in ("rows_new", "rows_updated", "rows_touched")])


CUTOFF = 883_612_800  # 1998-01-01


@query
def purge_stale(spark, folder):
    return merge.purge_stale(inputs.order_state(spark, folder, every=True), CUTOFF).select(
        "job_id", "last_seen_at")


@query
def purge_count(spark, folder):
    return merge.count_stale(inputs.order_state(spark, folder, every=True), CUTOFF)


@query
def meta_put_get(spark, folder):
    """Key-value entries: each customer's segment, replaced by the last order date."""
    meta = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("value"))
    entries = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("key")).agg(
        F.max(inputs.epoch(F.col("o_orderdate"))).cast("string").alias("value"))
    return merge.put_meta(meta, entries)


@query
def constraint_check(spark, folder):
    """Key and null violations of line items read as companies."""
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("company_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string")).alias("slug"),
        F.col("l_linestatus").alias("ats"))
    return checks.check_constraints(rows, COMPANIES)


# --- counts -----------------------------------------------------------------------------


@query
def count_by_company(spark, folder):
    return coverage.by_count(coverage.jobs_per_company(inputs.order_jobs(spark, folder)))


@query
def external_count(spark, folder):
    """Aggregator postings of every company known: named by a page, or stored (customers)."""
    postings = inputs.aggregator_postings(spark, folder)
    stored = table(spark, folder, "customer").select(F.col("c_name").alias("company_name"))
    return coverage.external_counts(postings, postings.select("company_name").union(stored))


@query
def external_count_all(spark, folder):
    """Aggregator postings of every company that a page names, and of one unknown."""
    postings = inputs.aggregator_postings(spark, folder)
    unknown = spark.createDataFrame([("No Such",)], "company_name string")
    return coverage.external_counts(postings, postings.select("company_name").union(unknown))


@query
def count_compare(spark, folder):
    return coverage.compare_counts(
        coverage.jobs_per_company(inputs.order_jobs(spark, folder)),
        inputs.external_counts(spark, folder))


@query
def compare_summary(spark, folder):
    summary = coverage.comparison_summary(count_compare(spark, folder))
    return summary.withColumn("avg_diff", F.round("avg_diff", 6))


@query
def head_tail_sample(spark, folder):
    return sampling.head_tail_sample(
        coverage.jobs_per_company(inputs.order_jobs(spark, folder)), 50, seed=7)


@query
def paged_search(spark, folder):
    return sampling.search_page(
        table(spark, folder, "part").select("p_partkey", "p_name", "p_size"),
        F.col("p_size") >= 10, order=["p_name", "p_partkey"], page=3, per_page=250)


# --- whole runs -------------------------------------------------------------------------


def _two_runs(spark, folder):
    store = StateStore(spark, scratch_path(spark, "run"))
    scrape.run_scrape(inputs.run_attempts(spark, folder, False), store, inputs.RUN_1)
    return store, scrape.run_scrape(inputs.run_attempts(spark, folder, True), store, inputs.RUN_2)


@query
def full_run(spark, folder):
    """Jobs after two runs over all documents."""
    store, _ = _two_runs(spark, folder)
    return store.read(JOBS)


@query
def full_run_stats(spark, folder):
    """What the second of two runs reports."""
    return _two_runs(spark, folder)[1].stats


@query
def full_run_totals(spark, folder):
    """Sums over the systems and the purged jobs of the second of two runs."""
    return _two_runs(spark, folder)[1].totals


@query
def incremental_feed(spark, folder):
    """The same two runs as micro-batches of a stream; companies afterwards."""
    landed = scratch_path(spark, "landed")
    store = StateStore(spark, scratch_path(spark, "feed"))
    checkpoint = scratch_path(spark, "checkpoint")
    for second, now in ((False, inputs.RUN_1), (True, inputs.RUN_2)):
        (inputs.run_attempts(spark, folder, second)
         .withColumn("probed_at", F.lit(now).cast("bigint"))
         .write.mode("append").option("compression", "zstd").parquet(landed))
        started = feed.start_feed(feed.read_feed(spark, landed), store, checkpoint)
        started.awaitTermination()
    return store.read(COMPANIES)


@query
def incremental_feed_jobs(spark, folder):
    """Both runs landed in one micro-batch, on a store that has versions; jobs afterwards."""
    landed = scratch_path(spark, "landed")
    store = StateStore(spark, scratch_path(spark, "feed"))
    runs = [inputs.run_attempts(spark, folder, second).withColumn(
        "probed_at", F.lit(now).cast("bigint"))
        for second, now in ((False, inputs.RUN_1), (True, inputs.RUN_2))]
    scrape.run_scrape(runs[0].drop("probed_at").where("false"), store, inputs.RUN_1 - 1)
    runs[1].unionByName(runs[0]).write.option("compression", "zstd").parquet(landed)
    feed.start_feed(feed.read_feed(spark, landed), store,
                    scratch_path(spark, "checkpoint")).awaitTermination()
    return store.read(JOBS)


@query
def registry_extra_board(spark, folder):
    """Slugs of a further system whose URL pattern starts with a wildcard."""
    extra = replace(boards.LEVER, ats="pages", url_literal=None,
                    url_pattern=r"https?://[a-z.]+\.example\.(?:com|net|org)/([a-z]+)/[0-9]+")
    records = table(spark, folder, "pages").select(F.col("url").alias("line"))
    return url_index.slugs_in_records(records, [extra, boards.LEVER])


@query
def discovery_run_index(spark, folder):
    result = discovery_plan.discover_from_index(
        inputs.index_records(spark, folder), inputs.page_slugs(spark, folder, "http"),
        scratch_path(spark, "slugs"), scratch_path(spark, "snapshot"))
    return result.merged


@query
def discovery_run_aggregator(spark, folder):
    result = discovery_plan.discover_from_aggregator(
        inputs.aggregator_postings(spark, folder), inputs.redirects(spark, folder),
        inputs.page_slugs(spark, folder, "http"),
        scratch_path(spark, "slugs"), scratch_path(spark, "snapshot"))
    return result.counts


@query
def validation_run(spark, folder):
    """Coverage of two discovery runs' snapshots."""
    snapshot = scratch_path(spark, "snapshot")
    for source, scheme in (("cc", "http"), ("simplify", "https")):
        slug_lists.write_snapshot(inputs.page_slugs(spark, folder, scheme), source, snapshot)
    return validation.validate_coverage(slug_lists.read_snapshot(spark, snapshot))


@query
def validation_run_counts(spark, folder):
    """Sampled companies' counts compared with the external source."""
    return validation.validate_job_counts(
        inputs.order_jobs(spark, folder), inputs.external_counts(spark, folder), 50, seed=7)


# --- order, directories, patterns, rollups ------------------------------------------------


@query
def previous_key(spark, folder):
    """Every index line with the line before it."""
    return ordering.previous_rows(inputs.index_lines(spark, folder), "line")


@query
def page_directory(spark, folder):
    """A first, a middle and the last page of all orders, and the page after a key."""
    rows = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", "o_custkey")
    pages = ordering.PageDirectory.of(rows, ["o_orderpriority", "o_orderkey"])
    last = -(-pages.total // 250)
    parts = [pages.page(n).withColumn("page", F.lit(n)) for n in (1, last // 2, last)]
    return reduce(DataFrame.union, [*parts, pages.after(("3-MEDIUM", 100)).withColumn("page", F.lit(0))])


@query
def host_pattern_table(spark, folder):
    """Hosts of all pages against a table of patterns: stretches of the hosts themselves."""
    pages = inputs.board_urls(spark, folder).select(
        "page_id", slugs.url_parts(F.col("url"))["host"].alias("host"), "label")
    patterns = pages.select(F.col("page_id").alias("rank"), F.substring("label", 2, 5).alias("pattern"))
    return discovery.with_first_pattern(pages.select("page_id", "host"), patterns)


@query
def coverage_rollup(spark, folder):
    return coverage.coverage_rollup(inputs.page_slugs(spark, folder, "http"),
                                    inputs.page_slugs(spark, folder, "https"))


@query
def slugs_per_source_rollup(spark, folder):
    found = inputs.board_urls(spark, folder).select(
        F.col("scheme").alias("source"), "ats", F.col("label").alias("slug"))
    return discovery.slug_counts_rollup(found)


@query
def run_stats_rollup(spark, folder):
    return probes.outcome_rollup(retry_collapse(spark, folder))


@query
def existence_lookup_bucketed(spark, folder):
    """existence_lookup over a state kept in buckets by job id."""
    name = scratch_path(spark, "lookup")
    kept = merge.write_bucketed(inputs.order_state(spark, folder), f"lookup_{name[-12:]}", name, 8)
    return merge.existing_in_buckets(inputs.line_batch(spark, folder), kept)


@query
def job_lookup(spark, folder):
    """The stored job of one id: the smallest of all orders."""
    state = inputs.order_state(spark, folder, every=True)
    one = table(spark, folder, "orders").agg(F.min("o_orderkey")).first()[0]
    return merge.job_exists(state, f"lever:{one}")


@query
def landed_postings(spark, folder):
    """Aggregator postings landed as JSON lines and read with their schema."""
    path = scratch_path(spark, "postings")
    inputs.aggregator_postings(spark, folder).write.json(path)
    return landed.read_landed(spark, "postings", path, "json")


@query
def redirect_failures(spark, folder):
    """Postings by what became of them; redirects of one family lead elsewhere or nowhere."""
    hops = inputs.redirects(spark, folder).withColumn("final_url", F.when(
        F.col("final_url").contains("greenhouse"), F.replace("final_url", F.lit("greenhouse.io"), F.lit("example.com")))
        .when(F.length("final_url") % 5 == 0, F.regexp_replace("final_url", "(lever[.]co/).*", "$1embed"))
        .otherwise(F.col("final_url")))
    return discovery.redirect_failures(
        inputs.aggregator_postings(spark, folder), hops.where(~F.col("final_url").contains("?")),
        boards.host_patterns())


@query
def discovery_run_blocks(spark, folder):
    """Discovery that reads only the blocks of two systems' keys, records landed by shard."""
    path = scratch_path(spark, "blocks")
    inputs.block_records(spark, folder).write.partitionBy("shard").parquet(path)
    records = spark.read.schema("offset long, line string, shard string").parquet(path)
    result = discovery_plan.discover_from_blocks(
        url_index.parse_block_lines(inputs.index_lines(spark, folder)), records,
        {"lever": ["com,example,t", "com,example,e"], "greenhouse": ["net,example,"],
         "ashby": ["org,example,th"]},
        inputs.page_slugs(spark, folder, "http"), scratch_path(spark, "slugs"),
        scratch_path(spark, "snapshot"), only=["lever", "ashby"])
    return result.merged


@query
def incremental_feed_replayed(spark, folder):
    """Two runs as a stream that gets every file twice; companies afterwards."""
    landed_files = scratch_path(spark, "landed")
    store = StateStore(spark, scratch_path(spark, "feed"))
    checkpoint = scratch_path(spark, "checkpoint")
    for second, now in ((False, inputs.RUN_1), (True, inputs.RUN_2)):
        run = inputs.run_attempts(spark, folder, second).withColumn("probed_at", F.lit(now).cast("bigint"))
        for _ in range(2):
            run.write.mode("append").option("compression", "zstd").parquet(landed_files)
            placed = feed.places(feed.read_feed(spark, landed_files))
            feed.start_feed(feed.once_only(placed, "30 days"), store, checkpoint).awaitTermination()
    if store.latest() != 2:
        raise RuntimeError(f"a replay was merged: {store.latest()} versions")
    return store.read(COMPANIES)
