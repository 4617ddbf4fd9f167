"""A full run: probe attempts in, next version of the state tables out."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import non_empty
from hirelake.operators import merge, probes
from hirelake.schemas import COMPANIES, JOB_DETAILS, JOB_SCHEMA, META, SEEN
from hirelake.session import materialize, side_by_side
from hirelake.sources.boards import (
    ALIVE, DEAD, REGISTRY, BoardSource, postings_of, project_jobs, union_all, with_postings)
from hirelake.sources.state_store import StateStore, part_name

LAST_RUN_KEY = "last_scrape_at"


@dataclass(frozen=True)
class RunResult:
    version: int
    stats: DataFrame    # per system: companies, dead, errors, jobs_new, jobs_updated
    totals: DataFrame   # one row: companies, jobs_new, jobs_updated, purged
    dropped: DataFrame  # per system: postings_dropped, for want of an id


def attempt_rows(attempts: DataFrame, source: BoardSource) -> DataFrame:
    """Each attempt with its number (row), outcome, postings and what those decide as a whole.

    That is tie (their hash), unkeyed (those without an id) and name (of the company).
    """
    name = (probes.first_name(F.col(f"postings.{source.company_name}"))
            if source.company_name else F.lit(None).cast("string"))
    unkeyed = F.size(F.filter("postings", lambda p: p["id"].isNull()))
    return with_postings(attempts, source).select(
        "ats", "slug", "attempt", "outcome", F.xxhash64("postings").alias("tie"),
        unkeyed.alias("unkeyed"), name.alias("name"),
        F.monotonically_increasing_id().alias("row"), "postings")


def posting_rows(attempts: DataFrame, source: BoardSource, now: int) -> DataFrame:
    """Job rows of all attempts, without a shuffle, each with its attempt: one for each posting
    with an id (pos), and one without pos for an attempt that has none."""
    jobs = project_jobs(postings_of(attempt_rows(attempts, source), outer=True), source, now)
    return jobs.withColumn("text_hash", F.sha2("description_text", 256))


def probe_boards(attempts: DataFrame, stored: DataFrame, source: BoardSource,
                 slugs: DataFrame | None = None) -> DataFrame:
    """One row per board: ats, slug, outcome, unkeyed, row (of the attempt that counts), company_name.

    attempts: as landed, or their posting_rows. slugs (ats, slug), if given, are the only boards
    to consider. The single shuffle on (ats, slug) serves the retry collapse and both joins; it
    has no postings. Names are settled here, at one row per company.
    """
    heads = (attempt_rows(attempts, source) if "body" in attempts.columns
             else attempts.where(F.coalesce("pos", F.lit(0)) == 0))
    boards = probes.collapse_attempts(heads, "unkeyed", "name", "row", tie=F.struct("tie", "row"))
    if slugs is not None:
        listed = slugs.where(F.col("ats") == source.ats).select("ats", "slug")
        boards = boards.join(listed, ["ats", "slug"], "left_semi")
    known = COMPANIES.conform(stored).where(F.col("ats") == source.ats)
    return probes.resolve_names(boards.withColumnRenamed("name", "company_name"), known)


def board_jobs(postings: DataFrame, boards: DataFrame) -> DataFrame:
    """Light job rows (with pos) of the boards alive, named after their company if they name none.

    postings: posting_rows; their descriptions stay where they are, and TEXT_AT tells where.
    """
    alive = boards.where(F.col("outcome") == ALIVE).select(
        "row", F.col("company_name").alias("_company"))
    described = F.col("text_hash").isNotNull()
    light = postings.where(F.col("pos").isNotNull()).select(
        *[c for c in JOB_SCHEMA.names if c != "description_text"], "text_hash", "pos", "row",
        F.when(described, F.col("row")).alias("text_row"), F.when(described, F.col("pos")).alias("text_pos"))
    return light.join(alive, "row").withColumn(
        "company_name", F.coalesce(non_empty(F.col("company_name")), "_company")).drop("_company", "row")


def next_companies(state: DataFrame, boards: DataFrame, now: int) -> DataFrame:
    """Companies after a run. Dead first: that join keeps the partitioning the upsert needs."""
    keyed = boards.select(
        F.concat_ws(":", "ats", "slug").alias("company_id"), "slug", "ats", "outcome",
        F.col("company_name").alias("name"), F.lit(now).alias("last_probed_at"))
    marked = merge.mark_dead(COMPANIES.conform(state), keyed.where(F.col("outcome") == DEAD))
    return merge.upsert_companies(marked, keyed.where(F.col("outcome") == ALIVE).drop("outcome"))


def run_scrape(attempts: DataFrame, store: StateStore, now: int, *,
               only: Iterable[str] | None = None, slugs: DataFrame | None = None,
               version: int | None = None, hash_mode: str = "reference",
               stale_days: int = merge.STALE_DAYS,
               step: tuple[str, int, int] | None = None, verify: bool = False) -> RunResult:
    """Merge a run's probe attempts into the state and commit the next version.

    only: the systems to process (all by default); the purge covers every system anyhow.
    slugs: (ats, slug) list of the boards to process (all attempts by default).
    step: stream, batch and run, for the commit log.
    verify: check the declared constraints of the parts written, and refuse the version if broken;
    the merges keep them by themselves, so this is for state that others write to as well.

    The narrow side of the state decides everything; stored details are read only where a job of
    their part is new, changed or stale (their descriptions only where one is carried), and parts
    of other systems only for the purge.
    """
    base = store.latest()
    version = (base or 0) + 1 if version is None else version
    sources = [REGISTRY[a] for a in (REGISTRY if only is None else only)]
    companies, seen, meta = (store.read(t, base) for t in (COMPANIES, SEEN, META))
    spark = store.spark

    # Parsed payloads feed several consumers, so they are written once, pruned. All but the last
    # step leave the descriptions there; it moves those that are to be stored, once.
    def settle_boards(source: BoardSource) -> tuple[DataFrame, DataFrame]:
        rows = materialize(posting_rows(attempts, source, now), f"postings-{source.ats}",
                           compression="zstd")
        return rows, materialize(probe_boards(rows, companies, source, slugs), f"boards-{source.ats}")

    postings, boards = zip(*side_by_side(spark, *[partial(settle_boards, s) for s in sources]))
    outcomes = union_all(list(boards))

    incoming = union_all([board_jobs(p, b) for p, b in zip(postings, boards)])
    texts = union_all([p.where("pos is not null and text_hash is not null").select(
        "ats", F.col("row").alias("text_row"), F.col("pos").alias("text_pos"), "description_text")
        for p in postings])
    ran = F.col("ats").isin([s.ats for s in sources])
    cutoff = merge.stale_cutoff(now, stale_days)
    folded = materialize(merge.fold_batch(incoming, seen.where(ran), hash_mode=hash_mode), "folded",
                         compression="zstd")
    settled = merge.settle(seen.where(ran), folded, cutoff)
    if len(sources) < len(REGISTRY):
        settled = settled.unionByName(merge.unchanged(seen.where(~ran), cutoff))
    settled = materialize(settled.withColumn("bucket", store.bucket()), "settled")

    # One row for each part: what a run did to it, and so which parts have to be written.
    totals = {c: F.sum(c).alias(c) for c in ("rows_new", "rows_updated")}
    parts = settled.groupBy("ats", "bucket").agg(
        *totals.values(), F.count_if("is_stale").alias("purged"),
        F.count_if(F.col("is_written") | F.col("is_stale")).alias("changed"),
        F.count_if("is_carried").alias("carried"),
        F.count_if(~F.col("is_stale")).alias("left")).collect()
    names = {part_name(r.ats, r.bucket): r for r in parts}
    chosen = {s.ats for s in sources}
    rewritten = [p for p, r in names.items() if r.changed]
    renewed = [p for p, r in names.items() if r.ats in chosen or r.purged]

    filled = {p for p, r in names.items() if r.left}

    def within(wanted: list[str]) -> DataFrame:
        name = F.concat(F.lit("ats="), "ats", F.lit("/bucket="), F.col("bucket").cast("string"))
        return settled.where(name.isin(wanted))

    def write_details() -> None:
        if not rewritten:
            store.carry(JOB_DETAILS, version, base)
            return
        held = {p: v for p, v in store.parts(JOB_DETAILS, base).items() if p in set(rewritten)}
        # Where no job is carried, the stored descriptions are not read.
        whole, replaced = (store.read_parts(JOB_DETAILS, {
            p: v for p, v in held.items() if bool(names[p].carried) == carried}) for carried in (True, False))
        details = whole.unionByName(merge.replaced_details(replaced))
        store.write(merge.rewrite_details(details, within(rewritten), folded, texts), JOB_DETAILS, version,
                    base=base, replaced=rewritten, filled=filled.intersection(rewritten))

    last = merge.get_meta(meta, LAST_RUN_KEY).first()
    latest = now if last is None else max(now, int(last.value))
    entry = spark.createDataFrame([(LAST_RUN_KEY, str(latest))], META.schema)
    side_by_side(
        spark, write_details,
        lambda: store.write(within(renewed).where(~F.col("is_stale")), SEEN, version, base=base,
                            replaced=renewed, filled=filled.intersection(renewed)),
        lambda: store.write(next_companies(companies.where(ran), outcomes, now), COMPANIES, version,
                            base=base, replaced=[part_name(s.ats) for s in sources]),
        lambda: store.write(merge.put_meta(meta, entry), META, version))
    store.commit(version, *step or (), verify=(JOB_DETAILS, COMPANIES) if verify else ())

    sums = {s.ats: [sum(r[c] for r in parts if r.ats == s.ats) for c in totals] for s in sources}
    per_ats = spark.createDataFrame([(ats, *counts) for ats, counts in sums.items()],
                                    "ats string, jobs_new bigint, jobs_updated bigint")
    stats = probes.outcome_stats(outcomes).join(per_ats, "ats")
    dropped = outcomes.groupBy("ats").agg(
        F.coalesce(F.sum("unkeyed"), F.lit(0)).alias("postings_dropped"))
    return RunResult(version, stats, run_totals(stats, sum(r.purged for r in parts)), dropped)


def run_totals(stats: DataFrame, purged: int) -> DataFrame:
    """Sums over the systems, and the number of jobs purged."""
    return stats.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
          for c in ("companies", "jobs_new", "jobs_updated")],
        F.lit(purged).cast("bigint").alias("purged"))
