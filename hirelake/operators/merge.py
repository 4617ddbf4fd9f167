"""Keyed merges into the state tables.

Every merge is a join on a unique key followed by one expression per column, so the
result is a new snapshot. Hot keys are dealt with before the join: copies of a key in a
batch are folded by aggregates that combine on the map side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import content_hash
from hirelake.operators.joins import left_join_unique
from hirelake.schemas import COMPANIES, JOB_DETAILS, JOBS, META

NEW, UPDATE, TOUCH = "new", "update", "touch"
SECONDS_PER_DAY = 86_400
STALE_DAYS = 7

# Job columns a repeated posting does not replace.
_KEPT = ("ats", "company_id", "ats_job_id")
# Overwritten unless the new value is null.
_COALESCED = ("description_text",)
# What light rows have in place of the description: its hash, and the posting that holds it.
TEXT_AT = ("text_hash", "text_row", "text_pos")
_REPLACED = tuple(c for c in JOBS.columns
                  if c not in ("job_id", "first_seen_at", "last_seen_at", *_KEPT, *_COALESCED))


# --- lookup and classification -------------------------------------------------------


def existing_jobs(incoming: DataFrame, state: DataFrame) -> DataFrame:
    """(job_id, content_hash, has_desc) of the incoming ids that are in the state."""
    ids = incoming.select("job_id").distinct()  # a repeated id is one row before the join
    known = state.select("job_id", "content_hash",
                         F.col("description_text").isNotNull().cast("int").alias("has_desc"))
    return known.join(ids, "job_id", "left_semi")


def write_bucketed(state: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """The lookup columns of a state as a table bucketed and sorted by job_id, read back.

    (job_id, content_hash, has_desc). Lookups in it shuffle the batch only, to its buckets. Take as
    many buckets as make one fit a task: rows of the state over some millions.
    """
    known = state.select("job_id", "content_hash",
                         F.col("description_text").isNotNull().cast("int").alias("has_desc"))
    (known.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, "job_id").sortBy("job_id").saveAsTable(table))
    return state.sparkSession.table(table)


def existing_in_buckets(incoming: DataFrame, lookup: DataFrame) -> DataFrame:
    """existing_jobs over a table of write_bucketed: a merge join without an exchange of the state.

    Ids of the batch are made distinct first, which deals them out as the join needs them.
    """
    ids = incoming.select("job_id").distinct()
    return lookup.hint("merge").join(ids, "job_id", "left_semi")


def job_exists(state: DataFrame, job_id: str) -> DataFrame:
    """The same for one id: a frame of one row, or none. The filter reaches the scan."""
    return state.where(F.col("job_id") == job_id).select(
        "job_id", "content_hash",
        F.col("description_text").isNotNull().cast("int").alias("has_desc"))


def compare_hash(mode: str = "reference", text_hash: Column | None = None) -> Column:
    """What an incoming row is compared by. text_hash stands for a description not at hand.

    'reference': hash without the description, although the stored hash has it; rows with
    a description therefore count as updates on every run. 'full': the row's own hash and its
    whole description, as the hash covers the first 500 characters only.
    """
    if mode == "full":
        return _full_hash(F.col("content_hash"),
                          F.sha2("description_text", 256) if text_hash is None else text_hash)
    if mode != "reference":
        raise ValueError(f"unknown hash mode {mode!r}")
    slug = F.expr("substring(company_id, instr(company_id, ':') + 1)")
    return content_hash(F.col("title"), slug, F.col("location_raw"))


def _full_hash(content: Column, text_hash: Column) -> Column:
    return F.concat(content, F.coalesce(text_hash, F.sha2(F.lit(""), 256)))


def stored_hashes(mode: str = "reference", text_hash: Column | None = None) -> Column:
    """The values of compare_hash that make a row equal to a stored job.

    A batch row without a description leaves the stored one, so in 'full' mode it is equal
    to a job whose hash was taken without one, whatever text is kept. text_hash stands for a
    description that is not at hand.
    """
    content = F.substring("content_hash", 1, 16)
    if mode == "full":
        text = F.sha2("description_text", 256) if text_hash is None else text_hash
        return F.array_distinct(F.array(_full_hash(content, text),
                                        _full_hash(content, F.lit(None).cast("string"))))
    return F.array(content)


def classify(incoming: DataFrame, state: DataFrame, hash_mode: str = "reference") -> DataFrame:
    """Incoming rows with `action`: new, update or touch. Ids may repeat any number of times."""
    stored = state.select("job_id", stored_hashes(hash_mode).alias("_stored"),
                          F.lit(True).alias("_known"))
    same = F.coalesce(F.array_contains("_stored", compare_hash(hash_mode)), F.lit(False))
    action = F.when(F.col("_known").isNull(), NEW).when(same, TOUCH).otherwise(UPDATE)
    return (left_join_unique(incoming, stored, "job_id")
            .withColumn("action", action).drop("_stored", "_known"))


# --- generic upsert -------------------------------------------------------------------


def upsert(state: DataFrame, rows: DataFrame, key: str, *, keep: Iterable[str] = (),
           coalesce: Iterable[str] = ()) -> DataFrame:
    """Insert or replace rows (unique on key) by full outer join.

    On a match, columns in keep hold the stored value and columns in coalesce take the new
    value unless it is null; all others are replaced.
    """
    keep, coalesce = set(keep), set(coalesce)
    s, r = state.alias("s"), rows.alias("r")
    in_state, in_rows = F.col(f"s.{key}").isNotNull(), F.col(f"r.{key}").isNotNull()
    cols = [F.coalesce(f"s.{key}", f"r.{key}").alias(key)]
    for c in state.columns:
        if c == key:
            continue
        old, new = F.col(f"s.{c}"), F.col(f"r.{c}")
        if c in keep:
            value = F.when(in_state, old).otherwise(new)
        elif c in coalesce:
            value = F.coalesce(new, old)
        else:
            value = F.when(in_rows, new).otherwise(old)
        cols.append(value.alias(c))
    merged = s.join(r, F.col(f"s.{key}") == F.col(f"r.{key}"), "full_outer")
    return merged.select(*cols).select(*state.columns)


def put_meta(meta: DataFrame, entries: DataFrame) -> DataFrame:
    """Key-value table with entries (unique on key) put in."""
    return upsert(META.conform(meta), META.conform(entries), "key")


def get_meta(meta: DataFrame, key: str) -> DataFrame:
    """The value of one key: a frame of one row, or none."""
    return meta.where(F.col("key") == key).select("value")


# --- companies ------------------------------------------------------------------------


def upsert_companies(state: DataFrame, probed: DataFrame) -> DataFrame:
    """Companies that answered: alive again, new probe time, name kept if none is given.

    An answer older than the stored probe time changes nothing.
    """
    known = state.select(F.col("company_id").alias("_id"), F.col("last_probed_at").alias("_last"))
    newer = F.col("_last").isNull() | (F.col("last_probed_at") >= F.col("_last"))
    probed = probed.join(known, F.col("company_id") == F.col("_id"), "left").where(newer)
    rows = COMPANIES.conform(probed.withColumn("is_dead", F.lit(0)))
    return upsert(COMPANIES.conform(state), rows, "company_id",
                  keep=("slug", "ats"), coalesce=("name",))


def mark_dead(state: DataFrame, dead: DataFrame) -> DataFrame:
    """Set is_dead on stored companies among the dead ones; unknown ones are not added.

    Where dead has last_probed_at, a company that answered later stays alive.
    """
    when = F.col("last_probed_at") if "last_probed_at" in dead.columns else F.lit(None)
    gone = dead.groupBy("company_id").agg(
        F.max(when.cast("bigint")).alias("_when"), F.first(F.lit(True)).alias("_gone"))
    held = F.col("_gone") & (F.coalesce(F.col("_when") >= F.col("last_probed_at"), F.lit(True)))
    return (state.join(gone, "company_id", "left")
            .withColumn("is_dead", F.when(held, 1).otherwise(F.col("is_dead")))
            .select(*state.columns))


# --- jobs -----------------------------------------------------------------------------


def _first_and_last(first: Column, last: Column, text: Column, of: Column) -> list[Column]:
    """Replay repeated rows in order, those only where `of` holds.

    Kept columns come from the first row, the description from the last row that has one,
    all others from the last row. The order leads each struct, so a plain minimum or
    maximum decides.
    """
    return [F.min(F.when(of, first)).alias("_first"), F.max(F.when(of, last)).alias("_last"),
            F.max(F.when(of, text)).alias("_text"), F.max("now").alias("now")]


def fold_batch(incoming: DataFrame, state: DataFrame, order: Iterable[str] = ("pos",),
               hash_mode: str = "reference") -> DataFrame:
    """One row per job_id of a batch that may repeat ids, ready for merge_jobs.

    Rows equal to the stored job (touch) bring nothing but their time. Which rows those
    are is a join on (job_id, hash), so it needs no look at the group as a whole:
    1. copies of one (job_id, hash) are folded, on the map side first;
    2. the state's (job_id, content_hash) pairs mark the groups to pass over;
    3. the rest is folded by job_id, again on the map side first.
    A job_id with any number of rows is thus at most one row per map task in each shuffle.
    state may be whole jobs or their narrow side (job_id, content_hash, text_hash), and incoming
    whole rows or light ones, which have TEXT_AT in place of the description: its hash and where
    it is, null without one. Row counts ride along for the statistics, which count repeated rows
    one by one.
    """
    light = "description_text" not in incoming.columns
    text = TEXT_AT if light else _COALESCED
    rows = incoming.withColumn(
        "_hash", compare_hash(hash_mode, F.col("text_hash") if light else None))
    at = F.struct(*order, "company_id").alias("at")
    described = F.col(text[0]).isNotNull()
    groups = rows.groupBy("job_id", "_hash").agg(
        *_first_and_last(F.struct(at, *_KEPT), F.struct(at, *_REPLACED),
                         F.when(described, F.struct(at, *text)), F.lit(True)),
        F.count("*").alias("n_rows"))
    text_hash = F.col("text_hash") if "text_hash" in state.columns else None
    stored = state.select("job_id", F.explode(stored_hashes(hash_mode, text_hash)).alias("_hash"),
                          F.lit(True).alias("_same"))
    written = F.col("_same").isNull()
    folded = groups.join(stored, ["job_id", "_hash"], "left").groupBy("job_id").agg(
        *_first_and_last(F.col("_first"), F.col("_last"), F.col("_text"), written),
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.when(written, F.col("n_rows")).otherwise(0)).alias("n_written"))
    return folded.select(
        "job_id", *[F.col(f"_first.{c}") for c in _KEPT],
        *[F.col(f"_last.{c}") for c in _REPLACED], *[F.col(f"_text.{c}") for c in text],
        "now", "n_rows", "n_written")


def merge_jobs(state: DataFrame, folded: DataFrame) -> DataFrame:
    """State after a folded batch, with rows_new, rows_updated and rows_touched per job.

    Jobs not in the batch stay as they are; touched ones only get the new last_seen_at.
    """
    s, b = JOBS.conform(state).alias("s"), folded.alias("b")
    in_state = F.col("s.job_id").isNotNull()
    in_batch = F.col("b.job_id").isNotNull()
    # A batch older than what is stored brings new jobs only.
    late = in_state & in_batch & (F.col("b.now") < F.col("s.last_seen_at"))
    written = in_batch & (F.col("b.n_written") > 0) & ~F.coalesce(late, F.lit(False))
    values = {
        "job_id": F.coalesce("s.job_id", "b.job_id"),
        "first_seen_at": F.when(in_state, F.col("s.first_seen_at")).otherwise(F.col("b.now")),
        "last_seen_at": F.greatest("b.now", "s.last_seen_at"),
    }
    for c in _KEPT:
        values[c] = F.when(in_state, F.col(f"s.{c}")).otherwise(F.col(f"b.{c}"))
    for c in _COALESCED:
        values[c] = F.coalesce(F.when(written, F.col(f"b.{c}")), F.col(f"s.{c}"))
    for c in _REPLACED:
        values[c] = F.when(written, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}"))
    rows = F.coalesce("b.n_rows", F.lit(0))
    hits = F.when(late, 0).otherwise(F.coalesce("b.n_written", F.lit(0)))
    counts = {
        "rows_new": F.when(in_state, 0).otherwise(rows),
        "rows_updated": F.when(in_state, hits).otherwise(0),
        "rows_touched": F.when(in_state, rows - hits).otherwise(0),
    }
    return s.join(b, F.col("s.job_id") == F.col("b.job_id"), "full_outer").select(
        *[values[c].alias(c) for c in JOBS.columns],
        *[c.cast("bigint").alias(name) for name, c in counts.items()])


def settle(seen: DataFrame, folded: DataFrame, cutoff: int) -> DataFrame:
    """What a folded batch means for each job, from the narrow side of the state alone.

    (job_id, ats, last_seen_at, content_hash, text_hash, is_new, is_written, is_stale, is_carried,
    rows_new, rows_updated, rows_touched); the first five are the narrow side after the run. A
    job is carried if stored values beyond _KEPT stay. No description is read: of a batch's only
    the hash.
    """
    text_hash = ("text_hash" if "text_hash" in folded.columns
                 else F.sha2("description_text", 256).alias("text_hash"))
    b = folded.select("job_id", "ats", "now", "n_rows", "n_written", "content_hash",
                      text_hash).alias("b")
    s = seen.alias("s")
    in_state, in_batch = F.col("s.job_id").isNotNull(), F.col("b.job_id").isNotNull()
    late = F.coalesce(in_state & in_batch & (F.col("b.now") < F.col("s.last_seen_at")), F.lit(False))
    written = in_batch & (F.col("b.n_written") > 0) & ~late
    rows = F.coalesce("b.n_rows", F.lit(0))
    hits = F.when(late, 0).otherwise(F.coalesce("b.n_written", F.lit(0)))
    last = F.greatest("b.now", "s.last_seen_at")
    return s.join(b, F.col("s.job_id") == F.col("b.job_id"), "full_outer").select(
        F.coalesce("s.job_id", "b.job_id").alias("job_id"), F.coalesce("s.ats", "b.ats").alias("ats"),
        last.alias("last_seen_at"),
        F.when(written, F.col("b.content_hash")).otherwise(F.col("s.content_hash")).alias("content_hash"),
        F.coalesce(F.when(written, F.col("b.text_hash")), F.col("s.text_hash")).alias("text_hash"),
        (~in_state).alias("is_new"), F.coalesce(written, F.lit(False)).alias("is_written"),
        (last < cutoff).alias("is_stale"),
        (in_state & (last >= cutoff) & ~F.coalesce(
            written & F.col("b.text_hash").isNotNull(), F.lit(False))).alias("is_carried"),
        *[c.cast("bigint").alias(name) for name, c in (
            ("rows_new", F.when(in_state, 0).otherwise(rows)),
            ("rows_updated", F.when(in_state, hits).otherwise(0)),
            ("rows_touched", F.when(in_state, rows - hits).otherwise(0)))])


def unchanged(seen: DataFrame, cutoff: int) -> DataFrame:
    """The same for jobs that a run does not look at: some are stale."""
    zero = F.lit(0).cast("bigint")
    return seen.select(
        "job_id", "ats", "last_seen_at", "content_hash", "text_hash", F.lit(False).alias("is_new"),
        F.lit(False).alias("is_written"), (F.col("last_seen_at") < cutoff).alias("is_stale"),
        (F.col("last_seen_at") >= cutoff).alias("is_carried"), zero.alias("rows_new"), zero.alias("rows_updated"), zero.alias("rows_touched"))


def replaced_details(details: DataFrame) -> DataFrame:
    """Stored details of which no job is carried: a rewrite looks at the key, _KEPT and first_seen_at."""
    looked_at = ("job_id", "first_seen_at", *_KEPT)
    return details.select(*[F.col(f.name) if f.name in looked_at else F.lit(None).cast(f.dataType).alias(f.name)
                            for f in JOB_DETAILS.schema.fields])


def rewrite_details(details: DataFrame, settled: DataFrame, folded: DataFrame,
                    texts: DataFrame | None = None) -> DataFrame:
    """The wide side after a run, for the jobs in settled that stay.

    Each row is moved once: the narrow decisions meet the stored details and the folded rows
    that are to be written. Light folded rows get their description from texts, which has it by
    TEXT_AT's place (ats, text_row, text_pos), one row each; only there is a new one shuffled.
    """
    kept = settled.where(~F.col("is_stale")).select("job_id", "is_new", "is_written").alias("k")
    s = details.alias("s")
    b = folded.join(settled.where("is_written and not is_stale").select("job_id"), "job_id",
                    "left_semi").alias("b")
    new, written = F.col("k.is_new"), F.col("k.is_written")
    values = {"job_id": F.col("k.job_id"),
              "first_seen_at": F.when(new, F.col("b.now")).otherwise(F.col("s.first_seen_at"))}
    for c in _KEPT:
        values[c] = F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}"))
    for c in _REPLACED:
        values[c] = F.when(written, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}"))
    joined = (kept.join(s, F.col("k.job_id") == F.col("s.job_id"), "left")
              .join(b, F.col("k.job_id") == F.col("b.job_id"), "left"))
    if texts is None:
        for c in _COALESCED:
            values[c] = F.coalesce(F.when(written, F.col(f"b.{c}")), F.col(f"s.{c}"))
        return joined.select(*[values[c].alias(c) for c in JOB_DETAILS.columns])
    brought = F.coalesce(written & F.col("b.text_hash").isNotNull(), F.lit(False))
    values["description_text"] = F.when(~brought, F.col("s.description_text"))
    # Jobs that are brought no text have no place, and spread by their id.
    place = {"text_row": F.when(brought, F.col("b.text_row")).otherwise(F.xxhash64("k.job_id")),
             "text_pos": F.when(brought, F.col("b.text_pos")).otherwise(-1)}
    light = joined.select(*[values[c].alias(c) for c in JOB_DETAILS.columns],
                          *[c.alias(name) for name, c in place.items()])
    found = texts.withColumnRenamed("description_text", "_text")
    return light.join(found, ["ats", "text_row", "text_pos"], "left").withColumn(
        "description_text", F.coalesce("_text", "description_text")).select(*JOB_DETAILS.columns)


def upsert_jobs(state: DataFrame, incoming: DataFrame, order: Iterable[str] = ("pos",),
                hash_mode: str = "reference") -> DataFrame:
    """State after a batch of job rows; ids may repeat, later rows win."""
    merged = merge_jobs(state, fold_batch(incoming, state, order, hash_mode))
    return merged.select(*JOBS.columns)


# --- expiry ---------------------------------------------------------------------------


def stale_cutoff(now: int, days: int = STALE_DAYS) -> int:
    return now - days * SECONDS_PER_DAY


def purge_stale(jobs: DataFrame, cutoff: int) -> DataFrame:
    """Jobs seen at or after the cutoff; the filter reaches the scan."""
    return jobs.where(F.col("last_seen_at") >= cutoff)


def count_stale(jobs: DataFrame, cutoff: int) -> DataFrame:
    """How many jobs a purge drops, per system."""
    return jobs.where(F.col("last_seen_at") < cutoff).groupBy("ats").agg(
        F.count("*").alias("purged"))
