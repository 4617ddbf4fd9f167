"""What a run writes and reads of the state, by files and plans; constraints at commit."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.operators import merge
from hirelake.plans.scrape import run_scrape
from hirelake.schemas import COMPANIES, JOB_DETAILS, JOBS, SEEN
from hirelake.session import scratch_dir
from hirelake.sources.state_store import ConstraintError, StateStore
from test_plans import DAY, RUN1, RUN2, T0, attempts, rows


def files(root, table):
    """(version, ats) of each data file of a table."""
    found = set()
    for folder, _, names in os.walk(os.path.join(root, "data", table)):
        if any(n.endswith(".parquet") for n in names):
            found.add((int(re.search(r"version=(\d+)", folder)[1]), re.search(r"ats=(\w+)", folder)[1]))
    return found


def test_a_run_over_one_system_writes_no_file_of_another(spark, tmp_path):
    root = str(tmp_path / "state")
    store = StateStore(spark, root)
    run_scrape(attempts(spark, RUN1), store, T0)
    before = {t.name: rows(store.read(t).where("ats <> 'lever'"), *t.columns) for t in (COMPANIES, JOBS)}
    run_scrape(attempts(spark, RUN2), store, T0 + DAY, only=["lever"])
    for table in ("jobs", "seen", "companies"):
        assert {a for v, a in files(root, table) if v == 2} == {"lever"}
    assert {t.name: rows(store.read(t).where("ats <> 'lever'"), *t.columns) for t in (COMPANIES, JOBS)} == before
    # The purge reaches the other systems' jobs: now their parts are rewritten, or gone.
    run_scrape(attempts(spark, RUN2), store, T0 + 8 * DAY, only=["lever"])
    assert rows(store.read(JOBS), "job_id") == [("lever:1",), ("lever:2",), ("lever:3",)]
    assert not any(p.startswith(("ats=greenhouse", "ats=ashby")) for t in (SEEN, JOB_DETAILS)
                   for p in store.parts(t, 3))


def test_jobs_seen_again_leave_the_details_alone(spark, tmp_path):
    root = str(tmp_path / "state")
    store = StateStore(spark, root)
    run_scrape(attempts(spark, RUN1), store, T0)
    result = run_scrape(attempts(spark, RUN1), store, T0 + 60, hash_mode="full")
    assert rows(result.totals, "jobs_new", "jobs_updated", "purged") == [(0, 0, 0)]
    assert {v for v, _ in files(root, "jobs")} == {1} and {v for v, _ in files(root, "seen")} == {1, 2}
    assert {r.last_seen_at for r in store.read(JOBS).collect()} == {T0 + 60}
    assert StateStore(spark, root).parts(JOB_DETAILS, 2) == store.parts(JOB_DETAILS, 1)  # as on disk


def test_settling_reads_no_stored_description(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    run_scrape(attempts(spark, RUN1), store, T0)
    batch = str(tmp_path / "folded")
    incoming = store.read(JOBS).withColumn("now", F.lit(T0 + 5).cast("long")).withColumn("pos", F.lit(0))
    for mode in ("reference", "full"):
        folded = merge.fold_batch(incoming, store.read(SEEN), hash_mode=mode)
        folded.write.mode("overwrite").parquet(batch)
        settled = merge.settle(store.read(SEEN), spark.read.parquet(batch), 0)
        assert {f.split("/data/")[1].split("/")[0] for f in settled.inputFiles() if "/data/" in f} == {"seen"}
        read = re.findall(r"ReadSchema: (\S+)", settled._jdf.queryExecution().executedPlan().toString())
        assert sum("description_text" in r for r in read) == 1  # the batch's own


def test_narrow_merge_equals_the_wide_one(spark, tmp_path):
    """Runs through the store against merge_jobs over whole rows."""
    store = StateStore(spark, str(tmp_path / "state"), buckets=3)
    run_scrape(attempts(spark, RUN1), store, T0)
    state = store.read(JOBS)
    batch = state.limit(4).withColumn("title", F.when(F.col("job_id") > "h", F.col("title")).otherwise("x"))
    batch = batch.withColumn("now", F.lit(T0 + 7).cast("long")).withColumn("pos", F.lit(1))
    extra = batch.limit(1).withColumn("job_id", F.lit("lever:new"))
    batch = spark.createDataFrame(batch.unionByName(extra).collect(), batch.schema)
    for mode in ("reference", "full"):
        folded = merge.fold_batch(batch, state, hash_mode=mode)
        wide = merge.merge_jobs(state, folded)
        narrow = merge.fold_batch(batch, store.read(SEEN), hash_mode=mode)
        settled = merge.settle(store.read(SEEN), narrow, 0)
        details = merge.rewrite_details(store.read(JOB_DETAILS), settled, narrow)
        got = details.join(settled.select("job_id", "last_seen_at"), "job_id").select(*JOBS.columns)
        assert rows(got, *JOBS.columns) == rows(wide, *JOBS.columns)
        counts = ("job_id", "rows_new", "rows_updated", "rows_touched")
        assert rows(settled, *counts) == rows(wide, *counts)


def test_a_version_that_breaks_a_key_is_refused(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    run_scrape(attempts(spark, RUN1), store, T0, verify=True)
    jobs = store.read(JOBS)
    double = jobs.where("job_id = 'lever:1'").withColumn("job_id", F.lit("lever:1b"))
    store.write(jobs.unionByName(double), JOBS, 2)
    with pytest.raises(ConstraintError, match=r"unique \(ats,ats_job_id\)"):
        store.commit(2, verify=(JOB_DETAILS,))
    nameless = spark.createDataFrame([("lever:z", None, "lever", None, 1, 0)], schemas.COMPANIES.schema.simpleString()
                                     .replace("struct<", "").rstrip(">"))
    store.write(nameless, COMPANIES, 2)
    with pytest.raises(ConstraintError, match="slug"):
        store.commit(2, verify=(COMPANIES,))
    assert store.latest() == 1 and store.read(JOBS).count() == jobs.count()


def test_a_run_keeps_descriptions_in_one_scratch_table(spark, tmp_path):
    """Retry collapse, names and folding move no answers; only the last step does, once."""
    before = set(glob.glob(f"{scratch_dir(spark)}/*"))
    run_scrape(attempts(spark, RUN1), StateStore(spark, str(tmp_path / "state")), T0)
    made = {}
    for path in set(glob.glob(f"{scratch_dir(spark)}/*")) - before:
        made[os.path.basename(path).rsplit("-", 1)[0]] = set(spark.read.parquet(path).columns)
    assert {k for k, columns in made.items() if columns & {"description_text", "postings", "body"}} == {
        "postings-lever", "postings-greenhouse", "postings-ashby"}
    assert {"boards-lever", "folded", "settled"} <= set(made)


def test_stored_descriptions_are_read_for_carried_jobs_only(spark, tmp_path, monkeypatch):
    store = StateStore(spark, str(tmp_path / "state"))
    run_scrape(attempts(spark, RUN1), store, T0)
    replaced = []
    monkeypatch.setattr(merge, "replaced_details", lambda details, plain=merge.replaced_details: (
        replaced.append(rows(details, "job_id")) or plain(details)))
    again = [(*r[:4], r[4].replace("Engineer", "Builder").replace("null", '"new"') if r[4] else None)
             for r in RUN1 if r[0] == "lever"]
    run_scrape(attempts(spark, again), store, T0 + DAY, only=["lever"])  # all with a new text
    assert replaced == [[("lever:1",), ("lever:2",)]]
    jobs = {r.job_id: r for r in store.read(JOBS).collect()}
    assert (jobs["lever:1"].title, jobs["lever:1"].description_text) == ("Builder", "new")
    assert jobs["lever:2"].description_text == "text" and jobs["lever:1"].first_seen_at == T0
    # Without a text of its own the stored one stays, and so does all of a job not seen.
    run_scrape(attempts(spark, RUN2), store, T0 + 2 * DAY)
    jobs = {r.job_id: r for r in store.read(JOBS).collect()}
    assert [jobs[f"lever:{i}"].description_text for i in (1, 2, 3)] == ["new", "text", None]
    assert jobs["greenhouse:11"].title == "B" and jobs["ashby:x"].title == "Designer"


def test_text_of_a_repeated_posting_and_of_a_later_attempt(spark, tmp_path):
    """The last row decides, the last description stays; an attempt that lost brings nothing."""
    def body(*postings):
        return "[" + ",".join('{"id":"%s","text":"%s","descriptionPlain":%s}' % p for p in postings) + "]"

    data = [("lever", "a", 1, 200, body(("1", "Late", '"late"'), ("7", "Late", '"late"'))),
            ("lever", "a", 0, 200, body(("1", "One", '"first"'), ("1", "Two", '"second"'), ("1", "Three", "null"))),
            ("lever", "b", 2, 200, body(("2", "B", '"of b"'))), ("lever", "b", 0, 503, None)]
    store = StateStore(spark, str(tmp_path / "state"))
    result = run_scrape(attempts(spark, data), store, T0)
    assert rows(store.read(JOBS), "job_id", "title", "description_text", "company_name") == [
        ("lever:1", "Three", "second", "a"), ("lever:2", "B", "of b", "b")]
    assert rows(result.totals, "companies", "jobs_new") == [(2, 4)]
