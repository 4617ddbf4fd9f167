"""Payload scan, outcomes and projections."""

import json

from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.text import content_hash
from hirelake.sources import boards
from hirelake.sources.boards import ASHBY, GREENHOUSE, LEVER

NOW = 1_700_000_000


def attempts(spark, *rows):
    """Rows of (ats, slug, status, body)."""
    return spark.createDataFrame(
        [(a, s, 0, status, body) for a, s, status, body in rows], schemas.PROBE_ATTEMPTS)


def project(spark, source, slug, body):
    read = boards.with_postings(attempts(spark, (source.ats, slug, 200, json.dumps(body))), source)
    jobs = boards.project_jobs(boards.postings_of(read), source, NOW)
    return [r.asDict() for r in jobs.orderBy("pos").collect()]


def hashed(spark, *parts):
    cols = [F.lit(p) for p in parts]
    return spark.range(1).select(content_hash(*cols)).first()[0]


LEVER_POSTING = {
    "id": "8d1c", "text": "Senior Engineer",
    "categories": {"commitment": "Full time", "department": "Eng", "team": "Core",
                   "location": "Austin, TX", "allLocations": ["Austin, TX"]},
    "country": "us", "workplaceType": "remote",
    "descriptionPlain": "About us", "additionalPlain": "   ",
    "lists": [{"text": "You", "content": "<li>code</li><li>test &amp; ship</li>"},
              {"text": "", "content": ""}, {"content": "<b>more</b>"}],
    "salaryRange": {"min": 100000, "max": 150000.5, "currency": "USD", "interval": "year"},
    "createdAt": 1,
}


def test_lever_projection(spark):
    row, = project(spark, LEVER, "acme", [LEVER_POSTING])
    text = "About us\n\nYou\n\ncode\ntest & ship\n\nmore"
    assert row == {
        "job_id": "lever:8d1c", "ats": "lever", "company_id": "lever:acme", "ats_job_id": "8d1c",
        "title": "Senior Engineer", "company_name": None, "description_text": text,
        "location_raw": "Austin, TX", "city": "Austin", "state": "TX", "country": "US",
        "is_remote": 1, "department": "Core", "employment_type": "full-time",
        "experience_level": "senior", "min_salary": 100000.0, "max_salary": 150000.5,
        "apply_url": "https://jobs.lever.co/acme/8d1c/apply", "now": NOW,
        "content_hash": hashed(spark, "Senior Engineer", "acme", "Austin, TX", text),
        "attempt": 0, "status_code": 200, "outcome": "alive", "pos": 0, "slug": "acme",
    }


def test_lever_defaults(spark):
    row, = project(spark, LEVER, "acme", [{"id": "1", "applyUrl": "https://x/y",
                                           "workplaceType": "Remote",
                                           "categories": {"department": "D", "team": ""}}])
    assert (row["title"], row["location_raw"], row["description_text"]) == ("", "", None)
    assert (row["is_remote"], row["department"], row["min_salary"]) == (0, "D", None)
    assert (row["apply_url"], row["employment_type"]) == ("https://x/y", "full-time")
    assert row["content_hash"] == hashed(spark, "", "acme", "")


def test_greenhouse_projection(spark):
    body = {"jobs": [{
        "id": 8440707002, "title": "Intern", "company_name": "Discord",
        "absolute_url": "https://gh/1", "content": "&lt;p&gt;Hi&lt;/p&gt;",
        "location": {"name": "Toronto, ON, Canada"},
        "departments": [{"id": 1, "name": "Eng"}, {"id": 2, "name": "Ops"}],
        "offices": [{"name": "HQ"}, {"name": "US Remote"}],
        "metadata": [{"value": ["a"]}, {"value": None}]},
        {"id": 7, "departments": []}]}
    first, second = project(spark, GREENHOUSE, "discord", body)
    assert (first["job_id"], first["ats_job_id"]) == ("greenhouse:8440707002", "8440707002")
    assert (first["company_name"], first["department"]) == ("Discord", "Eng")
    assert first["description_text"] == "<p>Hi</p>"
    assert (first["city"], first["state"], first["country"]) == ("Toronto", "ON", "CA")
    assert (first["is_remote"], first["employment_type"]) == (1, "full-time")
    assert (first["experience_level"], first["apply_url"]) == ("internship", "https://gh/1")
    assert (second["department"], second["company_name"], second["is_remote"]) == (None, None, 0)
    assert second["apply_url"] == "https://job-boards.greenhouse.io/discord/jobs/7"
    assert second["description_text"] is None


def test_ashby_projection(spark):
    body = {"jobs": [{
        "id": "a1", "title": " Staff Designer ", "location": "Remote", "team": "Design",
        "department": "", "employmentType": "Contract", "workplaceType": "Remote",
        "descriptionPlain": "", "descriptionHtml": "<p>x</p>", "isListed": True,
        "address": {"postalAddress": {"addressLocality": "San Francisco",
                                      "addressRegion": "California",
                                      "addressCountry": "United States"}},
        "compensation": {"summaryComponents": [
            {"compensationType": "Equity", "minValue": 1, "maxValue": 2},
            {"compensationType": "Salary", "minValue": None, "maxValue": 9},
            {"compensationType": "Salary", "minValue": 5, "maxValue": 6}]}},
        {"id": "a2", "isListed": False},
        {"id": "a3", "title": "t", "location": "Paris, FR", "isRemote": True,
         "address": {"postalAddress": {"addressLocality": "Nice", "addressCountry": "de"}}},
        {"id": "a4", "address": {"postalAddress": {"addressCountry": "CAN"}}},
        {"id": "a5", "address": {"postalAddress": {"addressCountry": "de"}}}]}
    rows = project(spark, ASHBY, "ramp", body)
    assert [r["ats_job_id"] for r in rows] == ["a1", "a3", "a4", "a5"]
    one, three, four, five = rows
    assert (one["title"], one["experience_level"]) == ("Staff Designer", "senior")
    assert (one["city"], one["state"], one["country"]) == ("San Francisco", "California", None)
    assert (one["is_remote"], one["department"], one["employment_type"]) == (1, "Design", "contract")
    assert (one["min_salary"], one["max_salary"]) == (None, 9.0)
    assert one["description_text"] == "x"
    assert one["apply_url"] == "https://jobs.ashbyhq.com/ramp/a1/application"
    assert (three["city"], three["country"], three["is_remote"]) == ("Paris", "FR", 1)
    assert (four["country"], five["country"]) == ("CA", "DE")


def test_postings_without_id_are_dropped(spark):
    rows = project(spark, LEVER, "acme", [{"text": "no id"}, {"id": "1"}])
    assert [r["job_id"] for r in rows] == ["lever:1"]


OUTCOMES = [
    # ats, status, body, outcome, postings
    ("lever", 200, '[{"id":"1"}]', "alive", 1),
    ("lever", 200, "[]", "alive", 0),
    ("lever", 200, ' \n[{"id":"1"}]', "alive", 1),
    ("lever", 200, '{"ok":false,"error":"x"}', "dead", None),
    ("lever", 200, '{"ok":', "error", None),
    ("lever", 200, '[{"id":"1"},{"id"', "error", None),
    ("lever", 200, "garbage", "error", None),
    ("lever", 200, None, "error", None),
    ("lever", 404, None, "dead", None),
    ("lever", 404, "[]", "dead", None),
    ("lever", 500, "[]", "error", None),
    ("lever", 302, "[]", "error", None),
    ("lever", None, None, "error", None),
    ("greenhouse", 200, '{"jobs":[]}', "alive", 0),
    ("greenhouse", 200, "{}", "alive", 0),
    ("greenhouse", 200, "[]", "error", None),
    ("greenhouse", 200, '{"jobs":[{"id":1},{"id":2}]}', "alive", 2),
    ("greenhouse", 200, "null", "error", None),
    ("greenhouse", 404, "{}", "dead", None),
    ("ashby", 200, '{"jobs":[]}', "dead", None),
    ("ashby", 200, "{}", "dead", None),
    ("ashby", 200, '{"jobs":[{"id":"1","isListed":false}]}', "alive", 0),
    ("ashby", 200, '{"jobs":[{"id":"1"}]}', "alive", 1),
    ("ashby", 429, '{"jobs":[]}', "error", None),
    # a field of an unexpected type is lost, its posting and its board are not
    ("ashby", 200, '{"jobs":[{"id":"1","isRemote":"maybe"},{"id":"2"}]}', "alive", 2),
    ("lever", 200, '[{"id":"1","salaryRange":{"min":"a lot"}},{"id":"2"}]', "alive", 2),
]


def test_outcomes(spark):
    rows = [(a, str(i), s, b) for i, (a, s, b, _, _) in enumerate(OUTCOMES)]
    probes = attempts(spark, *rows)
    got = {}
    for source in (LEVER, GREENHOUSE, ASHBY):
        for r in boards.with_postings(probes, source).collect():
            got[int(r.slug)] = (r.outcome, None if r.postings is None else len(r.postings))
    expected = {i: (o, n) for i, (_, _, _, o, n) in enumerate(OUTCOMES)}
    assert got == expected


def test_registry_is_open(spark):
    """A further system needs an entry, no new code paths."""
    extra = boards.BoardSource(
        ats="extra", posting=schemas.GREENHOUSE_POSTING, fields=GREENHOUSE.fields,
        location=GREENHOUSE.location, url_pattern="x/(.*)", host_pattern="x", index_prefix="x")
    row, = project(spark, extra, "co", {"jobs": [{"id": 1, "title": "Lead"}]})
    assert (row["job_id"], row["experience_level"]) == ("extra:1", "senior")


def test_scan_reads_needed_fields_only(spark, tmp_path):
    path = str(tmp_path / "p")
    attempts(spark, ("lever", "a", 200, "[]")).write.partitionBy("ats").parquet(path)
    plan = boards.with_postings(spark.read.parquet(path), LEVER).select("slug", "outcome")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ats" in text and "PartitionFilters: [isnotnull(ats" in text
    assert "attempt" not in text.split("ReadSchema:")[1]
