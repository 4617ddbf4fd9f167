"""Job-board payloads: reading landed bodies and projecting postings to the job row.

A board system is one BoardSource in REGISTRY. Adding another one means registering its
posting schema, its URL patterns and a projection made of Column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake import schemas
from hirelake.functions.labels import (
    DEFAULT_EMPLOYMENT_TYPE, employment_type, experience_level)
from hirelake.functions.location import parse_location
from hirelake.functions.text import content_hash, html_to_text, non_empty, strip

ALIVE, DEAD, ERROR = "alive", "dead", "error"
_CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class BoardSource:
    """What one board system needs: payload shape, URL patterns, projection."""

    ats: str
    posting: T.StructType
    # (posting, slug, bound location) -> job columns that differ between systems
    fields: Callable[[Column, Column, Column], Mapping[str, Column]]
    location: Callable[[Column], Column]
    url_pattern: str                # one group: the slug
    host_pattern: str
    index_prefix: str
    body_is_list: bool = False      # postings at the root; an object then means "no such board"
    empty_is_dead: bool = False     # a board without postings counts as gone
    keep: Callable[[Column], Column] | None = None
    company_name: str | None = None  # posting field that names the company, if there is one
    url_literal: str | None = None  # text that every line with a match contains

    @property
    def postings_type(self) -> T.ArrayType:
        return T.ArrayType(self.posting)


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# --- projections --------------------------------------------------------------------


def _lever_fields(p: Column, slug: Column, loc: Column) -> dict[str, Column]:
    per_list = F.flatten(F.transform(
        p["lists"], lambda x: F.array(x["text"], html_to_text(x["content"]))))
    parts = F.concat(F.array(p["descriptionPlain"]),
                     F.coalesce(per_list, F.array().cast("array<string>")),
                     F.array(p["additionalPlain"]))
    shown = F.filter(parts, lambda x: strip(_text(x)) != "")
    return {
        "title": _text(p["text"]),
        "description_text": non_empty(F.array_join(shown, "\n\n")),
        "country": F.coalesce(F.upper(non_empty(p["country"])), loc["country"]),
        "is_remote": F.when(p["workplaceType"] == "remote", 1).otherwise(loc["is_remote"]),
        "department": F.coalesce(non_empty(p["categories"]["team"]), p["categories"]["department"]),
        "employment_type": employment_type(p["categories"]["commitment"]),
        "min_salary": p["salaryRange"]["min"],
        "max_salary": p["salaryRange"]["max"],
        "apply_url": F.coalesce(p["applyUrl"], F.concat(
            F.lit("https://jobs.lever.co/"), slug, F.lit("/"), p["id"], F.lit("/apply"))),
    }


def _greenhouse_fields(p: Column, slug: Column, loc: Column) -> dict[str, Column]:
    remote_office = F.exists(p["offices"], lambda o: F.lower(_text(o["name"])).contains("remote"))
    return {
        "title": _text(p["title"]),
        "description_text": html_to_text(p["content"]),
        "is_remote": F.when(remote_office, 1).otherwise(loc["is_remote"]),
        "department": F.get(p["departments"], F.lit(0))["name"],
        "employment_type": F.lit(DEFAULT_EMPLOYMENT_TYPE),
        "min_salary": F.lit(None),
        "max_salary": F.lit(None),
        "apply_url": F.coalesce(p["absolute_url"], F.concat(
            F.lit("https://job-boards.greenhouse.io/"), slug, F.lit("/jobs/"), p["id"])),
    }


def _ashby_fields(p: Column, slug: Column, loc: Column) -> dict[str, Column]:
    address = p["address"]["postalAddress"]
    code = address["addressCountry"]
    country = (F.when(code.isin("USA", "US"), "US").when(code.isin("CAN", "CA", "Canada"), "CA")
               .when(F.length(code) == 2, F.upper(code)))
    salary = F.get(F.filter(p["compensation"]["summaryComponents"],
                            lambda s: s["compensationType"] == "Salary"), F.lit(0))
    remote = _flag(p["isRemote"]) | _flag(p["workplaceType"] == "Remote")
    return {
        "title": strip(_text(p["title"])),
        "description_text": F.coalesce(non_empty(p["descriptionPlain"]),
                                       html_to_text(p["descriptionHtml"])),
        "city": F.coalesce(loc["city"], non_empty(address["addressLocality"])),
        "state": F.coalesce(loc["state"], non_empty(address["addressRegion"])),
        "country": F.coalesce(loc["country"], country),
        "is_remote": F.when(remote, 1).otherwise(loc["is_remote"]),
        "department": F.coalesce(non_empty(p["department"]), p["team"]),
        "employment_type": employment_type(p["employmentType"]),
        "min_salary": salary["minValue"],
        "max_salary": salary["maxValue"],
        "apply_url": F.coalesce(p["applyUrl"], F.concat(
            F.lit("https://jobs.ashbyhq.com/"), slug, F.lit("/"), p["id"], F.lit("/application"))),
    }


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


REGISTRY: dict[str, BoardSource] = {}


def register(source: BoardSource) -> BoardSource:
    REGISTRY[source.ats] = source
    return source


# URL patterns, host names and index prefixes are fixed values of the three systems.
LEVER = register(BoardSource(
    ats="lever",
    posting=schemas.LEVER_POSTING,
    fields=_lever_fields,
    location=lambda p: _text(p["categories"]["location"]),
    url_pattern=r"jobs\.lever\.co/([a-zA-Z0-9._-]+)",
    url_literal="jobs.lever.co/",
    host_pattern="lever.co",
    index_prefix="co,lever,jobs)",
    body_is_list=True,
))
GREENHOUSE = register(BoardSource(
    ats="greenhouse",
    posting=schemas.GREENHOUSE_POSTING,
    fields=_greenhouse_fields,
    location=lambda p: _text(p["location"]["name"]),
    url_pattern=r"job-boards\.greenhouse\.io/([a-zA-Z0-9._-]+)",
    url_literal="job-boards.greenhouse.io/",
    host_pattern="greenhouse.io",
    index_prefix="io,greenhouse,job-boards)",
    company_name="company_name",
))
ASHBY = register(BoardSource(
    ats="ashby",
    posting=schemas.ASHBY_POSTING,
    fields=_ashby_fields,
    location=lambda p: _text(p["location"]),
    url_pattern=r"jobs\.ashbyhq\.com/([a-zA-Z0-9%._-]+)",
    url_literal="jobs.ashbyhq.com/",
    host_pattern="ashbyhq.com",
    index_prefix="com,ashbyhq,jobs)",
    empty_is_dead=True,
    keep=lambda p: F.coalesce(p["isListed"], F.lit(True)),
))


def host_patterns() -> dict[str, str]:
    """Host text to board system, in registration order."""
    return {s.host_pattern: s.ats for s in REGISTRY.values()}


# --- payload scan -------------------------------------------------------------------


def with_postings(probes: DataFrame, source: BoardSource) -> DataFrame:
    """Probe rows of one system with `outcome` and `postings` in place of the body.

    outcome: dead (404, or the system's sign for "no such board"), error (any other
    failure, unreadable body) or alive. postings: array of structs, null unless alive.
    The body is parsed once; fields no projection reads never leave the scan.
    """
    schema = T.StructType([T.StructField("jobs", source.postings_type),
                           T.StructField(_CORRUPT, T.StringType())])
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    body = F.col("body")
    first = F.substring(F.ltrim(body, F.lit(" \t\r\n")), 1, 1)
    if source.body_is_list:
        # Wrapping the list gives it the shape of the other systems; an object read as a
        # list would turn into one posting of nulls.
        text = F.when(first == "[", F.concat(F.lit('{"jobs":'), body, F.lit("}")))
        empty = T.StructType([T.StructField(_CORRUPT, T.StringType()),
                              T.StructField("error", T.StringType())])
        gone = (first == "{") & F.from_json(body, empty, options)[_CORRUPT].isNull()
    else:
        text = F.when(first == "{", body)
        gone = F.lit(False)
    parsed = (
        probes.where(F.col("ats") == source.ats)
        .withColumn("_parsed", F.from_json(text, schema, options))
        .withColumn("_gone", gone)
    )
    jobs = F.col("_parsed.jobs")
    unreadable = F.col("_parsed").isNull() | (
        jobs.isNull() & F.col(f"_parsed.{_CORRUPT}").isNotNull())
    status = F.col("status_code")
    dead = (status == 404) | (status.between(200, 299) & F.col("_gone"))
    if source.empty_is_dead:
        dead = dead | (status.between(200, 299) & ~unreadable
                       & (F.coalesce(F.size(jobs), F.lit(0)) == 0))
    outcome = (F.when(dead, DEAD)
               .when(~F.coalesce(status.between(200, 299), F.lit(False)) | unreadable, ERROR)
               .otherwise(ALIVE))
    postings = F.coalesce(jobs, F.array().cast(source.postings_type))
    if source.keep is not None:
        postings = F.filter(postings, source.keep)
    return (
        parsed.withColumn("outcome", outcome)
        .withColumn("postings", F.when(F.col("outcome") == ALIVE, postings))
        .drop("_parsed", "_gone", "body")
    )


def postings_of(boards: DataFrame, outer: bool = False) -> DataFrame:
    """One row per posting with its place in the payload (`pos`); outer: one for a board without.

    Postings without an id are dropped, as they cannot be keyed. Doing so inside the array
    also keeps the optimizer from adding a size filter that would parse each body twice.
    """
    others = [c for c in boards.columns if c != "postings"]
    keyed = F.filter("postings", lambda p: p["id"].isNotNull())
    explode = F.posexplode_outer if outer else F.posexplode
    return boards.select(*others, explode(keyed).alias("pos", "posting"))


def project_jobs(postings: DataFrame, source: BoardSource, now: Column | int) -> DataFrame:
    """Postings (columns slug, posting, and any others) to job rows.

    Other input columns but the posting are kept behind the job columns.
    """
    now = F.lit(now) if isinstance(now, int) else now
    extra = [c for c in postings.columns
             if c not in schemas.JOB_SCHEMA.names and c != "posting"]
    p, slug = F.col("posting"), F.col("slug")
    staged = postings.withColumn("_raw", source.location(p)).withColumn(
        "_loc", parse_location(F.col("_raw")))
    loc = F.col("_loc")
    fields = {
        "job_id": F.concat(F.lit(source.ats + ":"), p["id"]),
        "ats": F.lit(source.ats),
        "company_id": F.concat(F.lit(source.ats + ":"), slug),
        "ats_job_id": p["id"],
        "company_name": p[source.company_name] if source.company_name else F.lit(None),
        "location_raw": F.col("_raw"),
        "city": loc["city"],
        "state": loc["state"],
        "country": loc["country"],
        "now": now,
        **source.fields(p, slug, loc),
    }
    # Two steps, so that title and description are computed once and then reused.
    base = staged.select(*extra, slug.alias("_slug"),
                         *[c.alias(name) for name, c in fields.items()])
    derived = {
        "experience_level": experience_level(F.col("title")),
        "content_hash": content_hash(F.col("title"), F.col("_slug"), F.col("location_raw"),
                                     F.col("description_text")),
    }
    return base.select(
        *[derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
          for f in schemas.JOB_SCHEMA.fields],
        *extra)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All systems' rows in one frame, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
