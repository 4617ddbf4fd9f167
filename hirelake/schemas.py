"""Tables at rest, the normalised job row and the schemas of landed inputs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STR, _INT, _LONG, _DBL, _BOOL = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType())


def _struct(*fields: tuple) -> T.StructType:
    """Fields given as (name, type) or (name, type, nullable)."""
    return T.StructType([T.StructField(*f) for f in fields])


# The row every board projection ends in. `now` becomes first/last_seen_at when merged.
JOB_SCHEMA = _struct(
    ("job_id", _STR, False), ("ats", _STR, False), ("company_id", _STR, False),
    ("ats_job_id", _STR, False), ("title", _STR, False), ("company_name", _STR),
    ("description_text", _STR), ("location_raw", _STR), ("city", _STR), ("state", _STR),
    ("country", _STR), ("is_remote", _INT), ("department", _STR), ("employment_type", _STR),
    ("experience_level", _STR), ("min_salary", _DBL), ("max_salary", _DBL),
    ("apply_url", _STR, False), ("now", _LONG, False), ("content_hash", _STR),
)


@dataclass(frozen=True)
class TableSpec:
    """A table at rest: columns, keys and column defaults."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    defaults: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def conform(self, df: DataFrame) -> DataFrame:
        """Select this table's columns in order: cast, missing ones null, defaults filled in."""
        cols = []
        for f in self.schema.fields:
            c = F.col(f.name) if f.name in df.columns else F.lit(None)
            c = c.cast(f.dataType)
            if f.name in self.defaults:
                c = F.coalesce(c, F.lit(self.defaults[f.name]).cast(f.dataType))
            cols.append(c.alias(f.name))
        return df.select(*cols)


COMPANIES = TableSpec(
    "companies",
    _struct(("company_id", _STR, False), ("slug", _STR, False), ("ats", _STR, False),
            ("name", _STR), ("last_probed_at", _LONG), ("is_dead", _INT)),
    primary_key=("company_id",), unique=(("ats", "slug"),), defaults={"is_dead": 0})

JOBS = TableSpec(
    "jobs",
    T.StructType(
        [f for f in JOB_SCHEMA.fields if f.name not in ("now", "content_hash")]
        + _struct(("first_seen_at", _LONG, False), ("last_seen_at", _LONG, False),
                  ("content_hash", _STR)).fields),
    primary_key=("job_id",), unique=(("ats", "ats_job_id"),), defaults={"is_remote": 0})

# Jobs at rest: when each was last seen and what it is compared by, apart from all the rest.
SEEN = TableSpec(
    "seen",
    _struct(("job_id", _STR, False), ("ats", _STR, False), ("last_seen_at", _LONG, False),
            ("content_hash", _STR), ("text_hash", _STR)),
    primary_key=("job_id",))
JOB_DETAILS = TableSpec(
    "jobs", T.StructType([f for f in JOBS.schema.fields if f.name != "last_seen_at"]),
    primary_key=JOBS.primary_key, unique=JOBS.unique, defaults=JOBS.defaults)

META = TableSpec("meta", _struct(("key", _STR, False), ("value", _STR)), primary_key=("key",))

# Declared for downstream use; no operator reads or writes these three.
CANDIDATES = TableSpec(
    "candidates",
    T.StructType([f for f in JOB_SCHEMA.fields
                  if f.name not in ("company_id", "ats_job_id", "now", "content_hash")]),
    primary_key=("job_id",), defaults={"is_remote": 0})
APPLICATIONS = TableSpec(
    "applications", _struct(("job_id", _STR, False), ("applied_at", _STR, False)),
    primary_key=("job_id",))
EXCLUSIONS = TableSpec(
    "exclusions",
    _struct(("job_id", _STR, False), ("reason", _STR), ("company", _STR), ("title", _STR),
            ("url", _STR), ("excluded_at", _STR, False), ("block_type", _STR)),
    primary_key=("job_id",), defaults={"block_type": "platform"})

TABLES = {t.name: t for t in (COMPANIES, JOBS, META, CANDIDATES, APPLICATIONS, EXCLUSIONS)}

# Landed inputs, in place of network calls.
PROBE_ATTEMPTS = _struct(("ats", _STR), ("slug", _STR), ("attempt", _INT),
                         ("status_code", _INT), ("body", _STR))
POSTINGS = _struct(("company_id", _STR), ("company_name", _STR), ("posting_id", _STR),
                   ("hit_rank", _INT))
REDIRECTS = _struct(("posting_id", _STR), ("final_url", _STR))
EXTERNAL_COUNTS = _struct(("company_name", _STR), ("job_count", _LONG), ("failed", _BOOL))
SLUGS = _struct(("ats", _STR), ("slug", _STR))
SNAPSHOT = _struct(("source", _STR), ("ats", _STR), ("slug", _STR))

# Only the posting fields a projection reads; from_json skips all others.
# Ids are read as strings, so numeric and text ids keep their digits.
LEVER_POSTING = _struct(
    ("id", _STR), ("text", _STR),
    ("categories", _struct(("commitment", _STR), ("department", _STR), ("location", _STR),
                           ("team", _STR))),
    ("country", _STR), ("workplaceType", _STR), ("descriptionPlain", _STR),
    ("additionalPlain", _STR),
    ("lists", T.ArrayType(_struct(("text", _STR), ("content", _STR)))),
    ("salaryRange", _struct(("min", _DBL), ("max", _DBL))),
    ("applyUrl", _STR))

GREENHOUSE_POSTING = _struct(
    ("id", _STR), ("title", _STR), ("company_name", _STR), ("absolute_url", _STR),
    ("content", _STR), ("location", _struct(("name", _STR))),
    ("departments", T.ArrayType(_struct(("name", _STR)))),
    ("offices", T.ArrayType(_struct(("name", _STR)))))

ASHBY_POSTING = _struct(
    ("id", _STR), ("title", _STR), ("location", _STR), ("department", _STR), ("team", _STR),
    ("employmentType", _STR), ("workplaceType", _STR), ("descriptionPlain", _STR),
    ("descriptionHtml", _STR), ("applyUrl", _STR), ("isListed", _BOOL), ("isRemote", _BOOL),
    ("address", _struct(("postalAddress", _struct(
        ("addressLocality", _STR), ("addressRegion", _STR), ("addressCountry", _STR))))),
    ("compensation", _struct(("summaryComponents", T.ArrayType(_struct(
        ("compensationType", _STR), ("minValue", _DBL), ("maxValue", _DBL)))))))
