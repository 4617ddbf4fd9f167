"""Seniority and employment type read from short texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import lookup, non_empty

# Fixed values; the first keyword found in the title decides, so the order matters.
EXPERIENCE_KEYWORDS = (
    ("intern", "internship"),
    ("internship", "internship"),
    ("entry", "entry"),
    ("entry level", "entry"),
    ("entry-level", "entry"),
    ("new grad", "entry"),
    ("new college grad", "entry"),
    ("junior", "junior"),
    ("jr.", "junior"),
    ("jr ", "junior"),
    ("mid", "mid"),
    ("mid level", "mid"),
    ("mid-level", "mid"),
    ("senior", "senior"),
    ("sr.", "senior"),
    ("sr ", "senior"),
    ("staff", "senior"),
    ("principal", "senior"),
    ("lead", "senior"),
    ("director", "executive"),
    ("vp ", "executive"),
    ("vice president", "executive"),
    ("head of", "executive"),
)

# Fixed values; keys are looked up as given, then lower-cased.
EMPLOYMENT_TYPES = {
    "full time": "full-time",
    "full-time": "full-time",
    "fulltime": "full-time",
    "part time": "part-time",
    "part-time": "part-time",
    "contract": "contract",
    "contractor": "contract",
    "intern": "internship",
    "internship": "internship",
    "co-op": "internship",
    "FullTime": "full-time",
    "PartTime": "part-time",
    "Intern": "internship",
    "Contract": "contract",
    "Temporary": "contract",
    "permanent": "full-time",
}
DEFAULT_EMPLOYMENT_TYPE = "full-time"


def experience_level(title: Column) -> Column:
    """Level of the first keyword (in table order) that occurs in the title."""
    low = F.lower(title)
    level = F
    for keyword, name in EXPERIENCE_KEYWORDS:
        level = level.when(low.contains(keyword), F.lit(name))
    return level.otherwise(F.lit("unknown"))


def employment_type(raw: Column) -> Column:
    """Unified employment type; anything unknown counts as full-time."""
    raw = non_empty(raw)
    return F.coalesce(lookup(EMPLOYMENT_TYPES, raw), lookup(EMPLOYMENT_TYPES, F.lower(raw)),
                      F.lit(DEFAULT_EMPLOYMENT_TYPE))
