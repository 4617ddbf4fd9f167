"""Probe outcomes over retries, and what a run's outcomes mean for each company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import non_empty
from hirelake.sources.boards import ALIVE, DEAD, ERROR

MAX_ATTEMPTS = 3


def collapse_attempts(attempts: DataFrame, *carried: str, max_attempts: int = MAX_ATTEMPTS,
                      tie: Column | None = None) -> DataFrame:
    """One row per (ats, slug): the first attempt that did not fail, else outcome 'error'.

    attempts: ats, slug, attempt (0-based), outcome and the carried columns. Repeated
    attempt numbers are settled by outcome, then by tie (the hash of the carried values). The
    minimum is taken on the map side first, so a company with very many rows costs one
    row per map task.
    """
    answered = F.col("outcome") != ERROR
    if tie is None:
        tie = F.xxhash64(*carried) if carried else F.lit(0)
    # min_by passes over rows whose order is null.
    first = F.min_by(F.when(answered, F.struct("outcome", *carried)),
                     F.when(answered, F.struct("attempt", "outcome", tie)))
    won = (attempts.where(F.col("attempt") < max_attempts)
           .groupBy("ats", "slug").agg(first.alias("won")))
    return won.select(
        "ats", "slug", F.coalesce("won.outcome", F.lit(ERROR)).alias("outcome"),
        *[F.col(f"won.{c}").alias(c) for c in carried])


def first_name(names: Column) -> Column:
    """First non-empty entry of an array of names."""
    return F.get(F.filter(names, lambda n: non_empty(n).isNotNull()), F.lit(0))


def first_names(jobs: DataFrame, key: str = "company_id", name: str = "company_name",
                pos: str = "pos") -> DataFrame:
    """First non-empty name per company in payload order, for rows already unnested.

    Companies without any name are kept with a null one.
    """
    named = non_empty(F.col(name)).isNotNull()
    return jobs.groupBy(key).agg(
        F.min(F.when(named, F.struct(F.col(pos), F.col(name)))).getField(name).alias(name))


def resolve_names(companies: DataFrame, stored: DataFrame) -> DataFrame:
    """Fill company_name of (ats, slug, company_name, ...) rows without one.

    A stored company gives its name, even a null one; an unknown company gives its slug.
    Joined on (ats, slug), the key collapse_attempts has partitioned by.
    """
    known = stored.select("ats", "slug", F.col("name").alias("_stored"),
                          F.lit(True).alias("_known"))
    own = non_empty(F.col("company_name"))
    fallback = F.when(F.col("_known"), F.col("_stored")).otherwise(F.col("slug"))
    return (companies.join(known, ["ats", "slug"], "left")
            .withColumn("company_name", F.when(own.isNotNull(), own).otherwise(fallback))
            .drop("_stored", "_known"))


def outcome_stats(outcomes: DataFrame) -> DataFrame:
    """Companies alive, dead and in error, per system."""
    def n(value: str) -> Column:
        return F.count_if(F.col("outcome") == value)

    return outcomes.groupBy("ats").agg(
        n(ALIVE).alias("companies"), n(DEAD).alias("dead"), n(ERROR).alias("errors"))


def outcome_rollup(outcomes: DataFrame) -> DataFrame:
    """The same per system and over all, told apart by level (0 and 1), from one shuffle."""
    def n(value: str) -> Column:
        return F.count_if(F.col("outcome") == value)

    return outcomes.rollup("ats").agg(
        F.grouping_id().cast("int").alias("level"), n(ALIVE).alias("companies"),
        n(DEAD).alias("dead"), n(ERROR).alias("errors"))
