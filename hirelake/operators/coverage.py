"""Comparing slug sets and job counts between sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.operators.discovery import systems


def membership(a: DataFrame, b: DataFrame) -> DataFrame:
    """(ats, slug, in_a, in_b) over both sets: one shuffle for all set operations."""
    tagged = a.select("ats", "slug", F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select("ats", "slug", F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
    return tagged.groupBy("ats", "slug").agg(
        F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))


def coverage(a: DataFrame, b: DataFrame, names: Iterable[str],
             labels: tuple[str, str] = ("cc", "simplify")) -> DataFrame:
    """Set sizes per system, all systems listed; no rows if both sets are empty."""
    la, lb = labels
    in_a, in_b = F.col("in_a") == 1, F.col("in_b") == 1
    measures = {la: in_a, lb: in_b, f"{la}_only": in_a & ~in_b, f"{lb}_only": in_b & ~in_a,
                "both": in_a & in_b, "union": in_a | in_b}
    counts = membership(a, b).groupBy("ats").agg(
        *[F.count_if(m).alias(name) for name, m in measures.items()])
    listed = systems(a, names).join(counts, "ats", "left").na.fill(0, list(measures))
    # One row per system, so the window is as small as the registry.
    largest = F.max("union").over(Window.partitionBy(F.lit(0)))
    return listed.withColumn("_largest", largest).where("_largest > 0").drop("_largest")


def coverage_totals(report: DataFrame, labels: tuple[str, str] = ("cc", "simplify")) -> DataFrame:
    """Sums over all systems."""
    names = [f"{labels[0]}_only", f"{labels[1]}_only", "both"]
    return report.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def coverage_rollup(a: DataFrame, b: DataFrame,
                    labels: tuple[str, str] = ("cc", "simplify")) -> DataFrame:
    """Set sizes per system and over all, told apart by level (0 and 1); ats is null in the total.

    Grouping sets over the memberships: the total comes out of the shuffle that the systems take.
    """
    la, lb = labels
    in_a, in_b = F.col("in_a") == 1, F.col("in_b") == 1
    measures = {la: in_a, lb: in_b, f"{la}_only": in_a & ~in_b, f"{lb}_only": in_b & ~in_a,
                "both": in_a & in_b, "union": in_a | in_b}
    return membership(a, b).rollup("ats").agg(
        F.grouping_id().cast("int").alias("level"),
        *[F.count_if(m).alias(name) for name, m in measures.items()])


def jobs_per_company(jobs: DataFrame) -> DataFrame:
    """(company_name, job_count) of named companies."""
    return (jobs.where(F.col("company_name").isNotNull())
            .groupBy("company_name").agg(F.count("*").alias("job_count")))


def by_count(counts: DataFrame) -> DataFrame:
    """Largest first, by name within a count."""
    return counts.orderBy(F.col("job_count").desc(), "company_name")


def external_counts(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """(company_name, job_count) of the wanted companies in another source's postings.

    Names have to be equal; a company without postings counts 0. Postings are counted before
    they meet the names, so a company that has most of them is one row per map task.
    """
    names = wanted.where(F.col("company_name").isNotNull()).select("company_name").distinct()
    return names.join(jobs_per_company(postings), "company_name", "left").select(
        "company_name", F.coalesce("job_count", F.lit(0)).alias("job_count"))


def compare_counts(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(company, ours, simplify, diff, is_outlier) per company of ours.

    theirs: (company_name, job_count, failed). A company missing there counts 0, a failed
    lookup -1 without a difference. Outliers differ by more than 5 and more than 30 %.
    """
    external = theirs.select("company_name", F.col("job_count").alias("_theirs"), "failed")
    failed = F.coalesce(F.col("failed"), F.lit(False))
    count = F.when(failed, -1).otherwise(F.coalesce("_theirs", F.lit(0))).cast("bigint")
    diff = F.when(~failed, F.col("job_count") - F.coalesce("_theirs", F.lit(0)))
    outlier = F.coalesce(
        F.abs("diff") > F.greatest(F.lit(5.0), F.col("ours") * 0.3), F.lit(False))
    return (
        ours.join(external, "company_name", "left")
        .select(F.col("company_name").alias("company"), F.col("job_count").alias("ours"),
                count.alias("simplify"), diff.alias("diff"))
        .withColumn("is_outlier", outlier.cast("int")))


def comparison_summary(comparison: DataFrame) -> DataFrame:
    """One row: sampled, valid, avg_diff, more, less, equal."""
    diff = F.col("diff")
    return comparison.agg(
        F.count("*").alias("sampled"), F.count("diff").alias("valid"),
        F.avg("diff").alias("avg_diff"), F.count_if(diff > 0).alias("more"),
        F.count_if(diff < 0).alias("less"), F.count_if(diff == 0).alias("equal"))
