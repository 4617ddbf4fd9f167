"""Slug sets: cleaning, merging, and slugs behind aggregator redirects."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.slugs import (
    is_valid_slug, match_domain, match_host, redirect_targets, url_parts)
from hirelake.operators.joins import left_join_unique


def systems(like: DataFrame, names: Iterable[str]) -> DataFrame:
    """One row per board system, for reports that list all of them."""
    return like.sparkSession.createDataFrame([(n,) for n in sorted(names)], "ats string")


def clean_slugs(slugs: DataFrame) -> DataFrame:
    """Rows with a valid slug."""
    return slugs.where(is_valid_slug(F.col("slug")))


def cleaning_report(slugs: DataFrame, names: Iterable[str]) -> DataFrame:
    """(ats, removed, remaining) over distinct slugs, all systems listed."""
    valid = is_valid_slug(F.col("slug"))
    counts = slugs.select("ats", "slug").distinct().groupBy("ats").agg(
        F.count_if(~valid).alias("removed"), F.count_if(valid).alias("remaining"))
    return (systems(slugs, names).join(counts, "ats", "left")
            .na.fill(0, ["removed", "remaining"]))


def merge_slugs(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Distinct (ats, slug, is_new) of the existing slugs and the valid found ones.

    Existing slugs are not cleaned again. One tagged union and one aggregate stand for
    union, difference and both counts.
    """
    tagged = existing.select("ats", "slug", F.lit(0).alias("is_new")).unionByName(
        clean_slugs(found).select("ats", "slug", F.lit(1).alias("is_new")))
    return tagged.groupBy("ats", "slug").agg(F.min("is_new").alias("is_new"))


def merge_counts(merged: DataFrame) -> DataFrame:
    """(ats, new_count, total) of merge_slugs' result."""
    return merged.groupBy("ats").agg(
        F.sum("is_new").alias("new_count"), F.count("*").alias("total"))


def slug_counts(snapshot: DataFrame) -> DataFrame:
    """Distinct slugs per source and system."""
    return snapshot.select("source", "ats", "slug").distinct().groupBy("source", "ats").agg(
        F.count("*").alias("slugs"))


def slug_counts_rollup(snapshot: DataFrame) -> DataFrame:
    """Distinct slugs per source and system, per source, and over all: level 0, 1 and 3.

    A slug that several sources have counts in each of them, and in the total as often.
    """
    return snapshot.select("source", "ats", "slug").distinct().rollup("source", "ats").agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("slugs"))


GRAM = 4


def _grams(text: Column, size: int) -> Column:
    """All distinct stretches of that length."""
    last = F.length(text) - size
    return F.array_distinct(F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i + 1, F.lit(size)))).otherwise(F.array()))


def match_hosts(hosts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(host, rank, pattern) of the distinct hosts that contain a pattern: the first one by rank.

    patterns(rank, pattern) is a table of any size. A pattern is looked up by one of its stretches
    of GRAM characters, the one that fewest patterns have; hosts are cut into theirs. So the join
    is one by equality, and `contains` is tested on what it finds. A pattern shorter than that is
    its own stretch, and hosts are cut into such sizes only if a pattern has them.
    """
    distinct = hosts.where(F.col("host").isNotNull()).select("host").distinct()
    known = patterns.where(F.length("pattern") > 0).groupBy("pattern").agg(F.min("rank").alias("rank"))
    known = known.withColumn("size", F.least(F.length("pattern"), F.lit(GRAM)))
    sizes = [r.size for r in known.select("size").distinct().collect()]  # 1 to GRAM
    if not sizes:
        return distinct.select("host", F.lit(None).cast("long").alias("rank"),
                               F.lit(None).cast("string").alias("pattern")).where("false")

    def cut(text: Column) -> Column:
        return F.flatten(F.array(*[_grams(text, n) for n in sorted(sizes)]))

    grams = known.select("pattern", "rank", F.explode(cut(F.col("pattern"))).alias("gram"), "size")
    grams = grams.where(F.length("gram") == F.col("size"))
    common = grams.groupBy("gram").agg(F.count("*").alias("n"))
    keyed = grams.join(common, "gram").groupBy("pattern", "rank").agg(
        F.min(F.struct("n", "gram")).getField("gram").alias("gram"))
    found = distinct.select("host", F.explode(cut(F.col("host"))).alias("gram")).join(keyed, "gram")
    first = found.where(F.col("host").contains(F.col("pattern"))).groupBy("host").agg(
        F.min(F.struct("rank", "pattern")).alias("first"))
    return first.select("host", "first.rank", "first.pattern")


def with_first_pattern(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """rows(host, ...) with rank and pattern of the first pattern in their host, else null.

    A host may hold any share of the rows: only distinct hosts meet the patterns, and rows of
    frequent hosts, or of none, are not shuffled.
    """
    return left_join_unique(rows, match_hosts(rows, patterns), "host").select(
        *rows.columns, "rank", "pattern")


def first_hits(postings: DataFrame, key: str, order: Iterable[str]) -> DataFrame:
    """First row per key in the given order (all other columns break ties).

    An aggregate, not a window: each map task passes on one row per key.
    """
    order = list(order)
    rest = [c for c in postings.columns if c not in (key, *order)]
    first = postings.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(key, "_first.*").select(*postings.columns)


def resolve_redirects(postings: DataFrame, redirects: DataFrame, patterns: Mapping[str, str],
                      exact_domain: bool = False) -> DataFrame:
    """Distinct (ats, slug) of the postings' landed final URLs; unusable ones are dropped.

    URLs are read before the join, so that only usable ones are shuffled, once per
    posting and target however many copies were landed.
    """
    targets = (
        redirects.select("posting_id", F.inline(
            redirect_targets(F.col("final_url"), patterns, exact_domain)))
        .select("posting_id", "ats", "slug").distinct())
    wanted = postings.select("posting_id").distinct()
    return targets.join(wanted, "posting_id", "left_semi").select("ats", "slug").distinct()


def redirect_failures(postings: DataFrame, redirects: DataFrame, patterns: Mapping[str, str],
                      exact_domain: bool = False) -> DataFrame:
    """(reason, postings): why postings gave no slug, or that they gave one.

    resolved; no_redirect: none was landed; no_board: it leads to no known system; bad_slug: to
    one, but not to a board that can be named. The best of a posting's redirects counts.
    """
    url = F.col("final_url")
    targets = F.size(redirect_targets(url, patterns, exact_domain)) > 0
    host = url_parts(url)["host"]
    known = (match_domain if exact_domain else match_host)(host, patterns).isNotNull()
    level = F.when(targets, 3).when(known, 2).when(url.isNotNull(), 1).otherwise(0)
    best = redirects.groupBy("posting_id").agg(F.max(level).alias("level"))
    reasons = F.create_map(*[F.lit(x) for x in (0, "no_redirect", 1, "no_board", 2, "bad_slug", 3, "resolved")])
    return (postings.select("posting_id").distinct().join(best, "posting_id", "left")
            .groupBy(reasons[F.coalesce("level", F.lit(0))].alias("reason"))
            .agg(F.count("*").alias("postings")))
