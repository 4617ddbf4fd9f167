"""Stratified head-and-tail sample and paged search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def head_tail_sample(counts: DataFrame, size: int = 50, seed: int = 0) -> DataFrame:
    """Up to size rows of (company_name, job_count): the largest half, then a random half.

    With no more than size companies all are taken. The random half is the smallest
    values of a seeded hash of the name, so a sample can be repeated. One scan and one shuffle:
    each row stands in both orders, and each task passes on the first few of either. All that
    follows sees at most 2 * size + 2 rows.
    """
    half = size // 2
    rank = F.sha2(F.concat_ws("|", F.lit(str(seed)), "company_name"), 256)
    # Wide enough to fill the tail even if all of the head is in it; more than size rows
    # here mean more than size rows in the table.
    most = size + half + 1
    both = counts.select("company_name", "job_count", F.inline(F.array(
        F.struct(F.lit("head").alias("_kind"), (-F.col("job_count")).alias("_key"), F.lit("").alias("_rank")),
        F.struct(F.lit("pool").alias("_kind"), F.lit(0).cast("long").alias("_key"), rank.alias("_rank")))))
    place = F.row_number().over(
        Window.partitionBy("_kind").orderBy("_key", "_rank", "company_name"))
    few = both.withColumn("_n", place).where(F.col("_n") <= most)
    everything = Window.partitionBy(F.lit(0))
    in_head = F.max((F.col("_kind") == "head") & (F.col("_n") <= half)).over(
        Window.partitionBy("company_name"))
    pool = F.count_if(F.col("_kind") == "pool").over(everything)
    marked = few.withColumn("_in_head", in_head).withColumn("_pool", pool)
    head = (F.col("_kind") == "head") & (F.col("_n") <= half)
    tail = (F.col("_kind") == "pool") & ~F.col("_in_head")
    turn = F.row_number().over(Window.partitionBy("_kind", "_in_head").orderBy("_n"))
    wanted = F.when(F.col("_pool") <= size, size - half).otherwise(half)
    return marked.withColumn("_turn", turn).where(head | tail & (F.col("_turn") <= wanted)).select(
        *counts.columns)


def search_page(rows: DataFrame, condition: Column | None = None, *, order: list[str],
                page: int = 1, per_page: int = 250) -> DataFrame:
    """One page of the rows that match; order must be unique for pages to fit together."""
    found = rows if condition is None else rows.where(condition)
    return found.orderBy(*order).offset((page - 1) * per_page).limit(per_page)
