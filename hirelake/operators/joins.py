"""Joins that stay even when a few keys hold much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 1000


def left_join_unique(rows: DataFrame, table: DataFrame, key: str,
                     heavy_keys: int = HEAVY_KEYS) -> DataFrame:
    """rows left join table, where table is unique on key and rows may be skewed on it.

    The heavy_keys most frequent keys of rows are joined with a broadcast of their table
    rows, at most as many; all other rows take the ordinary join, where no key can hold
    more than a heavy_keys-th of them. Rows without a key, however many, stay where they are.
    Costs a count per key, combined on the map side.
    """
    heavy = (rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
             .orderBy(F.col("_n").desc(), key).limit(heavy_keys).select(key))
    marked = rows.join(F.broadcast(heavy.withColumn("_heavy", F.lit(True))), key, "left")
    few = table.join(F.broadcast(heavy), key, "left_semi")
    stays = F.col("_heavy").isNotNull() | F.col(key).isNull()
    apart = marked.where(stays).drop("_heavy").join(F.broadcast(few), key, "left")
    others = marked.where(~stays).drop("_heavy").join(table, key, "left")
    return others.unionByName(apart)
