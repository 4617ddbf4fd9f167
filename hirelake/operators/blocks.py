"""Which blocks of a sorted index hold keys with a given prefix."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def find_blocks(index: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """(prefix, shard, offset, length, first_line) of the blocks that may hold a prefix.

    index: (line, fields, shard, offset, length), where line is the block's last key. A
    block matches if its line starts with the prefix, or if it is the first line from the
    prefix on and some line lies before it. The second kind is the minimum over the lines
    at or above the prefix, a plain aggregate; looking at the previous line by window
    would move the whole index into one task.
    """
    line = F.col("line")
    row = F.struct("line", "fields", "shard", "offset", "length")
    # prefixes is a short list of parameters: one aggregate column each, one pass for all.
    edges = index.agg(F.array(*[
        F.struct(F.lit(p).alias("prefix"),
                 F.min(F.when(line >= p, row)).alias("block"),
                 F.coalesce(F.bool_or(line < p), F.lit(False)).alias("preceded"))
        for p in prefixes]).alias("edges"))
    edge = edges.select(F.explode("edges").alias("e")).where("e.preceded").select(
        "e.prefix", "e.block.*")
    inside = (
        index.where(reduce(or_, [line.startswith(p) for p in prefixes]))
        .select(F.explode(F.array(*[
            F.when(line.startswith(p), F.lit(p)) for p in prefixes])).alias("prefix"), "*")
        .where(F.col("prefix").isNotNull())
        .select("prefix", "line", "fields", "shard", "offset", "length"))
    hits = inside.unionByName(edge).where(
        (F.col("fields") >= 4) & F.col("offset").isNotNull() & F.col("length").isNotNull())
    return (hits.groupBy("prefix", "shard", "offset")
            .agg(F.min(F.struct("line", "length")).alias("first"))
            .select("prefix", "shard", "offset", "first.length",
                    F.col("first.line").alias("first_line")))
