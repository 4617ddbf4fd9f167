"""The URL index of a web crawl: block index lines and index records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.slugs import is_valid_slug, slug_in_line
from hirelake.sources.boards import REGISTRY, BoardSource


def read_block_index(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of a block index: `key timestamp<TAB>shard<TAB>offset<TAB>length<TAB>seq`."""
    lines = spark.read.text(paths).select(F.col("value").alias("line"))
    return parse_block_lines(lines)


def parse_block_lines(lines: DataFrame) -> DataFrame:
    """(line, fields, shard, offset, length); the last three are null in short lines."""
    parts = F.split("line", "\t", -1)
    return lines.select(
        "line", F.size(parts).alias("fields"), F.get(parts, F.lit(1)).alias("shard"),
        F.get(parts, F.lit(2)).try_cast("bigint").alias("offset"),
        F.get(parts, F.lit(3)).try_cast("bigint").alias("length"))


def read_index_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Index records, one per line, of landed gzip blocks; a damaged block fails the job."""
    return (spark.read.options(lineSep="\n", ignoreCorruptFiles="false").text(paths)
            .select(F.col("value").alias("line")))


def not_gzip(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path) of landed blocks that are not gzip at all, to be left out of the paths read.

    Blocks are a few hundred KB each; only their first two bytes leave the scan.
    """
    files = spark.read.format("binaryFile").load(paths)
    return files.where(F.hex(F.substring("content", 1, 2)) != "1F8B").select("path")


def in_blocks(records: DataFrame, blocks: DataFrame) -> DataFrame:
    """The landed records(shard, offset, ...) that lie in one of the blocks(shard, offset).

    Where records are partitioned by shard, only folders of shards with such a block are listed and
    read: an index has some hundreds of shards, so their names are a plain filter of the scan.
    """
    wanted = blocks.select("shard", "offset").distinct()
    shards = [r.shard for r in wanted.select("shard").distinct().collect()]
    near = records.where(F.col("shard").isin(shards))
    return near.join(wanted, ["shard", "offset"], "left_semi")


def slugs_in_records(records: DataFrame,
                     sources: Sequence[BoardSource] | None = None) -> DataFrame:
    """Distinct (ats, slug) found in index records, all systems in one pass.

    Plain substring tests sort out lines without a board URL before any pattern runs, unless
    a source names no such text.
    """
    sources = list(REGISTRY.values() if sources is None else sources)
    line = F.col("line")
    maybe = [line.contains(s.url_literal) if s.url_literal else F.lit(True) for s in sources]
    hits = F.array(*[
        F.struct(F.lit(s.ats).alias("ats"), slug_in_line(line, s.url_pattern).alias("slug"))
        for s in sources])
    return (
        records.where(reduce(or_, maybe))
        .select(F.inline(F.filter(hits, lambda h: is_valid_slug(h["slug"]))))
        .distinct()
    )
