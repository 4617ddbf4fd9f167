"""Slug lists (one slug per line) and discovery snapshots (slugs per source and system)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.text import strip

# Line ends beyond \r and \n, which the text source splits on itself.
_OTHER_LINE_ENDS = "[\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def _read_text(spark: SparkSession, path: str, glob: str,
               whole_files: bool = False) -> DataFrame | None:
    """Text files below path, None if there is no such path."""
    try:
        return (spark.read.options(recursiveFileLookup="true", pathGlobFilter=glob)
                .text(path, wholetext=whole_files))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_slug_lists(spark: SparkSession, path: str) -> DataFrame:
    """(ats, slug) from `{ats}.txt` files or `ats={ats}/` folders; empty if path is missing.

    Lines are trimmed; blank ones and those that start with '#' are dropped.
    """
    lines = _read_text(spark, path, "*.txt")
    if lines is None:
        return spark.createDataFrame([], schemas.SLUGS)
    file = F.col("_metadata.file_path")
    ats = F.coalesce(F.nullif(F.regexp_extract(file, "/ats=([^/]+)/", 1), F.lit("")),
                     F.regexp_extract(file, "([^/]+)\\.txt$", 1))
    return (
        lines.select(ats.alias("ats"),
                     F.explode(F.split("value", _OTHER_LINE_ENDS, -1)).alias("line"))
        .where(~F.col("line").startswith("#"))
        .select("ats", strip(F.col("line")).alias("slug"))
        .where(F.col("slug") != "")
        .distinct()
    )


def write_slug_lists(slugs: DataFrame, path: str) -> None:
    """(ats, slug) as text, one folder per system, ascending from file to file.

    Range partitioning keeps each system's list in order without one task holding it all.
    """
    (slugs.select("ats", "slug").distinct()
     .repartitionByRange("ats", "slug")
     .sortWithinPartitions("ats", "slug")
     .write.mode("overwrite").partitionBy("ats").text(path))


def write_slug_table(slugs: DataFrame, path: str) -> None:
    """(ats, slug) as parquet by system; only the systems present are replaced."""
    (slugs.select("ats", "slug").distinct()
     .repartitionByRange("ats", "slug")
     .sortWithinPartitions("ats", "slug")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ats").parquet(path))


# --- snapshots ----------------------------------------------------------------------


def write_snapshot(slugs: DataFrame, source: str, path: str) -> None:
    """Replace the slugs of one discovery source; systems not in `slugs` stay as they were."""
    (slugs.select(F.lit(source).alias("source"), "ats", "slug").distinct()
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source", "ats").parquet(path))


def read_snapshot(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """(source, ats, slug) of the snapshot table; empty if nothing was written yet."""
    try:
        table = spark.read.schema(schemas.SNAPSHOT).parquet(path).select(*schemas.SNAPSHOT.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], schemas.SNAPSHOT)
    return table if source is None else table.where(F.col("source") == source)


def write_snapshot_json(snapshot: DataFrame, path: str, per_line: int = 10_000) -> None:
    """(source, ats, slug) as JSON lines `{ats: [slug, ...]}`, one folder per source.

    A list is cut into lines of about per_line slugs each, so that no row ever holds a
    whole system; readers take the union of the lines.
    """
    slugs = snapshot.select("source", "ats", "slug").distinct()
    sizes = slugs.groupBy("source", "ats").agg(
        F.ceil(F.count("*") / per_line).cast("int").alias("lines"))
    (slugs.join(sizes, ["source", "ats"])  # a handful of rows; broadcast by measured size
     .groupBy("source", "ats", F.pmod(F.xxhash64("slug"), F.col("lines")).alias("line"))
     .agg(F.sort_array(F.collect_list("slug")).alias("slugs"))
     .select("source", F.to_json(F.create_map("ats", "slugs")).alias("value"))
     .write.mode("overwrite").partitionBy("source").text(path))


def read_snapshot_json(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """(source, ats, slug) from JSON maps; empty if path is missing.

    Reads the folders of write_snapshot_json or, with whole_files, `{source}_latest.json`
    files that hold one (possibly indented) document each.
    """
    glob = "*_latest.json" if whole_files else "*.txt"
    text = _read_text(spark, path, glob, whole_files)
    if text is None:
        return spark.createDataFrame([], schemas.SNAPSHOT)
    file = F.col("_metadata.file_path")
    source = F.regexp_extract(
        file, "([^/]+)_latest\\.json$" if whole_files else "/source=([^/]+)/", 1)
    per_ats = text.select(
        source.alias("source"),
        F.explode(F.from_json("value", "map<string,array<string>>")).alias("ats", "slugs"))
    return per_ats.select("source", "ats", F.explode("slugs").alias("slug")).distinct()
