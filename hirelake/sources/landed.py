"""Tables that collectors land in place of network calls, read with fixed schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from hirelake import schemas

# probe_attempts is best partitioned by ats: each system then reads its own folder only.
LANDED = {
    "probe_attempts": schemas.PROBE_ATTEMPTS,
    "postings": schemas.POSTINGS,
    "redirects": schemas.REDIRECTS,
    "external_counts": schemas.EXTERNAL_COUNTS,
}


def read_landed(spark: SparkSession, kind: str, paths: str | Sequence[str],
                file_format: str = "parquet", **options: str) -> DataFrame:
    """A landed table (parquet, ORC, JSON lines, CSV, ...); absent columns are null."""
    schema = LANDED[kind]
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.schema(schema).options(**options).format(file_format).load(paths)
            .select(*schema.names))
