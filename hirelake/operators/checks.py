"""Key and null checks of a state table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.schemas import TableSpec


def check_constraints(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(table, rule, columns, violations): one row per declared constraint.

    Keys: rows in excess of one per key value (nulls are not compared). Not-null columns:
    null rows. Only the columns a rule names are read.
    """
    keys = [("primary key", spec.primary_key), *[("unique", u) for u in spec.unique]]
    checks = []
    for rule, cols in keys:
        present = reduce(and_, [F.col(c).isNotNull() for c in cols])
        per_key = df.where(present).groupBy(*cols).agg(F.count("*").alias("n"))
        checks.append(per_key.agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")
        ).select(F.lit(rule).alias("rule"), F.lit(",".join(cols)).alias("columns"), "violations"))
    required = [f.name for f in spec.schema.fields if not f.nullable]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    checks.append(nulls.unpivot([], required, "columns", "violations").select(
        F.lit("not null").alias("rule"), "columns", "violations"))
    found = reduce(lambda a, b: a.unionByName(b), checks)
    return found.select(F.lit(spec.name).alias("table"), "rule", "columns", "violations")
