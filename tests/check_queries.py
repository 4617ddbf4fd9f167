"""Compare registered queries with their SQL: python tests/check_queries.py [sf_dir] [name ...]"""

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402


def connect(folder):
    con = duckdb.connect()
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, name, query, sql):
    """None if equal, else a description of the difference."""
    df = query(spark, folder)
    got = table_of(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = table_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == expected:
        return None if got else "empty result"
    only_got = [r for r in got if r not in set(expected)][:3]
    only_sql = [r for r in expected if r not in set(got)][:3]
    return f"{len(got)} vs {len(expected)} rows\n  spark: {only_got}\n  sql:   {only_sql}"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master(f"local[{os.cpu_count()}]")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, entry.queries()[name], entry.oracle_sql()[name])
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s", problem or "", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
