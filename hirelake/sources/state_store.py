"""State tables kept as immutable parts, versions that name them, and a commit log.

A table is cut into parts: jobs by system and by bucket of the job id, companies by system. A run
writes the parts it changes below its own version and then a manifest: for each part the version
whose files hold it. Parts that a run leaves alone are carried over by name, so their files are
neither read nor written. The manifest is the entry of the commit log, one file a run; a run that dies
half-way leaves files that no manifest names, and its retry overwrites them. Nothing is
ever written to a path that is being read. One writer at a time.

Jobs are split in two: when a job was last seen, with the hashes it is compared by (SEEN), and all
the rest (JOB_DETAILS). A job that is merely seen again changes the first only, which is narrow;
reading JOBS joins both.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from hirelake.operators.checks import check_constraints
from hirelake.schemas import COMPANIES, JOB_DETAILS, JOBS, SEEN, TableSpec

_LOG = "version long, stream string, batch long, probed_at long"
_MANIFEST = f"{_LOG}, name string, part string, held long"
_PARTED = {JOB_DETAILS.name: ("ats", "bucket"), SEEN.name: ("ats", "bucket"), COMPANIES.name: ("ats",)}


class ConstraintError(ValueError):
    """A version that breaks a declared constraint; it is not committed."""


def seen_of(jobs: DataFrame) -> DataFrame:
    """The narrow side of job rows."""
    return jobs.select("job_id", "ats", "last_seen_at", "content_hash",
                       F.sha2("description_text", 256).alias("text_hash"))


def part_name(ats: str, bucket: int | None = None) -> str:
    return f"ats={ats}" if bucket is None else f"ats={ats}/bucket={bucket}"


@dataclass(frozen=True)
class StateStore:
    spark: SparkSession
    root: str
    # Parts of a system's jobs. Spark deals job ids out by the same hash, so that with a multiple
    # of it as the number of shuffle partitions each task writes one part.
    buckets: int = 4
    # Manifests by version: of versions being written, and of committed ones once they were read.
    _pending: dict = field(default_factory=dict, compare=False, repr=False)
    _known: dict = field(default_factory=dict, compare=False, repr=False)

    def bucket(self) -> Column:
        return F.pmod(F.hash("job_id"), F.lit(self.buckets)).alias("bucket")

    def latest(self) -> int | None:
        """Number of the last committed version."""
        try:
            log = self.spark.read.schema("version long").parquet(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return log.agg(F.max("version")).first()[0]

    # --- manifests ---

    def _entry(self, version: int) -> str:
        return f"{self.root}/commits/run={version:012d}"

    def _committed(self, version: int) -> dict[str, dict[str, int]]:
        """A committed manifest; it never changes."""
        if version not in self._known:
            found: dict[str, dict[str, int]] = {}
            for r in self.spark.read.schema(_MANIFEST).parquet(self._entry(version)).collect():
                found.setdefault(r.name, {})[r.part] = r.held
            self._known[version] = found
        return self._known[version]

    def parts(self, table: TableSpec, version: int | None) -> dict[str, int]:
        """The parts of a table in a version, each with the version that wrote it.

        As many as there are systems and buckets, whatever the number of rows.
        """
        if version is None:
            return {}
        return (self._pending.get(version) or self._committed(version)).get(table.name, {})

    def _data(self, table: TableSpec, version: int) -> str:
        return f"{self.root}/data/{table.name}/version={version:012d}"

    def _partition_ddl(self, table: TableSpec) -> str:
        names = _PARTED.get(table.name, ())
        return ", ".join(f"{n} {'int' if n == 'bucket' else 'string'}" for n in names)

    # --- reading ---

    def read(self, table: TableSpec, version: int | None = None) -> DataFrame:
        """A table of a version (the latest by default); empty before the first commit."""
        version = self.latest() if version is None else version
        if table.name == JOBS.name and table is not JOB_DETAILS:
            seen = self.read(SEEN, version).select("ats", "job_id", "last_seen_at")
            return self.read(JOB_DETAILS, version).join(seen, ["ats", "job_id"]).select(*table.columns)
        return self.read_parts(table, self.parts(table, version))

    def read_parts(self, table: TableSpec, parts: dict[str, int]) -> DataFrame:
        """The rows of some parts; no file of another one is looked at."""
        if not parts:
            return self.spark.createDataFrame([], table.schema)
        schema = T.StructType([*table.schema.fields, T.StructField("version", T.LongType())])
        if "bucket" in _PARTED.get(table.name, ()):
            schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        paths = [f"{self._data(table, v)}/{p}".rstrip("/") for p, v in sorted(parts.items())]
        df = (self.spark.read.schema(schema).option("basePath", f"{self.root}/data/{table.name}")
              .parquet(*paths))
        return df.select(*table.columns)

    # --- writing ---

    def write(self, df: DataFrame, table: TableSpec, version: int, *, base: int | None = None,
              replaced: Collection[str] | None = None, filled: Collection[str] | None = None) -> None:
        """Write a table of a version that is not committed yet.

        With `replaced`, df has the rows of those parts (of new ones too) and all other parts are
        carried over from version `base`; without, df is the whole table. filled names the parts
        that df has rows for, where that is known.
        """
        if table.name == JOBS.name and table is not JOB_DETAILS:
            jobs = JOBS.conform(df)
            for side, rows in ((SEEN, seen_of(jobs)), (JOB_DETAILS, jobs)):
                self.write(rows, side, version, base=base, replaced=replaced, filled=filled)
            return
        names = _PARTED.get(table.name, ())
        folder = self._data(table, version)
        rows = df.select(*table.columns, *([self.bucket()] if "bucket" in names else []))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .option("compression", "zstd").partitionBy(*names).parquet(folder))
        written = self._written(table, folder) if filled is None else filled
        self._note(table, version, base, replaced, written)

    def carry(self, table: TableSpec, version: int, base: int | None) -> None:
        """Take a table over from version base as it is."""
        self._note(table, version, base, (), ())

    def _written(self, table: TableSpec, folder: str) -> set[str]:
        names = _PARTED.get(table.name, ())
        if not names:
            return {""}
        found = self.spark.read.schema(self._partition_ddl(table)).parquet(folder).distinct().collect()
        return {part_name(*r) for r in found}

    def _note(self, table: TableSpec, version: int, base: int | None,
              replaced: Collection[str] | None, written: Collection[str]) -> None:
        carried = {} if replaced is None else self.parts(table, base)
        named = {p: v for p, v in carried.items() if p not in (replaced or ())}
        self._pending.setdefault(version, {})[table.name] = named | dict.fromkeys(written, version)

    def violations(self, table: TableSpec, version: int) -> DataFrame:
        """(table, rule, columns, violations) above zero in the parts that a version wrote.

        A job id has one bucket, so its copies are in one part; the other unique keys of the rows
        written are compared with all rows, by those columns alone.
        """
        parts = self.parts(table, version)
        fresh = self.read_parts(table, {p: v for p, v in parts.items() if v == version})
        every = self.read_parts(table, parts)
        own = check_constraints(fresh, TableSpec(table.name, table.schema, table.primary_key))
        found = [own]
        for columns in table.unique:
            present = reduce(and_, [F.col(c).isNotNull() for c in columns])
            keys = fresh.where(present).select(*columns).distinct()
            again = every.select(*columns).join(keys, list(columns), "left_semi")
            found.append(again.groupBy(*columns).agg(F.count("*").alias("n")).agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(
                F.lit(table.name).alias("table"), F.lit("unique").alias("rule"),
                F.lit(",".join(columns)).alias("columns"), "violations"))
        return reduce(DataFrame.unionByName, found).where("violations > 0")

    # --- commits ---

    def has(self, stream: str, batch: int, run: int) -> bool:
        """Whether a run of a stream's batch is committed."""
        if self.latest() is None:
            return False
        log = self.spark.read.schema(_LOG).parquet(f"{self.root}/commits")
        return not log.where((F.col("stream") == stream) & (F.col("batch") == batch)
                             & (F.col("probed_at") == run)).isEmpty()

    def commit(self, version: int, stream: str | None = None, batch: int | None = None,
               run: int | None = None, verify: Collection[TableSpec] = ()) -> None:
        """Make a fully written version the latest one; a stream says which batch and run it was.

        The tables to verify must keep their constraints, or nothing is committed.
        """
        if verify:
            checks = reduce(DataFrame.unionByName, [self.violations(t, version) for t in verify])
            broken = checks.orderBy("table", "rule", "columns").collect()
            if broken:
                raise ConstraintError("; ".join(
                    f"{r['table']}: {r.violations} rows against {r.rule} ({r.columns})" for r in broken))
        manifest = self._pending.pop(version, {})
        run_of = (version, stream, batch, run)
        lines = [(*run_of, name, part, v) for name, own in manifest.items() for part, v in own.items()]
        (self.spark.createDataFrame(lines or [(*run_of, None, None, None)], _MANIFEST).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(self._entry(version)))
        self._known[version] = manifest
