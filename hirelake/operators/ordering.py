"""Work that needs a total order without one task that holds it: previous rows and pages.

Rows are range-partitioned and written once, with the number of their partition and their place in
it. What is needed across partitions is one row for each of them.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.session import materialize


def _sorted_parts(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """rows with _part, its range partition, and _at, the place in it; written once, by part."""
    number = F.monotonically_increasing_id()  # partition << 33, plus the row's place
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", number)
    return materialize(
        dealt.withColumn("_part", F.shiftright("_id", 33).cast("int"))
        .withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id"),
        label, ("_part",))


def previous_rows(rows: DataFrame, key: str, name: str = "previous") -> DataFrame:
    """rows with the key of the row before in ascending order, null for the first.

    The form of lag over the whole table: within a partition a window by partition, and for the
    first row of each the last key of the partition before, one value a partition.
    """
    parts = _sorted_parts(rows, [key], "ordered")
    ends = parts.groupBy("_part").agg(F.max_by(key, "_at").alias("last")).orderBy("_part").collect()
    bounds = [(b._part, a["last"]) for a, b in zip(ends, ends[1:])]
    field = next(f for f in rows.schema.fields if f.name == key)
    edge = rows.sparkSession.createDataFrame(
        bounds, f"_part int, _edge {field.dataType.simpleString()}")
    own = Window.partitionBy("_part").orderBy("_at")
    joined = parts.join(F.broadcast(edge), "_part", "left")  # one row a partition
    before = F.when(F.col("_at") == 0, F.col("_edge")).otherwise(F.lag(key).over(own))
    return joined.withColumn(name, before).select(*rows.columns, name)


@dataclass(frozen=True)
class PageDirectory:
    """Rows in order, cut into files by range, with the number of rows before each."""
    rows: DataFrame         # with _part and _at
    columns: tuple[str, ...]
    order: tuple[str, ...]
    starts: tuple[int, ...]  # rows before each part, and at the end of all of them
    parts: tuple[int, ...]
    last: tuple              # the last key of each part

    @classmethod
    def of(cls, rows: DataFrame, order: list[str]) -> PageDirectory:
        """Sort once. order must be unique and without nulls for pages to fit together."""
        parts = _sorted_parts(rows, order, "pages")
        ends = parts.groupBy("_part").agg(
            F.count("*").alias("n"), F.max_by(F.struct(*order), "_at").alias("last")
        ).orderBy("_part").collect()
        return cls(parts, tuple(rows.columns), tuple(order),
                   (0, *accumulate(e.n for e in ends)), tuple(e._part for e in ends),
                   tuple(tuple(e["last"]) for e in ends))

    @property
    def total(self) -> int:
        return self.starts[-1]

    def _within(self, first: int, stop: int) -> DataFrame:
        """Rows from place first up to stop; only the files of their parts are read."""
        some = [i for i in range(len(self.parts)) if self.starts[i] < stop and self.starts[i + 1] > first]
        if not some:
            return self.rows.where("false").select(*self.columns)
        held = self.rows.where(F.col("_part").isin([self.parts[i] for i in some]))
        near = [(F.col("_part") == self.parts[i]) & (F.col("_at") >= first - self.starts[i])
                & (F.col("_at") < stop - self.starts[i]) for i in some]
        wanted = near[0]
        for condition in near[1:]:
            wanted = wanted | condition
        return held.where(wanted).orderBy(*self.order).select(*self.columns)

    def page(self, number: int, per_page: int = 250) -> DataFrame:
        """Page 1, 2, ...; any of them costs the same."""
        return self._within((number - 1) * per_page, number * per_page)

    def after(self, key: tuple, per_page: int = 250) -> DataFrame:
        """The rows that follow a key, in place of a page number."""
        at = bisect_right(self.last, tuple(key))
        if at == len(self.parts):
            return self.rows.where("false").select(*self.columns)
        types = {f.name: f.dataType for f in self.rows.schema.fields}
        # struct fields compare one after the other, as the order does
        beyond = F.struct(*self.order) > F.struct(
            *[F.lit(v).cast(types[c]).alias(c) for c, v in zip(self.order, key)])
        # Whole parts of per_page rows at least, beyond the one that holds the key.
        stop = next((i for i in range(at + 1, len(self.parts))
                     if self.starts[i] - self.starts[at + 1] >= per_page), len(self.parts))
        held = self.rows.where(F.col("_part").isin(list(self.parts[at:stop])) & beyond)
        return held.orderBy(*self.order).limit(per_page).select(*self.columns)
