"""Merkle manifest of a table by sibling-shift self-joins.

Rows are leaves; each source is a tree over its leaves by id, and the sources' subroots, by source,
are the leaves of one more tree. At every level each node asks for the places of its siblings (its
place XOR 1 in a binary tree, else the shifts of its slot within the run), an equijoin brings their
digests, and the node of slot zero emits the parent: the hash of the whole run. A node keeps the
digests left and right of it, so that the proof of a leaf is what lies on its way to the root.

Both sides of a level's join are dealt out by run, once; the join, the gathering of at most `arity`
digests and the emission need no further exchange. A level is written to the shared folder and has
1/arity of the rows of the one below. Places come from a range sort: each row's number within its
partition plus the rows of the same source in partitions before, so no source is gathered in a
task, however many rows it holds.

Defined cases: a null field is `-`, an empty one `0:`; null ids come first in their source, rows of
one id by their leaf; rows repeated are leaves of their own; a null source is a source, the first;
an empty table has no rows and no root; columns other than the named ones are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm.common import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16

# A join by (group, run, place) may use rows dealt out by (group, run) alone.
_ANY_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_PATH = "array<struct<before: binary, after: binary>>"


@contextmanager
def _dealt_by_run(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_ANY_KEYS)
    spark.conf.set(_ANY_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ANY_KEYS, before)


def field(column: Column) -> Column:
    """UTF-8 byte count, colon, value; a dash if null."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """The hash of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def lowered(text: Column) -> Column:
    return F.translate(text.cast("string"), string.ascii_uppercase, string.ascii_lowercase)


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def placed(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """rows(group, ...) with idx, the place by the order within the group, and n, its rows."""
    dealt = rows.repartitionByRange("group", *order).sortWithinPartitions("group", *order)
    # The id counts a partition's rows from its number << 33 on.
    held = stage(dealt.withColumn("at", F.monotonically_increasing_id()), label)
    held = held.withColumn("part", F.shiftright("at", 33))
    counts = held.groupBy("group", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("group")
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        "group", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"))
    return held.join(starts, ["group", "part"]).withColumn(
        "idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _run_of(idx: str, arity: int) -> Column:
    return F.expr(f"{idx} div {arity}")


def _places(arity: int) -> Column:
    """A node's own place and those of its siblings; some are beyond the last node."""
    idx = F.col("idx")
    if arity == 2:
        return F.array(idx, idx.bitwiseXOR(F.lit(1).cast("long")))
    slot = idx % arity
    return F.transform(F.sequence(F.lit(0), F.lit(arity - 1)),
                       lambda shift: idx - slot + (slot + shift) % arity)


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda whole, one: F.concat(whole, one.digest))


def _level(nodes: DataFrame, arity: int, carried: Sequence[str]) -> DataFrame:
    """nodes(group, idx, n, digest, carried) with before and after: the digests of their siblings.

    Groups of one node are at their root already and are left out.
    """
    dealt = nodes.where("n > 1").withColumn("run", _run_of("idx", arity)).repartition("group", "run")
    asks = dealt.select("group", "run", "idx", F.explode(_places(arity)).alias("place"))
    has = dealt.select("group", "run", F.col("idx").alias("place"), "digest")
    found = asks.join(has, ["group", "run", "place"]).groupBy("group", "run", "idx").agg(
        F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("own_run"))
    sides = found.select(
        "group", "run", "idx",
        _joined(F.filter("own_run", lambda x: x.place < F.col("idx"))).alias("before"),
        _joined(F.filter("own_run", lambda x: x.place > F.col("idx"))).alias("after"))
    return dealt.select("group", "run", "idx", "n", "digest", *carried).join(
        sides, ["group", "run", "idx"])


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """What the nodes of slot zero emit: (group, idx, n, digest) one level up."""
    whole = F.sha2(F.concat(_text(F.col("digest")), _text(F.col("after"))), 256)
    return level.where(F.col("idx") % arity == 0).select(
        "group", F.col("run").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
        F.unhex(whole).alias("digest"))


def grow(nodes: DataFrame, arity: int, label: str, carried: Sequence[str] = ()
         ) -> tuple[list[DataFrame], DataFrame]:
    """The levels of the trees over nodes(group, idx, n, digest), and their roots (group, digest)."""
    levels, roots = [], nodes.where("n = 1").select("group", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        with _dealt_by_run(nodes.sparkSession):
            level = stage(_level(nodes, arity, () if levels else carried), f"{label}-{len(levels)}")
        levels.append(level)
        nodes = _parents(level, arity)
        roots = roots.unionByName(nodes.where("n = 1").select("group", "digest"))
        most = -(-most // arity)
    return levels, stage(roots, f"{label}-roots")


def paths(levels: Sequence[DataFrame], carried: Sequence[str] = ()) -> DataFrame | None:
    """(group, idx, path, carried) of the lowest level: the siblings from there up to the root."""
    above = None
    for depth in range(len(levels) - 1, -1, -1):
        extra = carried if depth == 0 else ()
        own = F.array(F.struct("before", "after"))
        rows = levels[depth].select("group", "idx", "run", own.alias("path"), *extra)
        if above is not None:
            upper = above.select("group", F.col("idx").alias("run"), F.col("path").alias("rest"))
            rows = rows.join(upper, ["group", "run"], "left").withColumn(
                "path", F.concat("path", F.coalesce("rest", F.array().cast(_PATH))))
        above = rows.select("group", "idx", "path", *extra)
    return above


def merkle_manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id",
                    group_col: str = "source", tampered: dict[str, Column] | None = None,
                    arity: int = ARITY) -> DataFrame:
    """(id, leaf, subroot, root, path, tampered_leaf), one row for each of rows.

    path is the siblings' digests (before, after) at each level from the leaf to the root.
    tampered names columns to be read in place of fields for tampered_leaf, which takes the same
    path; without it that is the leaf itself.
    """
    own = leaf([rows[f] for f in fields])
    other = leaf([(tampered or {}).get(f, rows[f]) for f in fields]) if tampered else own
    group = F.coalesce(F.concat(F.lit("="), rows[group_col].cast("string")), F.lit(""))
    leaves = stage(rows.select(group.alias("group"), rows[id_col].cast("long").alias("id"),
                               own.alias("digest"), other.alias("other")), "leaves")
    leaves = stage(placed(leaves, ["id", "digest"], "sorted-leaves"), "placed-leaves")
    carried = ("id", "other")
    levels, subroots = grow(leaves, arity, "level", carried)
    top = placed(subroots.select(F.lit("").alias("group"), F.col("group").alias("source_key"), "digest"),
                 ["source_key"], "subroots")
    top_levels, roots = grow(top, arity, "top", ("source_key",))
    root = roots.first()
    root = F.lit(root.digest.hex() if root else None).cast("string")

    none = F.array().cast(_PATH)
    alone = leaves.where("n = 1").select("group", none.alias("path"), "digest", *carried)
    below = paths(levels, ("digest", *carried))
    every = alone if below is None else alone.unionByName(below.drop("idx"))
    upper = paths(top_levels, ("source_key",))
    ends = subroots.withColumnRenamed("digest", "subroot")
    if upper is None:
        ends = ends.withColumn("rest", none)
    else:
        ends = ends.join(upper.select(F.col("source_key").alias("group"), F.col("path").alias("rest")),
                         "group")
    return every.join(ends, "group").select(
        F.col("id").alias(id_col), _text(F.col("digest")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.concat("path", "rest").alias("path"), _text(F.col("other")).alias("tampered_leaf"))


def proof(path: Column) -> Column:
    """All digests of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(_text(s.before), _text(s.after))), "")


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, start, lambda own, s: F.sha2(
        F.concat(_text(s.before), own, _text(s.after)), 256))
