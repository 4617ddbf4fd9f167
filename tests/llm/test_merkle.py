"""The manifest against trees built node by node."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hirelake.llm import merkle

SCHEMA = ("doc_id long, source string, lang string, n_chars long, text string, leaf string, root string, "
          "idx long, n long, path string, before string, part long")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_tree(leaves, arity):
    """(root, siblings of each leaf up to it as (before, after))."""
    paths = [[] for _ in leaves]
    under = [[i] for i in range(len(leaves))]
    nodes = leaves
    while len(nodes) > 1:
        up, up_under = [], []
        for a in range(0, len(nodes), arity):
            run = nodes[a:a + arity]
            for slot in range(len(run)):
                for i in under[a + slot]:
                    paths[i].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            up.append(h("".join(run)))
            up_under.append([i for own in under[a:a + arity] for i in own])
        nodes, under = up, up_under
    return nodes[0], paths


def plain(rows, arity, tampered):
    """doc_id, leaf, subroot, root, proof, folded root of each row."""
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        made.append((own, *plain_tree([plain_leaf(r) for r in own], arity)))
    if not made:
        return []
    root, tops = plain_tree([m[1] for m in made], arity)
    out = []
    for (own, subroot, paths), top in zip(made, tops):
        for row, path in zip(own, paths):
            whole = path + top
            acc = plain_leaf((*row[:4], lower(row[4]))) if tampered(row) else plain_leaf(row)
            for before, after in whole:
                acc = h(before + acc + after)
            out.append((row[0], plain_leaf(row), subroot, root, h("".join(b + a for b, a in whole)), acc))
    return out


def chosen(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0


def rows_of(seed):
    own = random.Random(seed)
    rows = [(i, own.choice([None, "", "a", "a", "a", "B", "é", "￿", "\U0001F600"]), own.choice([None, "en"]),
             own.choice([None, -3, 0, 10]), own.choice([None, "", "Text É", "x" * 3000, "a:b\x00"]) )
            for i in range(150)]
    rows += [(1000 + i, "long", "en", i, f"T{i}") for i in range(300)]
    rows += [rows[5], rows[5], (7, "a", None, 1, "other"), (None, "a", "x", 1, "t"), (None, "a", "x", 1, "T"),
             (None, None, None, None, None), (-4, "alone", "en", 2, "One")]
    own.shuffle(rows)
    return rows


@pytest.mark.parametrize("arity", [16, 3, 2])
def test_manifest(spark, arity):
    rows = rows_of(arity)
    docs = spark.createDataFrame([r + (None,) * 7 for r in rows], SCHEMA).repartition(3)
    pick = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0, F.lit(False))
    text = F.when(pick, merkle.lowered(docs["text"])).otherwise(docs["text"])
    got = merkle.merkle_manifest(docs, tampered={"text": text}, arity=arity).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("p"),
        merkle.folded(F.col("path"), F.col("tampered_leaf")).alias("f")).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(plain(rows, arity, chosen))
    assert any(r.f != r.root for r in got) and any(r.f == r.root for r in got)


def test_small_tables(spark):
    for rows in ([], [(1, "a", "en", 1, "T")], [(1, "a", "en", 1, "T"), (2, "b", None, None, None)]):
        docs = spark.createDataFrame([r + (None,) * 7 for r in rows], SCHEMA)
        got = merkle.merkle_manifest(docs).select(
            "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("p"),
            merkle.folded(F.col("path"), F.col("leaf")).alias("f")).collect()
        assert sorted(map(tuple, got)) == sorted(plain(rows, 16, lambda r: False))


def test_a_level_deals_each_side_out_once(spark):
    """The join, the gathering and the node's own row use one dealing by run."""
    nodes = spark.range(1000).select(
        F.hex(F.col("id") % 1).alias("group"), F.col("id").alias("idx"), F.lit(1000).cast("long").alias("n"),
        F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with merkle._dealt_by_run(spark):
            plan = merkle._level(nodes, 16, ())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    import re
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and all(re.sub(r"#\d+L?", "", e).startswith("group, run, ") and "place" not in e
                             and "idx" not in e for e in exchanges), exchanges
    assert "Cartesian" not in plan and "NestedLoop" not in plan
