"""URL filters as a sort-merge range join.

A rule (host, path, verdict) fits its host and all subdomains where the path starts with the
rule's. Keys are canonical: the host's labels reversed, a separator, the path. A rule's key is a
prefix, hence an interval of keys; a URL asks with one key for each host above its own. Rules
and keys are dealt out by ranges of keys (boundaries from a bounded sample; a rule goes to every
range that its interval touches), sorted, and swept once: since intervals of prefixes nest, the
rules open at a key are a stack, and its top is the longest. The longest over all of a URL's
keys wins; at equal length block beats allow.

Each distinct (host, path) is judged once, so a host or URL that a third of the pages have is
split by path, and joined back in a join that can be split. Defined cases: a null URL, or one
without `://`, has an empty host and path and fits no rule; rules with a null host or verdict
are ignored, a null path is empty and fits every path; repeated rows are judged alike; without
rules all URLs get the default; other columns are not read.
"""

from __future__ import annotations

import string
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "\x01"  # sorts before all characters of a host
SAMPLE = 4000


def url_host_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase,
                       string.ascii_lowercase)
    return host, F.regexp_extract(url, pattern, 2)


def rule_key(host: str, path: str) -> bytes:
    return (".".join(host.split(".")[::-1]) + SEPARATOR + path).encode()


def asked_keys(host: str, path: str) -> list[bytes]:
    """The keys of the host and of every host above it."""
    labels = host.split(".")
    return [rule_key(".".join(labels[i:]), path) for i in range(len(labels))]


def _ranges(bounds: list[bytes]):
    """Tasks that deal out keys and rules: part is the number of boundaries up to a key."""
    def keys(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(bisect_right(bounds, key), key, host, path)
                    for host, path in zip(*(batch.column(c).to_pylist() for c in ("host", "path")))
                    for key in asked_keys(host, path)]
            yield _batch(rows, ("part", "key", "host", "path"))

    def rules(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, path, verdict in zip(*(batch.column(c).to_pylist()
                                             for c in ("host", "path", "verdict"))):
                key = rule_key(host, path)
                part = bisect_right(bounds, key)
                rows.append((part, key, host, path, verdict))
                while part < len(bounds) and bounds[part].startswith(key):
                    part += 1
                    rows.append((part, key, host, path, verdict))
            yield _batch(rows, ("part", "key", "host", "path", "verdict"))
    return keys, rules


_TYPES = {"part": pa.int32(), "key": pa.binary()}


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_pydict({n: pa.array(list(c), _TYPES.get(n, pa.string()))
                                       for n, c in zip(names, columns)})


def _sweep(batches) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part and key, rules before equal keys."""
    own, stack = None, []
    for batch in batches:
        out = []
        for part, key, host, path, verdict in zip(*(batch.column(c).to_pylist() for c in (
                "part", "key", "host", "path", "verdict"))):
            if part != own:
                own, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if verdict is not None:
                if not stack or stack[-1][0] != key or stack[-1][2] < verdict:
                    stack.append((key, host + path, verdict))
            elif stack:
                out.append((host, path, *stack[-1][1:]))
        yield _batch(out, ("host", "path", "rule", "verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict), one row per page; rules has host, path and verdict."""
    host, path = url_host_path(pages[url_col])
    rows = pages.select(pages[id_col].alias("id"), host.alias("host"), path.alias("path"))
    asked = rows.where("host != ''").select("host", "path").distinct()
    lower = F.translate(rules["host"], string.ascii_uppercase, string.ascii_lowercase)
    usable = rules.where(rules["host"].isNotNull() & rules["verdict"].isNotNull()).select(
        lower.alias("host"), F.coalesce(rules["path"], F.lit("")).alias("path"),
        rules["verdict"].alias("verdict"))
    some = asked.orderBy(F.xxhash64("host", "path"), "host", "path").limit(SAMPLE).collect()
    keys = sorted({k for r in some for k in asked_keys(r.host, r.path)})
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = keys[::max(1, -(-len(keys) // parts))][1:]
    deal_keys, deal_rules = _ranges(bounds)
    points = asked.mapInArrow(deal_keys, "part int, key binary, host string, path string")
    starts = usable.mapInArrow(
        deal_rules, "part int, key binary, host string, path string, verdict string")
    both = points.withColumn("verdict", F.lit(None).cast("string")).unionByName(starts)
    swept = both.repartition("part").sortWithinPartitions(
        "part", "key", F.col("verdict").isNull(), "verdict").mapInArrow(
        _sweep, "host string, path string, rule string, verdict string")
    best = swept.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule").alias("n"), "verdict", "rule")).alias("best"))
    judged = rows.join(best, ["host", "path"], "left")
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
