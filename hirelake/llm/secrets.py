"""Secret scan with corpus-wide ownership frequency.

Base kinds (fixed patterns) are `assign`, `access` and `hex`. The method looks at *tokens* too:
runs of 20 or more base64-like characters with upper-case letters, lower-case letters and
digits, outside the base spans. The 128-bit hash of every candidate value is counted over the
corpus by distinct repositories and distinct owners (combined on the map side). A value that
more than `max_owners` owners have, or more than `max_repos` repositories, is a copied example; any
other looks live if a single owner has it, and is shared if several have. Tokens are reported as
spans of kind `token` unless they are examples; base spans always stay, with their verdict.

Positions are code points, end exclusive. Texts are scanned once; only candidates, without
their values, are written and shuffled. Defined cases: a null or empty text has no spans; a
null repository or owner is one of its own, the same for all rows; rows repeated with id and
text count once; null ids stay null; bytes that are no UTF-8 are read as U+FFFD; other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import slices, stage

# The patterns of the base kinds, in the order of the kinds.
KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of [0-9a-f]+ that are long enough
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KEYWORDS = ("passw", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the base kinds."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(1, *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return found + [(2, *m.span(), m[0]) for m in HEX.finditer(text)]


def tokens(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Token candidates that touch none of the taken spans."""
    found = []
    for m in TOKEN.finditer(text):
        value = m[0]
        if (any(c.isdigit() for c in value) and value.lower() != value and value.upper() != value
                and not any(a < m.end() and m.start() < b for _, a, b, _ in taken)):
            found.append((3, *m.span(), value))
    return found


def _hash(value: str) -> bytes:
    return xxhash.xxh3_128_digest(value)


def _candidates(batches) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out: dict[str, list] = {n: [] for n in ("key", "repo", "owner", "kind", "start", "end", "hash")}
        texts = (b.decode(errors="replace") for b in batch.column("text").cast(pa.binary()).to_pylist())
        for key, repo, owner, text in zip(*(batch.column(c).to_pylist() for c in ("key", "repo", "owner")),
                                          texts):
            found = base_spans(text)
            for kind, start, end, value in found + tokens(text, found):
                for n, x in zip(out, (key, repo, owner, kind, start, end, _hash(value))):
                    out[n].append(x)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("key", pa.int64()), ("repo", pa.string()), ("owner", pa.string()), ("kind", pa.int32()),
            ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary())]))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, repos, owners): in how many repositories and with how many owners a value occurs."""
    pairs = candidates.groupBy("hash", "owner").agg(F.countDistinct("repo").alias("repos"))
    return pairs.groupBy("hash").agg(F.sum("repos").alias("repos"), F.count("*").alias("owners"))


def scan_secrets(docs: DataFrame, repo_col: str = "source", owner_col: str = "source",
                 max_owners: int = 3, max_repos: int = 20, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, spans): an array of (start, kind, end, repos, owners, verdict), sorted.

    verdict is example (more than max_owners owners, or max_repos repositories), else live (one
    owner) or shared.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    named = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(docs[id_col].cast("long"), text).alias("key"),
                       docs[id_col].cast("long").alias("id"), named(repo_col).alias("repo"),
                       named(owner_col).alias("owner"), text.alias("text"))
    found = stage(rows.mapInArrow(_candidates, "key long, repo string, owner string, kind int, "
                                  "start long, end long, hash binary"), "candidates")
    copied = (F.col("owners") > max_owners) | (F.col("repos") > max_repos)
    verdict = F.when(copied, "example").when(F.col("owners") == 1, "live").otherwise("shared")
    judged = found.join(ownership(found), "hash").withColumn("verdict", verdict)
    judged = judged.where((F.col("kind") < 3) | (F.col("verdict") != "example"))
    kinds = F.array(*map(F.lit, KINDS))
    spans = judged.groupBy("key").agg(F.array_sort(F.collect_set(F.struct(
        "start", F.col("kind").alias("rank"), "end", "repos", "owners", "verdict"))).alias("spans"))
    spans = spans.select("key", F.transform("spans", lambda s: F.struct(
        s.start.alias("start"), kinds[s["rank"]].alias("kind"), s.end.alias("end"),
        s.repos.alias("repos"), s.owners.alias("owners"), s.verdict.alias("verdict"))).alias("spans"))
    none = F.expr("cast(array() as array<struct<start: bigint, kind: string, end: bigint, "
                  "repos: bigint, owners: bigint, verdict: string>>)")
    return rows.select("key", "id").join(spans, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans"))
