"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import sha256_hex
from hirelake.llm.decontaminate import find_contamination
from hirelake.llm.exact_dedup import exact_dedup
from hirelake.llm.langid import fit, held_out, identify
from hirelake.llm.line_dedup import line_dedup
from hirelake.llm.merkle import folded, lowered, merkle_manifest, proof
from hirelake.llm.packing import pack
from hirelake.llm.pieces import encode_decode
from hirelake.llm.secrets import scan_secrets
from hirelake.llm.simhash import simhash_dedup
from hirelake.llm.substring_dedup import substring_dedup
from hirelake.llm.suffix_dedup import suffix_dedup
from hirelake.llm.url_rules import judge_urls
from hirelake.llm.whitening import fit as fit_whitening
from hirelake.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_substring_dedup(spark, folder):
    return substring_dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM d)),
repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM windows SEMI JOIN repeated USING (w)),
words AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS k
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@query
def op4_suffix_dedup(spark, folder):
    return suffix_dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", sha256_hex(F.col("kept")).alias("kept_sha256"))


ORACLES["op4_suffix_dedup"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS s FROM d)),
firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (
  SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS prev
  FROM windows JOIN firsts USING (w) WHERE doc_id > first_id),
numbered AS (
  SELECT doc_id, s, sum(CASE WHEN prev IS NULL OR s > prev + 50 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY s) AS span FROM hits),
spans AS (
  SELECT doc_id, span, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, span, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY span) AS from_byte
  FROM spans),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(h, 2 * from_byte + 1, 2 * (a - from_byte)), '' ORDER BY span) AS k
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@query
def op2_exact_dedup(spark, folder):
    return exact_dedup(table(spark, folder, "documents"))


ORACLES["op2_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@query
def op3_secret_scan(spark, folder):
    found = scan_secrets(table(spark, folder, "documents"), repo_col="doc_id", owner_col="source")
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))))
    base = F.filter("spans", lambda s: s.kind != "token")
    count = lambda field, value: F.size(
        F.filter("spans", lambda s: s[field] == value)).cast("long")
    return found.select(
        "doc_id", *(count("kind", k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        sha256_hex(said(base)).alias("base_sha256"), said(F.col("spans")).alias("spans"),
        *(count("verdict", v).alias(f"n_{v}") for v in ("live", "example")))


@query
def op5_simhash_dedup(spark, folder):
    return simhash_dedup(table(spark, folder, "documents"))


@query
def op6_decontamination(spark, folder):
    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    items = F.array_sort(F.array_distinct("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        sha256_hex(F.concat_ws(",", items)).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op6_decontamination"] = r"""
WITH low AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
windows AS (
  SELECT id, least(10, len(ws)) AS n, array_to_string(ws[s:s + 9], ' ') AS win
  FROM (SELECT id, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS s
        FROM w WHERE kind = 'b' AND len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT id, s, n, array_to_string(ws[s:s + n - 1], ' ') AS win
  FROM (SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
        FROM w, sizes WHERE kind = 'd' AND len(ws) >= n)),
found AS (
  SELECT p.id AS doc_id, p.s, p.n, b.id AS item
  FROM places p JOIN windows b ON p.win = b.win AND p.n = b.n),
hit AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT w.id AS doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON w.id = hit.doc_id LEFT JOIN items ON w.id = items.doc_id
WHERE kind = 'd'
"""


@query
def op7_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    return identify(docs, fit(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# The rules (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op8_url_filter(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, folder, "pages"), rules)


ORACLES["op8_url_filter"] = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
    ('org', '/fr/', 'allow')),
fits AS (
  SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN rules r ON ('.' || p.host).ends_with('.' || r.host) AND p.path.starts_with(r.path)
  GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN fits f ON p.page_id = f.page_id
"""


@query
def op9_best_fit_packing(spark, folder):
    return pack(table(spark, folder, "documents"))


@query
def op10_line_dedup(spark, folder):
    return line_dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept")).alias("kept_sha256"))


ORACLES["op10_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12)
    || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE often.key IS NULL), ''))
    AS kept_sha256
FROM k LEFT JOIN often ON k.key = often.key GROUP BY doc_id
"""


@query
def op11_sentencepiece(spark, folder):
    made = encode_decode(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    line = F.array_join(F.col("ids").cast("array<string>"), " ")
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_hex(line).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"))


@query
def op12_merkle_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    text = F.when(F.coalesce(chosen, F.lit(False)), lowered(docs["text"])).otherwise(docs["text"])
    return merkle_manifest(docs, tampered={"text": text}).select(
        "doc_id", "leaf", "subroot", "root", sha256_hex(proof(F.col("path"))).alias("proof_sha256"),
        folded(F.col("path"), F.col("tampered_leaf")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def _merkle_sql(levels: int = 7, top_levels: int = 4, arity: int = 16) -> str:
    """Trees of so many levels at most; nodes that are roots already go up unchanged."""
    def tree(name: str, depth: int) -> str:
        parts = []
        for k in range(depth):
            run = f"PARTITION BY grp, idx // {arity} ORDER BY idx ROWS BETWEEN"
            parts.append(f"""{name}p{k} AS (
  SELECT grp, idx, n,
    coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{k}),
{name}{k + 1} AS (
  SELECT grp, idx // {arity} AS idx, (any_value(n) + {arity - 1}) // {arity} AS n,
    CASE WHEN any_value(n) = 1 THEN any_value(digest)
      ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
  FROM {name}{k} GROUP BY grp, idx // {arity})""")
        return ",\n".join(parts)

    def value(column: str) -> str:
        return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(value, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # The checksum bit by bit: a byte is mixed in, then eight shifts (marked -1).
    crc = """xor(4294967295, list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
        ELSE a >> 1 END, 4294967295::BIGINT))"""

    def steps(name: str, depth: int, idx: str, grp: str) -> str:
        return "\n".join(
            f"  JOIN {name}p{k} {name}q{k} ON {name}q{k}.grp = {grp} AND {name}q{k}.idx = {idx} // {arity ** k}"
            for k in range(depth))

    names = [f"tq{k}" for k in range(levels)] + [f"uq{k}" for k in range(top_levels)]
    folds = ",\n".join(
        f"f{k + 1} AS (SELECT * EXCLUDE (acc), CASE WHEN n{k} > 1 THEN sha256(b{k} || acc || a{k}) "
        f"ELSE acc END AS acc FROM f{k})" for k in range(len(names)))
    sides = ", ".join(f"{name}.n AS n{k}, {name}.before AS b{k}, {name}.after AS a{k}"
                      for k, name in enumerate(names))
    whole = " || ".join(f"CASE WHEN n{k} > 1 THEN b{k} || a{k} ELSE '' END" for k in range(len(names)))
    return f"""
WITH x AS (
  SELECT doc_id, grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS idx,
    count(*) OVER (PARTITION BY grp) AS n, digest, tampered
  FROM (SELECT doc_id, coalesce('=' || source, '') AS grp, {leaf('text')} AS digest,
      CASE WHEN {crc} % 5 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS tampered FROM documents)),
t0 AS (SELECT grp, idx, n, digest FROM x),
{tree('t', levels)},
u0 AS (
  SELECT 0 AS grp, grp AS source_key, row_number() OVER (ORDER BY grp) - 1 AS idx,
    count(*) OVER () AS n, digest FROM t{levels}),
{tree('u', top_levels)},
f0 AS (
  SELECT x.doc_id, x.digest AS leaf, u0.digest AS subroot, u{top_levels}.digest AS root,
    x.tampered AS acc, {sides}
  FROM x
{steps('t', levels, 'x.idx', 'x.grp')}
  JOIN u0 ON u0.source_key = x.grp
{steps('u', top_levels, 'u0.idx', '0')}
  JOIN u{top_levels} ON u{top_levels}.idx = 0),
{folds}
SELECT doc_id, leaf, subroot, root, sha256({whole}) AS proof_sha256, acc AS folded_root,
  acc = root AS verified
FROM f{len(names)}
"""


ORACLES["op12_merkle_manifest"] = _merkle_sql()


@query
def op13_embedding_whitening(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return whiten(vectors, fit_whitening(vectors)).withColumn(
        "deviation", F.expr("try_cast(deviation as bigint)"))
