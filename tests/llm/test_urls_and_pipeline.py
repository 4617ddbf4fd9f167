"""URL rules and the pipeline against plain versions, and what the queries return."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_text_operators import ascii_lower, plain_groups
from hirelake.llm import langid, url_rules
from hirelake.llm.queries import ORACLES, QUERIES, URL_RULES

URLS = ["http://a.example.net/en/1?x=/de/", "HTTPS://WWW.Example.NET/de/", "http://example.com/de/",
        "ftp://x.example.com/de/q#/en/", "http://net/", "http://net", "http://internet/", "net/",
        None, "", "://", "http://b.org/fr/", "http://org/fr", "http://é.net/\n", "x://y://z.net/a",
        "http://example.net/en/", "http://example.net/en", "http://example.net/en/"]


def plain(url, rules):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), found[1]) if found else ""
    path = found[2] if found else ""
    fits = [(len(h + p), v, h + p) for h, p, v in rules if h is not None and v is not None
            and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best and best[2], best[1] if best else "allow"


@pytest.mark.parametrize("parts", ["4", "1"])
def test_url_rules(spark, parts):
    pages = spark.createDataFrame([(i, u, "rule", "x") for i, u in enumerate(URLS)],
                                  "page_id long, url string, host string, verdict string")
    more = URL_RULES + [("net", "/", "allow"), ("example.net", "/en/1", "block"), ("é.net", "", "block"),
                        (None, "/", "block"), ("org", "/", None), ("a.example.net", "/e", "block")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for rules in (URL_RULES, more, []):
            frame = spark.createDataFrame(rules, "host string, path string, verdict string")
            got = url_rules.judge_urls(pages, frame).collect()
            assert collections.Counter(map(tuple, got)) == collections.Counter(
                (i, *plain(u, rules)) for i, u in enumerate(URLS))
        assert url_rules.judge_urls(pages.where("false"), frame).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rules_reach_all_ranges_they_cover():
    rules = [("net", "/", "block")]
    bounds = sorted(k for i in range(50) for k in url_rules.asked_keys(f"h{i}.net", "/"))[::7]
    import pyarrow as pa
    _, deal = url_rules._ranges(bounds)
    batch = pa.RecordBatch.from_pydict(dict(zip(("host", "path", "verdict"), map(list, zip(*rules)))))
    parts = next(deal([batch])).column("part").to_pylist()
    key = url_rules.rule_key("net", "/")
    assert parts == list(range(parts[0], parts[0] + len(parts)))
    assert len(parts) == 1 + sum(b.startswith(key) and b > key for b in bounds)


def test_every_query_returns_a_row_per_document(spark):
    folder = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    for name in ("op3_secret_scan", "op5_simhash_dedup", "op7_language_id", "op11_sentencepiece",
                 "op12_merkle_manifest"):
        df = QUERIES[name](spark, folder)
        assert df.select("doc_id").distinct().count() == df.count() == n


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [s for s, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    spoken = corpus_pipeline.language_id(spark, docs, folder)
    assert spoken.columns == docs.columns
    assert {r.doc_id for r in spoken.collect()} >= {d for d, t in texts.items() if len(t.split()) > 20}

    exact = corpus_pipeline.exact(spark, docs, folder)
    low = {d: re.sub("[A-Z]", lambda m: m[0].lower(), t) for d, t in texts.items()}
    last = {t: max(d for d in low if low[d] == t) for t in set(low.values())}
    assert exact.columns == docs.columns
    assert sorted(r.doc_id for r in exact.collect()) == sorted(last.values())

    near = corpus_pipeline.near_duplicates(spark, docs, folder)
    ids = sorted(texts)
    at = plain_groups([texts[d] for d in ids])
    assert near.columns == docs.columns
    assert {r.doc_id for r in near.collect()} == {ids[c] for c in at.values()}

    clean = corpus_pipeline.benchmark_free(spark, docs, folder)
    hits = QUERIES["op6_decontamination"](spark, folder)
    assert {r.doc_id for r in clean.collect()} == {
        r.doc_id for r in hits.where("not contaminated").collect()}

    packed = corpus_pipeline.run(spark, folder)
    assert packed.select("doc_id").distinct().count() <= near.count()
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(
        F.col("offset") + F.col("length")).alias("end"))
    assert sums.where("n != end or n > 2048").count() == 0


def test_pipeline_keeps_what_a_plain_version_keeps(spark):
    """Each stage on what its predecessor kept; only language decisions are the model's."""
    import public_tokenizers
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(texts) == docs.count()
    said = langid.identify(docs, langid.fit(docs)).collect()
    left = [{r.doc_id for r in said if not r.rejected}]

    last = {}
    for d in sorted(left[-1]):
        last[ascii_lower(texts[d])] = d
    left.append(set(last.values()))

    ids = sorted(left[-1])
    left.append({ids[c] for c in plain_groups([texts[d] for d in ids]).values()})

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(x) for x in windows}

    def contaminated(text):
        w = words(text)
        return any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))
    left.append({d for d in left[-1] if not contaminated(texts[d])})
    # Every stage but the first removes something here, and most documents stay.
    assert len(texts) >= len(left[0]) > len(left[1]) > len(left[2]) > len(left[3]) > len(texts) // 2

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for d in left[-1]:
        own = [*tokens.encode(texts[d], add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(own) % 2048 or 2048, len(own), 2048), len(own)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, n, a, b - a, zlib.crc32(np.array(own[a:b], "<u4").tobytes())] += 1
    packed = corpus_pipeline.run(spark, folder).select(
        "doc_id", "piece", "start", "length", "ids_crc32")
    assert collections.Counter(map(tuple, packed.collect())) == want
