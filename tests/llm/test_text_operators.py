"""Operators on documents against brute force, over rows with every odd case."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from hirelake.llm import (
    decontaminate, exact_dedup, langid, line_dedup, packing, secrets, simhash, substring_dedup,
    suffix_dedup)
from hirelake.llm.components import components

SCHEMA = ("doc_id long, text string, lang string, source string, key long, id string, row long, "
          "fp string, mark string, n long, length string, spans string, letters boolean")


def prose(seed, n):
    """Words that start with a number each now and then, so most stretches occur once."""
    own = random.Random(seed)
    return " ".join(own.choice(["the", "Of", "and", "träge", "ñu", "x"]) + str(own.randrange(n))
                    * own.randrange(2) for _ in range(n))


PASSAGE = prose(1, 90)
LONG = prose(2, 6000)
TEXTS = [
    None, "", " ", "one", "one\ntwo", PASSAGE, PASSAGE.upper(), PASSAGE, LONG, LONG[:9000] + " end",
    "start " + PASSAGE + " stop", prose(3, 50) + "\t" + PASSAGE + "\n" + prose(4, 80),
    "a " * 120, "ab" * 200, "é" * 70, prose(5, 300), prose(5, 300) + " more",
    PASSAGE[:150] + prose(6, 40), "\u2028" + PASSAGE + "\x00",
    "line\n  LINE \nother", *["Line \nkept %d" % i for i in range(12)], "x\x0bline\n\n\n",
    prose(7, 40) + "\n" + PASSAGE[100:330], "un | deux |\r\n", "12 34 56", "!?",
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [
    (7, PASSAGE), (None, PASSAGE), (None, PASSAGE), (None, None), (3, "other text"), (99, LONG)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "de"][n % 3], [None, "s0", "s1"][n % 3]) + (None,) * 9
            for n, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(rows):
    return collections.Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                               for r in rows)


def test_substring_dedup(docs, nothing):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in ROWS]
    for size in (35, 6, 5, 2):
        seen = collections.Counter(tuple(w[i:i + size]) for w in split
                                   for i in range(len(w) - size + 1))
        want = []
        for (doc, _), w in zip(ROWS, split):
            gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] > 1
                    for j in range(i, i + size)}
            kept = [x for i, x in enumerate(w) if i not in gone]
            want.append((doc, len(w), len(gone), " ".join(kept)))
        assert multiset(substring_dedup.substring_dedup(docs, size).collect()) == multiset(want)
    assert substring_dedup.substring_dedup(nothing).collect() == []


@pytest.mark.parametrize("group", [1 << 17, 1])
def test_suffix_dedup(docs, nothing, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 40)
    data = [(float("inf") if d is None else d, (t or "").encode()) for d, t in ROWS]
    first = {}
    for doc, b in data:
        for i in range(len(b) - 49):
            first[b[i:i + 50]] = min(doc, first.get(b[i:i + 50], doc))
    want = []
    for (real, _), (doc, b) in zip(ROWS, data):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < doc:
                gone[i:i + 50] = True
        spans = int((gone[:-1] & gone[1:] != gone[:-1]).sum())
        want.append((real, len(b), int(gone.sum()), spans,
                     bytes(x for x, g in zip(b, gone) if not g)))
    assert multiset(suffix_dedup.suffix_dedup(docs).collect()) == multiset(want)
    assert suffix_dedup.suffix_dedup(nothing).collect() == []


@pytest.mark.parametrize("base", [50, 25, 13, 5, 1])
@pytest.mark.parametrize("weak", [False, True])
def test_ranks_by_doubling(monkeypatch, base, weak):
    """Places of strings that a smaller id has, at any first length; hashes need not tell them apart."""
    monkeypatch.setattr(suffix_dedup, "BASE", base)
    if weak:
        every = suffix_dedup.Rolling.all
        monkeypatch.setattr(suffix_dedup.Rolling, "all", lambda self, n: every(self, n) & np.uint64(3))
    own = random.Random(base)
    stock = [bytes(own.choice(b"ab") for _ in range(70)) for _ in range(4)] + [b"a" * 70]
    texts = [(own.choice([1, 2, 3, 5, 2 ** 63 - 1]), own.choice(stock)[own.randrange(9):]) for _ in range(40)]
    for window in (50, 33, 9, 2):
        finder = suffix_dedup.EarlierFinder(None, None, "", window, (window + 1) // 2)
        first, at, ids, strings, origin = {}, [], [], [], 0
        for doc, text in texts:
            for i in range(len(text) - window + 1):
                at.append(origin + i)
                ids.append(doc)
                strings.append(text[i:i + window])
                first[strings[-1]] = min(doc, first.get(strings[-1], doc))
            origin += len(text)
        data = np.frombuffer(b"".join(t for _, t in texts), np.uint8)
        got = finder.has_earlier(data, np.array(at), np.array(ids))
        assert got.tolist() == [first[s] < doc for s, doc in zip(strings, ids)]


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_dedup(spark, docs, nothing, tmp_path):
    groups = collections.defaultdict(list)
    for doc, t in ROWS:
        groups[ascii_lower(t)].append(doc)
    best = {t: max((d for d in own if d is not None), default=None) for t, own in groups.items()}
    want = [(d, best[ascii_lower(t)], len(groups[ascii_lower(t)]), d == best[ascii_lower(t)],
             hashlib.sha256(ascii_lower(t).encode()).hexdigest()) for d, t in ROWS]
    assert multiset(exact_dedup.exact_dedup(docs).collect()) == multiset(want)
    assert exact_dedup.exact_dedup(nothing).collect() == []
    kept = exact_dedup.keep_distinct(docs)
    assert kept.columns == docs.columns
    assert sorted(ascii_lower(r.text) for r in kept.collect()) == sorted(groups)

    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=3)
    one = spark.createDataFrame([(1, "a"), (2, "B")], "doc_id long, text string")
    two = spark.createDataFrame([(9, "b"), (8, "c")], "doc_id long, text string")
    index.add(one).collect()
    got = {r.doc_id: r for r in index.add(two).collect()}
    assert (got[9].keep_id, got[9].kept, got[9].group_size) == (2, False, 2)
    assert got[8].kept
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=3)
    assert again.read().count() == 3
    plan = index.read().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the buckets are the partitioning


def test_exact_dedup_in_batches(spark, docs, tmp_path):
    """A batch meets a filled index; the decisions are those of one batch."""
    one = exact_dedup.exact_dedup(docs, batches=1).collect()
    for batches in (2, 5):
        path = str(tmp_path / f"index{batches}")
        assert multiset(exact_dedup.exact_dedup(docs, batches=batches, path=path).collect()) == multiset(one)
        index = exact_dedup.DigestIndex(spark, path)
        per_batch = {r.batch: r["count"] for r in index.read().groupBy("batch").count().collect()}
        assert len(per_batch) >= 2 and sum(per_batch.values()) == len({r.text_sha256 for r in one})
        more = spark.table(index.more_name).agg(F.sum("n")).first()[0]
        assert more  # rows that met their text in the index
        assert index.read().agg(F.sum("n")).first()[0] + more == len(ROWS)
        assert exact_dedup.keep_distinct(docs, path=path).collect() == []
    assert exact_dedup.keep_distinct(docs, batches=5).count() == len({r.text_sha256 for r in one})
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "thrice"), buckets=3)
    row = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [index.add(row).first().group_size for _ in range(3)] == [1, 2, 3]


def test_an_index_of_a_call_leaves_no_tables(spark, docs):
    before = {t.name for t in spark.catalog.listTables()}
    found, kept = exact_dedup.exact_dedup(docs), exact_dedup.keep_distinct(docs)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert found.count() == len(ROWS)
    assert kept.count() == found.select("text_sha256").distinct().count()


def test_each_bucket_is_one_file(spark, tmp_path):
    """Also where a shuffle has more partitions than the index has buckets."""
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=5)
    docs = spark.range(400).selectExpr("id as doc_id", "cast(id % 300 as string) as text")
    with exact_dedup._setting(spark, "spark.sql.shuffle.partitions", "13"):
        assert index.add(docs).where("kept").count() == 300
    files = [p for p in (tmp_path / "index").glob("*.parquet")]
    assert len(files) == 5
    # The bucket named by the file holds the digests that Spark looks for in it.
    assert index.read().join(docs.select(exact_dedup.digest(F.col("text")).alias("digest")).distinct(),
                             "digest").count() == 300


def test_a_batch_that_was_not_committed_does_not_count(spark, docs, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    index = exact_dedup.DigestIndex(spark, path, buckets=3)
    first = docs.where("doc_id < 12")
    before = multiset(index.add(first).collect())

    def die(self, batch):
        raise RuntimeError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(exact_dedup.DigestIndex, "_commit", die)
        with pytest.raises(RuntimeError):
            index.add(docs)
    again = exact_dedup.DigestIndex(spark, path, buckets=99)
    assert again.buckets == 3 and again.read().count() == len({r[-1] for r in before})
    # The same batch once more, as if nothing had happened.
    rest = docs.where("doc_id >= 12")
    got = {r.doc_id: r for r in again.add(rest).collect()}
    texts = collections.Counter(ascii_lower(t) for d, t in ROWS if d is not None)
    for d, t in ROWS:
        if d is not None and d >= 12:
            assert got[d].group_size == texts[ascii_lower(t)]


def plain_fingerprint(text, words):
    own = (text or "").encode().lower().split()
    shingles = [b" ".join(own[i:i + words]) for i in range(max(1, len(own) - words + 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_dedup(spark, docs, nothing):
    prints = [plain_fingerprint(t, 4) for _, t in ROWS]
    at = joined(range(len(ROWS)), [(i, j) for i in range(len(ROWS)) for j in range(i)
                                   if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = {c: min((ROWS[i][0] for i in at if at[i] == c and ROWS[i][0] is not None), default=None)
             for c in at.values()}
    want = [(d, f"{prints[i]:016x}", least[at[i]]) for i, (d, _) in enumerate(ROWS)]
    assert multiset(simhash.simhash_dedup(docs).collect()) == multiset(want)
    assert simhash.simhash_dedup(nothing).collect() == []
    with pytest.raises(ValueError):
        simhash.simhash_dedup(docs, max_bits=5)


def plain_groups(texts, words=5):
    """Linked by fingerprints of at most 4 differing bits, or by sets of shingles at 0.8 or more."""
    def shingles(text):
        own = (text or "").encode().lower().split()
        return {b" ".join(own[i:i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()
    prints, sets = [plain_fingerprint(t, words) for t in texts], [shingles(t) for t in texts]
    return joined(range(len(texts)), [
        (i, j) for i in range(len(texts)) for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 4 or sets[i] == sets[j]
        or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])])


def edited(seed, words, share):
    own = random.Random(seed)
    return " ".join(f"new{own.randrange(10 ** 6)}" if own.random() < share else w for w in words)


def test_one_of_each_group_of_near_copies(spark, docs, nothing):
    """Edited copies of a few texts; chains of them; texts that share no more than a part."""
    words = [f"w{i * i % 977}" for i in range(400)]
    texts = [t for _, t in ROWS] + [edited(s, words, share) for s in range(12)
                                    for share in (0.005, 0.015, 0.03, 0.08)]
    for step in range(0, 120, 12):  # neighbours of the chain are alike, its ends are not
        texts.append(" ".join([f"x{i}" for i in range(step, step + 130)]))
    texts += [" ".join(words[:200] + [f"y{s}-{i}" for i in range(200)]) for s in range(6)]
    at = plain_groups(texts)
    ids = [d for d, _ in ROWS] + list(range(1000, 1000 + len(texts) - len(ROWS)))
    rows = spark.createDataFrame(list(zip(ids, texts, ["a"] * len(ids))),
                                 "doc_id long, text string, label string").repartition(3)
    least = {c: min((ids[i] for i in at if at[i] == c and ids[i] is not None), default=None)
             for c in at.values()}
    assert 10 < len(least) < len(texts) - 20
    got = simhash.keep_one_of_each(rows)
    assert got.columns == rows.columns
    assert collections.Counter(r.doc_id for r in got.collect()) == collections.Counter(least.values())
    assert simhash.keep_one_of_each(docs).columns == docs.columns
    assert simhash.keep_one_of_each(nothing).collect() == []


@pytest.mark.parametrize("longest", [1 << 16, 3])
def test_links_of_dense_fingerprints(spark, longest):
    """All fingerprints near one centre, also through the finer keys, and some far ones."""
    own = random.Random(5)
    prints = {own.getrandbits(64) for _ in range(40)}
    centre = own.getrandbits(64)
    for _ in range(150):
        prints.add(centre ^ sum(1 << own.randrange(64) for _ in range(own.randrange(5))) & (1 << 64) - 1)
    nodes = sorted(simhash._signed(p) for p in prints)
    near = [(a, b) for a in nodes for b in nodes
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    rows = spark.createDataFrame([(n,) for n in nodes], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(rows, longest=longest)).collect()}
    want = joined(nodes, near)
    assert {n: roots.get(n, n) for n in nodes} == want


def test_components_of_a_long_chain(spark):
    at = lambda step: ((F.col("id") + step) * 8 % 301)
    links = spark.range(300).select(at(0).alias("a"), at(1).alias("b"))
    roots = {r.node: r.root for r in components(links).collect()}
    assert set(roots.values()) == {0} and len(roots) == 300


ITEMS = [("b1", PASSAGE[:200]), ("b2", "one"), ("b10", "ONE two"), ("b3", None), ("b4", "!"),
         ("b5", LONG[300:700]), ("b5", prose(5, 300)[40:200]), (None, "line other")]


@pytest.mark.parametrize("block_words", [1 << 18, 60])
def test_decontamination(spark, docs, nothing, block_words):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
    windows = collections.defaultdict(set)
    for item, t in ITEMS:
        w = words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add(item)
    want, clean = [], 0
    for doc, t in ROWS:
        w, hit, items = words(t), set(), set()
        for i in range(len(w)):
            for n in {len(x) for x in windows}:
                if tuple(w[i:i + n]) in windows and i + n <= len(w):
                    hit |= set(range(i, i + n))
                    items |= windows[tuple(w[i:i + n])]
        clean += not hit
        want.append((doc, len(w), len(hit), tuple(sorted(x for x in items if x))))
    found = decontaminate.find_contamination(docs, bench, block_words=block_words)
    got = found.select("doc_id", "n_words", "n_hit", F.array_sort(F.array_distinct("items")).alias(
        "items"), F.size("matches").alias("n")).collect()
    assert all((r.n_hit > 0) == (r.n > 0) for r in got)
    assert multiset((*r[:3], tuple(r['items'])) for r in got) == multiset(want)
    kept = decontaminate.decontaminate(docs, bench, block_words=block_words)
    assert kept.columns == docs.columns and kept.count() == clean
    assert decontaminate.find_contamination(nothing, bench).collect() == []
    none = decontaminate.find_contamination(docs, bench.where("false"))
    assert none.where("n_hit = 0").count() == len(ROWS)


def test_longest_match(spark):
    text = "u v " + " ".join(f"w{i}" for i in range(30)) + " z"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(5, 40)))],
                                  "item_id long, text string")
    found = decontaminate.find_contamination(docs, bench).first().matches
    assert {(m.word, m.item_word, m.length) for m in found} == {
        (7 + i, i, 25 - i) for i in range(16)}


def test_longest_matches_in_repetitive_texts():
    """Every place against a search of all pairs."""
    own = random.Random(4)
    for trial in range(60):
        items = [[own.choice("ab" if trial % 2 else "abcd") for _ in range(own.randrange(0, 25))]
                 for _ in range(own.randrange(1, 5))]
        texts = [[own.choice("abx" if trial % 3 else "ab") for _ in range(own.randrange(0, 40))] for _ in range(3)]
        window = own.choice([2, 3, 5])
        block = decontaminate.Benchmark.of(list(range(len(items))), [" ".join(i) for i in items], window)
        found = decontaminate._Found(block, pa.array([" ".join(t) for t in texts]))
        want, pairs = {}, set()
        for row, t in enumerate(texts):
            for w in range(len(t)):
                best = 0
                for number, item in enumerate(items):
                    for i in range(len(item)):
                        n = 0
                        while w + n < len(t) and i + n < len(item) and t[w + n] == item[i + n]:
                            n += 1
                        if n >= window or item and len(item) < window and i == 0 and n == len(item):
                            pairs.add((row, number))
                            best = max(best, 0)
                            want.setdefault((row, w), 0)
                        best = max(best, n)
                if (row, w) in want:
                    want[row, w] = best
        got = {}
        for row, word, times, item_word, length, item in found.matches():
            assert items[item][item_word:item_word + length] == texts[row][word:word + length]
            got |= {(row, word + k): length for k in range(times)}
        assert got == want
        assert set(zip(*(x.tolist() for x in found.items()))) == pairs


def test_one_repeated_word_takes_seconds():
    import time
    block = decontaminate.Benchmark.of([1, 2], ["a " * 10_000, "a " * 300 + "b"], 10)
    start = time.time()
    found = decontaminate._Found(block, pa.array(["a " * 1_000_000, "b"]))
    matches = found.matches()
    assert found.covered.sum() == 1_000_000 and [x.tolist() for x in found.items()] == [[0, 0], [0, 1]]
    assert matches[0][4] == 10_000 and matches[0][2] == 990_001
    assert time.time() - start < 60


def thue_morse(letters):
    """Two words that collide in every polynomial hash modulo 2 ** 64."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


def test_words_that_collide_in_rolling_hashes(spark):
    one, other = thue_morse("ab")
    tail = " ".join(f"w{i}" for i in range(34))
    docs = spark.createDataFrame([(1, f"{tail} {one}"), (2, f"{tail} {other}")], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.substring_dedup(docs).collect()] == [0, 0]
    bench = spark.createDataFrame([("i", one)], "item_id string, text string")
    found = decontaminate.find_contamination(docs, bench).collect()
    assert {r.doc_id: (r.n_hit, r["items"]) for r in found} == {1: (1, ["i"]), 2: (0, [])}
    # Bytes: equal in no stretch of 50, and so untouched.
    cut = [(1, one[:49] + "x" + other[100:149]), (2, other[:49] + "y" + one[100:149])]
    rows = spark.createDataFrame(cut, "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.suffix_dedup(rows).collect()] == [0, 0]


def test_line_dedup(docs, nothing):
    def key(line):
        return ascii_lower(line.strip(" \t\n\r\x0b\x0c"))
    lines = [(t or "").split("\n") for _, t in ROWS]
    for least, chars in ((10, 1), (2, 1), (2, 5)):
        n = collections.Counter(k for own in lines for k in {key(x) for x in own} if len(k) >= chars)
        want = []
        for (doc, _), own in zip(ROWS, lines):
            kept = [x for x in own if n[key(x)] < least]
            want.append((doc, len(own), len(own) - len(kept), "\n".join(kept)))
        for most_bytes in (1 << 24, -1):  # arrays in every task; probes sent to the shards
            got = line_dedup.line_dedup(docs, least, chars, most_bytes=most_bytes).collect()
            assert multiset(got) == multiset(want)
    assert line_dedup.line_dedup(nothing).collect() == []


def test_minimal_perfect_hash():
    own = np.random.default_rng(3)
    h, f = own.integers(-2**63, 2**63, (2, 5000))
    counts = own.integers(1, 99, 5000)
    shard = line_dedup.Shard.from_bytes(line_dedup.Shard.build(h, f, counts).to_bytes())
    assert len(shard.counts) == 5000 == np.bitwise_count(shard.bits).sum()
    assert (shard.counts_of(h, f) == counts).all()
    assert not shard.counts_of(h, f + 1).any() and not shard.counts_of(h[::-1].copy() + 1, f + 1).any()


def test_packing(docs, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for capacity in (2048, 64):
        rows = packing.pack(docs, capacity=capacity, with_ids=True).collect()
        want = collections.Counter()
        for doc, t in ROWS:
            ids = [*tokens.encode(t or "", add_special_tokens=False).ids, 0]
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids), capacity), len(ids)]
            for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
                want[doc, n, a, b - a, crc, tuple(ids[a:b])] += 1
        assert multiset((*r[:5], tuple(r.ids)) for r in rows) == want
        bins = collections.defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for own in bins.values():
            own.sort()
            assert [a for a, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
            assert sum(n for _, n in own) <= capacity
        assert len(bins) <= 1.02 * -(-sum(r.length for r in rows) // capacity) + 1
    assert packing.pack(nothing).collect() == []


def test_fullest_combination():
    own = random.Random(1)
    for _ in range(60):
        counts = {own.randrange(1, 30): own.randrange(1, 4) for _ in range(6)}
        room = own.randrange(1, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        chosen = packing.fullest(counts, room)
        assert all(k <= counts[n] for n, k in chosen.items())
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= room)


def test_special_tokens_are_as_the_file_gives_them():
    tokens = packing.Tokens.load("byte_bpe_50k")
    assert 50256 in tokens.ids("a <|endoftext|> b")
    for text in (LONG, "  \n\n é\u2028ñ '" * 5, "don't I'LL 123 ４５"):
        assert tokens.ids(text).tolist() == [*tokens.exact.encode(text, add_special_tokens=False).ids, 0]


# --- secrets -------------------------------------------------------------------------------

KEY = "Zk3" + "aB9x" * 6
SECRETS = [
    (1, f"api_key = 'abcdefgh1' AKIA{'A1' * 8} {'0af' * 12} {KEY}", "s0"),
    (2, f"PassWord: short1 token:{KEY}", "s1"), (3, "AKIA" + "B" * 11 + " " + "f" * 31, "s2"),
    (4, None, None), (5, "", "s0"), (6, "é😀 secret=ÄÄ secret=12345678=", None),
    (7, "Only" + "Here" * 5 + "7", "s4"), (8, "apikey\":\"qwertyuiop", "s1"),
    (8, "apikey\":\"qwertyuiop", "s1"), (9, "ſecret=12345678 Token=12345678", "s3"),
]


def test_secret_scan(spark):
    docs = spark.createDataFrame(SECRETS, "doc_id long, text string, source string").withColumn(
        "hash", F.lit("x"))
    got = secrets.scan_secrets(docs, repo_col="doc_id", owner_col="source").collect()
    plain = re.compile("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
                       "[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?"
                       "([A-Za-z0-9+/_.=-]+)")
    want = collections.Counter()
    for doc, text, _ in SECRETS:
        own = [(m.start(), "assign", m.end()) for m in plain.finditer(text or "") if len(m[2]) >= 8]
        own += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
        own += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
        want[doc, tuple(sorted(own))] += 1
    assert want == collections.Counter((r.doc_id, tuple(
        (s.start, s.kind, s.end) for s in r.spans if s.kind != "token")) for r in got)
    by = {r.doc_id: r.spans for r in got}
    assert [s.kind for s in by[7]] == ["token"]  # one owner
    assert [s.verdict for s in by[1] if s.kind == "token"] == ["shared"]  # KEY has two owners
    assert [s.verdict for s in by[2]] == ["shared"]
    assert secrets.scan_secrets(docs.where("false")).collect() == []


def test_copied_examples_are_told_from_live_values(spark):
    rows = [(i, "token=EXAMPLE1234", f"s{i}") for i in range(6)] + [(9, "token=live123456", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.spans[0] for r in secrets.scan_secrets(docs, repo_col="doc_id").collect()}
    assert got[0].verdict == "example" and (got[0].owners, got[0].repos) == (6, 6)
    assert got[9].verdict == "live"


def test_verdicts_of_tokens_follow_owners_and_repositories(spark):
    """Against counts in plain Python: few owners, many owners, and one owner with many copies."""
    own = random.Random(8)
    keys = ["".join(own.choices("abcdefXYZ", k=22)) + "a7Q" for _ in range(12)]
    # Key 8 has one owner and 25 copies.
    rows = [(n, f"see {k} x", "s0" if i == 8 else f"s{own.randrange(1 + i)}")
            for n, (i, k) in enumerate((i, k) for i, k in enumerate(keys) for _ in range(1 + 3 * i))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    has = collections.defaultdict(set)
    for doc, text, owner in rows:
        for m in secrets.TOKEN.finditer(text):
            has[m[0]].add((doc, owner))
    want = {}
    for doc, text, owner in rows:
        spans = []
        for m in secrets.TOKEN.finditer(text):
            owners, repos = len({o for _, o in has[m[0]]}), len({d for d, _ in has[m[0]]})
            if owners <= 3 and repos <= 20:
                spans.append((m.start(), m.end(), repos, owners, "live" if owners == 1 else "shared"))
        want[doc] = sorted(spans)
    got = secrets.scan_secrets(docs, repo_col="doc_id").collect()
    assert {r.doc_id: [(s.start, s.end, s.repos, s.owners, s.verdict) for s in r.spans] for r in got} == want
    assert {s[-1] for x in want.values() for s in x} == {"live", "shared"} and [] in want.values()
    broken = spark.sql("SELECT 1L AS doc_id, cast(X'FF6162' AS string) AS text, 's' AS source")
    assert secrets.scan_secrets(broken).first().spans == []


# --- language ------------------------------------------------------------------------------


def test_language_id(spark, docs, nothing):
    folder = "/root/testdata/sf0.001/documents.parquet"
    table = spark.read.parquet(folder)
    model = langid.fit(table)
    found = langid.identify(table, model).join(
        table.select("doc_id", "lang", langid.held_out(F.col("doc_id")).alias("held")), "doc_id")
    held = found.where("held").collect()
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.collect())
    odd = langid.identify(docs, model).collect()
    assert len(odd) == len(ROWS)
    letters = [any(c.isalpha() for c in t or "") for _, t in ROWS]
    assert sum(r.lang_pred == "und" for r in odd) == letters.count(False)
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in odd)
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.rejected for r in odd)
    unlabelled = langid.fit(nothing)
    assert {r.lang_pred for r in langid.identify(docs, unlabelled).collect()} == {"und"}
    assert langid.accepted(docs, unlabelled).count() == letters.count(True)
    assert langid.identify(nothing, model).collect() == []


def plain_scores(model, text):
    """Score of each language: subwords taken one by one, averaged, softmax."""
    letters = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
               for c in (text or "").encode()]
    total, n = np.zeros(len(model.weights)), 0
    for order, size in enumerate((2, 3, 4)):
        for i in range(len(letters) - size + 1):
            part = letters[i:i + size]
            if 32 in part[1:-1] or part == [32, 32]:
                continue  # not in one word
            number = sum(c << 8 * k for k, c in enumerate(part)) * 0x9E3779B1 % (1 << 32) >> 18
            total += model.weights[:, order * (1 << 14) + number]
            n += 1
    mean = total / max(1, n)
    logits = ((mean if model.softmax is None else mean @ model.softmax) + model.bias) / model.temperature
    odds = np.exp(logits - logits.max())
    return odds / odds.sum()


def test_predictions_equal_a_plain_scorer(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    both = table.union(docs.select("doc_id", "text", "lang").withColumn(
        "doc_id", -1 - F.coalesce("doc_id", F.lit(0))))
    for dim in (16, 2):  # folded into one number per language, and not
        model = langid.train(*langid.sample(table, "doc_id", "text", "lang", per_language=60), dim=dim)
        assert (model.softmax is None) == (dim == 16)
        want = collections.Counter()
        for r in both.collect():
            scores = plain_scores(model, r.text)
            known = any(c.isalpha() for c in r.text or "")
            want[r.doc_id, model.languages[scores.argmax()] if known else "und",
                 round(scores.max() if known else 0.0, 9),
                 bool(not known or scores.max() < model.threshold)] += 1
        assert want == collections.Counter(
            (r.doc_id, r.lang_pred, round(r.score, 9), r.rejected)
            for r in langid.identify(both, model).collect())


def test_every_label_is_learned(spark):
    """More than a hundred labels; one with long texts only, one with a single text."""
    own = random.Random(8)

    def texts(label, n_words, n=8):
        letters = "".join(chr(0x4E00 + 16 * label + i) for i in range(16))
        words = ["".join(own.choice(letters) for _ in range(3)) for _ in range(12)]
        return [" ".join(own.choice(words) for _ in range(n_words)) for _ in range(n)]

    by_label = {f"l{k:03}": texts(k, 30) for k in range(120)}
    by_label["long"] = texts(200, 3000)
    by_label["single"] = texts(201, 30, 1)
    assert min(len(t.encode()) for t in by_label["long"]) > 16_000
    free = (i for i in range(10_000) if zlib.crc32(str(i).encode()) % 5)
    rows = [(next(free), t, label) for label, own_texts in by_label.items() for t in own_texts]
    rows += [(next(free), None, "null text"), (next(free), "no label", None)] + 3 * rows[-1:]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found, labels = langid.sample(table, "doc_id", "text", "lang")
    assert collections.Counter(labels) == {x: len(t) for x, t in by_label.items()}
    assert collections.Counter(langid.sample(table, "doc_id", "text", "lang", per_language=2)[1]) == {
        x: min(2, len(t)) for x, t in by_label.items()}
    model = langid.train(found, labels)
    assert model.languages == sorted(by_label)
    wanted = {r[0]: r[2] for r in rows if r[1] and r[2]}
    said = {r.doc_id: r.lang_pred for r in langid.identify(table, model).collect()}
    right = collections.Counter(wanted[i] for i in wanted if said[i] == wanted[i])
    assert right["long"] == 8 and right["l000"] == 8 and sum(right.values()) >= 0.95 * len(wanted)


def test_subwords_stay_in_their_text():
    texts = pa.array(["Hello, you", "", None, "ñ", "ab"])
    alone = [langid.text_bytes(texts.slice(i, 1)) for i in range(len(texts))]
    whole = langid.text_bytes(texts)
    for order, bucket in enumerate(langid.subwords(*whole)):
        parts = [list(langid.subwords(*a))[order] for a in alone]
        assert bucket.tolist() == np.concatenate(parts).tolist()
