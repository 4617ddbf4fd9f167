"""Texts longer than what a task works on at a time, against plain versions over whole texts."""

import collections
import random
import zlib

import numpy as np
import pytest
import xxhash

from hirelake.llm import (
    decontaminate, exact_dedup, line_dedup, packing, secrets, simhash, substring_dedup, suffix_dedup)
from hirelake.llm.common import SLICE_BYTES


def words(seed, n):
    own = random.Random(seed)
    return [own.choice(["the", "träge", "ñu", "and"]) + str(own.randrange(n)) for _ in range(n)]


def lines(own):
    return "\n".join(" ".join(own[i:i + 12]) for i in range(0, len(own), 12))


WORDS = words(1, 150_000)
FIRST = lines(WORDS)
# The same, but for every 40th word of its first half.
SECOND = lines([w + "x" if i % 40 == 0 and i < 75_000 else w for i, w in enumerate(WORDS)])
KEY = " api_key = 'q1w2e3r4t5'"
ROWS = [(1, FIRST), (2, SECOND), (3, " ".join(WORDS[-50:])), (4, None), (5, ""), (6, FIRST),
        (7, " ".join(words(2, 80))), (8, " ".join(words(3, 130_000)) + KEY)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(2).cache()


def test_the_texts_are_long():
    assert [d for d, t in ROWS if len((t or "").encode()) > SLICE_BYTES] == [1, 2, 6, 8]


def test_substring_dedup(docs):
    split = [(t or "").split() for _, t in ROWS]
    names = [[hash(tuple(w[i:i + 35])) for i in range(len(w) - 34)] for w in split]
    seen = collections.Counter(x for own in names for x in own)
    want = {}
    for (doc, _), w, own in zip(ROWS, split, names):
        gone = np.zeros(len(w) + 1, int)
        for i, x in enumerate(own):
            if seen[x] > 1:
                gone[i] += 1
                gone[i + 35] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        want[doc] = len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone) if not g)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
           for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == want and 0 < want[2][1] < want[2][0]


def test_suffix_dedup(docs):
    data = [(doc, (t or "").encode()) for doc, t in ROWS]
    first = {}
    for doc, b in data:
        for i in range(len(b) - 49):
            first.setdefault(hash(b[i:i + 50]), doc)
    want = {}
    for doc, b in data:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 49):
            if first[hash(b[i:i + 50])] < doc:
                gone[i] += 1
                gone[i + 50] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        want[doc] = len(b), int(gone.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()
    got = {r.doc_id: (r.n_bytes, r.n_removed, bytes(r.kept))
           for r in suffix_dedup.suffix_dedup(docs).collect()}
    assert got == want and want[6][1] == want[6][0]


def test_exact_dedup(docs):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {1: (6, 2, False), 6: (6, 2, True), 4: (5, 2, False), 5: (5, 2, True),
                   **{i: (i, 1, True) for i in (2, 3, 7, 8)}}


def test_fingerprints(docs):
    def plain(text):
        own = (text or "").lower().encode().split()
        if not own:
            return 0
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(own[i:i + 4]), 42)
                           for i in range(max(1, len(own) - 3))], np.uint64)
        return sum(1 << b for b in range(64)
                   if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_dedup(docs).collect()}
    assert {d: f for d, (f, _) in got.items()} == {d: f"{plain(t):016x}" for d, t in ROWS}
    assert got[6][1] == 1 and got[5][1] == 4


def test_lines(docs):
    split = [(t or "").split("\n") for _, t in ROWS]
    n = collections.Counter(k for own in split for k in {x.strip(" ").lower() for x in own} if k)
    want = {}
    for (doc, _), own in zip(ROWS, split):
        kept = [x for x in own if n[x.strip(" ").lower()] < 3]
        want[doc] = len(own), len(own) - len(kept), "\n".join(kept)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.line_dedup(docs, 3, 1).collect()}
    assert got == want and want[1][1] > 1000


def test_a_passage_at_the_end(spark, docs):
    bench = spark.createDataFrame([("late", " ".join(WORDS[-30:])), ("absent", "a b c d e f g h i j k"),
                                   ("other", KEY + " trap")], "item_id string, text string")
    found = {r.doc_id: (r.n_hit, sorted(r["items"]))
             for r in decontaminate.find_contamination(docs, bench).collect()}
    assert found == {d: (30, ["late"]) if d in (1, 2, 3, 6) else (0, []) for d, _ in ROWS}


def test_a_secret_at_the_end(docs):
    got = secrets.scan_secrets(docs, repo_col="doc_id", owner_col="doc_id").collect()
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind != "token"] for r in got}
    start = ROWS[-1][1].index("api_key")
    assert spans == {**{d: [] for d, _ in ROWS}, 8: [("assign", start, len(ROWS[-1][1]) - 1)]}


def test_pieces(docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for doc, t in ROWS:
        ids = [*tokens.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, n] = a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packing.pack(docs).collect()}
    assert got == want
