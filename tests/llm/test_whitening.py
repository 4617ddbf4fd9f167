"""Whitening against a dense computation over exact fractions and numpy."""

import collections
import math
from fractions import Fraction

import numpy as np
import pytest

from hirelake.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n long, component int, id string, vec string, x string"


def plain(rows, most=16):
    """vec_id, n, deviation and the matrices of the fit."""
    good = [(i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = collections.Counter(len(x) for _, x in good)
    d = max(lengths, key=lambda k: (lengths[k], k))
    good = [(i, x) for i, x in good if len(x) == d]
    fit = sorted({tuple(x) for _, x in good})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    cov = np.array([[float(sum(Fraction(n * x[a] - total[a]) * (n * x[b] - total[b]) for x in fit) / n ** 3)
                     for b in range(d)] for a in range(d)])
    dev = [(i, x, sum((n * c - s) ** 2 for c, s in zip(x, total))) for i, x in good]
    return n, total, cov, fit, dev


def check(spark, rows, most=16):
    frame = spark.createDataFrame([(i, v) + (None,) * 5 for i, v in rows], SCHEMA).repartition(3)
    made = whitening.fit(frame, components=most)
    got = whitening.whiten(frame, made).collect()
    n, total, cov, fit, dev = plain(rows)
    e = np.linalg.eigvalsh(cov)[::-1]
    assert np.allclose(made.covariance, cov, rtol=1e-12, atol=1e-12 * abs(cov).max())
    k = len(made.values)
    assert k == min(most, int((e > e.sum() * len(e) * 2.3e-16).sum()))
    assert np.allclose(made.values, e[:k], rtol=1e-9)
    assert np.allclose(cov @ made.components, made.components * made.values, atol=1e-9 * e[0])
    assert np.allclose(made.components.T @ made.components, np.eye(k), atol=1e-12)
    want = collections.Counter((i, c, n, v) for i, _, v in dev for c in range(1, k + 1))
    assert collections.Counter((r.vec_id, r.component, r.n, int(r.deviation)) for r in got) == want
    scale = made.components / np.sqrt(made.values)
    white = collections.defaultdict(list)
    for i, x, v in dev:
        y = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, total)]) @ scale
        for c in range(k):
            white[i, c + 1, v].append(y[c])
    for r in got:
        assert min(abs(r.whitened - w) for w in white[r.vec_id, r.component, int(r.deviation)]) < 1e-7
        assert abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9
        assert r.identity_error == made.identity_error <= 1e-6
    return got


def test_odd_rows(spark):
    own = np.random.default_rng(1)
    base = own.normal(size=(90, 6)) @ own.normal(size=(6, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(3, rows[4][1]), (None, rows[5][1]), (None, rows[5][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [1.0] * 5 + [None]), (304, [float("nan")] * 6),
             (305, [1.0] * 5 + [float("inf")]), (306, [-0.0, 1e-300, -1e-300, 0.015625, -0.015625, 5.0])]
    check(spark, rows)
    check(spark, rows, most=3)


def test_large_entries_stay_exact(spark):
    own = np.random.default_rng(2)
    rows = [(i, (v * 1e8).tolist()) for i, v in enumerate(own.normal(size=(40, 4)))]
    check(spark, rows)


def test_more_dimensions_than_vectors(spark):
    own = np.random.default_rng(3)
    check(spark, [(i, v.tolist()) for i, v in enumerate(own.normal(size=(5, 20)))])


def test_no_variance(spark):
    frame = lambda rows: spark.createDataFrame([(i, v) + (None,) * 5 for i, v in rows], SCHEMA)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(frame(rows), whitening.fit(frame(rows)))
        assert got.collect() == []
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_sums_of_pairs():
    y = np.array([[1, -2, 3], [4, 5, -6], [1 << 40, 0, -(1 << 40)]])
    one, two = whitening.pair_squares(y)
    plain = [[int(a) for a in row] for row in y]
    assert list(one) == [sum(r[i] ** 2 for r in plain) for i in range(3)]
    assert list(two) == [sum((r[i] + r[j]) ** 2 for r in plain) for i, j in ((0, 1), (0, 2), (1, 2))]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    from hirelake.llm.queries import QUERIES
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = check(spark, rows)
    made = QUERIES["op13_embedding_whitening"](spark, folder).collect()
    fields = lambda r: (r.vec_id, r.component, r.n, int(r.deviation), round(r.explained, 12))
    assert sorted(map(fields, made)) == sorted(map(fields, got))
