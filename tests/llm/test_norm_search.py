from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lakeops.llm import norm_search

SHAPE = "vec_id long, embedding array<float>, label int, score long, chunk long"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2) for i, v in rows], SHAPE)


def brute(rows, k=20, every=20):
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        best = {}
        for own in (v for i, v in good if i == q):
            for i, v in good:
                if i != q:
                    score = min(max(sum(a * b for a, b in zip(own, v, strict=True)), -(2**63)), 2**63 - 1)
                    best[i] = max(score, best.get(i, -(2**70)))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n + 1, i, s) for n, (i, s) in enumerate(ranked)]
    return out


def found(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(n, seed, spread):
    """Vectors with some direction in common, lengths that fall, ties, copies and zeros."""
    rng = random.Random(seed)
    axis = [rng.gauss(0, 1) for _ in range(8)]
    rows = []
    for i in range(n):
        size = 1 / (1 + spread * rng.random() * 20)
        rows.append((i, [size * (a + 0.3 * rng.gauss(0, 1)) for a in axis]))
    rows += [(1000 + i, rows[3][1]) for i in range(70)] + [(2000 + i, [0.0] * 8) for i in range(30)]
    rows += [(3000, None), (3020, []), (3040, [None] * 8), (3060, [float("nan")] * 8), (3080, [float("inf")] * 8), (None, rows[1][1])]
    rows += [rows[0], rows[0], (40, rows[7][1]), (5, rows[9][1]), (-20, rows[2][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("spread", "bits"), [(0, 4), (1, 4), (1, 12)])
def test_same_as_all_pairs(spark, spread, bits):
    rows = vectors(400, spread, spread)
    assert found(norm_search.top_products(table(spark, rows), rows_bits=bits, query_bits=3)) == brute(rows)


def test_few_and_none(spark):
    assert found(norm_search.top_products(table(spark, []))) == []
    rows = [(0, [1, 2]), (1, [-1, 0.5]), (20, [3, 3])]
    assert found(norm_search.top_products(table(spark, rows))) == brute(rows)
    with pytest.raises(ValueError, match="lengths"):
        norm_search.top_products(table(spark, [(0, [1]), (1, [1, 2])]))


def test_huge_numbers(spark):
    rows = [(i, [(-1) ** i * 10.0 ** (i % 30), 1.5 * i, 2.0**40]) for i in range(60)]
    assert found(norm_search.top_products(table(spark, rows), rows_bits=4)) == brute(rows)


def test_pruning_saves_products(monkeypatch):
    rng = np.random.default_rng(5)
    x = np.floor(64 * rng.normal(size=(4000, 32)) * np.exp(-np.arange(32) / 4) * rng.pareto(2, size=(4000, 1)))
    x = x[np.argsort(-np.linalg.norm(x, axis=1))]
    ids, done = np.arange(4000), []
    plain = norm_search._products
    monkeypatch.setattr(norm_search, "_products", lambda q, x, exact: (done.append(len(q) * len(x)), plain(q, x, exact))[1])
    turn = np.linalg.svd(x, full_matrices=False)[2].T
    best = norm_search.search(x[:50], ids[:50], np.full(50, -np.inf), x, ids, turn, 20, run=250)
    assert sum(done) < 0.3 * 50 * 4000
    scores = (x[:50] @ x.T).astype(int)
    np.fill_diagonal(scores, -(10**15))
    for q in range(50):
        want = sorted(range(4000), key=lambda i: (-scores[q, i], i))[:20]
        assert best.id[best.query == q].tolist() == want
