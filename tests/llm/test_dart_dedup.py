from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from llm import data

from lakeops.llm import dart_dedup as op
from lakeops.llm.graph import components


def shingle_set(text) -> set:
    w = data.words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows: list[tuple]) -> dict:
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in sets}


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 800).astype(np.uint64), rng.integers(0, 2**63, 200).astype(np.uint64)
    values = np.concatenate([a, a[:600], b, a[:3], a])
    weights = np.concatenate([np.ones(800), np.ones(800), np.ones(3), np.full(800, 2.5)])
    found = op.throw_darts(values, weights, np.array([0, 800, 1600, 1603, 1603, 2403]), 2000)
    assert abs((found[0] == found[1]).mean() - 0.6) < 0.04
    assert abs((found[0] == found[4]).mean() - 0.4) < 0.04  # weights 1 against 2.5
    assert not found[3].any() and len(set(found[2].tolist())) > 100


def test_chains_and_large_groups(spark):
    """Copies that are each near a base, but hardly near each other, and copies of copies."""
    rng = random.Random(8)
    rows, n = [], 0
    for size in (1, 2, 30, 60):
        base = data.prose(rng, 150).split()
        for k in range(size):
            w = list(base)
            for i in rng.sample(range(150), 4 if k % 2 else 2):
                w[i] = f"edit{rng.randrange(10**6)}"
            rows.append((n := n + 1, " ".join(w)))
        rows.append((n := n + 1, " ".join(base)))
    for k in range(12):  # a chain: each is near the next one alone
        rows.append((n := n + 1, " ".join(f"c{i}" for i in range(12 * k, 12 * k + 150))))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in op.near_duplicates(docs).collect()}
    assert found == brute(rows)


def bands_of(texts: list[str]) -> list[set]:
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    return [set(x) for out in op._signatures(op.SHINGLE, op.BANDS, op.ROWS)([batch]) for x in out.column(4).to_pylist()]


def test_pair_that_shares_one_band_only(spark):
    """Two near texts meet in one bucket alone, whose smallest document is near to neither."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(184)]

    def edited(n: int) -> str:
        places = rng.sample(range(4, 180, 5), n)  # each takes five shingles
        return " ".join(f"edit{rng.randrange(10**9)}" if i in places else w for i, w in enumerate(base))

    x = " ".join(base)
    near, far = [edited(4) for _ in range(6000)], [edited(8) for _ in range(3000)]  # 160 of 200 shingles in common, 140 of 220
    own, of_near, of_far = bands_of([x])[0], bands_of(near), bands_of(far)
    meet = [(y, own & b) for y, b in zip(near, of_near, strict=True) if len(own & b) == 1]
    y, leader = next((y, z) for y, band in meet for z, b in zip(far, of_far, strict=True) if band <= b)
    rows = [(1, leader), (2, x), (3, y)]
    found = {r["doc_id"]: r["class_id"] for r in op.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows) == {1: 1, 2: 2, 3: 2}


def test_awkward_rows(spark):
    docs = data.awkward(spark)
    rows = op.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    plain = [(r["doc_id"], r["text"]) for r in docs.filter("doc_id is not null").collect()]
    want = brute(plain)
    for r in rows:
        if r["doc_id"] is None:
            assert r["class_id"] is None and r["kept"]
        else:
            assert r["class_id"] == want[r["doc_id"]] and r["kept"] == (r["class_id"] == r["doc_id"])
    out = op.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    assert sorted(x for x in kept if x is not None) == sorted(set(want.values())) and kept.count(None) == 2
    assert op.near_duplicates(data.nothing(spark)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, x) for x in range(201, 400)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(300)] + [(7, 7)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: root(x) for x in parent if root(x) != x}
