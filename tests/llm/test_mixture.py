from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from llm import data

from lakeops.llm import mixture as op


def brute_targets(size: dict) -> dict:
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = 1.5 * sum(size.values()), {}
    while True:
        rest = {s: (total - sum(fixed.values())) * weight[s] / sum(weight[x] for x in size if x not in fixed) for s in size if s not in fixed}
        over = [s for s in rest if rest[s] > 2 * size[s]]
        if not over:
            return fixed | rest
        fixed |= {s: 2 * size[s] for s in over}


def test_pivot_keeps_the_sum_and_the_expectation():
    rng = np.random.default_rng(1)
    p = rng.random(40).tolist()
    runs = np.array([op.pivot(list(range(40)), p, seed) for seed in range(3000)])
    assert np.allclose(runs.sum(axis=1), sum(p))
    assert ((runs > 0) & (runs < 1)).sum(axis=1).max() <= 1
    assert np.abs(runs.mean(axis=0) - p).max() < 0.04


def test_mix(spark):
    docs = data.awkward(spark)
    rows = op.mix(docs).collect()
    assert len(rows) == docs.count()
    size = defaultdict(int)
    for r in docs.collect():
        size[r["source"]] += len(data.words(r["text"]))
    goal, taken, largest = brute_targets(size), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in size:
        assert abs(taken[s] - goal[s]) <= largest[s] / 2
    again = op.mix(docs.repartition(3)).select("doc_id", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(type(again[0])(doc_id=r["doc_id"], taken=r["taken"])) for r in rows)


def test_levels_of_the_tree(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 7 as int)) as text", "if(id < 2000, 'hot', 'cold') as source")
    rows = op.mix(docs, bucket=16).groupBy("source").agg({"taken": "sum", "target": "max", "copies": "max"}).collect()
    for r in rows:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 7 and r["max(copies)"] <= 2


def test_sample(spark):
    docs = data.awkward(spark)
    out = op.sample(docs)
    assert out.columns == docs.columns
    copies = {}
    for r in op.mix(docs).collect():
        copies[r["doc_id"], r["rank"], r["source"]] = copies.get((r["doc_id"], r["rank"], r["source"]), 0) + r["copies"]
    found = {(r["doc_id"], r["rank"], r["source"]): r["count"] for r in out.selectExpr("doc_id", "xxhash64(text) as rank", "source").groupBy("doc_id", "rank", "source").count().collect()}
    assert found == {k: v for k, v in copies.items() if v}


def test_empty(spark):
    assert op.mix(data.nothing(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["taken"], r["target"]) for r in op.mix(blank).collect()} == {(0, 0.0)}
