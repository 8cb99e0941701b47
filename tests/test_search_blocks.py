from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from lakeops.operators import vectors


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_scan_holds_few_rows(monkeypatch, metric):
    """The best of many batches, with ties and repeated ids; what is held between merges does not grow with the queries times all documents."""
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(900, 8)), 1)
    x[450:500] = x[:50]
    docs = pd.DataFrame({"doc_id": np.arange(900), "_vec": list(x)})
    queries = pd.DataFrame({"query_id": np.arange(300), "_vec": list(x[:300])})
    monkeypatch.setattr(vectors, "_DOCS_AT_ONCE", 64)
    monkeypatch.setattr(vectors, "_CELLS_AT_ONCE", 4096)
    held, best = [], vectors._best
    monkeypatch.setattr(vectors, "_best", lambda owner, ids, scores, k: held.append(len(owner)) or best(owner, ids, scores, k))
    found = vectors._scan(queries, iter(docs.iloc[i : i + 200] for i in range(0, 900, 200)), 5, metric, vectors._Dense, True)
    units = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    scores = units @ units.T if metric == "cosine" else x @ x.T if metric == "dot" else -((x[:, None] - x[None]) ** 2).sum(axis=2)
    scores = np.round(scores, 9)
    np.fill_diagonal(scores, -np.inf)
    for q in range(300):
        want = np.lexsort((np.arange(900), -scores[q]))[:5]
        assert found[found["query_id"] == q]["doc_id"].tolist() == want.tolist()
    assert max(held) < 100_000 + 300 * 64


def test_blocks_bound_the_kept_rows(spark, monkeypatch):
    """Many queries with a long list each go in blocks, with the same rows."""
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(400)], "doc_id bigint, embedding array<double>")
    find = lambda: {tuple(r) for r in vectors.knn(docs, docs, 7, query_id="doc_id", exclude_self=True).collect()}
    want, sizes = find(), []
    monkeypatch.setattr(vectors, "KEPT_AT_ONCE", 700)
    blocks = vectors._blocks
    monkeypatch.setattr(vectors, "_blocks", lambda q, *rest: sizes.append(q.select("_block").distinct().count()) or blocks(q, *rest))
    assert find() == want and sizes[0] >= 4
