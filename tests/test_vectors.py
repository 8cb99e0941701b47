from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import rows

from lakeops.functions.text import hash_embedder
from lakeops.operators import vectors


def points(spark, n=80, dim=6, seed=1):
    """A third of the points are copies of one, one is zero."""
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)).round(3)
    data[::3] = data[0]
    data[1] = 0
    found = [(i, [float(x) for x in data[i]], "even" if i % 2 == 0 else "odd") for i in range(n)]
    return data, spark.createDataFrame(found, "doc_id long, embedding array<float>, parity string").repartition(5)


def brute(data, q, k, metric, allowed):
    def score(a, b):
        if metric == "l2":
            return -float(((a - b) ** 2).sum())
        value = float(a @ b)
        if metric == "cosine":
            value /= (np.sqrt(a @ a) or 1) * (np.sqrt(b @ b) or 1)
        return value

    scored = sorted(((-round(score(q.astype(np.float32).astype(float), data[i].astype(np.float32).astype(float)), 9), i) for i in allowed))
    return [i for _, i in scored[:k]]


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("query_bytes", [vectors.QUERY_BYTES, 800])
def test_exact_search_equals_brute_force(spark, metric, query_bytes):
    data, docs = points(spark)
    found = vectors.knn(docs, docs, 5, metric, query_id="doc_id", exclude_self=True, query_bytes=query_bytes)
    got: dict = {}
    for q, _, d, _ in rows(found, "query_id", "rank"):
        got.setdefault(q, []).append(d)
    for q in range(len(data)):
        assert got[q] == brute(data, data[q], 5, metric, [i for i in range(len(data)) if i != q])


def test_filtered_search_and_few_documents(spark):
    data, docs = points(spark)
    found = vectors.knn(docs, docs, 100, "dot", query_id="doc_id", filters=[("parity", "parity")])
    got = [d for q, _, d, _ in rows(found, "query_id", "rank") if q == 4]
    assert got == brute(data, data[4], 100, "dot", range(0, 80, 2))


def test_all_cells_probed_is_exact(spark):
    _, docs = points(spark)
    centres = vectors.train_cells(docs, 4)
    exact = rows(vectors.knn(docs, docs, 5, query_id="doc_id"), "query_id", "rank")
    cells = vectors.cell_knn(docs, docs, centres, 5, probes=4, query_id="doc_id", rows_per_task=10)
    assert rows(cells, "query_id", "rank") == exact


def test_sparse_equals_brute_force(spark):
    docs = {i: {f"t{j}": 1.0 + (i * j) % 5 for j in range(i % 7)} for i in range(60)}
    queries = {i: {f"t{j}": 0.5 + j for j in range(i, i + 3)} for i in range(8)}
    schema = "doc_id int, terms map<string,double>"
    corpus = spark.createDataFrame(list(docs.items()), schema)
    asked = spark.createDataFrame(list(queries.items()), schema.replace("doc_id", "query_id"))
    for limit in (vectors.ROWS_PER_CHUNK, 5):
        got: dict = {}
        for q, _, d, s in rows(vectors.sparse_topk(asked, corpus, 4, rows_per_salt=limit), "query_id", "rank"):
            got.setdefault(q, []).append((d, s))
        for q, terms in queries.items():
            scored = [(round(sum(w * docs[d].get(t, 0) for t, w in terms.items()), 9), d) for d in docs if terms.keys() & docs[d].keys()]
            best = sorted(scored, key=lambda x: (-x[0], x[1]))[:4]
            assert got.get(q, []) == [(d, s) for s, d in best]


def test_hybrid_and_recall(spark):
    schema = "query_id int, rank int, doc_id int, score double"
    dense = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 11, 0.5)], schema)
    sparse = spark.createDataFrame([(1, 1, 11, 7.0), (1, 2, 12, 7.0)], schema)
    fused = rows(vectors.hybrid_topk(dense, sparse, 3), "rank")
    assert fused == [(1, 1, 10, 0.5), (1, 2, 11, 0.5), (1, 3, 12, 0.5)]
    ranked = rows(vectors.hybrid_topk(dense, sparse, 1, "rrf"), "rank")
    assert ranked == [(1, 1, 11, round(0.5 / 62 + 0.5 / 61, 9))]
    assert rows(vectors.recall_at_k(dense, sparse, 2)) == [(1, 0.5)]
    assert rows(vectors.recall_at_k(dense, sparse.filter("query_id = 2"), 2)) == [(1, 0.0)]


def test_embedding_and_terms(spark):
    df = spark.createDataFrame([(1, "Alpha beta\n alpha"), (2, "  ")], "id int, text string")
    kept = vectors.prepare_texts(df, "text", max_length=50, pieces=2)
    (row,) = vectors.embed(kept, "text", hash_embedder).collect()
    assert math.isclose(sum(x * x for x in row["embedding"]), 1.0)
    assert vectors.sparse_vectors(df, "id", "text").collect()[0]["terms"] == {"alpha": 1.693147, "beta": 1.0}
    assert vectors.vocabulary(vectors.sparse_vectors(df, "id", "text")).count() == 2
    empty = vectors.sparse_vectors(df.filter("id = 2"), "id", "text")
    assert vectors.vocabulary(empty, fallback=3).count() == 3
    zero = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<float>")
    assert [r[0] for r in zero.select(vectors.normalize("v")).collect()] == [[0.0, 0.0], [0.6, 0.8]]


@pytest.mark.parametrize("negative", [False, True])
def test_sparse_search_cuts_nothing_that_counts(spark, negative):
    """Frequent cheap terms and rare dear ones, ties at the cut, a query without a hit; negative weights switch the cuts off."""
    rng = np.random.default_rng(5)
    docs = {i: {f"t{j}": float(rng.integers(1, 4)) for j in range(12) if rng.random() < 0.9 / (1 + j)} | {"all": 1.0} for i in range(300)}
    queries = {q: {f"t{j}": float(rng.integers(1, 30)) / 10 for j in rng.choice(12, 4, replace=False)} | {"all": 0.25} for q in range(20)}
    queries[99], docs[999] = {"nowhere": 1.0}, {}
    if negative:
        queries[3]["t1"] = -2.0
    schema = "doc_id int, terms map<string,double>"
    found = vectors.sparse_topk(spark.createDataFrame(list(queries.items()), schema.replace("doc_id", "query_id")), spark.createDataFrame(list(docs.items()), schema), 5)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    got: dict = {}
    for q, _, d, s in rows(found, "query_id", "rank"):
        got.setdefault(q, []).append((d, s))
    for q, terms in queries.items():
        scored = [(round(sum(w * docs[d].get(t, 0) for t, w in terms.items()), 9), d) for d in docs if terms.keys() & docs[d].keys()]
        best = sorted(scored, key=lambda x: (-x[0], x[1]))[:5]
        assert got.get(q, []) == [(d, s) for s, d in best]


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_codes_find_most_neighbours(spark, metric):
    rng = np.random.default_rng(2)
    data = (rng.normal(size=(20, 16))[rng.integers(0, 20, 600)] + rng.normal(size=(600, 16)) * 0.5).round(4)
    frame = [(i, [float(x) for x in row]) for i, row in enumerate(data)] + [(1000, None)]
    docs = spark.createDataFrame(frame, "doc_id long, embedding array<float>")
    books = vectors.train_codebooks(docs, 4, 32, metric=metric)
    assert [b.shape for b in books] == [(32, 4)] * 4
    coded = vectors.encode(docs, books, metric=metric)
    assert coded.count() == 600 and {len(r["code"]) for r in coded.collect()} == {4}
    asked = docs.filter("doc_id % 30 = 0")
    truth = vectors.knn(asked, docs, 5, metric, query_id="doc_id", exclude_self=True)
    for limit in (vectors.QUERY_BYTES, 200):
        found = vectors.coded_knn(asked, coded, docs, books, 5, metric, rerank=8, query_id="doc_id", exclude_self=True, query_bytes=limit)
        assert vectors.recall_at_k(truth, found, 5).agg({"recall": "avg"}).head()[0] >= 0.9
        hit = truth.join(found, ["query_id", "doc_id"]).select(truth["score"].alias("a"), found["score"].alias("b")).collect()
        assert hit and all(math.isclose(r["a"], r["b"], abs_tol=1e-6) for r in hit)
    whole = vectors.coded_knn(asked, coded, docs, books, 5, metric, rerank=200, query_id="doc_id", exclude_self=True)
    assert [r[:3] for r in rows(whole, "query_id", "rank")] == [r[:3] for r in rows(truth, "query_id", "rank")]


def test_few_vectors_have_few_codes(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])], "doc_id long, embedding array<float>")
    books = vectors.train_codebooks(docs, 16, 256)
    assert [len(b) for b in books] == [2, 2]
    found = vectors.coded_knn(docs, vectors.encode(docs, books), docs, books, 2, query_id="doc_id", exclude_self=True)
    assert rows(found.select("query_id", "doc_id"), "query_id", "doc_id") == [(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)]
