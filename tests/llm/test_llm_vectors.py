from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from lakeops.llm import collision_dedup, forest_search

SHAPE = "vec_id long, embedding array<double>, label int, n_links long, score double, kept string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 9, 0.5, "x") for i, v in rows], SHAPE)


def vectors(n: int, dim: int, seed: int) -> list:
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    for i in range(n // 3, n // 2):  # near copies, of one vector and of many
        base[i] = base[i % 7 if i % 2 else 0] * rng.uniform(0.5, 3) + rng.standard_normal(dim) * 0.04
    base[n // 2] = base[n // 2 + 1]
    return list(enumerate(base.tolist()))


BAD = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [None] * 16), (5004, [float("nan")] * 16), (5005, [float("inf")] + [1.0] * 15), (None, [1.0] * 16)]


def brute_links(rows):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    low = ids.copy()
    while True:
        now = np.array([low[linked[i]].min() for i in range(len(ids))])
        if (now == low).all():
            return {i: (int(linked[k].sum()) - 1, int(low[k])) for k, i in enumerate(ids)}
        low = now


@pytest.mark.parametrize("cell", [2048, 40])
def test_near_duplicates(spark, cell):
    rows = vectors(300, 16, cell)
    found = {r["vec_id"]: r for r in collision_dedup.near_duplicates(table(spark, rows + BAD), cell=cell).collect()}
    assert len(found) == 307
    for i, (n, low) in brute_links(rows).items():
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (n, low, low == i)
    for i in range(5000, 5006):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert found[None]["n_links"] == 0


def test_repeated_rows_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0])]
    found = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in collision_dedup.near_duplicates(table(spark, rows)).collect())
    assert found == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)]
    assert collision_dedup.near_duplicates(table(spark, [])).count() == 0
    with pytest.raises(ValueError, match="lengths"):
        collision_dedup.near_duplicates(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def brute_nearest(rows, query, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    score = (x * x[list(ids).index(query)]).sum(axis=1)
    order = [j for j in np.lexsort((ids, -score)) if ids[j] != query][:k]
    return [(int(ids[j]), score[j]) for j in order]


def test_nearest_is_exact_over_all_leaves(spark):
    rows = vectors(400, 16, 3) + [(1000 + i, [float(i % 5)] * 16) for i in range(1, 60)]  # many ties
    found = forest_search.nearest(table(spark, rows + BAD), leaf=32, share=1.0, chunk=20).collect()
    for q in [i for i, v in rows if i % 20 == 0 and any(v)]:
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        usable = [(i, v) for i, v in rows if any(v)]
        want = brute_nearest(usable, q, 20)
        assert [x[1] for x in got] == [x[0] for x in want]
        assert [x[0] for x in got] == list(range(1, 21)) and np.allclose([x[2] for x in got], [x[1] for x in want])


def test_recall_of_the_calibrated_search(spark):
    rows = vectors(3000, 16, 4)
    found = forest_search.nearest(table(spark, rows), leaf=64).collect()
    hits = [r["vec_id"] in {x[0] for x in brute_nearest(rows, r["query_id"], 20)} for r in found if r["query_id"] % 100 == 0]
    assert len(found) == 3000 and np.mean(hits) >= 0.9


def test_few_candidates(spark):
    found = forest_search.nearest(table(spark, [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (20, [0.5, 0.5])])).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert forest_search.nearest(table(spark, [(20, [1.0, 2.0])])).count() == 0
    assert forest_search.nearest(table(spark, [])).count() == 0


def test_best_leaf_comes_first():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((500, 8))
    trees = [forest_search.Tree(points, 4, rng) for _ in range(3)]
    queries = rng.standard_normal((20, 8))
    own = np.stack([t.leaf(queries) for t in trees], axis=1)
    for q, order in enumerate(forest_search.visits(trees, queries, 48)):
        assert len(set(order)) == 48 and {(t, int(own[q, t])) for t in range(3)} == set(order[:3])


def test_ties_at_the_cut_of_a_chunk_go_to_smaller_ids():
    """Many different vectors of one score: the rows kept do not depend on their order."""
    ids = np.random.default_rng(4).permutation(200)
    rows = pd.DataFrame({"asks": False, "id": ids, "vector": list(np.eye(201)[ids])})
    ask = pd.DataFrame({"asks": [True], "id": [1000], "vector": [np.eye(201)[200]]})
    found = forest_search._score(20)(pd.concat([rows, ask], ignore_index=True))
    assert found["id"].tolist() == list(range(20)) and not found["score"].any()


def test_one_id_with_several_vectors(spark):
    """Each vector has links of its own; a candidate id counts once, with its best score."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.001]), (3, [0.0, 1.0]), (20, [1.0, 0.0]), (20, [0.0, 1.0]), (4, [-1.0, -1.0])]
    found = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in collision_dedup.near_duplicates(table(spark, rows)).collect())
    assert found == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True), (20, 2, 1, False), (20, 2, 1, False)]
    near = sorted(tuple(r) for r in forest_search.nearest(table(spark, rows)).collect())
    assert [(q, n, i) for q, n, i, _ in near] == [(20, 1, 1), (20, 2, 2), (20, 3, 3), (20, 4, 4)]
    assert [round(s, 3) for *_, s in near] == [1.0, 1.0, 1.0, -1.0]
