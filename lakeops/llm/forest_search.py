"""Approximate nearest neighbours by inner product: a forest of random-projection trees, one priority queue for all of them, exact reranking.

Trees are fitted on a bounded sample: a node's hyperplane is the difference of two of its points, cut at the median. All vectors are filed under one leaf of each tree. A
query's queue holds nodes of all trees, ordered by the least margin on their way from the root (how far the query lies on the node's side, or beyond it); the
best node is taken out and split until the wanted number of leaves has come out. That number is calibrated: the least that reaches `recall` on the sample against brute force.
For inner products vectors get one more component, so that all have one length, and the nearest in angle have the largest product.

Equal vectors are one candidate with its smallest ids: more than k of them can't be among a query's k nearest, as ties go to the smaller id. Leaves
are cut into chunks of a bounded expected row count, and the queries that visit a leaf are dealt out likewise. A task hands on the best candidates of each query,
scored in double precision on the original vectors. Queries that met too few candidates are run again over all leaves.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an id. Rows that repeat an id and its vector are one.
Vectors of different lengths raise an error. An empty table gives an empty result. Further columns of the input are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.vectors import dimension, matrix, pairwise_dot, usable
from lakeops.llm.work import prepare, stored

K, TREES, LEAF, SAMPLE = 20, 8, 512, 16384
RECALL, TRIAL = 0.96, 200
CHUNK = 4096
LOT = 1 << 16  # pairs scored at once


def lengthened(values: np.ndarray, longest: float) -> np.ndarray:
    """Vectors over the greatest length, with one more component that makes them unit vectors."""
    values = values / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (values * values).sum(axis=1, keepdims=True)))
    return np.concatenate([values, rest], axis=1)


def as_queries(values: np.ndarray) -> np.ndarray:
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    return np.concatenate([unit, np.zeros((len(values), 1))], axis=1)


class Tree:
    """A complete tree: planes[level] and cuts[level] have a row for each node of the level."""

    def __init__(self, points: np.ndarray, depth: int, rng: np.random.Generator):
        self.planes, self.cuts = [], []
        node = np.zeros(len(points), np.int64)
        for level in range(depth):
            order = np.argsort(node, kind="stable")
            first = np.searchsorted(node[order], np.arange(2**level))
            last = np.searchsorted(node[order], np.arange(2**level), "right")
            planes = rng.standard_normal((2**level, points.shape[1]))
            cuts = np.zeros(2**level)
            for k in range(2**level):
                inside = order[first[k] : last[k]]
                if len(inside) > 1:
                    a, b = rng.choice(inside, 2, replace=False)
                    if (points[a] != points[b]).any():
                        planes[k] = points[a] - points[b]
                planes[k] /= np.linalg.norm(planes[k])
                if len(inside):
                    cuts[k] = np.median(points[inside] @ planes[k])
            self.planes.append(planes)
            self.cuts.append(cuts)
            node = node * 2 + ((points * planes[node]).sum(axis=1) > cuts[node])

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for planes, cuts in zip(self.planes, self.cuts, strict=True):
            node = node * 2 + ((points * planes[node]).sum(axis=1) > cuts[node])
        return node

    def margins(self, queries: np.ndarray) -> list[np.ndarray]:
        """Signed distance of each query from each plane, level by level."""
        return [queries @ planes.T - cuts for planes, cuts in zip(self.planes, self.cuts, strict=True)]


def visits(trees: list[Tree], queries: np.ndarray, wanted: int) -> Iterator[list[tuple[int, int]]]:
    """For each query the (tree, leaf) that come first out of the queue over all trees."""
    depth = len(trees[0].planes)
    sides = [tree.margins(queries) for tree in trees]
    for q in range(len(queries)):
        queue = [(-math.inf, t, 0, 0) for t in range(len(trees))]
        found: list[tuple[int, int]] = []
        while queue and len(found) < wanted:
            # The first entry is minus the least margin so far: the smallest comes out first.
            worst, t, level, node = heapq.heappop(queue)
            if level == depth:
                found.append((t, node))
                continue
            margin = sides[t][level][q, node]
            heapq.heappush(queue, (max(worst, margin), t, level + 1, node * 2))
            heapq.heappush(queue, (max(worst, -margin), t, level + 1, node * 2 + 1))
        yield found


def calibrated(trees: list[Tree], values: np.ndarray, points: np.ndarray, k: int, recall: float, rng: np.random.Generator) -> float:
    """The share of all leaves that reaches the recall, by queries of the sample against brute force over the sample."""
    total = len(trees) * 2 ** len(trees[0].planes)
    picked = rng.choice(len(values), min(TRIAL, len(values)), replace=False)
    score = values[picked] @ values.T
    score[np.arange(len(picked)), picked] = -np.inf
    k = min(k, len(values) - 1)
    if k < 1:
        return 1.0
    truth = np.argpartition(-score, k - 1, axis=1)[:, :k]
    leaves = np.stack([tree.leaf(points) for tree in trees])
    needed = []
    for q, order in enumerate(visits(trees, as_queries(values[picked]), total)):
        place = {x: i for i, x in enumerate(order)}
        needed += [min(place[t, int(leaves[t, x])] for t in range(len(trees))) + 1 for x in truth[q]]
    return float(np.quantile(needed, recall, method="higher")) / total


def _file(trees: list[Tree], longest: float):
    """Candidates (id, ids, vector) under one leaf of each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = lengthened(matrix(batch.column(2)), longest)
                for t, tree in enumerate(trees):
                    yield pa.record_batch(
                        [*batch.columns, pa.array([t] * batch.num_rows, pa.int32()), pa.array(tree.leaf(points))], names=["id", "ids", "vector", "tree", "leaf"]
                    )

    return run


def _ask(trees: list[Tree], wanted: int):
    """Queries (id, vector) at every leaf they visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = list(visits(trees, as_queries(matrix(batch.column(1))), wanted))
            row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            where = np.array([x for one in found for x in one], np.int64)
            for start in range(0, len(row), 4096):
                some = row[start : start + 4096]
                tree, leaf = where[start : start + 4096].T
                yield pa.record_batch([batch.column(0).take(some), batch.column(1).take(some), pa.array(tree, pa.int32()), pa.array(leaf)], names=["id", "vector", "tree", "leaf"])

    return run


def _score(k: int):
    """The best candidates of each query in one chunk of a leaf."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["asks"].to_numpy(bool)
        queries, candidates = rows[asks], rows[~asks]
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(queries) or not len(candidates):
            return empty
        y = np.array(candidates["vector"].tolist(), np.float64)
        ids = candidates["id"].to_numpy()
        out = []
        for start in range(0, len(queries), 512):
            x = np.array(queries["vector"].iloc[start : start + 512].tolist(), np.float64)
            # All that may be among the best, as this product may round differently; then the score itself.
            rough = x @ y.T
            few = min(len(y), k)
            margin = 4 * x.shape[1] * np.finfo(float).eps * np.linalg.norm(x, axis=1, keepdims=True) * np.linalg.norm(y, axis=1).max()
            owner, best = np.nonzero(rough >= -np.partition(-rough, few - 1, axis=1)[:, few - 1 : few] - margin)
            exact = np.concatenate([pairwise_dot(x[owner[i : i + LOT]], y[best[i : i + LOT]]) for i in range(0, len(owner), LOT)])
            order = np.lexsort((ids[best], -exact, owner))
            order = order[np.arange(len(order)) - np.searchsorted(owner, owner) < k]
            out.append(pd.DataFrame({"query_id": queries["id"].to_numpy()[start + owner[order]], "id": ids[best[order]], "score": exact[order]}))
        return pd.concat(out) if out else empty

    return run


def nearest(
    vectors: DataFrame, queries: str = "vec_id % 20 = 0", id: str = "vec_id", vector: str = "embedding", k: int = K, trees: int = TREES, leaf: int = LEAF,
    sample: int = SAMPLE, recall: float = RECALL, chunk: int = CHUNK, seed: int = 3, share: float | None = None,
) -> DataFrame:
    """The k nearest found of each query, one row each: query_id, rank, vec_id, score.

    `queries` is a condition on vec_id. `share` is the share of all leaves that a query visits; by default it is calibrated for `recall`.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).filter(F.col("vec_id").isNotNull() & usable("vector"))
    # Rows of one vector are ranked within each task before the shuffle, so only k + 1 of them leave it.
    place = F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))
    first = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    same = first.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    same = stored(same.select(F.col("ids")[0].alias("id"), "ids", "vector"), "distinct-vectors")
    shape = "query_id long, rank int, vec_id long, score double"
    dim = dimension(same, "vector")
    if dim is None:
        return spark.createDataFrame([], shape)
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, longest = same.agg(F.count("*"), F.sqrt(F.max(squares))).head()
    part = same.filter(F.pmod(F.xxhash64("vector", F.lit(seed)), F.lit(1 << 30)) < min(1.0, sample / total) * (1 << 30))
    values = np.array([r["vector"] for r in part.orderBy("id").select("vector").collect()], np.float64).reshape(-1, dim)
    points, rng = lengthened(values, longest), np.random.default_rng(seed)
    depth = max(0, math.ceil(math.log2(max(1, len(values)) / leaf)))
    forest = [Tree(points, depth, rng) for _ in range(trees if depth else 1)]
    leaves = len(forest) * 2**depth
    if share is None:
        share = calibrated(forest, values, points, k, recall, rng) if len(values) > 1 else 1.0
    sent = spark.sparkContext.broadcast([(t.planes, t.cuts) for t in forest])

    def forest_of(parts: list) -> list[Tree]:
        out = []
        for planes, cuts in parts:
            tree = Tree.__new__(Tree)
            tree.planes, tree.cuts = planes, cuts
            out.append(tree)
        return out

    kind = dict(same.dtypes)["vector"]
    filed = stored(
        same.mapInArrow(lambda b: _file(forest_of(sent.value), longest)(b), f"id long, ids array<long>, vector {kind}, tree int, leaf long").drop("ids"), "leaves"
    )
    asked = rows.filter(F.expr(queries.replace(id, "vec_id"))).select(F.col("vec_id").alias("id"), "vector").distinct()

    # A vec_id with several vectors fills several places with one candidate: so many more are kept. It is 1 for clean tables.
    most = same.select(F.explode("ids").alias("vec_id")).groupBy("vec_id").count().agg(F.max("count")).head()[0]
    places = (k + 1) * most

    def search(asked: DataFrame, wanted: int) -> DataFrame:
        at = stored(asked.mapInArrow(lambda b: _ask(forest_of(sent.value), wanted)(b), f"id long, vector {kind}, tree int, leaf long"), "visits")
        both = filed.withColumn("asks", F.lit(False)).unionByName(at.withColumn("asks", F.lit(True)))
        full = both.groupBy("tree", "leaf").agg(F.count(F.when(~F.col("asks"), 1)).alias("c"), F.count(F.when(F.col("asks"), 1)).alias("a"))
        parts = [F.greatest(F.lit(1), F.ceil(F.col(x) / chunk)).alias(f"{x}s") for x in ("c", "a")]
        full = stored(full.filter("c > 0 and a > 0").select(F.col("tree").alias("of_tree"), F.col("leaf").alias("of_leaf"), *parts), "chunks")
        dealt = both.join(full, (both.tree == full.of_tree) & (both.leaf == full.of_leaf)).withColumn("own", F.xxhash64("id", F.lit(seed)))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("asks"), F.col("cs")).otherwise(F.col("as")) - 1))
        dealt = dealt.withColumn("other", other).withColumn("own", F.pmod("own", F.when(F.col("asks"), F.col("as")).otherwise(F.col("cs"))))
        dealt = dealt.select(
            "id", "vector", "asks", "tree", "leaf",
            F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")).alias("c"), F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")).alias("a"),
        )
        scored = dealt.groupBy("tree", "leaf", "c", "a").applyInPandas(_score(places), "query_id long, id long, score double")
        # A candidate may come from several trees with the same score: one of them counts. dense_rank keeps repeats together.
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        best = scored.withColumn("place", F.dense_rank().over(order)).filter(F.col("place") <= places).drop("place").distinct()
        best = best.join(same.select("id", "ids"), "id").select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
        best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return stored(best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")

    out = search(asked, max(1, math.ceil(share * leaves)))
    if math.ceil(share * leaves) < leaves:
        least = min(k, rows.select("vec_id").distinct().limit(k + 1).count() - 1)
        counts = out.groupBy("query_id").count().filter(F.col("count") >= least).select(F.col("query_id").alias("id"))
        short = stored(asked.join(counts, "id", "left_anti"), "short")
        if short.head(1):
            out = out.join(counts, out.query_id == counts.id).drop("id").unionByName(search(short, leaves))
    return out
