"""Exact largest inner products: vectors by descending length, partial sums in rotated coordinates, Cauchy-Schwarz bounds.

Vectors are turned into whole numbers and placed by descending length. A rotation by the right singular vectors of the whole table (from its second moments, d x d
numbers) moves most of every vector into the first coordinates. A query meets the vectors in order of length, in chunks: first the longest chunk, which gives each query the score
that a later vector must reach. A query goes on only to chunks whose longest vector could reach it, and stops in a chunk at the first run of vectors too short for
it. What is met is bounded by a partial sum over the first coordinates plus the product of the lengths of the rests; the sums of the pairs that are left grow by more
coordinates until they are out or are scored exactly. Bounds carry a margin for rounding and drop only what is below the least score that counts, so ties
and results are exact; rotation and margin decide about work alone.

Queries come in blocks and vectors in chunks of bounded rows; one task holds one block and one chunk. No chunk is copied to a block none of whose queries reaches it.

Vectors that are null, empty or hold a null or non-finite number, and rows without an id, take no part; zero vectors do. A row is known by its id: rows that repeat an id are one candidate,
or one query, with the best of their scores, and never a candidate of their own id. Ties go to smaller ids. Scores beyond the range of a long are
cut to it. Vectors of different lengths are an error. An empty table gives an empty result. Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.places import positioned
from lakeops.llm.vectors import dimension, matrix
from lakeops.llm.work import prepare, stored

K, EVERY, SCALE = 20, 20, 64
ROWS_BITS, QUERY_BITS = 12, 12  # rows of a chunk, queries of a block, as powers of 2
RUN = 1024  # vectors that are met at once
SHELLS = 512  # lengths that the driver knows, at most
_SLACK = 1e-9
_LARGEST = 2.0**53
_HITS = "block long, slot long, query_id long, vec_id long, score long"


def whole(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Vectors as whole numbers in doubles, with their length, negative so that it ascends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(scale * matrix(batch.column(1)))
            length = np.sqrt((x * x).sum(axis=1))
            packed = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([""] * len(x), pa.string()), batch.column(0), pa.array(-length), packed], names=["tree", "vec_id", "below", "x"])

    return run


def _unpacked(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, d)


def moments(d: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task's sum of x x' as rows of position and value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                x = _unpacked(batch.column(0), d)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * d)), pa.array(total.ravel())], names=["at", "value"])

    return run


def rotation(rows: DataFrame, d: int) -> np.ndarray:
    """Right singular vectors of the table as columns, the largest singular value first."""
    sums = rows.select("x").mapInArrow(moments(d), "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    gram = np.zeros(d * d)
    for row in sums:
        gram[row["at"]] = row["value"]
    peak = np.abs(gram).max()
    if not np.isfinite(peak) or peak == 0:
        return np.eye(d)
    return np.linalg.eigh(gram.reshape(d, d) / peak)[1][:, ::-1].copy()


def _products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers, all pairs. Doubles are exact while no product of two lengths reaches 2**53."""
    if exact:
        return (q @ x.T).astype(np.int64)
    big = [[int(v) for v in row] for row in x]
    out = [[sum(a * b for a, b in zip(r, s, strict=True)) for s in big] for r in ([int(v) for v in row] for row in q)]
    return np.array([[min(max(v, -(2**63)), 2**63 - 1) for v in row] for row in out], np.int64).reshape(len(q), len(x))


class Best:
    """The k best candidates of each query so far, by score and then smaller id; `least` is what a further one must reach."""

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least
        self.query = np.zeros(0, np.int64)
        self.id, self.score = self.query, self.query

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids, score = np.append(self.query, query), np.append(self.id, ids), np.append(self.score, score)
        order = np.lexsort((~score, ids, query))  # ~ turns the order around without overflow
        query, ids, score = query[order], ids[order], score[order]
        fresh = np.append(True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]))[: len(query)]
        query, ids, score = query[fresh], ids[fresh], score[fresh]
        order = np.lexsort((ids, ~score, query))
        query, ids, score = query[order], ids[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        self.query, self.id, self.score = query[kept], ids[kept], score[kept]
        full = np.flatnonzero(rank[kept] == self.k - 1)
        # A double below the score: larger scores than 2**53 are not all doubles.
        least = self.score[full].astype(np.float64)
        self.least[self.query[full]] = np.maximum(self.least[self.query[full]], least - np.abs(least) * _SLACK * (np.abs(least) >= _LARGEST))


def search(q: np.ndarray, q_ids: np.ndarray, least: np.ndarray, x: np.ndarray, x_ids: np.ndarray, turn: np.ndarray, k: int, run: int = RUN) -> Best:
    """The k best vectors of `x`, which comes by descending length, for each query, of those that score `least` or more."""
    best = Best(len(q), k, least.astype(np.float64).copy())
    q_length, x_length = np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    exact = bool(q_length.max(initial=0) * x_length.max(initial=0) < _LARGEST)
    d = q.shape[1]
    cuts = sorted({max(d // 4, 1), max(d // 2, 1)})
    q_turned, x_turned = q @ turn, x @ turn
    q_rest, x_rest = ([np.sqrt((m[:, c:] ** 2).sum(axis=1)) for c in cuts] for m in (q_turned, x_turned))
    for start in range(0, len(x), run):
        here = slice(start, min(start + run, len(x)))
        active = np.flatnonzero(q_length * x_length[start] * (1 + _SLACK) >= best.least)
        if not len(active):
            break
        size = q_length[active, None] * x_length[None, here]
        least_here = best.least[active, None] - _SLACK * size
        part = q_turned[active, : cuts[0]] @ x_turned[here, : cuts[0]].T
        alive = part + q_rest[0][active, None] * x_rest[0][None, here] >= least_here
        if alive.mean() > 0.1:
            scores = _products(q[active], x[here], exact)
            alive &= scores >= best.least[active, None]
            alive &= q_ids[active, None] != x_ids[None, here]
            if here.stop - here.start > k and len(np.unique(x_ids[here])) == here.stop - here.start:
                shown = np.where(alive, scores, np.iinfo(np.int64).min)
                alive &= scores >= np.partition(shown, -k, axis=1)[:, -k, None]
            row, column = np.nonzero(alive)
            found = scores[row, column]
        else:
            row, column = np.nonzero(alive)
            sums = part[row, column]
            for i in range(1, len(cuts)):
                more = slice(cuts[i - 1], cuts[i])
                sums = sums + np.einsum("ij,ij->i", q_turned[active[row], more], x_turned[start + column, more])
                left = sums + q_rest[i][active[row]] * x_rest[i][start + column] >= least_here[row, column]
                row, column, sums = row[left], column[left], sums[left]
            if exact:
                found = np.einsum("ij,ij->i", q[active[row]], x[start + column]).astype(np.int64)
            else:
                found = np.array([_products(q[active[r]][None], x[start + c][None], False)[0, 0] for r, c in zip(row, column, strict=True)], np.int64)
            good = (found >= best.least[active[row]]) & (q_ids[active[row]] != x_ids[start + column])
            row, column, found = row[good], column[good], found[good]
        if len(row):
            best.add(active[row], x_ids[start + column], found)
    return best


def _tile(d: int, turn: np.ndarray, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx") if rows.num_rows else rows
        block = queries.column("block")[0].as_py() if queries.num_rows else 0
        slots, ids = queries.column("slot").to_numpy(), queries.column("vec_id").to_numpy()
        best = search(_unpacked(queries.column("x"), d), ids, queries.column("least").to_numpy(), _unpacked(rows.column("x"), d), rows.column("vec_id").to_numpy(), turn, k)
        return pa.Table.from_arrays(
            [pa.array(np.full(len(best.query), block)), pa.array(slots[best.query]), pa.array(ids[best.query]), pa.array(best.id), pa.array(best.score)],
            names=["block", "slot", "query_id", "vec_id", "score"],
        )

    return run


def top_products(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, rows_bits: int = ROWS_BITS, query_bits: int = QUERY_BITS) -> DataFrame:
    """For each vec_id that `every` divides, the k vectors with the largest inner products of floor(scale * x): query_id, rank, vec_id, score."""
    spark = prepare(vectors.sparkSession)
    number = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id is not null and size(embedding) > 0").filter(number)
    d = dimension(usable, "embedding")
    result = "query_id long, rank int, vec_id long, score long"
    if d is None:
        return spark.createDataFrame([], result)
    rows = stored(positioned(usable.mapInArrow(whole(scale), "tree string, vec_id long, below double, x binary"), ["below", "vec_id"]), "by-length")
    turn = rotation(rows, d)
    rows = rows.withColumn("chunk", F.shiftright("idx", rows_bits))
    asking = rows.filter(F.col("vec_id") % every == 0).select("tree", "vec_id", "below", "x")
    asking = positioned(asking, ["below", "vec_id"]).withColumnRenamed("idx", "slot").withColumn("block", F.shiftright("slot", query_bits))
    asking = stored(asking.select("block", "slot", "vec_id", "below", "x"), "queries")
    tile = _tile(d, turn, k)
    # The longest chunk for all queries.
    first = asking.withColumn("least", F.lit(float("-inf"))).withColumn("chunk", F.lit(0).cast("long"))
    copies = stored(asking.select("block").distinct().withColumn("chunk", F.lit(0).cast("long")), "blocks")
    longest = rows.filter("chunk = 0").join(copies, "chunk").select("block", "chunk", "idx", "vec_id", "x")
    hits = stored(first.groupBy("block", "chunk").cogroup(longest.groupBy("block", "chunk")).applyInArrow(tile, _HITS), "first-hits")
    # How far each query goes: chunks come in shells, the driver knows the longest vector of each.
    last = rows.agg(F.max("chunk")).head()[0]
    if last:
        per = -(-last // SHELLS)
        shells = rows.filter("chunk > 0").groupBy(((F.col("chunk") - 1) / per).cast("long").alias("shell")).agg((-F.min("below")).alias("length")).orderBy("shell").collect()
        lengths = F.array(*(F.lit(float(r["length"])) for r in shells))
        least = hits.groupBy("slot").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("low"))
        least = least.select("slot", F.when(F.col("n") >= k, F.col("low") - F.abs("low") * _SLACK * (F.abs("low") >= _LARGEST).cast("int")).alias("least"))
        going = asking.join(least, "slot", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
        shells_met = F.size(F.filter(lengths, lambda v: v * -F.col("below") * (1 + _SLACK) >= F.col("least")))
        going = stored(going.withColumn("reach", F.least(shells_met.cast("long") * per, F.lit(last).cast("long"))).filter("reach > 0"), "queries-on")
        tiles = going.groupBy("block").agg(F.max("reach").alias("to")).select("block", F.explode(F.sequence(F.lit(1).cast("long"), "to")).alias("chunk"))
        tiles = stored(tiles, "tiles")
        left = going.join(tiles, "block").filter("chunk <= reach").select("block", "chunk", "slot", "vec_id", "least", "x")
        right = rows.join(tiles, "chunk").select("block", "chunk", "idx", "vec_id", "x")
        more = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(tile, _HITS)
        hits = stored(hits.unionByName(more), "hits")
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
