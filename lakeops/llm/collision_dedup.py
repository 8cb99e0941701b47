"""Near-duplicate vectors by collision-counting projections.

Unit vectors are projected on many random directions. Along each direction a query's window reaches a fixed distance to either side of it; a pair collides
if one lies in the other's window. Two vectors within the wanted cosine collide along most directions, others along few: pairs with enough collisions are
verified by their exact cosine. The window and the least count are calibrated by drawn pairs at the threshold itself, so that `recall` of them pass.

Not every pair meets. Rows are cut into cells by medians of the leading projections; a query visits the cells that its (wider) window reaches, and within a cell
the projections are sorted, so a window is a range of ranks. Cells are cut into chunks of a bounded expected row count, and visits are dealt out in the same way,
so no task holds a large cell. A task gives back link counts and a spanning forest of its links, not the links.

The work still grows faster than the rows: random directions in 64 dimensions tell little, so at cosine 0.95 a query visits most cells of a small table.

Equal vectors are one class with a count. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing: n_links 0, own component, kept;
so do rows without a vec_id (null component). Rows that repeat a vec_id and its vector count as one vector. An empty table gives an empty result.
Vectors of different lengths raise an error. Further columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.graph import components
from lakeops.llm.vectors import dimension, matrix, pairwise_dot, usable
from lakeops.llm.work import prepare, stored

COSINE = 0.95
PROJECTIONS, WIDTH = 24, 2.0  # WIDTH and REACH: half windows, in standard deviations of a pair at the threshold
REACH = 4.0
RECALL = 0.9995
CELL, SAMPLE = 8192, 65536
_TILE = 128


def directions(dim: int, n: int, seed: int) -> np.ndarray:
    """n unit directions as columns, orthogonal as far as they can be."""
    rng, out = np.random.default_rng(seed), []
    while sum(x.shape[1] for x in out) < n:
        out.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
    return np.concatenate(out, axis=1)[:, :n]


def calibrate(axes: np.ndarray, chord: float, half: float, recall: float, seed: int, draws: int = 200_000) -> int:
    """The least collision count that `recall` of random pairs at distance `chord` reach."""
    rng, dim = np.random.default_rng(seed), axes.shape[0]
    counts = np.zeros(draws, np.int64)
    for start in range(0, draws, 20_000):
        apart = rng.standard_normal((20_000, dim))
        apart *= chord / np.linalg.norm(apart, axis=1, keepdims=True)
        counts[start : start + 20_000] = (np.abs(apart @ axes) <= half).sum(axis=1)
    return int(np.quantile(counts, 1 - recall, method="lower"))


def median_cuts(points: np.ndarray, depth: int) -> list[np.ndarray]:
    """cuts[d][node]: the median of projection d among the sample points in the node, level by level."""
    node, cuts = np.zeros(len(points), np.int64), []
    for level in range(depth):
        value = points[:, level]
        order = np.lexsort((value, node))
        first = np.searchsorted(node[order], np.arange(2**level))
        last = np.searchsorted(node[order], np.arange(2**level), "right")
        middle = np.minimum((first + last) // 2, len(points) - 1)
        cut = value[order][middle]
        cuts.append(cut)
        node = node * 2 + (value > cut[node])
    return cuts


def cells_of(points: np.ndarray, cuts: list[np.ndarray], reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every cell within `reach` of each point along all cut projections; with reach 0, its own."""
    row, node = np.arange(len(points)), np.zeros(len(points), np.int64)
    for level, cut in enumerate(cuts):
        gap = points[row, level] - cut[node]
        low, high = gap <= reach, gap > -reach if reach else gap > 0
        row, node = np.concatenate([row[low], row[high]]), np.concatenate([node[low] * 2, node[high] * 2 + 1])
    return row, node


def _units(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _place(axes: np.ndarray, cuts: list[np.ndarray], reach: float):
    """Rows (id, n, unit) to (id, n, unit, cell, home): the home cell first, then the visited ones, home included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _units(matrix(batch.column(2)))
            points = unit @ axes[:, : max(1, len(cuts))]
            raw = pa.array([x.tobytes() for x in unit], pa.binary())
            for reach_now, home in ((0.0, True), (reach, False)):
                row, cell = cells_of(points, cuts, reach_now)
                at = pa.array(row)
                for start in range(0, len(row), 8192):
                    some = at[start : start + 8192]
                    yield pa.record_batch(
                        [batch.column(0).take(some), batch.column(1).take(some), raw.take(some), pa.array(cell[start : start + 8192]), pa.array([home] * len(some))],
                        names=["id", "n", "unit", "cell", "home"],
                    )

    return run


def linked_pairs(visits: np.ndarray, homes: np.ndarray, axes: np.ndarray, half: float, least: int, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(visit, home) numbers of the pairs with at least `least` window collisions and at least the wanted cosine."""
    ahead, here = visits @ axes, homes @ axes
    kind = np.uint16 if len(homes) < 65535 else np.uint32
    ranks, lows, spans = [], [], []
    early = -(-2 * axes.shape[1] // 3)
    for k in range(axes.shape[1]):
        order = np.argsort(here[:, k], kind="stable")
        rank = np.empty(len(homes), kind)
        rank[order] = np.arange(len(homes), dtype=kind)
        line = here[order, k]
        low = np.searchsorted(line, ahead[:, k] - half).astype(kind)
        high = np.searchsorted(line, ahead[:, k] + half, "right").astype(kind)
        ranks.append(rank)
        lows.append(low)
        spans.append(high - low)
    for start in range(0, len(visits), _TILE):
        end = min(len(visits), start + _TILE)
        count = np.zeros((end - start, len(homes)), np.uint8)
        for rank, low, span in zip(ranks[:early], lows, spans, strict=False):
            # Ranks below the window wrap around to large numbers.
            count += (rank[None, :] - low[start:end, None]) < span[start:end, None]
        # Only pairs that can still reach the least count are counted on the other projections.
        hope = np.flatnonzero(count >= max(0, least - (len(ranks) - early)))
        for part in range(0, len(hope), 65536):
            at = hope[part : part + 65536]
            a, b, total = at // len(homes) + start, at % len(homes), count.ravel()[at]
            for rank, low, span in zip(ranks[early:], lows[early:], spans[early:], strict=True):
                total += (rank[b] - low[a]) < span[a]
            a, b = a[total >= least], b[total >= least]
            ok = pairwise_dot(visits[a], homes[b]) >= cosine
            yield a[ok], b[ok]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node number reachable from each of n nodes by the links (a, b)."""
    low = np.arange(n)
    while True:
        before = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        low = low[low]
        if (low == before).all():
            return low


def _meet(axes: np.ndarray, half: float, least: int, cosine: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        unit = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows), -1)
        ids, many, home = rows["id"].to_numpy(), rows["n"].to_numpy(), rows["home"].to_numpy(bool)
        visits, homes = np.flatnonzero(~home), np.flatnonzero(home)
        links = np.zeros(len(rows), np.int64)
        nodes, where = np.unique(ids, return_inverse=True)
        forest = np.arange(len(nodes))
        if len(visits) and len(homes):
            for a, b in linked_pairs(unit[visits], unit[homes], axes, half, least, cosine):
                a, b = visits[a], homes[b]
                other = ids[a] != ids[b]
                a, b = a[other], b[other]
                np.add.at(links, a, many[b])
                both = np.unique(np.stack([where[a], where[b]], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
                forest = _forest(len(nodes), np.append(both[:, 0], np.arange(len(nodes))), np.append(both[:, 1], forest))
        found = np.flatnonzero(links)
        tree = np.flatnonzero(forest != np.arange(len(nodes)))
        return pd.DataFrame({
            "id": np.append(ids[found], nodes[tree]),
            "links": np.append(links[found], np.zeros(len(tree), np.int64)),
            "other": np.append(ids[found], nodes[forest[tree]]),
        })

    return run


def near_duplicates(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, projections: int = PROJECTIONS,
    recall: float = RECALL, cell: int = CELL, sample: int = SAMPLE, seed: int = 11,
) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    n_links counts the other vectors found with at least `cosine`, component_id is the smallest vec_id reachable by links, itself included. The cell cuts are medians of a
    sample of about `sample` distinct vectors; all vectors are placed and compared.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    good = rows.filter(F.col("vec_id").isNotNull() & usable("vector"))
    # A vector's number, not its smallest vec_id, names it from here on: a vec_id may come with several vectors.
    same = good.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count_distinct("vec_id").alias("n"))
    same = stored(same.withColumn("id", F.monotonically_increasing_id()), "distinct-vectors")
    dim, total = dimension(same, "vector"), same.count()
    alone = rows.filter(F.col("vec_id").isNull() | ~usable("vector")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if dim is None:
        return alone
    depth = max(0, math.ceil(math.log2(total / cell)))
    axes = directions(dim, projections + depth, seed)
    chord = math.sqrt(2 - 2 * cosine)
    half, reach = (min(chord, x * chord / math.sqrt(dim)) for x in (WIDTH, REACH))
    counting = axes[:, depth:]
    least = calibrate(counting, chord, half, recall, seed)
    cuts = []
    if depth:
        part = same.filter(F.pmod(F.xxhash64("vector", F.lit(seed)), F.lit(1 << 30)) < min(1.0, sample / total) * (1 << 30))
        points = _units(np.array([r["vector"] for r in part.select("vector").collect()], np.float64)) @ axes[:, :depth]
        cuts = median_cuts(points, depth) if len(points) else []
    sent = spark.sparkContext.broadcast((axes, cuts, counting))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, cuts, _ = sent.value
        return _place(axes, cuts, reach)(batches)

    placed = stored(
        same.select("id", "n", "vector").mapInArrow(place, "id long, n long, unit binary, cell long, home boolean"), "placed"
    )
    full = placed.groupBy("cell").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.sum((~F.col("home")).cast("long")).alias("visits"))
    full = stored(
        full.select(F.col("cell").alias("of"), F.greatest(F.lit(1), F.ceil(F.col("homes") / cell)).alias("hs"), F.ceil(F.col("visits") / cell).alias("vs")), "cells"
    )
    dealt = placed.join(full, placed.cell == full.of).withColumn("mine", F.xxhash64("id", F.lit(seed)))
    mine = F.struct(F.when(F.col("home"), F.pmod("mine", "hs")).alias("h"), F.when(~F.col("home"), F.pmod("mine", "vs")).alias("v"))
    # A home chunk meets every chunk of visits, and the other way round.
    over = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("home"), F.col("vs")).otherwise(F.col("hs")) - 1))
    dealt = dealt.withColumn("own", mine).withColumn("with", over)
    dealt = dealt.select(
        "id", "n", "unit", "home", "cell", F.coalesce("own.h", "with").alias("h"), F.coalesce("own.v", "with").alias("v")
    )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        return _meet(sent.value[2], half, least, cosine)(rows)

    found = stored(dealt.groupBy("cell", "h", "v").applyInPandas(meet, "id long, links long, other long"), "met")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    tree = components(found.filter("id != other").select(F.col("id").alias("a"), F.col("other").alias("b")))
    classes = same.join(links, "id", "left").join(tree, same.id == tree.node, "left")
    classes = stored(classes.select("vector", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("group")), "vector-links")
    lowest = classes.groupBy("group").agg(F.min("least").alias("component_id"))
    classes = classes.join(lowest, "group").select(F.col("vector").alias("_vector"), "n_links", "component_id")
    out = good.join(stored(classes, "classes"), F.col("vector") == F.col("_vector"))
    out = out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return out.unionByName(alone)
