"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

Each element of a weighted set is a unit-high strip of height `weight` and endless length. Darts fall into the strips as a Poisson
process that depends on the element alone, so two sets share exactly the darts that hit the region they have in common. A dart's
position along the strip is its time and a hash names its coordinate; the earliest dart of each coordinate is the signature.
Two signatures agree in a coordinate with the probability of the weighted Jaccard similarity. Only darts up to the time by which
about `k ln k + 4k` have fallen into the whole set are thrown; sets that leave a coordinate empty go on with twice the time.

Null or empty texts, and texts without a word, have no shingle and no duplicate: each such document is a class of its own.
A document without an id stays its own class, with a null class id. Rows that repeat a doc_id count as one document.
Texts with fewer words than a shingle have one shingle, all their words. Further columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.graph import components
from lakeops.llm.text import Words, mix, shingles, slices, uniform
from lakeops.llm.work import prepare, stored

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5  # of two texts with similarity 0.8, one pair in 20 000 shares no band
LONG = 1000  # coordinates of the long signature, which tells similarities apart to about 0.05


def throw_darts(values: np.ndarray, weights: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """Signatures of weighted sets, a row of k dart names each. Set i has elements values[bounds[i]:bounds[i + 1]]; empty sets get zeros."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    total = np.bincount(owner, weights, n)
    until = np.divide(k * np.log(k) + 4 * k, total, out=np.zeros(n), where=total > 0)
    first = np.full(n * k, np.inf)
    name = np.zeros(n * k, np.uint64)
    # A strip of weight 2.3 is three layers; of the last one, darts above height 0.3 miss.
    layers = np.ceil(weights).astype(np.int64)
    strip = np.repeat(np.arange(len(values)), layers)
    layer = np.arange(len(strip)) - np.repeat(np.cumsum(layers) - layers, layers)
    height = np.minimum(weights[strip] - layer, 1.0)
    seed, owner = mix(values[strip] + mix(layer.astype(np.uint64))), owner[strip]
    while len(strip):
        live = np.arange(len(strip))
        clock, key = np.zeros(len(strip)), seed
        while len(live):
            key = key + np.uint64(0x9E3779B97F4A7C15)
            dart = mix(key)
            clock = clock - np.log(uniform(dart))
            on = clock <= until[owner[live]]
            live, clock, key, dart = live[on], clock[on], key[on], dart[on]
            aim = mix(dart + np.uint64(1))
            hit = height[live] >= 1.0
            if not hit.all():
                hit |= uniform(mix(dart + np.uint64(2))) < height[live]
            cell = owner[live][hit] * k + (aim[hit] % np.uint64(k)).astype(np.int64)
            before = first[cell]
            np.minimum.at(first, cell, clock[hit])
            better = (clock[hit] <= first[cell]) & (clock[hit] < before)
            name[cell[better]] = aim[hit][better]
        open_sets = np.isinf(first.reshape(n, k)).any(axis=1) & (total > 0)
        until[open_sets] *= 2
        on = open_sets[owner]
        first.reshape(n, k)[open_sets] = np.inf
        strip, seed, owner, height = strip[on], seed[on], owner[on], height[on]
    return name.reshape(n, k)


def _signatures(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, bounds = shingles(Words(part.column(1)), size)
                n = part.num_rows
                counts = np.diff(bounds)
                names = throw_darts(values, np.ones(len(values)), bounds, bands * rows).reshape(n, bands, rows)
                keys = mix(np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)))
                for i in range(rows):
                    keys = mix(keys + names[:, :, i])
                # The sets themselves, to find equal ones: sums of two scrambles of all elements.
                sums = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
                if len(values):
                    for total, salt in zip(sums, (11, 12), strict=True):
                        padded = np.append(mix(values + np.uint64(salt)), np.uint64(0))
                        total[:] = np.where(counts > 0, np.add.reduceat(padded, bounds[:-1]), 0)
                yield pa.record_batch(
                    [
                        part.column(0), pa.array(counts, pa.int64()), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                        pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), pa.array(keys.reshape(-1).view(np.int64))),
                        # One byte of each coordinate, to estimate the similarity of a pair.
                        pa.ListArray.from_arrays(
                            np.arange(0, n * bands * rows + 1, bands * rows, dtype=np.int32), pa.array((names.reshape(-1) & np.uint64(255)).astype(np.uint8).view(np.int8))
                        ),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "bands", "marks"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, bounds = shingles(Words(part.column(1)), size)
                sets = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.record_batch([part.column(0), pa.array(sets, pa.binary())], names=["doc_id", "elements"])

    return run


def _long_marks(k: int):
    """Element sets to long signatures, a byte a coordinate; a bounded number of sets at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                sets = [np.frombuffer(x, np.uint64) for x in part.column(1).to_pylist()]
                bounds = np.append(0, np.cumsum([len(x) for x in sets]))
                values = np.concatenate(sets)
                names = throw_darts(values, np.ones(len(values)), bounds, k)
                marks = pa.array((names.reshape(-1) & np.uint64(255)).astype(np.uint8).view(np.int8))
                lists = pa.ListArray.from_arrays(np.arange(0, part.num_rows * k + 1, k, dtype=np.int32), marks)
                yield pa.record_batch([part.column(0), lists], names=["named", "long_marks"])

    return run


def least_agreed(k: int, similarity: float, lost: float = 1e-5) -> int:
    """Coordinates that a pair of this similarity shares at least, but for one pair in 1 / lost."""
    total = 0.0
    for n in range(k + 1):
        total += math.comb(k, n) * similarity**n * (1 - similarity) ** (k - n)
        if total > lost:
            return n
    return k


@F.pandas_udf(T.DoubleType())
def _jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
    out = np.zeros(len(left))
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out[i] = both / (len(x) + len(y) - both)
    return pd.Series(out)


def _verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Exact similarity of candidate pairs (a, b)."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("right"))
    return stored(pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", _jaccard("left", "right").alias("similarity")), name)


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (smallest doc_id of the class), kept (doc_id is the class id).

    A class is a connected component of the links: pairs that share a band and have an exact Jaccard similarity of at least
    `similarity`. Documents with equal shingle sets are one node. In a bucket (documents with one band in common), each is compared with
    the bucket's smallest document. One that is not similar to it is compared with the bucket's document that has the most links so far. Only
    then, in buckets that still hold several components, it is compared with all others that lie in another component, agree in enough coordinates
    of a short and of a long signature, and are not ruled out by the triangle inequality of the Jaccard distance. So a bucket of n copies costs n
    comparisons, not n squared. A pair of the least similarity is missed if it shares no band (with 25 bands of 5, one pair in 20 000) or, where only
    the last comparison could find it, if a signature agrees in too few coordinates (one in 100 000 for either).

    Joins are sort-merge joins at every size: plans, and what they cost, are alike for small and large inputs.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape = "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, marks array<tinyint>"
    signed = stored(texts.mapInArrow(_signatures(size, bands, rows), shape), "signatures")
    named = signed.filter("doc_id is not null and n_shingles > 0")
    equal = stored(named.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "equal")
    first = F.col("doc_id") == F.col("rep")
    member = stored(
        named.join(equal.hint("merge"), ["h1", "h2"]).select(
            "doc_id", "rep", F.when(first, F.col("bands")).alias("bands"), F.when(first, F.col("marks")).alias("marks")
        ),
        "members",
    )
    banded = member.filter("bands is not null").select(F.col("rep").alias("id"), F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).filter("leader < last")
    buckets = stored(buckets.select("key", "leader"), "buckets")
    seats = stored(banded.join(buckets.hint("merge"), "key").filter("id > leader").distinct(), "seats")
    pairs = stored(seats.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = stored(texts.join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets(size), "doc_id long, elements binary"), "sets")
    sets = sets.groupBy("doc_id").agg(F.max("elements").alias("elements")) if _repeats(sets) else sets
    tested = _verified(pairs, sets, "tested")
    links = tested.filter(F.col("similarity") >= similarity)
    # Those that are not similar to their bucket's leader, against the member of the bucket with the most links so far.
    far = 1 - similarity
    seats = seats.join(tested.hint("merge"), (seats.leader == tested.a) & (seats.id == tested.b)).select(
        "key", "leader", "id", (1 - F.col("similarity")).alias("distance")
    )
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    loose = stored(seats.filter(F.col("distance") > far), "loose")
    open_ = loose.select("key").distinct()
    close = seats.filter(F.col("distance") <= far).join(open_.hint("merge"), "key", "left_semi").select("key", "id")
    hubs = close.join(stored(degree, "degrees").hint("merge"), F.col("id") == F.col("node"))
    hubs = hubs.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("less"))).alias("most"))
    hubs = stored(hubs.select("key", (-F.col("most.less")).alias("hub")), "hubs")
    held = loose.join(hubs.hint("merge"), "key")
    retry = stored(held.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct(), "retry")
    again = _verified(retry.join(tested.hint("merge"), ["a", "b"], "left_anti"), sets, "tested-hubs")
    links = links.unionByName(again.filter(F.col("similarity") >= similarity)).select("a", "b")
    found = components(links)

    # At last, of each bucket that still holds several components, the pairs that may link them.
    named_bands = member.filter("bands is not null").select(F.col("rep").alias("of"), "bands", "marks")
    placed = seats.join(open_.hint("merge"), "key", "left_semi").join(found.hint("merge"), F.col("id") == F.col("node"), "left")
    placed = placed.select("key", "leader", "id", "distance", F.coalesce("component", "id").alias("component"))
    first = placed.select("key", "leader").distinct().join(found.hint("merge"), F.col("leader") == F.col("node"), "left")
    first = first.select("key", F.col("leader").alias("id"), F.lit(0.0).alias("distance"), F.coalesce("component", "leader").alias("component"))
    placed = stored(placed.drop("leader").unionByName(first), "placed")
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    several = stored(several.filter("low < high and n > 2").select("key"), "several")
    placed = stored(placed.join(several.hint("merge"), "key", "left_semi"), "placed-open")
    asked = placed.select(F.col("id").alias("doc_id")).distinct()
    long = sets.join(asked.hint("merge"), "doc_id", "left_semi").mapInArrow(_long_marks(LONG), "named long, long_marks array<tinyint>")
    placed = placed.join(named_bands.hint("merge"), F.col("id") == F.col("of")).join(stored(long, "long-marks").hint("merge"), F.col("id") == F.col("named"))
    placed = stored(placed.drop("of", "named"), "open")
    x, y = placed.filter(F.col("distance") > far).alias("x"), placed.filter("distance > 0").alias("y")
    # A pair is taken in the first of the bands it shares; similar texts share most coordinates.
    shared = F.array_intersect("x.bands", "y.bands")

    def agreed(marks: str) -> Column:
        return F.aggregate(F.zip_with(f"x.{marks}", f"y.{marks}", lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x)

    rest = x.join(
        y.hint("merge"),
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.abs(F.col("x.distance") - F.col("y.distance")) <= far + 1e-9)
        & ((F.col("x.id") < F.col("y.id")) | (F.col("y.distance") <= far))
        & (shared[0] == F.col("x.key"))
        & (agreed("marks") >= least_agreed(bands * rows, similarity))
        & (agreed("long_marks") >= least_agreed(LONG, similarity)),
    )
    rest = rest.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    rest = rest.join(again.hint("merge"), ["a", "b"], "left_anti")
    more = _verified(rest, sets, "tested-rest").filter(F.col("similarity") >= similarity)
    if more.head(1):
        found = components(links.unionByName(more.select("a", "b")))

    label = member.join(found, member.rep == found.node, "left").select("doc_id", F.coalesce("component", "rep").alias("class_id"))
    label = stored(label.groupBy("doc_id").agg(F.min("class_id").alias("class_id")), "classes").withColumnRenamed("doc_id", "id")
    out = signed.join(label, signed.doc_id == label.id, "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def _repeats(sets: DataFrame) -> bool:
    """Whether a doc_id has several rows."""
    return bool(sets.groupBy("doc_id").count().filter("count > 1").head(1))


def drop_near_duplicates(docs: DataFrame, **options: float) -> DataFrame:
    """The documents of `docs`, one of each class; of repeated rows of a kept document, one. Rows without doc_id stay."""
    keep = near_duplicates(docs, **options).filter("kept and doc_id is not null").select("doc_id")
    named = docs.join(keep.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(docs.columns).unionByName(docs.filter("doc_id is null"))
