"""Mixing sources to target weights: copies of documents by pivotal dependent rounding.

A source's target divided by its size is the number of copies of each of its documents: some whole copies and a fractional probability
of one more. Two fractional documents meet, and mass moves from one to the other at random, so that each keeps its expectation and one of
them ends at 0 or 1; the other meets the next document. Documents of about the same size meet first, so the words taken hardly change
with the draw. The work is a reduction tree: buckets of a bounded expected row count per (source, size class) leave one fractional document
each; these are the rows of the next level, until one document per source and class is left. At the root these few, of all sizes, are rounded
from the largest down with the words over or short so far carried along, so a source ends within about half of its smallest of them. Draws are
hashes of document ids, so a rerun agrees.

Null or empty texts have size 0 and are taken 0 times over: `taken` is 0. A null source is a source of its own, last in the order. Rows that
repeat a doc_id are documents of their own; a null doc_id is treated like an id. An empty table gives an empty result.
Further columns of the input are not read (`sample` hands them on).
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.work import prepare, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BUCKET = 512


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, target. `sizes` has source and size.

    Sources by code point, null last, take `weights` in turn, repeating. They divide `share` of the sum of all sizes by weight; a
    target ends at `most` times its source's size, and what is over goes to the others by weight, until none is above.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source; positions need one order over all of them.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    per = stored(per.select("source", "source_size", weight.alias("weight")), "sources")
    level, full = 0.0, -1
    while True:
        # The level is words per weight: a source gets level x weight, or its limit if that is less.
        limited = F.col("source_size") * F.lit(most) <= F.lit(level) * F.col("weight")
        row = per.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(limited, F.col("source_size") * most)).alias("given"),
            F.sum(F.when(~limited, F.col("weight"))).alias("open"),
            F.count(F.when(limited, 1)).alias("full"),
        ).head()
        if row["full"] == full or not row["open"]:
            break
        full = row["full"]
        level = max(0.0, (share * row["all"] - (row["given"] or 0.0)) / row["open"])
    amount = F.least(F.col("source_size") * F.lit(most), F.lit(level) * F.col("weight"))
    if full >= 0 and not row["open"]:
        amount = F.col("source_size") * F.lit(most)
    return per.select("source", "source_size", amount.cast("double").alias("target"))


def _draw(*parts: object) -> float:
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return (int.from_bytes(digest, "big") >> 11) * 2.0**-53


def pivot(ids: list, chances: list[float], seed: object) -> list[float]:
    """Pivotal rounding of a list: all become 0 or 1 but one at most, and the sum stays."""
    out = list(chances)
    left = -1
    for i, p in enumerate(chances):
        if p <= 0.0 or p >= 1.0:
            continue
        if left < 0:
            left = i
            continue
        a, b = out[left], p
        u = _draw(seed, ids[left], ids[i], i)
        if a + b <= 1.0:
            keep_left = u * (a + b) < a
            out[left], out[i] = (a + b, 0.0) if keep_left else (0.0, a + b)
        else:
            full_left = u * (2.0 - a - b) < 1.0 - b
            out[left], out[i] = (1.0, a + b - 1.0) if full_left else (a + b - 1.0, 1.0)
        if not 1e-12 < out[left] < 1 - 1e-12:
            out[left] = float(round(out[left]))
            left = i
        if not 1e-12 < out[i] < 1 - 1e-12:
            out[i] = float(round(out[i]))
            if left == i:
                left = -1
    return out


def _ordered(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(["size", "rank", "doc_id"], ascending=[False, True, True], kind="stable").reset_index(drop=True)


def _round_bucket(level: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = _ordered(rows)
        ids = [None if pd.isna(x) else int(x) for x in rows["doc_id"]]
        rows["chance"] = pivot(ids, rows["chance"].tolist(), level)
        return rows

    return run


def _round_root(rows: pd.DataFrame) -> pd.DataFrame:
    rows = _ordered(rows)
    chances, sizes = rows["chance"].to_numpy(), rows["size"].to_numpy(float)
    over = float(rows["missing"].iloc[0]) - float((chances * sizes).sum())
    out = []
    for p, size in zip(chances, sizes, strict=True):
        wanted = p * size + over
        out.append(float(wanted * 2 >= size))
        over = wanted - out[-1] * size
    return rows.drop(columns="missing").assign(chance=out)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, bucket: int = BUCKET, seed: int = 7
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken (words, repeats counted), copies, source."""
    prepare(docs.sparkSession)
    # rank tells rows with one doc_id apart by their place among all columns; equal rows are interchangeable.
    items = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count("text").alias("size"), F.xxhash64("text").alias("rank"))
    items = stored(items, "sizes")
    goal = stored(targets(items, weights, share, most), "targets").withColumnRenamed("source", "of")
    items = items.join(goal, items.source.eqNullSafe(goal.of), "left").drop("of")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12)
    items = items.withColumn("whole", whole).withColumn("chance", F.greatest(F.lit(0.0), ratio - whole))
    items = items.withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size") * 2)).otherwise(-1))
    counts = stored(items.groupBy("source", "class").agg(F.count("*").alias("n")), "classes")
    parts = F.ceil(F.col("n") / bucket)
    counts = counts.select(F.col("source").alias("of"), F.col("class").alias("in"), parts.alias("parts"))
    items = items.join(counts, items.source.eqNullSafe(counts.of) & (items["class"] == counts["in"])).drop("of", "in")
    items = items.withColumn("part", F.pmod(F.xxhash64("doc_id", "rank", F.lit(seed)), "parts"))
    widest = counts.agg(F.max("parts")).head()[0] or 1
    keys = ["source", "class", "part"]
    shape = items.schema
    # Buckets of a class, then buckets of the buckets' last documents, at last all classes of a source.
    level, done = 0, []
    current = items.groupBy(*keys).applyInPandas(_round_bucket(0), shape)
    while True:
        current = stored(current, f"rounded-{level}")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(current.filter(~open_))
        rest = current.filter(open_)
        level += 1
        if widest == 1:
            break
        widest = math.ceil(widest / bucket)
        rest = rest.withColumn("part", F.floor(F.col("part") / bucket))
        current = rest.groupBy(*keys).applyInPandas(_round_bucket(level), shape)
    words = F.col("size") * (F.col("whole") + F.floor("chance"))
    sums = [x.groupBy("source").agg(F.sum(words).alias("words"), F.max("target").alias("goal")) for x in [*done, rest]]
    given = sums[0]
    for more in sums[1:]:
        given = given.unionByName(more)
    given = given.groupBy("source").agg((F.max("goal") - F.sum("words")).alias("missing")).withColumnRenamed("source", "of")
    rest = rest.join(given, rest.source.eqNullSafe(given.of)).drop("of")
    done.append(rest.groupBy("source").applyInPandas(_round_root, shape))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("whole") + F.round("chance")).cast("long")
    return out.select(
        "doc_id", F.col("size").cast("long").alias("size"), "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"),
        copies.alias("copies"), "source", "rank",
    )


def sample(docs: DataFrame, **options: object) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it. Rows equal in doc_id, text and source stand for one another."""
    keys = {"_id": F.col("doc_id").cast("long"), "_rank": F.xxhash64("text"), "_source": F.col("source")}
    chosen = mix(docs, **options).select(F.col("doc_id").alias("_id"), F.col("rank").alias("_rank"), F.col("source").alias("_source"), "copies")
    total = stored(chosen.groupBy(*keys).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).filter("_copies > 0"), "copies")

    def met(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        wanted = wanted.withColumnsRenamed({k: f"_w{k}" for k in keys})
        same = [rows[k].eqNullSafe(wanted[f"_w{k}"]) for k in keys]
        return rows.join(wanted, same[0] & same[1] & same[2])

    keyed = docs.withColumns(keys)
    out = met(keyed, total.filter("_rows = 1"))
    shared = total.filter("_rows > 1")
    if shared.head(1):
        out = out.unionByName(met(keyed, shared).dropDuplicates(list(keys)))
    copy = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return out.withColumn("_copy", copy).select(docs.columns)
