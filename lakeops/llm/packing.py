"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted; a bin of length c costs c plus a fixed overhead. Pieces are packed in decreasing length: each goes to
the open bin in which it leaves the least room; if none has room, a bin of the size with the least cost per word it can hold of such
pieces is opened. The permitted lengths are weighed jointly: each shard is packed under several opening rules, and the cheapest packing counts. At last
every bin is cut down to the smallest permitted length that holds its contents.

Documents longer than the longest sequence fill whole sequences and leave one piece; nothing is cut off. Shards hold a bounded expected number of
pieces, and each leaves a few bins unfilled, whatever the input's size. The result depends on ids, lengths and seed only.

Null or empty texts have no words and no row in the result. Rows that repeat a doc_id are packed one by one (`copy` counts rows with one id and
length); a null doc_id is treated like an id. Further columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.work import prepare, stored, word_count

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 64
SHARD = 1000
RULES = ("ratio", "largest", "smallest")


def opening(length: int, remaining: int, capacities: tuple[int, ...], overhead: int, rule: str) -> int:
    """The size of a new bin for a piece, when `remaining` words (this piece included) are still to be packed."""
    fitting = [c for c in capacities if c >= length]
    if rule != "ratio":
        return fitting[-1] if rule == "largest" else fitting[0]
    # Pieces come in decreasing length, so the next ones are about as long or shorter and can fill what is left.
    held = lambda c: min(c // length * length + (c % length) // 2, max(remaining, length))
    return min(fitting, key=lambda c: ((c + overhead) / held(c), c))


def best_fit(lengths: list[int], capacities: tuple[int, ...], overhead: int, rule: str) -> tuple[list[int], list[int], list[int]]:
    """Bin of each piece, words in each bin, and capacity of each bin after it was cut down. `lengths` decrease."""
    rooms: dict[int, list[int]] = {}  # open bins by free words
    free = 0  # bit f is set if a bin has f free words
    bins, used, sizes = [], [], []
    remaining = sum(lengths)
    for length in lengths:
        above = free >> length
        if above:
            room = length + (above & -above).bit_length() - 1
            stack = rooms[room]
            place = stack.pop()
            if not stack:
                free &= ~(1 << room)
        else:
            room, place = opening(length, remaining, capacities, overhead, rule), len(used)
            used.append(0)
            sizes.append(room)
        room -= length
        if room:
            rooms.setdefault(room, []).append(place)
            free |= 1 << room
        used[place] += length
        bins.append(place)
        remaining -= length
    steps = sorted(capacities)
    return bins, used, [steps[int(np.searchsorted(steps, u))] for u in used]


def cost(sizes: list[int], overhead: int) -> int:
    return sum(sizes) + overhead * len(sizes)


def pack_shard(lengths: list[int], capacities: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the packings under all opening rules and all subsets of largest lengths."""
    tries = []
    for top in range(len(capacities), 0, -1):
        permitted = capacities[:top]
        if lengths and lengths[0] > permitted[-1]:
            break
        tries += [best_fit(lengths, permitted, overhead, rule) for rule in (RULES if top == len(capacities) else RULES[:1])]
    return min(tries, key=lambda t: cost(t[2], overhead))


def _pack(capacities: tuple[int, ...], overhead: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.loc[rows.index.repeat(rows["n"])].reset_index(drop=True)
        rows["copy"] += rows.groupby(["doc_id", "length", "copy"], dropna=False).cumcount()
        top = capacities[-1]
        whole = (rows["length"] // top).to_numpy()
        rest = (rows["length"] % top).to_numpy()
        count = whole + (rest > 0)
        pieces = rows.loc[rows.index.repeat(count), ["doc_id", "copy", "length"]].reset_index(drop=True)
        pieces["piece"] = np.arange(len(pieces)) - np.repeat(np.cumsum(count) - count, count)
        pieces["start"] = pieces["piece"] * top
        pieces["n_words"] = np.minimum(top, pieces["length"] - pieces["start"])
        pieces = pieces.sort_values(["n_words", "doc_id", "copy", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        bins, used, sizes = pack_shard(pieces["n_words"].tolist(), capacities, overhead)
        place = np.asarray(bins, np.int64)
        pieces["bin_id"] = (int(key[0]) << 32) + place
        pieces["capacity"] = np.asarray(sizes, np.int64)[place]
        pieces["bin_words"] = np.asarray(used, np.int64)[place]
        pieces["offset"] = pieces.groupby("bin_id")["n_words"].cumsum() - pieces["n_words"]
        return pieces.rename(columns={"length": "doc_words"})[["doc_id", "doc_words", "copy", "piece", "start", "n_words", "bin_id", "capacity", "bin_words", "offset"]]

    return run


SHAPE = "doc_id long, doc_words long, copy long, piece long, start long, n_words long, bin_id long, capacity long, bin_words long, offset long"


def pack(
    docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, shard: int = SHARD, length: str | None = None
) -> DataFrame:
    """One row per packed piece: doc_id, doc_words, copy, piece, start (words of the document before it), n_words, bin_id, capacity, bin_words, offset.

    `length` names a column with lengths (of tokens, say); without it the words of `text` count.
    """
    prepare(docs.sparkSession)
    capacities = tuple(sorted(set(capacities)))
    size = F.col(length).cast("long") if length else word_count("text")
    items = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("length")).filter("length > 0")
    # Rows with one id and length are counted before the shuffle and dealt out again in parts of at most a quarter of a shard.
    part = max(1, shard // 4)
    items = items.groupBy("doc_id", "length").agg(F.count("*").alias("rows"))
    items = items.withColumn("slot", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / part).cast("int"))))
    copy = F.col("slot").cast("long") * part
    items = items.select("doc_id", "length", copy.alias("copy"), F.least(F.lit(part).cast("long"), F.col("rows") - copy).alias("n"), "slot")
    items = stored(items, "lengths")
    shards = max(1, -(-(items.agg(F.sum("n")).head()[0] or 0) // shard))
    items = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "length", "slot"), F.lit(shards)))
    return items.drop("slot").groupBy("shard").applyInPandas(_pack(capacities, overhead), SHAPE)
