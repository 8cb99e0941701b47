"""Removal of long passages that occur more than once, by prefix-partitioned suffix trees.

A passage is a run of `window` words. Its suffixes are filed under a prefix: the run of `prefix` words with the least hash within the passage (equal passages choose
the same one, so they meet), an anchor. Prefixes have variable length: an anchor that occurs once is left out; one that occurs up to `crowd` times sends its
suffixes to one group; for a more frequent one the prefix grows to the whole passage, so its group is a single node of the tree, which is counted with
aggregation before the shuffle. Groups are taken into memory several at a time, up to a bounded number of suffixes, and their trees are built from the top down, an edge of up to
eight words at a time: nodes with one suffix are cut off, and what is alive at the depth of `window` words are the internal nodes that deep: their
suffixes repeat. Words are compared by 64-bit hashes at every place of the passage, as is each edge.

Null or empty texts and texts with fewer words than a window keep all their words. Rows that repeat a text, with or without its doc_id, are occurrences of their own. Rows without
a doc_id take part. An empty table gives an empty result. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.text import Words, mix, slices, windows
from lakeops.llm.work import discard, prepare, stored

WINDOW, PREFIX = 35, 8
CROWD = 500
GROUP_SUFFIXES = 400_000


def least_of(values: np.ndarray, span: int) -> np.ndarray:
    """For each start, the place of the leftmost least value among `span` consecutive ones."""
    place, width = np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        width += step
    return place


class Anchors:
    """The anchors of a batch of texts: word place `at`, first passage start `low` and number of passages `count`, all as word numbers of the batch."""

    def __init__(self, words: Words, window: int, prefix: int):
        self.hashes = words.hashes()
        row = words.row_of()
        self.grams = windows(self.hashes, prefix)
        n = max(0, len(row) - window + 1)
        chosen = least_of(self.grams, window - prefix + 1)[:n]
        start = np.flatnonzero(row[:n] == row[window - 1 :][:n])
        chosen = chosen[start]
        first = np.flatnonzero((np.diff(chosen, prepend=-1) != 0) | (np.diff(row[start], prepend=-1) != 0)) if len(start) else np.zeros(0, np.int64)
        self.at, self.low = chosen[first], start[first]
        self.count = np.diff(np.append(first, len(start)))
        self.row = row[self.low]
        self.name = self.grams[self.at].view(np.int64)


def _find(window: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(2))
                found = Anchors(words, window, prefix)
                owner = pa.array(found.row)
                place = found.at - words.first[found.row]
                yield pa.record_batch(
                    [pa.array(found.name), part.column(0).take(owner), part.column(1).take(owner), pa.array(place, pa.int32())],
                    names=["name", "doc_id", "row_key", "place"],
                )

    return run


def _suffixes(window: int, prefix: int):
    """Rows (doc_id, row_key, text, places, crowded) to (name, whole, doc_id, row_key, start, words): the words of an anchor's passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(2))
                found = Anchors(words, window, prefix)
                marks = np.zeros(len(words) + 1, np.int8)
                for i, column in ((1, 3), (2, 4)):
                    lists = part.column(column).fill_null([]) if part.column(column).null_count else part.column(column)
                    sizes = np.diff(lists.offsets.to_numpy())
                    owner = np.repeat(np.arange(part.num_rows), sizes)
                    marks[words.first[owner] + lists.flatten().to_numpy(zero_copy_only=False)] = i
                kind = marks[found.at]
                single, whole = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
                # A crowded anchor's passages go out one by one, filed under all their words.
                many = found.count[whole]
                low = np.repeat(found.low[whole], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                names = windows(found.hashes, window)[low].view(np.int64)
                size = found.count[single] + window - 1
                ends = np.cumsum(size)
                index = np.repeat(found.low[single] - (ends - size), size) + np.arange(size.sum())
                content = found.hashes[index].view(np.uint8)
                offsets = np.append(0, ends).astype(np.int64) * 8
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(single), [None, pa.py_buffer(offsets), pa.py_buffer(content)]).cast(pa.binary())
                for name, start, rows, flag, data in (
                    (found.name[single], found.low[single], found.row[single], False, binary),
                    (names, low, np.repeat(found.row[whole], many), True, pa.nulls(len(low), pa.binary())),
                ):
                    owner = pa.array(rows)
                    yield pa.record_batch(
                        [pa.array(name), pa.array([flag] * len(name), pa.bool_()), part.column(0).take(owner), part.column(1).take(owner), pa.array(start - words.first[rows], pa.int32()), data],
                        names=["name", "whole", "doc_id", "row_key", "start", "words"],
                    )

    return run


def repeated_suffixes(content: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of the passages content[s:s + window] occur twice or more among them: top-down tree construction, cut off at single suffixes."""
    node, alive = np.zeros(len(starts), np.uint64), np.arange(len(starts))
    for depth in range(0, window, 8):
        edge = windows(content, min(8, window - depth))
        _, child, size = np.unique(mix(node ^ edge[starts[alive] + depth]) + node, return_inverse=True, return_counts=True)
        keep = size[child] > 1
        alive, node = alive[keep], mix(child[keep].astype(np.uint64))
    out = np.zeros(len(starts), bool)
    out[alive] = True
    return out


def _runs(sizes: np.ndarray, repeated: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first passage start and length of every run of repeated passages within an owner's passages."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = np.append(False, repeated[:-1]) & (at > 0)
    opens = np.flatnonzero(repeated & ~before)
    after = np.append(repeated[1:], False) & np.append(at[1:] > 0, False)
    closes = np.flatnonzero(repeated & ~after)
    return owner[opens], starts[owner[opens]] + at[opens], closes - opens + 1


def _trees(window: int, limit: int):
    """Rows sorted by name to (doc_id, row_key, start, n): runs of repeated passages."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        words = rows.column("words").combine_chunks().cast(pa.large_binary())
        content = np.frombuffer(b"".join(words.to_pylist()), np.uint64)
        length = np.diff(words.offsets.to_numpy() if hasattr(words, "offsets") else np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]) // 8
        sizes = length - window + 1
        base = np.cumsum(length) - length
        starts = np.repeat(base, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        repeated = repeated_suffixes(content, starts, window)
        owner, start, n = _runs(sizes, repeated, rows.column("start").to_numpy())
        at = pa.array(owner)
        pick = lambda name: rows.column(name).combine_chunks().take(at)
        return pa.record_batch([pick("doc_id"), pick("row_key"), pa.array(start, pa.int32()), pa.array(n, pa.int32())], names=["doc_id", "row_key", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        suffixes = 0
        for batch in batches:
            held.append(batch)
            suffixes += batch.column(4).nbytes // 8 - (window - 1) * batch.num_rows
            if suffixes < limit:
                continue
            # The last name may go on in the next batch: it is held back.
            rows = pa.Table.from_batches(held).combine_chunks()
            names = rows.column("name").to_numpy()
            cut = int(np.searchsorted(names, names[-1]))
            if cut:
                yield solve(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
            suffixes = sum(b.column(4).nbytes // 8 for b in held) if len(names) - cut < len(names) else 0
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(1))
                lists = part.column(2)
                runs = lists.flatten()
                owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy())
                change = np.zeros(len(words) + 1, np.int64)
                start = words.first[owner] + runs.field("start").to_numpy(zero_copy_only=False)
                np.add.at(change, start, 1)
                np.add.at(change, start + runs.field("n").to_numpy(zero_copy_only=False) + window - 1, -1)
                gone = np.cumsum(change)[:-1] > 0
                counts = np.diff(words.first)
                removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (counts > 0)
                digests, kept = [], []
                for r in range(part.num_rows):
                    a, b = words.first[r], words.first[r + 1]
                    text = b" ".join(words.data[s:e].tobytes() for s, e in zip(words.starts[a:b][~gone[a:b]], words.ends[a:b][~gone[a:b]], strict=True)) if removed[r] else _plain(words, a, b)
                    digests.append(hashlib.sha256(text).hexdigest())
                    kept.append(text)
                yield pa.record_batch(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    return run


def _plain(words: Words, a: int, b: int) -> bytes:
    """Words a to b joined by one blank."""
    if a == b:
        return b""
    return b" ".join(words.data[words.starts[a] : words.ends[b - 1]].tobytes().split())


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, crowd: int = CROWD, group: int = GROUP_SUFFIXES) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Every word that a repeated passage of `window` words covers is removed; passages are judged on the input. The words that stay are joined by one blank.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
    key = ["doc_id", "row_key"]
    anchors = stored(texts.mapInArrow(_find(window, prefix), "name long, doc_id long, row_key long, place int"), "anchors")
    often = stored(anchors.groupBy("name").agg(F.count("*").alias("times")).filter("times > 1"), "prefixes")
    places = anchors.join(often, "name").groupBy(*key).agg(
        F.array_sort(F.collect_set(F.when(F.col("times") <= crowd, F.col("place")))).alias("places"),
        F.array_sort(F.collect_set(F.when(F.col("times") > crowd, F.col("place")))).alias("crowded"),
    )
    places = stored(places, "places")
    discard(anchors, often)
    # Rows that repeat share a key and its places, each once; each of them sends its own suffixes.
    met = _same(texts, places).select("doc_id", "row_key", "text", "places", "crowded")
    suffixes = stored(met.mapInArrow(_suffixes(window, prefix), "name long, whole boolean, doc_id long, row_key long, start int, words binary"), "suffixes")
    groups = suffixes.filter("not whole").repartition("name").sortWithinPartitions("name").select("name", "doc_id", "row_key", "start", "words")
    runs = groups.mapInArrow(_trees(window, group), "doc_id long, row_key long, start int, n int")
    whole = suffixes.filter("whole").select("name", *key, "start")
    nodes = stored(whole.groupBy("name").agg(F.count("*").alias("times")).filter("times > 1").select("name"), "nodes")
    runs = runs.unionByName(whole.join(nodes, "name").select(*key, "start", F.lit(1).alias("n")))
    runs = stored(runs.distinct().groupBy(*key).agg(F.collect_list(F.struct("start", "n")).alias("runs")), "runs")
    discard(places, suffixes, nodes)
    return _same(texts, runs, "left").select("doc_id", "text", "runs").mapInArrow(
        _cut(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )


def _same(texts: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """Join by doc_id, null meeting null, and row_key."""
    found = found.withColumnsRenamed({"doc_id": "_doc", "row_key": "_key"})
    return texts.join(found, texts.doc_id.eqNullSafe(found["_doc"]) & (texts.row_key == found["_key"]), how)
