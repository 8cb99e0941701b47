"""Merkle manifest of a dataset: hash trees kept as postorder append logs, and proofs read from them by position.

Each tree (one per key) has its leaves in a stated order. Level by level every two consecutive nodes become the hash of their digests, an odd last
one the hash of its own alone, until one node remains. A builder takes an aligned run of 2**bits leaves and writes each node at the moment it is
complete: a leaf, then every parent that the leaf closes. So the subtree of a node ends with the node and fills consecutive places, and a node's place
follows from subtree sizes alone: `e` leaves hold `2 * e - ones(e)` complete nodes (`ones` counts the 1 bits), so the node of height h that leaf e closes is at
`2 * e - ones(e) + h`. Nodes that only the end of the tree closes follow, by height. Proofs address siblings by this formula; nothing is searched.

The last nodes of the builders are the leaves of the next round's, so n leaves take log(n) / bits rounds, and no builder sees more than 2**bits
digests, whatever the size of a tree. The trees' roots, ordered by key, are the leaves of a last tree.

Null keys come first and form a tree of their own; null fields are hashed as `-`. Leaves with equal order column follow each other by digest, so
equal rows are interchangeable: each has its own place and proof. An empty table gives empty results. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.places import positioned
from lakeops.llm.work import stored

BITS = 10
_STEP = "array<struct<sibling: string, left: boolean>>"
_STEP_ARROW = pa.struct([("sibling", pa.string()), ("left", pa.bool_())])


def field(value: Column, text: bool = True) -> Column:
    """A field as it enters a leaf: its UTF-8 byte count, a colon and the value; `-` for null."""
    value = value if text else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*fields), 256)


# --- places in the log ------------------------------------------------------------------------------------


def place(height, index, leaves: int):
    """Place of a node in the log of a tree of `leaves` leaves; numbers or arrays."""
    height, index = np.asarray(height, np.int64), np.asarray(index, np.int64)
    last = ((index + 1) << height) - 1
    whole = 2 * last - np.bitwise_count(last) + height
    trailing = (leaves & -leaves).bit_length() - 1
    return np.where(last < leaves, whole, 2 * leaves - leaves.bit_count() + height - trailing - 1)


def depth(leaves: int) -> int:
    """Height of the root."""
    return (leaves - 1).bit_length()


def append_log(leaves: Sequence[str], height: int) -> list[str]:
    """The nodes of a tree up to `height` in the order in which they are complete."""
    log: list[str] = []
    open_: list[str | None] = [None] * (height + 1)  # per height, a left child that waits for its sibling
    for node in leaves:
        log.append(node)
        for h in range(height):
            if open_[h] is None:
                open_[h] = node
                break
            node, open_[h] = sha256((open_[h] + node).encode()).hexdigest(), None
            log.append(node)
    # The end closes what still waits: a node alone, or with the one that was closed just below it.
    late = None
    for h in range(height):
        pair = [x for x in (open_[h], late) if x is not None]
        if pair:
            late = sha256("".join(pair).encode()).hexdigest()
            log.append(late)
    return log


# --- logs -------------------------------------------------------------------------------------------------


def _builder(bits: int) -> Callable[[pa.Table], pa.Table]:
    def build(run: pa.Table) -> pa.Table:
        run = run.sort_by("idx")
        n = run.column("n")[0].as_py()
        log = append_log(run.column("digest").to_pylist(), min(bits, depth(n)))
        row = {"tree": run.column("tree")[0].as_py(), "block": run.column("idx")[0].as_py() >> bits, "n": n, "m": run.num_rows, "nodes": log, "top": log[-1]}
        return pa.Table.from_pylist([row], pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("m", pa.int32()), ("nodes", pa.list_(pa.string())), ("top", pa.string())]))

    return build


def grow(leaves: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """The logs of all trees, a table a round: tree, block, n (leaves of the tree in this round), m (those of the block), nodes, top.

    `leaves`: tree, idx, digest, n.
    """
    most = leaves.agg(F.max("n")).head()[0] or 0
    rounds: list[DataFrame] = []
    while True:
        runs = leaves.select("tree", "idx", "digest", "n").groupBy("tree", F.shiftright("idx", bits).alias("block"))
        segments = stored(runs.applyInArrow(_builder(bits), "tree string, block long, n long, m int, nodes array<string>, top string"), "merkle-log")
        rounds.append(segments)
        if most <= 1 << bits:
            return rounds
        most = (most + (1 << bits) - 1) >> bits
        fewer = F.shiftright(F.col("n") + ((1 << bits) - 1), bits)
        leaves = segments.filter(F.col("n") > 1 << bits).select("tree", F.col("block").alias("idx"), F.col("top").alias("digest"), fewer.alias("n"))


def tops(rounds: Sequence[DataFrame], bits: int = BITS) -> DataFrame:
    """The root of each tree."""
    ends = [r.filter(F.col("n") <= 1 << bits).select("tree", "top") for r in rounds]
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return out


def log_rows(rounds: Sequence[DataFrame], bits: int = BITS) -> DataFrame:
    """The logs as rows: tree, round, block, place in the block's log, digest. The leaves of a later round are the tops of the one before."""
    out = None
    for i, segments in enumerate(rounds):
        part = segments.select("tree", F.lit(i).alias("round"), "block", F.posexplode("nodes").alias("place", "digest"))
        out = part if out is None else out.unionByName(part)
    return out


# --- proofs -----------------------------------------------------------------------------------------------


def _steps(local: np.ndarray, n: int, m: int, log: list[str], up: list[dict], bits: int) -> pa.Array:
    """Per leaf of a block its way up: in the block by places, then `up`, the same for all."""
    height = min(bits, depth(n))
    pool = pa.array([*log, *(s["sibling"] for s in up), None], pa.string())
    at = np.full((len(local), height + len(up)), len(pool) - 1, np.int64)
    left = np.zeros(at.shape, bool)
    for h in range(height):
        sibling = (local >> h) ^ 1
        there = sibling < -(-m >> h)
        at[there, h] = place(h, sibling[there], m)
        left[:, h] = there & (sibling < local >> h)
    at[:, height:] = np.arange(len(log), len(log) + len(up))
    left[:, height:] = [s["left"] for s in up]
    flat = pa.StructArray.from_arrays([pool.take(pa.array(at.ravel())), pa.array(left.ravel())], fields=list(_STEP_ARROW))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(local) + 1, dtype=np.int32) * at.shape[1]), flat)


def _expand(bits: int) -> Callable[[pa.Table], pa.Table]:
    """A segment with the way up from its top: the way up from each of its leaves."""

    def run(segment: pa.Table) -> pa.Table:
        row = segment.to_pylist()[0]
        local = np.arange(row["m"])
        steps = _steps(local, row["n"], row["m"], row["nodes"], row["up"] or [], bits)
        return pa.Table.from_arrays([pa.array([row["tree"]] * row["m"]), pa.array(local + (row["block"] << bits)), steps], names=["tree", "idx", "steps"])

    return run


def _expanded(segments: DataFrame, up: DataFrame | None, bits: int) -> DataFrame:
    runs = _with_way(segments, up).groupBy("tree", "block")
    return stored(runs.applyInArrow(_expand(bits), f"tree string, idx long, steps {_STEP}"), "merkle-ways")


def ways(rounds: Sequence[DataFrame], bits: int = BITS) -> DataFrame | None:
    """The way up from the top of each block of the first round: tree, idx (the block), steps. None if all trees have one block."""
    up = None
    for segments in reversed(rounds[1:]):
        up = _expanded(segments, up, bits)
    return up


def _with_way(segments: DataFrame, up: DataFrame | None) -> DataFrame:
    wanted = segments.select("tree", "block", "n", "m", "nodes")
    if up is None:
        return wanted.withColumn("up", F.array().cast(_STEP))
    up = up.select(F.col("tree").alias("of"), "idx", F.col("steps").alias("up"))
    return wanted.join(up, (F.col("tree") == F.col("of")) & (F.col("block") == F.col("idx")), "left").drop("of", "idx")


def _prover(bits: int, carried: Sequence[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def prove(leaves: pa.Table, segment: pa.Table) -> pa.Table:
        row = segment.to_pylist()[0]
        local = leaves.column("idx").to_numpy() - (row["block"] << bits)
        steps = _steps(local, row["n"], row["m"], row["nodes"], [*(row["up"] or []), *(row["last"] or [])], bits)
        for name in ("subroot", "root"):
            leaves = leaves.append_column(name, pa.array([row[name]] * leaves.num_rows, pa.string()))
        return leaves.append_column("steps", steps).select([*carried, "subroot", "root", "steps"])

    return prove


@dataclass
class Manifest:
    """Leaves with their places, the trees' logs, and the log of the tree over their roots."""

    leaves: DataFrame
    rounds: list[DataFrame]
    roots: DataFrame
    last: list[DataFrame]
    bits: int = BITS

    def root(self) -> str | None:
        """The digest of the whole dataset, None if it has no rows."""
        row = tops(self.last, self.bits).head()
        return row and row["top"]

    def proofs(self) -> DataFrame:
        """Per leaf its carried columns, leaf, subroot, root, and steps: sibling (null if alone) and its side, from the leaf to the root."""
        first = _with_way(self.rounds[0], ways(self.rounds, self.bits))
        # The tree over the roots has one leaf a key; its own blocks are expanded like those of a later round.
        last = _expanded(self.last[0], ways(self.last, self.bits), self.bits)
        keys = self.roots.select(F.col("name").alias("key"), "idx", F.col("digest").alias("subroot"))
        keys = keys.join(last.select("idx", F.col("steps").alias("last")), "idx").withColumn("root", F.lit(self.root()))
        segments = first.join(keys.drop("idx"), F.col("tree") == F.col("key")).drop("key")
        leaves = self.leaves.withColumn("block", F.shiftright("idx", self.bits)).drop("n")
        carried = [c for c in leaves.columns if c not in ("tree", "idx", "block", "digest")] + ["digest"]
        shape = ", ".join(f"{c} {leaves.schema[c].dataType.simpleString()}" for c in carried) + f", subroot string, root string, steps {_STEP}"
        both = leaves.groupBy("tree", "block").cogroup(segments.groupBy("tree", "block"))
        return both.applyInArrow(_prover(self.bits, carried), shape).withColumnRenamed("digest", "leaf")


def build(docs: DataFrame, key: Column, order: Column, fields: Sequence[Column], carry: Mapping[str, Column] | None = None, bits: int = BITS) -> Manifest:
    """The manifest of `docs`: a tree per `key` with the leaves ascending by `order` (null first). `carry` columns come back with the proofs."""
    carry = dict(carry or {})
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("")).alias("tree"), order.alias("leaf_order"), digest(fields).alias("digest"), *(c.alias(f"carry_{name}") for name, c in carry.items())
    )
    leaves = stored(positioned(rows, ["leaf_order", "digest"]).drop("leaf_order").withColumnsRenamed({f"carry_{name}": name for name in carry}), "merkle-leaves")
    rounds = grow(leaves, bits)
    roots = tops(rounds, bits).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest"))
    roots = stored(positioned(roots, ["name"]), "merkle-roots")
    return Manifest(leaves, rounds, roots, grow(roots, bits), bits)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its way up lead to."""
    return F.aggregate(
        steps, leaf, lambda node, step: F.sha2(F.when(step["sibling"].isNull(), node).when(step["left"], F.concat(step["sibling"], node)).otherwise(F.concat(node, step["sibling"])), 256)
    )


def proof_digest(steps: Column) -> Column:
    """The hash of all siblings of a way up."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: s["sibling"]), ""), 256)


def document_fields(n_chars: Column | None = None) -> list[Column]:
    """The fields of a document's leaf; `n_chars` may be another than the stored one."""
    n_chars = F.col("n_chars") if n_chars is None else n_chars
    return [field(F.col("doc_id"), False), field(F.col("source")), field(F.col("lang")), field(n_chars, False), field(F.col("text"))]


def audit(docs: DataFrame, every: int = 7, bits: int = BITS) -> DataFrame:
    """Proofs of all documents, checked against leaves that are tampered with where `every` divides the CRC-32 of the doc_id.

    A tampered leaf has 1 more in n_chars; a null n_chars stays, and a null doc_id is never tampered with. Returns doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.
    """
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    shown = F.when(changed, digest(document_fields(F.col("n_chars") + 1)))
    manifest = build(docs, F.col("lang"), F.col("doc_id"), document_fields(), {"doc_id": F.col("doc_id").cast("long"), "shown": shown}, bits)
    folded = manifest.proofs().withColumn("folded_root", fold(F.coalesce("shown", "leaf"), F.col("steps")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
