from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from llm import data
from pyspark.sql import functions as F

from lakeops.llm import merkle


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def levels(leaves):
    out = [list(leaves)]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def leaf(row, more=0):
    n_chars = None if row["n_chars"] is None else row["n_chars"] + more
    values = [row["doc_id"], row["source"], row["lang"], n_chars, row["text"]]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def siblings(tree, i):
    out = []
    for level in tree[:-1]:
        out.append(None if i ^ 1 >= len(level) else ((i & 1) == 1, level[i ^ 1]))
        i >>= 1
    return out


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault((row["lang"] is not None, row["lang"] or ""), []).append(row)
    out, tops = [], []
    for key in sorted(trees):
        trees[key].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        tops.append(levels([leaf(r) for r in trees[key]]))
    over = levels([t[-1][0] for t in tops])
    for t, key in enumerate(sorted(trees)):
        for i, row in enumerate(trees[key]):
            way = siblings(tops[t], i) + siblings(over, t)
            shown = leaf(row, int(row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0))
            folded = shown
            for step in way:
                folded = h(folded) if step is None else h(step[1], folded) if step[0] else h(folded, step[1])
            proof = h(*(s[1] for s in way if s))
            out.append((row["doc_id"], leaf(row), tops[t][-1][0], over[-1][0], proof, folded, folded == over[-1][0]))
    return out


def keyed(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_places():
    for n in [*range(1, 40), 64, 65, 100]:
        leaves = [str(i) for i in range(n)]
        tree = levels([h(x) for x in leaves])
        log = merkle.append_log([h(x) for x in leaves], merkle.depth(n))
        assert len(log) == sum(map(len, tree))
        for height, level in enumerate(tree):
            for i, node in enumerate(level):
                assert log[int(merkle.place(height, i, n))] == node


def test_a_part_of_a_larger_tree_goes_up_alone():
    log = merkle.append_log(["a"], 3)
    assert log == ["a", h("a"), h(h("a")), h(h(h("a")))] and int(merkle.place(3, 0, 1)) == 3


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_audit(spark, bits):
    docs = data.awkward(spark)
    want = brute(docs.collect())
    assert keyed(merkle.audit(docs, bits=bits).collect()) == keyed(want)
    # Odd numbers are tampered with and found; the proof of a null n_chars has nothing to change.
    broken = {r[0] for r in want if not r[6]}
    assert broken and all(zlib.crc32(str(d).encode()) % 7 == 0 for d in broken)


def test_many_keys(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.concat(F.lit("l"), F.col("id") % 37).alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert keyed(merkle.audit(docs, bits=2).collect()) == keyed(brute(docs.collect()))


def test_log_rows(spark):
    docs = data.awkward(spark)
    manifest = merkle.build(docs, F.col("lang"), F.col("doc_id"), merkle.document_fields(), bits=3)
    rows = merkle.log_rows(manifest.rounds, 3).filter("tree = '=en' and round = 0 and block = 0").orderBy("place").collect()
    leaves = [r["digest"] for r in manifest.leaves.filter("tree = '=en'").orderBy("idx").collect()]
    assert [r["digest"] for r in rows] == merkle.append_log(leaves[:8], 3)


def test_empty_and_single(spark):
    assert merkle.audit(data.nothing(spark)).collect() == []
    one = data.awkward(spark).filter("doc_id = 104")
    row = merkle.audit(one).head()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == h()
