from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm import data

from lakeops.llm import repeats as op


def brute(texts: list, window: int) -> list[tuple]:
    docs = [data.words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def passages(seed: int) -> list:
    """Random texts over few words, with passages shared by two or by many."""
    rng = random.Random(seed)
    text = lambda n: [rng.choice("ab") + str(rng.randrange(40)) for _ in range(n)]
    shared = [text(n) for n in (34, 35, 36, 60, 90)]
    out = []
    for _ in range(120):
        words = text(rng.randrange(5, 120))
        for s in rng.choices(shared, k=rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = s if rng.random() < 0.7 else s[: rng.randrange(30, len(s) + 1)]
        out.append(" ".join(words))
    return out + [None, "", " ".join(["again"] * 80), " ".join(["again"] * 20), out[0], out[0]]


@pytest.mark.parametrize("crowd", [500, 10, 1])
def test_against_brute_force(spark, crowd):
    texts = passages(crowd)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as n_words", "'x' as runs", "2 as place")
    rows = sorted(op.remove_repeats(docs, crowd=crowd, group=3000).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows] == brute(texts, 35)


def test_awkward_rows(spark):
    docs = data.awkward(spark)
    kinds = sorted((r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op.remove_repeats(docs).collect())
    assert kinds == sorted(brute([r["text"] for r in docs.collect()], 35))
    assert op.remove_repeats(data.nothing(spark)).count() == 0


def test_least_of():
    values = np.random.default_rng(1).integers(0, 9, 200)
    for span in (1, 2, 3, 7, 28):
        assert op.least_of(values, span).tolist() == [i + int(np.argmin(values[i : i + span])) for i in range(200 - span + 1)]


def test_many_equal_rows(spark):
    """Rows that repeat cost in proportion to their number: each place of theirs counts once."""
    text = " ".join(str(i * i % 1009) for i in range(120))
    docs = spark.range(4000).selectExpr("cast(null as bigint) as doc_id", f"'{text}' as text")
    rows = op.remove_repeats(docs).groupBy("n_words", "n_removed").count().collect()
    assert [tuple(r) for r in rows] == [(120, 120, 4000)]
