from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction

from llm import data

from lakeops.llm import packing as op


def check(rows, lengths, capacities):
    """Every word of every document is in exactly one place; bins hold what they say and are as small as they can be."""
    bins, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
        covered[r["doc_id"], r["doc_words"], r["copy"]].append((r["start"], r["n_words"]))
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["n_words"]
        assert at == pieces[0]["bin_words"] and pieces[0]["capacity"] == min(c for c in capacities if c >= at)
    totals = defaultdict(list)
    for (doc, *_), spans in covered.items():
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
        totals[doc].append(at)
    assert {k: sorted(v) for k, v in totals.items()} == {k: sorted(v) for k, v in lengths.items()}


def test_pack(spark):
    docs = data.awkward(spark)
    lengths = defaultdict(list)
    for r in docs.collect():
        if n := len(data.words(r["text"])):
            lengths[r["doc_id"]].append(n)
    rows = op.pack(docs, shard=40).collect()
    check(rows, lengths, op.CAPACITIES)
    assert sorted(map(str, rows)) == sorted(map(str, op.pack(docs.repartition(3), shard=40).collect()))


def test_repeated_rows_are_split(spark):
    docs = spark.range(5000).selectExpr("1 as doc_id", "'a b c' as text")
    rows = op.pack(docs, shard=500).collect()
    assert len({(r["copy"], r["piece"]) for r in rows}) == len(rows) == 5000
    assert {r["capacity"] for r in rows} <= {512, 1024, 2048}  # a shard has about 1500 words


def test_cheapest_rule_and_downsizing():
    rng = random.Random(2)
    lengths = sorted((rng.randrange(1, 900) for _ in range(300)), reverse=True)
    bins, used, sizes = op.pack_shard(lengths, op.CAPACITIES, op.OVERHEAD)
    for rule in op.RULES:
        assert op.cost(sizes, op.OVERHEAD) <= op.cost(op.best_fit(lengths, op.CAPACITIES, op.OVERHEAD, rule)[2], op.OVERHEAD)
    assert sum(used) == sum(lengths) and all(u <= s for u, s in zip(used, sizes, strict=True))
    assert sum(sizes) < 1.05 * sum(lengths)


def test_best_fit_takes_the_fullest_bin():
    bins, used, _ = op.best_fit([700, 500, 300, 290], (1000,), 0, "largest")
    assert bins == [0, 1, 0, 1] and used == [1000, 790]


def test_empty(spark):
    assert op.pack(data.nothing(spark)).count() == 0
    assert op.pack(data.awkward(spark).filter("doc_id in (100, 101, 102)")).count() == 0


def slow_packing(lengths, capacities, overhead, rule):
    """Best-fit by looking at every open bin: [capacity after the cut, words of the pieces] of each bin."""
    bins, left = [], sum(lengths)
    for turn, n in enumerate(lengths):
        fits = [b for b in bins if b["size"] - sum(b["words"]) >= n]
        if fits:
            best = min(fits, key=lambda b: (b["size"] - sum(b["words"]), -b["turn"]))
        else:
            price = {}
            for c in capacities:
                if c >= n:
                    full = (c // n) * n
                    price[c] = Fraction(c + overhead, max(min(full + (c - full) // 2, left), n))
            size = {"ratio": min(price, key=lambda c: (price[c], c)), "largest": max(price), "smallest": min(price)}[rule]
            best = {"size": size, "words": []}
            bins.append(best)
        best["words"].append(n)
        best["turn"] = turn
        left -= n
    return sorted([min(c for c in capacities if c >= sum(b["words"])), b["words"]] for b in bins)


def slow_choice(lengths, capacities, overhead):
    """The least cost over all opening rules with all capacities, and by cost per word with the longest ones left out."""
    ways = [(capacities, rule) for rule in ("ratio", "largest", "smallest")]
    ways += [(capacities[:n], "ratio") for n in range(1, len(capacities)) if not lengths or lengths[0] <= capacities[n - 1]]
    return min(sum(size + overhead for size, _ in slow_packing(lengths, c, overhead, rule)) for c, rule in ways)


def test_best_fit_against_a_slow_one():
    rng = random.Random(5)
    for capacities, overhead, longest in (((512, 1024, 2048, 4096), 64, 4096), ((8, 12, 20), 3, 20), ((10,), 0, 10), ((5, 50), 1, 50)):
        for n in (0, 1, 2, 7, 60):
            lengths = sorted((min(longest, 1 + int(rng.expovariate(4 / longest))) for _ in range(n)), reverse=True)
            for rule in op.RULES:
                bins, used, sizes = op.best_fit(lengths, capacities, overhead, rule)
                found = [[size, [n for n, b in zip(lengths, bins, strict=True) if b == i]] for i, size in enumerate(sizes)]
                assert sorted(found) == slow_packing(lengths, capacities, overhead, rule)
                assert used == [sum(words) for _, words in found]
            assert op.cost(op.pack_shard(lengths, capacities, overhead)[2], overhead) == slow_choice(lengths, capacities, overhead)


def test_one_shard_against_a_slow_packing(spark):
    docs = data.awkward(spark)
    pieces = []
    for r in docs.collect():
        n = len(data.words(r["text"]))
        pieces += [op.CAPACITIES[-1]] * (n // op.CAPACITIES[-1]) + [n % op.CAPACITIES[-1]] * (n % op.CAPACITIES[-1] > 0)
    bins = {r["bin_id"]: r["capacity"] for r in op.pack(docs, shard=1_000_000).collect()}
    assert sum(bins.values()) + op.OVERHEAD * len(bins) == slow_choice(sorted(pieces, reverse=True), op.CAPACITIES, op.OVERHEAD)
