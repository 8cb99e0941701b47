from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
from llm import data
from pyspark.sql import functions as F

from lakeops.llm import fill_middle as fim
from lakeops.llm.text import flat


def brute(doc_id, text):
    t = text or ""
    key = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    rng = random.Random(3)
    letters = "ab \n<PSM>é中😀" + "xyz" * 5
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 400))) for _ in range(200)]
    shared = data.prose(rng, 900)
    out += [data.prose(rng, 50) + shared + data.prose(rng, rng.randrange(50), "fr") for _ in range(20)]
    out += ["中" * 20_000, "x" * 50_000, "<" * 9000 + "P>", "y" * 4095 + "<P>" + "y" * 5000, "😀", "a", "<P", "P>", "<S<S>", None]
    return out


def test_forms(spark):
    rows = [(i, t, "z") for i, t in enumerate(odd_texts())] + [(None, "no number at all", "z"), (3, "again", "z"), (3, "again", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    made = fim.fill_in_middle(docs)
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, r[5])
    assert sorted((tuple(r)[:6] for r in got), key=order) == sorted((brute(d, t) for d, t, _ in rows), key=order)
    assert sorted((r["doc_id"] or -1, r["back"]) for r in got) == sorted((d or -1, t or "") for d, t, _ in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_awkward(spark):
    docs = data.awkward(spark)
    got = fim.fill_in_middle(docs).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(brute(r["doc_id"], r["text"])) for r in docs.collect())
    assert fim.fill_in_middle(data.nothing(spark)).collect() == []


def cuts(texts):
    bytes_, bounds = flat(pa.array(texts, pa.string()))
    return bytes_, bounds, fim.chunk_starts(bytes_, bounds)


def test_chunks_follow_content():
    rng = random.Random(1)
    shared = data.prose(rng, 2000)
    texts = [data.prose(rng, 300) + shared, shared + data.prose(rng, 100, "de"), "é" * 9000]
    raw, bounds, starts = cuts(texts)
    assert set(bounds[:-1].tolist()) <= set(starts.tolist()) and not ((raw[starts] & 0xC0) == 0x80).any()
    assert np.diff(np.append(starts, len(raw))).max() <= fim.LONGEST + 3
    pieces = [{raw[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(raw)), strict=True) if lo <= a < hi} for lo, hi in zip(bounds, bounds[1:], strict=False)]
    assert len(pieces[0] & pieces[1]) > 0.8 * len(pieces[1]) * len(shared) / len(texts[1])
    # The chunks of a text do not depend on the text before it.
    alone = cuts(texts[1:2])[2]
    assert (alone + bounds[1]).tolist() == [s for s in starts.tolist() if bounds[1] <= s < bounds[2]]


def test_memory_is_bounded():
    rng = random.Random(2)
    texts = [data.prose(rng, 200) for _ in range(40)] * 2
    raw, bounds, starts = cuts(texts)
    for memory in (500, fim.MEMORY):
        chunks, got = fim.Chunks(memory), []
        for i, text in enumerate(texts):
            inside = [int(s - bounds[i]) for s in starts if bounds[i] <= s < bounds[i + 1]]
            got.append(fim.transform_text(text.encode(), inside, chunks, (i * 7919, i * 104729, 0, 50)))
            assert chunks.held <= memory + fim.LONGEST + 3
        assert [g[0] for g in got] == list(map(len, texts))
        assert [g[4] for g in got[:40]] != [g[4] for g in got[40:]]
    assert chunks.found >= len(starts) // 2
