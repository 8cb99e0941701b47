from __future__ import annotations

import math
import random
import zlib

import numpy as np
from llm import data

from lakeops.llm import language_id as op


def test_codewords_tell_all_languages_apart():
    for n in range(2, 12):
        code = op.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (2 ** (n - 2) if n <= 5 else 3)
        assert (np.abs(code.sum(axis=0)) < n).all()  # no bit is the same for all


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(3)
    rows = [(i, data.prose(rng, rng.randrange(8, 60), lang), lang) for i in range(600) for lang in [("en", "de", "fr")[i % 3]]]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "123 !?", "de"), (None, data.prose(rng, 30, "de"), "fr"), (3, rows[3][1], "en"), (3, rows[3][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as lang_pred", "0.5D as score")
    found = op.predict(docs, op.train(docs)).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    for i in (1000, 1001, 1002):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["ambiguous"]) == ("und", 0.0, True)
    assert by[None]["lang_pred"] == "de" and by[None]["held_out"] is False
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found if r["doc_id"] is not None)
    held = [(r["lang_pred"], dict((a, c) for a, _, c in rows[:600])[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] < 600]
    assert np.mean([a == b for a, b in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = op.keep_known(docs, op.train(docs))
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3


def test_prediction_ignores_labels(spark):
    docs = data.awkward(spark)
    model = op.train(docs)
    one = op.predict(docs, model).orderBy("doc_id", "score").collect()
    other = op.predict(docs.selectExpr("doc_id", "text", "'zz' as lang"), model).orderBy("doc_id", "score").collect()
    assert one == other


def test_none_or_one_language(spark):
    docs = spark.createDataFrame([(i, "some text", None) for i in range(9)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in op.predict(docs, op.train(docs)).collect()} == {"und"}
    docs = docs.selectExpr("doc_id", "text", "'en' as lang")
    assert {(r["lang_pred"], r["score"]) for r in op.predict(docs, op.train(docs)).collect()} == {("en", 1.0)}
    empty = docs.filter("false")
    assert op.predict(empty, op.train(empty)).count() == 0


def test_documents_stay_if_no_language_was_learned(spark):
    docs = spark.createDataFrame([(i, f"clean words of text {i}", None) for i in range(20)], "doc_id long, text string, lang string")
    assert op.keep_known(docs, op.train(docs)).count() == 20


def plain_features(text):
    """Numbers of the byte n-grams of a text, one at a time."""
    raw = [b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode()]
    for k, size in enumerate(op.SIZES):
        for i in range(len(raw) - size + 1):
            if raw[i] == raw[i + 1] == 32:
                continue
            code = int.from_bytes(bytes(raw[i : i + size]), "big") & 0xFFFFFFFF
            number = ((code * 0x9E3779B1 & 0xFFFFFFFF) ^ (code >> 15)) * 0x85EBCA77 & 0xFFFFFFFF
            yield k * op.BUCKETS + (number >> 16)


def plain_margin(text, weights, bit):
    found = [float(weights[f, bit]) for f in plain_features(text)]
    return sum(found) / max(1, len(found))


def test_training_and_decoding_against_plain_counts(spark):
    rng = random.Random(8)
    rows = [(i, data.prose(rng, rng.randrange(0, 30), lang) + rng.choice(["", " 7  é!", "\n\nÀ"]), lang) for i in range(240) for lang in [("en", "de", "fr")[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op.train(docs)
    assert model.languages == ["de", "en", "fr"]
    counts = {x: {} for x in model.languages}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 3 == 0:
            for f in plain_features(text):
                counts[lang][f] = counts[lang].get(f, 0) + 1
    size = len(op.SIZES) * op.BUCKETS
    total = {x: sum(c.values()) + size / 2 for x, c in counts.items()}
    seen = sorted(set().union(*counts.values())) + [0, size - 1]
    for bit in range(model.code.shape[1]):
        for f in seen[:: 1 + bit]:
            sides = [[(counts[x].get(f, 0) + 0.5) / total[x] for x, c in zip(model.languages, model.code[:, bit], strict=True) if c == s] for s in (1, -1)]
            assert abs(model.weights[f, bit] - math.log(sum(sides[0]) / len(sides[0]) / (sum(sides[1]) / len(sides[1])))) < 1e-4
    found = {r["doc_id"]: r for r in op.predict(docs, model).collect()}
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text):
            assert found[i]["lang_pred"] == "und"
            continue
        loss = []
        for word in model.code:
            each = [
                math.log1p(math.exp(-int(c) * (plain_margin(text, model.weights, b) * model.scale[b] + model.shift[b]))) * model.trust[b] for b, c in enumerate(word)
            ]
            loss.append(sum(each))
        first, second = sorted(loss)[:2]
        assert loss[model.languages.index(found[i]["lang_pred"])] - first < 1e-6
        assert abs(found[i]["score"] - 1 / sum(math.exp(first - x) for x in loss)) < 1e-6
        gap = (second - first) / sum(model.trust)
        assert found[i]["ambiguous"] == (gap < op.MARGIN) or abs(gap - op.MARGIN) < 1e-6
