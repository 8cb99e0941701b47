from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm import data

from lakeops.llm import token_files as op

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), np.minimum(rng.zipf(1.3, n), 49407), np.full(n, 7), np.tile(rng.integers(0, 9, 50), n // 50 + 1)[:n]):
        back, counts = op.unpack_section(op.pack_section(ids.astype(np.int64), np.array([n]), block=256))
        assert (back == ids).all() and counts.tolist() == [n]


def test_it_learns():
    ids = np.tile(np.random.default_rng(1).integers(0, 49408, 200), 40)
    assert len(op.pack_section(ids, np.array([len(ids)]), block=8000)) < 0.2 * 2 * len(ids)


def test_damage_is_found():
    section = bytearray(op.pack_section(np.arange(5000) % 77, np.array([5000])))
    for at in (40, len(section) // 2, len(section) - 1):
        broken = bytearray(section)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            op.unpack_section(bytes(broken))


def test_blocks_are_independent():
    ids = np.random.default_rng(2).integers(0, 3000, 1024)
    together, alone = op.encode_blocks(ids, 256), op.encode_blocks(ids[256:512], 256)
    assert together[1] == alone[0]


def test_words_with_the_mark():
    texts = ["a \x01 b", "x\x01y !\x01", "\x01", "\x01\x01 \x01!", "plain words only", "", "\u00a0\x01 é", "w " * 200 + "\x01"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(op.VOCABULARY))
    wanted = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    encoder = op.Encoder(public_tokenizers.path(op.VOCABULARY))
    for _ in range(2):  # fresh words, then known ones
        ids, counts = encoder.encode(pa.array(texts))
        assert ids.tolist() == sum(wanted, []) and counts.tolist() == [len(w) for w in wanted]


def test_a_task_keeps_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr(op, "KNOWN", 10)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(op.VOCABULARY))
    encoder = op.Encoder(public_tokenizers.path(op.VOCABULARY))
    for i in range(6):
        text = " ".join(f"word{j} thing" for j in range(i, i + 8))
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2] and len(encoder.known) <= 10 + 9


def test_carries_and_rare_ranks():
    rng = np.random.default_rng(5)
    for ranks in (np.full(700, 65535), rng.integers(0, 1 << 16, 5000), np.where(rng.random(5000) < 0.999, 0, 65535)):
        payloads = op.encode_blocks(ranks, 300)
        back = op.decode_blocks(payloads, 300).reshape(-1)[: len(ranks)]
        assert (back == ranks).all()


def test_a_piece_is_encoded_once():
    """Spellings that differ in case and in punctuation around them share their pieces."""
    encoder = op.Encoder(public_tokenizers.path(op.VOCABULARY))
    texts = ["tree Tree TREE tree. Tree, (TREE) tree! \u00c9t\u00e9 \u00e9t\u00e9 \u00c9T\u00c9."]
    ids, _ = encoder.encode(pa.array(texts))
    tokenizer = Tokenizer.from_file(public_tokenizers.path(op.VOCABULARY))
    assert ids.tolist() == [*tokenizer.encode(texts[0], add_special_tokens=False).ids, 2]
    assert len(encoder.known) == 7  # two words, five marks


@pytest.mark.parametrize("bits", [1, 20])
def test_pieces_are_those_of_the_library(monkeypatch, bits):
    monkeypatch.setattr(op, "_NAME_SLOTS", bits)  # many pieces share a slot
    tokenizer = Tokenizer.from_file(public_tokenizers.path(op.VOCABULARY))
    rng = np.random.default_rng(3)
    signs = [*"abzABZ019!?.,-_<>|/'\"# \t\n\x01\x1c\x85", *"\u00e9\u00c9\u00df\u00ff\u00d7\u00f7\u0130\u0131\u017f\u212a\u0301\u00f1\u4e2d\u0436\u00b2\u00aa", "<|endoftext|>", " ", " the ", "</w>", "'S"]
    texts = ["".join(rng.choice(signs, int(n))) for n in rng.integers(0, 30, 1500)]
    texts += ["x" * 70 + "a " + "x" * 70 + "b", "\u4e2d" * 40 + " " + "\u4e2d" * 41]
    encoder = op.Encoder(public_tokenizers.path(op.VOCABULARY))
    wanted = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    for _ in range(2):
        ids, counts = encoder.encode(pa.array(texts))
        assert ids.tolist() == sum(wanted, []) and counts.tolist() == [len(w) for w in wanted]


def test_a_worker_keeps_its_encoder():
    path = public_tokenizers.path(op.VOCABULARY)
    assert op.encoder_of(path) is op.encoder_of(path)


@pytest.mark.parametrize("n", [1, 2, 7, 3000, 1 << 16])
def test_ranks_share_their_class(n):
    ranks = op.Ranks(np.sort(np.random.default_rng(n).zipf(1.3, n).clip(max=10**6))[::-1])
    assert (ranks.width > 0).all()
    places = ranks.symbols * op._INNER + ranks.start[1:]
    found = ranks.found()
    assert (found[places] == np.arange(n)).all() and (found[places + ranks.width[1:] - 1] == np.arange(n)).all()
    assert set(np.bincount(ranks.symbols, ranks.width[1:])) <= {0, op._INNER}


def test_rows_of_one_id(spark):
    """Rows that share a doc_id are spread over the files by their texts."""
    docs = spark.range(0, 4000, numPartitions=4).selectExpr("7L as doc_id", "concat('word ', id) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one part
    files = op.write_files(docs, block=64, lanes=2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files.select("part").distinct().count() > 1
    assert op.read_files(files).selectExpr("count(distinct start) n").first()["n"] == 4000


def test_documents(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(op.VOCABULARY))
    odd = spark.createDataFrame([(901, "It's #2 <|endoftext|>x Ünïcode é   a\u001cb", "en", "a", 5, 1, True, 1, None)], data.SHAPE)
    docs = data.awkward(spark).unionByName(odd)
    rows = sorted(op.read_files(op.write_files(docs, block=512, lanes=8)).collect(), key=lambda r: r["start"])
    assert len(rows) == docs.count()
    names = [r["doc_id"] for r in rows]
    assert names == sorted(names, key=lambda x: (x is not None, x or 0))
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        if r["doc_id"] is not None:
            ids = np.array([*tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2], "<u4")
            assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
    assert op.read_files(op.write_files(data.nothing(spark))).count() == 0
