from __future__ import annotations

import random

import numpy as np
import pytest
from llm import data

from lakeops.llm import token_counts as op

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

PATH = public_tokenizers.path(op.VOCABULARY)


def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_every_prefix_of_random_texts():
    count, counter = library(), op.Counter(op.Vocabulary(PATH), op.classes(PATH))
    rng = random.Random(4)
    bits = [*"abcdeSTrlmvdt'  \n\t  0129!?-_.éß中 　😀'", "'s", "'re", "'ll", "<|endoftext|>", "<|endoft", " the", "\r\n"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(20)))
        assert counter.one(text).tolist() == [count(text[:i]) for i in range(len(text) + 1)], repr(text)


def test_documents_and_stored_prefixes(spark):
    count = library()
    special = spark.createDataFrame([(900, "a<|endoftext|> b", "en", "a", 5, 1, True, 1, None)], data.SHAPE)
    docs = data.awkward(spark).unionByName(special)
    rows = op.with_limit(op.count_prefixes(docs)).collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is None:
            continue
        text = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_bytes"]) == (count(text), len(text.encode()))
        assert r["over_limit"] == (r["n_tokens"] > 1024) and len(r["deltas"]) == len(text)
        for i in {len(text) // 3, min(len(text), 50)}:
            assert op.count_at(r["deltas"], i) == count(text[:i])
        fits = op.longest_prefix(r["deltas"], 20)
        counts = np.cumsum(np.frombuffer(r["deltas"], np.int8), dtype=int)
        assert fits == max((i + 1 for i, c in enumerate(counts) if c <= 20), default=0)
    assert op.count_prefixes(data.nothing(spark)).count() == 0


def test_classes_are_the_librarys():
    """Every code point between letters, numbers and others, alone and behind a space, is cut as the library cuts it."""
    kinds, cutter = op.classes(PATH), Tokenizer.from_file(PATH).pre_tokenizer
    names = {op._LETTER: "a", op._NUMBER: "1", op._OTHER: "!", op._BLANK: " "}
    assert (kinds[list(range(0xD800))] != 255).all() and kinds[0x1C89] == kinds[0xA7CB] == op._LETTER
    wrong = []
    for low in range(0, 0x30000, 1024):
        for c in (c for c in range(low, low + 1024, 3) if not 0xD800 <= c < 0xE000):
            text = f"x{chr(c)}y7{chr(c)}8?{chr(c)}?"
            points = np.array([ord(x) for x in text])
            starts, _, _ = op.cut(points, np.array([0, len(text)]), kinds)
            if starts.tolist() != [s for _, (s, _) in cutter.pre_tokenize_str(text)]:
                wrong.append((hex(c), names[int(kinds[c])]))
    assert wrong == []


def test_special_strings_and_long_blank_runs(spark):
    count = library()
    texts = ["a" + "\n \t" * 4000 + "b", "<|endoftext|>" * 3000 + "x", " " * 9000 + "z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op.count_prefixes(docs).collect():
        text = texts[r["doc_id"]]
        assert r["n_tokens"] == count(text)
        for end in (1, 2, len(text) // 2, len(text) - 1, len(text)):
            assert op.count_at(r["deltas"], end, r["jumps"]) == count(text[:end])


def test_counts_that_move_far():
    """A vocabulary could make a count move by more than a signed byte tells: nothing is lost then."""
    import pyarrow as pa

    class Far:
        vocabulary = type("", (), {"special": []})

        def plain(self, data, bounds):
            return np.array([0, 1, 301, 101, 0, 1, 2]), np.array([0, 4, 7])

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["abc", "de"])], names=["doc_id", "text"])
    first, second = next(op._count(Far)(iter([batch]))).to_pylist()
    assert [op.count_at(first["deltas"], i, first["jumps"]) for i in range(4)] == [0, 1, 301, 101] and first["n_tokens"] == 101
    assert op.longest_prefix(first["deltas"], 150, first["jumps"]) == 3 and second["jumps"] is None and second["n_tokens"] == 2
