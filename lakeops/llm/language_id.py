"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. For each bit a binary classifier over hashed byte n-grams (2 to 4 bytes of the lower-cased text,
everything but letters as one blank) tells the languages with +1 from those with -1: its weight of an n-gram is the log ratio of the n-gram's mean
frequency on either side, its margin the mean weight in a text, scaled by a logistic fit on other labelled rows. Decoding adds up the logistic losses of the
margins against each codeword, every bit weighted by how far it beats guessing; the least loss wins. A text is `ambiguous` if the runner-up is close.

A null text, or one without a letter, is `und` with score 0. Without any labelled row every text is `und`; with one language all others are that one with
score 1. Rows that repeat a doc_id are rows of their own; a row whose doc_id is null is predicted but never learned from. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.text import flat, slices
from lakeops.llm.work import prepare

SIZES = (2, 3, 4)
BUCKETS = 1 << 16
LEARN_ROWS, FIT_ROWS = 3000, 1000  # expected rows per language that are learned from, and that margins are scaled on
MARGIN = 0.05
UNKNOWN = "und"
_BLOCK = 1 << 17
# ASCII letters as lower case, other ASCII as blank; bytes of longer characters stay.
_PLAIN = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """An n x bits matrix of +1 and -1. Up to five languages: all ways to part them; beyond: the best of many random matrices."""
    if n <= 1:
        return np.zeros((n, 0), np.int8)
    if n <= 5:
        columns = [[1, *(1 if (i >> k) & 1 else -1 for k in range(n - 1))] for i in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.int8).T
    bits = max(15, int(np.ceil(10 * np.log2(n))))
    rng, best, widest = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = np.where(rng.random((n, bits)).argsort(axis=0) < n // 2, 1, -1).astype(np.int8)
        apart = (bits - code.astype(int) @ code.T) // 2 + bits * np.eye(n, dtype=int)
        if apart.min() > widest:
            best, widest = code, apart.min()
    return best


def _features(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, segment starts, feature numbers) of the n-grams, block by block. N-grams don't cross rows; blanks alone are left out."""
    data = _PLAIN[data]
    wide = data.astype(np.uint32)
    for k, size in enumerate(SIZES):
        n = len(data) - size + 1
        for start in range(0, max(n, 0), _BLOCK):
            end = min(n, start + _BLOCK)
            code = wide[start:end].copy()
            for i in range(1, size):
                code = (code << np.uint32(8)) | wide[start + i : end + i]
            blank = (data[start:end] == 32) & (data[start + 1 : end + 1] == 32)
            row = np.searchsorted(bounds, np.arange(start, end), "right") - 1 if len(bounds) > _BLOCK else np.repeat(
                np.arange(len(bounds) - 1), np.diff(np.clip(bounds, start, end))
            )
            ok = ~blank & (np.arange(start + size, end + size) <= bounds[row + 1])
            code, row = code[ok], row[ok]
            if not len(code):
                continue
            number = ((code * np.uint32(0x9E3779B1)) ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(16)
            first = np.flatnonzero(np.diff(row, prepend=-1))
            yield row[first], first, number.astype(np.int64) + k * BUCKETS


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return flat(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))


def margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean weight of the n-grams of each text, for each bit. `weights` is features x bits."""
    data, bounds = _lowered(column)
    total = np.zeros((len(column), weights.shape[1] + 1), np.float64)
    bits = np.ascontiguousarray(weights.T)
    for rows, first, number in _features(data, bounds):
        total[rows, -1] += np.diff(np.append(first, len(number)))
        for b in range(bits.shape[0]):
            total[rows, b] += np.add.reduceat(bits[b][number], first, dtype=np.float64)
    return total[:, :-1] / np.maximum(total[:, -1:], 1)


@dataclass
class Model:
    """A bounded table: features x bits weights, and per bit the scale, shift and weight of its margin."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def decode(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity of margin rows."""
        if len(self.languages) < 2:
            return np.zeros(len(raw), int), np.ones(len(raw)), np.zeros(len(raw), bool)
        margin = raw * self.scale + self.shift
        loss = np.stack([(np.logaddexp(0, -margin * c) * self.trust).sum(axis=1) for c in self.code], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(raw))
        best, second = loss[rows, order[:, 0]], loss[rows, order[:, 1]]
        chance = np.exp(best[:, None] - loss)
        return order[:, 0], 1 / chance.sum(axis=1), (second - best) / self.trust.sum() < MARGIN


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            labels = np.array(part.column(1).to_pylist())
            data, bounds = _lowered(part.column(0))
            for rows, first, number in _features(data, bounds):
                ends = np.append(first[1:], len(number))
                for label in np.unique(labels[rows]):
                    at = np.concatenate([number[a:b] for a, b in zip(first[labels[rows] == label], ends[labels[rows] == label], strict=True)])
                    total.setdefault(str(label), np.zeros(len(SIZES) * BUCKETS, np.int64))
                    total[str(label)] += np.bincount(at, minlength=len(SIZES) * BUCKETS)
    for label, counts in total.items():
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array([label] * len(used)), pa.array(used), pa.array(counts[used])], names=["lang", "feature", "n"])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a one-dimensional logistic fit with a small ridge, by Newton steps on the standardised input."""
    mean, spread = x.mean(), x.std() + 1e-9
    design = np.stack([(x - mean) / spread, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (p - y)) + 1e-2 * beta * len(x) / 100
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2) * len(x) / 100
        step = np.linalg.solve(curve, slope)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta[0] / spread, beta[1] - beta[0] * mean / spread


def _sampled(rows: DataFrame, cap: int) -> DataFrame:
    """About `cap` rows per language, chosen by a hash; all of a language that has fewer."""
    found = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not found:
        return rows
    share: Column = F.lit(1.0)
    for lang, n in found.items():
        if n > cap:
            share = F.when(F.col("lang") == lang, F.lit(cap / n)).otherwise(share)
    return rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share * (1 << 30))


def train(docs: DataFrame, learn_rows: int = LEARN_ROWS, fit_rows: int = FIT_ROWS) -> Model:
    """A model from the labelled rows of `docs` whose crc32(doc_id as text) mod 3 is 0 (n-gram weights) or 2 (scales of the margins).

    About `learn_rows` and `fit_rows` rows of each language are read; n-grams are counted by the executors, and the driver gets one count per
    language and feature, and one row of margins for each row the scales are fitted on.
    """
    prepare(docs.sparkSession)
    part = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    labelled = docs.filter("lang is not null and text is not null").select("doc_id", "text", "lang", part.alias("part"))
    learn = _sampled(labelled.filter("part = 0"), learn_rows).select("text", "lang")
    counted = learn.mapInArrow(_counts, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    code = codewords(len(languages))
    counts = np.zeros((len(languages), len(SIZES) * BUCKETS))
    counts[counted["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int), counted["feature"].to_numpy(int)] = counted["n"]
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    bits = code.shape[1]
    weights = np.zeros((len(SIZES) * BUCKETS, bits), np.float32)
    for b in range(bits):
        weights[:, b] = np.log(share[code[:, b] > 0].mean(axis=0) / share[code[:, b] < 0].mean(axis=0))
    model = Model(languages, code, weights, np.ones(bits), np.zeros(bits), np.ones(bits))
    if bits:
        _fit(model, _sampled(labelled.filter(F.col("part") == 2).filter(F.col("lang").isin(languages)), fit_rows))
    return model


def _fit(model: Model, rows: DataFrame) -> None:
    sent = rows.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.record_batch([part.column(1), pa.array(margins(part.column(0), sent.value).tolist(), pa.list_(pa.float64()))], names=["lang", "m"])

    found = rows.select("text", "lang").mapInArrow(run, "lang string, m array<double>").toPandas()
    if not len(found):
        return
    raw = np.array(found["m"].tolist())
    which = found["lang"].map({x: i for i, x in enumerate(model.languages)}).to_numpy(int)
    weight = (1 / np.bincount(which, minlength=len(model.languages)))[which]
    weight *= len(which) / weight.sum()
    for b in range(raw.shape[1]):
        side = model.code[which, b] > 0
        if side.all() or not side.any():
            continue
        model.scale[b], model.shift[b] = _logistic(raw[:, b], side.astype(float), weight)
        wrong = ((raw[:, b] * model.scale[b] + model.shift[b] > 0) != side) * weight
        model.trust[b] = max(0.05, 1 - 2 * wrong.sum() / len(which))


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` whose text gets a language, with all their columns; all rows if the model has learned none."""
    prepare(docs.sparkSession)
    if not model.languages:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            for part in slices(batch, "text"):
                names, _, _ = _verdict(part.column(at), model)
                yield part.filter(pa.array(names != UNKNOWN))

    return docs.mapInArrow(run, docs.schema)


def _verdict(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    texts = column.cast(pa.large_string()).fill_null("")
    letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
    if not model.languages:
        letters[:] = False
    which, score, close = model.decode(margins(texts, model.weights))
    names = np.array([*model.languages, UNKNOWN], object)[np.where(letters, which, len(model.languages))]
    return names, np.where(letters, score, 0.0), close | ~letters


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score, ambiguous."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))  # plain arrays: executors need no copy of this package

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            for part in slices(batch, "text"):
                names, score, close = _verdict(part.column(2), model)
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(close)],
                    names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )

    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False)).alias("held_out")
    shape = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text").mapInArrow(run, shape)
