"""Token counts of every prefix of a text, by dynamic programming over a byte-level BPE vocabulary.

The last token of a prefix tells its whole encoding: it is the one vocabulary entry that ends the prefix and may follow the last token of what is left. Whether two
tokens may stand side by side follows from the merges that built them: no merge across their border may come before the merges that use up the pieces next to it. So
one pass over a piece of text gives the exact count at each of its prefixes. Texts are cut into pieces as the vocabulary's pattern does, for a whole batch at a time; each
distinct piece of a task is solved once. Where a prefix ends inside a blank run, a contraction or a special string, it is cut otherwise than the
whole text; those places are counted as the library counts the prefix alone.

`deltas` holds the change of the count from prefix to prefix, a signed byte a code point; `jumps` holds what a byte cannot, as behind a very long blank run (null for
nearly all texts). `count_at` and `longest_prefix` answer truncation and
budget questions from it without encoding anything again.

Null is the empty text: 0 tokens. Rows that repeat a doc_id, or have none, are rows of their own. Further columns of the input are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm.text import flat, mix, powers, slices
from lakeops.llm.work import prepare

VOCABULARY, LIMIT = "byte_bpe_50k.json", 1024
_SLICE = 1 << 20
_LETTER, _NUMBER, _BLANK, _OTHER = 1, 2, 3, 0
_REMEMBERED = 1 << 24  # counts of solved pieces that a task keeps


def classes(path: str) -> np.ndarray:
    """Letter, number, blank or other for every code point, as the vocabulary's own pre-tokenizer sees them: it joins runs of a class and cuts elsewhere.

    Its tables may know letters that Python's do not. A code point that joins an `a` is a letter, a 1 a number, a ! other; one that joins nothing is a blank.
    Surrogates do not occur in texts.
    """
    cutter = Tokenizer.from_file(path).pre_tokenizer
    table = np.full(0x110000, _OTHER, np.uint8)
    for low in range(0, 0x110000, 4096):
        points = [c for c in range(low, low + 4096) if not 0xD800 <= c < 0xE000]
        run = "".join(map(chr, points))
        if not run or len(cutter.pre_tokenize_str("!" + run)) == 1:
            continue
        table[points] = _BLANK
        for mark, kind in (("a", _LETTER), ("1", _NUMBER), ("!", _OTHER)):
            text = "".join(mark + c for c in run) + mark
            cuts = {start for _, (start, _) in cutter.pre_tokenize_str(text)}
            table[[c for i, c in enumerate(points) if 2 * i + 1 not in cuts and 2 * i + 2 not in cuts]] = kind
    return table


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens by bytes, and for each token the merge that made it. Ids of merged tokens grow with the rank of their merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_alphabet()
        raw = lambda token: bytes(letters[c] for c in token)
        model = spec["model"]
        special = {t["content"] for t in spec["added_tokens"]}
        names = {t: i for t, i in model["vocab"].items() if t not in special}
        self.token = {raw(t): i for t, i in names.items()}
        self.special = sorted(special, key=len, reverse=True)
        self.longest = max(map(len, self.token))
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = names[left], names[right], names[left + right]
            self.rank[a, b] = rank
            if c not in made:
                made[c], self.parts[c] = rank, (a, b)
        # Along a token's right (left) edge: pieces from the whole down, each with the rank of the merge that uses it up.
        self._right = {t: self._edge(t, 1, made) for t in names.values()}
        self._left = {t: self._edge(t, 0, made) for t in names.values()}
        self._follows: dict[int, bool] = {}

    def _edge(self, token: int, side: int, made: dict[int, int]) -> list[tuple[int, float]]:
        out, until = [], float("inf")
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out
            until, token = made[token], self.parts[token][side]

    def follows(self, a: int, b: int) -> bool:
        """Whether a and b can be neighbours in an encoding."""
        rank = self.rank
        for x, used_a in self._right[a]:
            for y, used_b in self._left[b]:
                merge = rank.get((x, y))
                if merge is not None and merge < used_a and merge <= used_b:
                    return False
        return True

    def prefix_counts(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """For each of the sorted pieces, the tokens in each of its byte prefixes; place 0 is the empty prefix.

        A piece goes on from what it has in common with the one before it. The lists are reused: read each before the next.
        """
        token, known, longest = self.token.get, self._follows, self.longest
        last, counts, before = [-1], [0], b""
        for piece in pieces:
            common, most = 0, min(len(piece), len(before))
            while common < most and piece[common] == before[common]:
                common += 1
            del last[common + 1 :], counts[common + 1 :]
            for end in range(common + 1, len(piece) + 1):
                for start in range(max(0, end - longest), end):
                    t = token(piece[start:end])
                    if t is None:
                        continue
                    if start:
                        pair = last[start] << 20 | t
                        fits = known.get(pair)
                        if fits is None:
                            fits = known[pair] = self.follows(last[start], t)
                        if not fits:
                            continue
                    last.append(t)
                    counts.append(counts[start] + 1)
                    break
                else:
                    raise ValueError(f"no token for byte {piece[end - 1]}")
            before = piece
            yield counts


def cut(points: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the pieces of texts (code points, row bounds), starts of the contractions with two letters, and (start, end) of blank runs before other text.

    Pieces: 's 't 'm 'd 're 've 'll; a run of letters, of numbers or of others, with one space before it; a blank run, whose last blank goes with (space) or
    stands before (any other) the text that follows.
    """
    n = len(points)
    kind = kinds[points]
    row_start = np.zeros(n + 1, bool)
    row_start[bounds] = True
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start |= row_start
    runs = np.flatnonzero(start)
    first, end = runs[:-1], runs[1:]
    blank = kind[first] == _BLANK
    # Blank runs with text of their row behind them.
    before = blank & ~row_start[end]
    s, e = first[before], end[before]
    space = points[e - 1] == 32
    start[e[space]] = False
    start[e - 1] = True
    # Contractions: an apostrophe alone, not after a space.
    alone = first[(end - first == 1) & (points[first] == 39)]
    alone = alone[row_start[alone] | (points[np.maximum(alone, 1) - 1] != 32)]
    padded = np.append(points, [0, 0])
    near, next_ = ~row_start[np.minimum(alone + 1, n)], ~row_start[np.minimum(alone + 2, n)]  # still in the row
    one, two = padded[alone + 1], padded[alone + 2]
    single = np.isin(one, [ord(c) for c in "stmd"]) & near
    double = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & near & next_
    short, long = alone[single], alone[double]
    for at, size in ((short, 2), (long, 3)):
        start[at + 1] = False
        start[at + size] = True
    return np.flatnonzero(start[:n]), long, np.stack([s, e], axis=1)


class Counter:
    """Prefix counts of batches of texts; solved pieces are kept for the next batch."""

    def __init__(self, vocabulary: Vocabulary, kinds: np.ndarray):
        self.vocabulary, self.kinds = vocabulary, kinds
        self.known = np.zeros(0, np.uint64)
        self.where = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _solve(self, names: np.ndarray, begin: np.ndarray, end: np.ndarray, raw: bytes) -> np.ndarray:
        """Where the prefix counts of each piece begin in `flat`; new pieces (by name) are solved. A full memory starts anew."""
        if len(self.flat) > _REMEMBERED:
            self.known, self.where, self.flat = self.known[:0], self.where[:0], self.flat[:0]
        distinct, example, inverse = np.unique(names, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        fresh = np.ones(len(distinct), bool)
        inner = place < len(self.known)
        fresh[inner] = self.known[place[inner]] != distinct[inner]
        if fresh.any():
            new = distinct[fresh]
            pieces = [raw[begin[i] : end[i]] for i in example[fresh]]
            order = sorted(range(len(pieces)), key=pieces.__getitem__)
            where, added = np.zeros(len(new), np.int64), []
            for i, counts in zip(order, self.vocabulary.prefix_counts([pieces[i] for i in order]), strict=True):
                where[i] = len(self.flat) + len(added)
                piece = pieces[i]
                if piece.isascii():
                    added += counts
                else:  # prefixes of whole characters
                    added += [c for c, byte in zip(counts, piece + b"\0", strict=True) if byte & 0xC0 != 0x80]
            self.flat = np.concatenate([self.flat, np.array(added, np.int32)])
            known, where = np.concatenate([self.known, new]), np.concatenate([self.where, where])
            order = np.argsort(known, kind="stable")
            self.known, self.where = known[order], where[order]
            place = np.searchsorted(self.known, distinct)
        return self.where[place][inverse]

    def plain(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts at every code point prefix of texts without special strings, and the row bounds in them (n + 1 counts for n code points)."""
        rows = len(bounds) - 1
        lead = (data & 0xC0) != 0x80
        at = np.append(np.flatnonzero(lead), len(data))  # byte of each code point
        chars = np.append(0, np.cumsum(lead))[bounds]
        out_bounds = chars + np.arange(rows + 1)
        out = np.zeros(out_bounds[-1], np.int32)
        if not len(data):
            return out, out_bounds
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        start, long, blanks = cut(points, chars, self.kinds)
        end = np.append(start[1:], len(points))
        begin_all, end_all = np.concatenate([start, blanks[:, 0]]), np.concatenate([end, blanks[:, 1]])
        names = _names(data, at[begin_all], at[end_all])
        where = self._solve(names, at[begin_all], at[end_all], raw)
        size = end - start
        total = self.flat[where[: len(start)] + size].astype(np.int64)
        row = np.searchsorted(chars, start, "right") - 1
        summed = np.append(0, np.cumsum(total))
        base = summed[:-1] - summed[np.searchsorted(start, chars[row])]
        # Place p + 1 of the output is the prefix that ends with code point p; every row has one place more, for its empty prefix.
        shift = np.repeat(row, size) + 1
        inner = np.arange(len(points)) - np.repeat(start, size) + 1
        out[np.arange(len(points)) + shift] = np.repeat(base, size) + self.flat[np.repeat(where[: len(start)], size) + inner]
        out[long + 1 + row[np.searchsorted(start, long)] + 1] = base[np.searchsorted(start, long)] + 2
        if len(blanks):
            first = np.searchsorted(start, blanks[:, 0])
            out[blanks[:, 1] - 1 + row[first] + 1] = base[first] + self.flat[where[len(start) :] + (blanks[:, 1] - blanks[:, 0])]
        return out, out_bounds

    def one(self, text: str) -> np.ndarray:
        """Counts at every prefix of one text, special strings included."""
        out, base, begin = [np.zeros(1, np.int64)], 0, 0
        for at, special in self._specials(text):
            # A special string that is not complete yet is text like any other.
            segment = text[begin : at + len(special) - 1].encode()
            counts, _ = self.plain(np.frombuffer(segment, np.uint8), np.array([0, len(segment)]))
            out.append(counts[1:] + base)
            base += int(counts[at - begin]) + 1
            out.append(np.array([base]))
            begin = at + len(special)
        segment = text[begin:].encode()
        counts, _ = self.plain(np.frombuffer(segment, np.uint8), np.array([0, len(segment)]))
        return np.concatenate([*out, counts[1:] + base])

    def _specials(self, text: str) -> Iterator[tuple[int, str]]:
        """Leftmost special strings without overlap, the longest of those that begin at one place."""
        begin = 0
        found = {s: text.find(s) for s in self.vocabulary.special}
        while True:
            found = {s: at if at >= begin else text.find(s, begin) for s, at in found.items() if at >= 0}
            found = {s: at for s, at in found.items() if at >= 0}
            if not found:
                return
            special = min(found, key=lambda s: (found[s], -len(s)))
            yield found[special], special
            begin = found[special] + len(special)


def _names(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range. Ranges are long only now and then; each byte counts by its place in its range."""
    size = end - begin
    index = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    value = mix(np.arange(1, 257, dtype=np.uint64))[data[index]] * powers(int(size.max()) + 1)[inner]
    return mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64))


_JUMPS = pa.list_(pa.struct([("at", pa.int64()), ("more", pa.int64())]))


def _count(make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = make()
        special = [s.encode() for s in counter.vocabulary.special]
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                data, bounds = flat(part.column(1))
                counts, ends = counter.plain(data, bounds)
                if any(s in data.tobytes() for s in special):
                    texts = part.column(1).to_pylist()
                    rows = [
                        counter.one(t) if t and any(s in t for s in counter.vocabulary.special) else counts[a:b] for t, a, b in zip(texts, ends, ends[1:], strict=False)
                    ]
                    counts = np.concatenate(rows)
                tokens = counts[ends[1:] - 1]
                change = np.diff(counts, prepend=0)
                change = np.delete(change, ends[:-1])
                places = ends - np.arange(len(ends))
                deltas = np.clip(change, -127, 127).astype(np.int8)
                far = np.flatnonzero(change != deltas)
                jumps = [None] * part.num_rows
                for at, row in zip(far, np.searchsorted(places, far, "right") - 1, strict=True):
                    jumps[row] = [*(jumps[row] or []), {"at": int(at - places[row]), "more": int(change[at]) - int(deltas[at])}]
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(deltas)])
                yield pa.record_batch(
                    [part.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(tokens, pa.int64()), binary.cast(pa.binary()), pa.array(jumps, _JUMPS)],
                    names=["doc_id", "n_bytes", "n_tokens", "deltas", "jumps"],
                )

    return run


def count_prefixes(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, deltas and jumps (see `count_at`). `path` names a byte-level BPE file of the tokenizers library."""
    spark = prepare(docs.sparkSession)
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    kinds = spark.sparkContext.broadcast(classes(path))

    def make() -> Counter:
        return Counter(Vocabulary(path), kinds.value)

    shape = "doc_id long, n_bytes long, n_tokens long, deltas binary, jumps array<struct<at: bigint, more: bigint>>"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(lambda b: _count(make)(b), shape)


def with_limit(counted: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Whether a document has more than `limit` tokens."""
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _changes(deltas: bytes, jumps: list | None) -> np.ndarray:
    out = np.frombuffer(deltas, np.int8).astype(np.int64)
    for jump in jumps or ():
        out[jump["at"]] += jump["more"]
    return out


def count_at(deltas: bytes, end: int, jumps: list | None = None) -> int:
    """Tokens of the first `end` code points."""
    return int(_changes(deltas, jumps)[:end].sum())


def longest_prefix(deltas: bytes, budget: int, jumps: list | None = None) -> int:
    """Code points of the longest prefix with at most `budget` tokens."""
    fits = np.flatnonzero(np.cumsum(_changes(deltas, jumps)) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0
