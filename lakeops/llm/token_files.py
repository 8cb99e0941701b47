"""Token-id files: an adaptive context-mixing range coder in independently reset, checksummed blocks.

A file is a Parquet table of sections in document order. A section holds whole documents: a header (magic, version, sizes, CRC-32 of the
rest), the documents' id counts, the different ids by falling frequency, their counts, and for each block its payload size, the CRC-32 of its
ids and the payload. Each block starts with a fresh model and can be decoded alone; a section's blocks are coded side by side, one array element each.

Ids are coded as ranks by frequency in their section. The model of a block predicts the next one in three orders. Orders 2 and 1 name the id that last followed the same
two ids, or the same one. The symbol that is coded says that a named id comes, or else the class of the rank: six classes of about equal weight. The rank in its class
follows by its count in the section. Three adaptive distributions predict the symbol: order 0; order 1, by the last id (by size, if it is not frequent); order 2, by how
often in a row the named ids were right. They are mixed by weights that follow the best of them. All arithmetic that the other side must repeat is exact, so encoder and
decoder agree everywhere.

Null texts are empty; every document has at least its end id. Documents are in ascending doc_id, null first, rows that repeat a doc_id by a hash of their text. An
empty table gives empty files. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.text import Words, flat, mix, slices
from lakeops.llm.work import prepare, stored

VOCABULARY, END = "word_bpe_49k.json", 2
BLOCK, LANES = 4096, 2048
KNOWN = 1 << 20  # pieces of words whose ids a Python worker keeps
MAGIC = b"TIDS"
_HEADER = "<4sHIIIIQ"  # magic, version, ids per block, blocks, documents, distinct ids, ids
_VERSION = 3
_CLASSES = 6  # of ranks
_SYMBOLS = _CLASSES + 2  # the ids that orders 2 and 1 name come first
_INNER = 1 << 16  # what the ranks of a class share
_SLOTS = 1 << 11
_NAME = 17  # bits of a rank in a slot; the rest tells how sure it is
_NOBODY = (1 << _NAME) - 1
_SURE = 5  # 0: no id is named; 1 to 4: how often in a row it was right, plus 1
_WORTHS = 2 * _SURE * _SURE
_LEAST, _PULL = np.int16(28), np.int16(172)  # the weight of an order goes to the first, or to their sum when it was the best
_RATES = np.array([[5], [4], [4]], np.int16)  # how fast the orders learn
# A distribution adds up to 32 * 1023 + 31. Mixed in sixteenths of its 32nds, and with the least frequency for each symbol, that makes 2**14.
_TOP, _FINE, _FLOOR = 32 * 1023 + 31, 5, 2
_ROW = f"V{2 * _SYMBOLS}"  # a distribution as one element: rows are fetched and put back whole

_GOALS = np.where(np.arange(_SYMBOLS) >= np.arange(_SYMBOLS)[:, None], _TOP, 0).astype(np.int16).reshape(-1).view(_ROW)
_FOUR = 0x0001000100010001  # repeats a 16-bit number
_FLOORS = (_FLOOR * np.arange(1, _SYMBOLS + 1)).astype(np.int16)
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77])
# The last id as a context: the most frequent ranks alone, the others by size.
_CONTEXT = np.repeat(np.arange(17), np.diff(np.append(0, 1 << np.arange(17))))
_CONTEXTS = int(_CONTEXT[-1]) + 1
_USUAL = (1 << 24) // np.arange(1, (1 << 16) + 1)  # counts of ranks when none are given


class Ranks:
    """How the ranks of a section are split: six classes of about equal weight, and in each class a share of 2**16 for each rank, by its count."""

    def __init__(self, times: np.ndarray):
        times = np.maximum(np.asarray(times, np.int64), 1)
        n, before = len(times), np.cumsum(times) - times
        classes = np.minimum(before * _CLASSES // max(int(times.sum()), 1), _CLASSES - 1)
        self.bounds = np.searchsorted(classes, np.arange(_CLASSES + 1))
        many = np.diff(self.bounds)
        heavy = np.bincount(classes, times, _CLASSES).astype(np.int64)
        width = 1 + times * (_INNER - many)[classes] // heavy[classes]
        first = self.bounds[:-1][many > 0]
        if n:
            width[first] += _INNER - np.add.reduceat(width, first)
        start = np.cumsum(width) - width
        # Named ids have the whole of their symbol: place 0.
        self.width = np.append(_INNER, width)
        self.start = np.append(0, start - _INNER * np.cumsum(many > 0)[classes] + _INNER)
        self.symbols = classes + 2
        self.context = _CONTEXT[:n]
        self.hashes = (np.arange(n) * _MULTIPLIERS[:, None] >> 8) & (_SLOTS - 1)

    def found(self) -> np.ndarray:
        """The rank of each place of each class, behind two classes for the named ids."""
        out = np.zeros((_SYMBOLS, _INNER), np.uint16)
        for i, (a, b) in enumerate(pairwise(self.bounds.tolist())):
            if b > a:
                out[i + 2] = np.repeat(np.arange(a, b), self.width[a + 1 : b + 1])
        return out.reshape(-1)


class _Model:
    """The predictions of one block per lane, in ranks. Arrays of the orders are stacked, so that each step makes few calls.

    A distribution is the eight upper ends of its symbols' intervals. `now` holds those of the step: order 0, which stays there, and those of
    order 1 (by the last id) and order 2 (by what the named ids are worth), which are fetched from `cdf` and put back. The lanes of a context
    lie side by side: most steps meet the same few.
    """

    def __init__(self, lanes: int, ranks: Ranks):
        self.lane, self.lanes, self.ranks = np.arange(lanes), lanes, ranks
        self.slots = np.full(2 * lanes * _SLOTS, _NOBODY, np.int32)  # by the two last ids, by the last
        self.base = np.stack([self.lane, self.lane + lanes * _SLOTS])
        self.slot, self.past = self.base.copy(), np.zeros(lanes, np.int64)
        even = (np.arange(1, _SYMBOLS + 1) * _TOP // _SYMBOLS).astype(np.int16)
        self.cdf = np.tile(even, lanes * (_WORTHS + _CONTEXTS)).view(_ROW)
        self.context = ranks.context * lanes
        self.last_rows = self.lane + lanes * _WORTHS
        self.rows = np.stack([self.last_rows, self.lane])
        self.now = np.tile(even, (3, lanes))
        self.fetched = self.now.view(_ROW)[1:]
        self.step, self.goal = np.empty_like(self.now), np.empty(lanes, _ROW)
        self.corner = self.lane * _SYMBOLS
        self.shares, self.values = np.empty((3, lanes, 2), np.int64), np.empty((lanes, 2), np.int64)
        self.floors = np.tile(_FLOORS, lanes)
        self.weight = np.full((2, lanes), 85, np.int16)  # of orders 1 and 2, in 256ths
        self.share = np.zeros((3, lanes), np.int16)  # of all three, in sixteenths
        self.best = np.zeros((2, lanes), bool)
        self.held, self.name, self.sure = (np.zeros((2, lanes), np.int32) for _ in range(3))

    def look(self) -> None:
        """What the orders name, and the three distributions."""
        self.slots.take(self.slot, out=self.held, mode="clip")
        np.bitwise_and(self.held, _NOBODY, out=self.name)
        np.right_shift(self.held, _NAME, out=self.sure)
        worth = self.sure[0] * _SURE
        worth += self.sure[1]
        worth += worth
        worth += self.name[0] == self.name[1]
        worth *= self.lanes
        np.add(self.lane, worth, out=self.rows[1])
        self.cdf.take(self.rows, out=self.fetched, mode="clip")
        np.right_shift(self.weight, 4, out=self.share[1:])
        np.subtract(16 - self.share[1], self.share[2], out=self.share[0])

    def symbol(self, ranks: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """0 for the id that order 2 names, 1 for that of order 1, else two more than the class."""
        symbol = self.ranks.symbols.take(ranks)
        np.copyto(symbol, 1, where=hit[1])
        np.copyto(symbol, 0, where=hit[0])
        return symbol

    def interval(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of a symbol in the mixed distribution, of 2**14; notes what each order gave it."""
        at = self.corner + symbol
        upper = self.now.take(at, axis=1)
        at -= 1
        lower = self.now.take(at, axis=1, mode="wrap")
        lower *= symbol > 0
        self.given = upper - lower
        upper >>= _FINE
        lower >>= _FINE
        upper -= lower
        lower *= self.share
        upper *= self.share
        low, wide = lower[0] + lower[1], upper[0] + upper[1]
        low += lower[2]
        wide += upper[2]
        wide += _FLOOR
        first = symbol * _FLOOR
        first += low
        return first, wide.astype(np.int64)

    def find(self, value: np.ndarray) -> np.ndarray:
        """The symbol whose interval holds a value below 2**14."""
        part = np.right_shift(self.now, _FINE, out=self.step)
        # Shares and values are repeated for each symbol.
        four = self.share * np.int64(_FOUR)
        self.shares[..., 0] = four
        self.shares[..., 1] = four
        part *= self.shares.view(np.int16).reshape(3, -1)
        last = part[0]
        last += part[1]
        last += part[2]
        last += self.floors
        four = value * _FOUR
        self.values[:, 0] = four
        self.values[:, 1] = four
        # Eight truth values are added up as the bytes of a word.
        below = (last <= self.values.view(np.int16).reshape(-1)).view(np.uint64)
        return ((below * np.uint64(0x0101010101010101)) >> np.uint64(56)).view(np.int64)

    def learn(self, symbol: np.ndarray, ranks: np.ndarray, narrow: np.ndarray, hit: np.ndarray) -> None:
        given0, given1, given2 = self.given
        np.logical_and(given1 >= given0, given1 > given2, out=self.best[0])
        np.logical_and(given2 >= given0, given2 >= given1, out=self.best[1])
        pull = self.best * _PULL
        pull += _LEAST
        pull -= self.weight
        pull >>= 5
        self.weight += pull
        _GOALS.take(symbol, out=self.goal, mode="clip")
        step = np.subtract(self.goal.view(np.int16), self.now, out=self.step)
        step >>= _RATES
        self.now += step
        self.cdf[self.rows] = self.fetched
        sure = np.minimum(self.sure, _SURE - 2, out=self.sure)
        sure *= hit
        sure += 1
        sure <<= _NAME
        sure += narrow
        self.slots[self.slot] = sure
        np.add(self.last_rows, self.context.take(ranks), out=self.rows[0])
        one, two = self.ranks.hashes
        name = one.take(ranks)
        both = name ^ self.past
        name *= self.lanes
        both *= self.lanes
        np.add(self.base[0], both, out=self.slot[0])
        np.add(self.base[1], name, out=self.slot[1])
        two.take(ranks, out=self.past, mode="clip")


_LEAST_RANGE, _DIGIT, _TAIL = np.uint64(1 << 31), np.uint64(32), np.uint64(31)
_REST = np.uint64((1 << 31) - 1)


class _Coder:
    """Range coders side by side. Frequencies add up to 2**30; `low` keeps 63 bits and a carry. Digits of 32 bits are noted as they come."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 1 << 63, np.uint64)
        self.lanes: list[np.ndarray] = []
        self.digits: list[np.ndarray] = []

    def code(self, start: np.ndarray, size: np.ndarray) -> None:
        unit = self.range >> np.uint64(30)
        self.low += unit * start.view(np.uint64)
        np.multiply(unit, size.view(np.uint64), out=self.range)
        # One digit is enough: a range is never below 1.
        small = (self.range < _LEAST_RANGE).nonzero()[0]
        self._note(small)
        self.range[small] = self.range.take(small) << _DIGIT

    def _note(self, lanes: np.ndarray) -> None:
        low = self.low.take(lanes)
        self.lanes.append(lanes.astype(np.int32))
        self.digits.append(low >> _TAIL)
        low &= _REST
        low <<= _DIGIT
        self.low[lanes] = low

    def finish(self) -> list[bytes]:
        n = len(self.low)
        for _ in range(2):
            self._note(np.arange(n))
        lane = np.concatenate(self.lanes)
        order = np.argsort(lane.astype(np.uint16) if n <= 1 << 16 else lane, kind="stable")
        used = np.bincount(lane, minlength=n)
        digits = np.concatenate(self.digits)[order]
        ends = np.cumsum(used)
        # Digits above 32 bits carry over to the digit before, which seldom passes the carry on. A lane's first digit gets and gives none.
        while len(over := np.flatnonzero(digits >> _DIGIT)):
            digits[over] &= np.uint64(0xFFFFFFFF)
            digits[over - 1] += np.uint64(1)
        raw = digits.astype("<u4")
        return [raw[j - k : j].tobytes() for j, k in zip(ends.tolist(), used.tolist(), strict=True)]


class _Decoder:
    def __init__(self, payloads: list[bytes]):
        lanes, room = len(payloads), max(map(len, payloads)) // 4 + 4
        digits = np.zeros((lanes, room), np.uint32)
        for i, payload in enumerate(payloads):
            digits[i, : len(payload) // 4] = np.frombuffer(payload, "<u4")
        self.code = (digits[:, 0].astype(np.uint64) << _TAIL) | (digits[:, 1] >> np.uint32(1))
        # The code is 63 bits long: what follows lies across two digits.
        digits = digits.reshape(-1)
        self.digits = digits << np.uint32(31)
        self.digits[:-1] |= digits[1:] >> np.uint32(1)
        self.at = np.arange(lanes) * room + 1
        # A block that is through reads the zeros at its end.
        self.stop = np.arange(1, lanes + 1) * room - 2
        self.range = np.full(lanes, 1 << 63, np.uint64)

    def target(self) -> np.ndarray:
        """The value below 2**30 whose interval comes next."""
        self.unit = self.range >> np.uint64(30)
        return np.minimum(self.code // self.unit, np.uint64((1 << 30) - 1)).view(np.int64)

    def take(self, start: np.ndarray, size: np.ndarray) -> None:
        self.code -= self.unit * start.view(np.uint64)
        np.multiply(self.unit, size.view(np.uint64), out=self.range)
        small = (self.range < _LEAST_RANGE).nonzero()[0]
        at = self.at.take(small)
        self.code[small] = (self.code.take(small) << _DIGIT) | self.digits.take(at)
        self.range[small] = self.range.take(small) << _DIGIT
        self.at[small] = np.minimum(at + 1, self.stop.take(small))


def encode_blocks(ranks: np.ndarray, block: int = BLOCK, split: Ranks | None = None) -> list[bytes]:
    """Payloads of the blocks of a list of ranks below 2**16; the last block is filled up with rank 0."""
    if not len(ranks):
        return []
    split = split or Ranks(_USUAL)
    lanes = -(-len(ranks) // block)
    steps = min(block, len(ranks))
    table = np.zeros(lanes * block, np.int32)
    table[: len(ranks)] = ranks
    table = np.ascontiguousarray(table.reshape(lanes, block)[:, :steps].T)
    model, coder = _Model(lanes, split), _Coder(lanes)
    for step in range(steps):
        narrow = table[step]
        now = narrow.astype(np.int64)
        model.look()
        hit = model.name == narrow
        symbol = model.symbol(now, hit)
        first, width = model.interval(symbol)
        place = now + 1
        place *= symbol > 1
        first <<= 16
        first += split.start.take(place) * width
        model.learn(symbol, now, narrow, hit)
        width *= split.width.take(place)
        coder.code(first, width)
    return coder.finish()


def decode_blocks(payloads: list[bytes], steps: int, split: Ranks | None = None) -> np.ndarray:
    """The ranks of blocks, a row each, of `steps` ranks."""
    lanes = len(payloads)
    out = np.zeros((steps, lanes), np.int32)
    if not lanes:
        return out.T
    split = split or Ranks(_USUAL)
    model, coder = _Model(lanes, split), _Decoder(payloads)
    found, most = split.found(), len(split.symbols) - 1
    for step in range(steps):
        model.look()
        value = coder.target()
        symbol = model.find(value >> 16)
        first, width = model.interval(symbol)
        first <<= 16
        # Both numbers are below 2**30: the quotient is exact enough.
        inner = ((value - first) / width).astype(np.int64)
        inner += symbol << 16
        now = found.take(inner, mode="clip").astype(np.int64)
        np.copyto(now, model.name[0], where=symbol == 0)
        np.copyto(now, model.name[1], where=symbol == 1)
        np.minimum(now, most, out=now)
        place = now + 1
        place *= symbol > 1
        first += split.start.take(place) * width
        width *= split.width.take(place)
        coder.take(first, width)
        narrow = out[step]
        narrow[:] = now
        model.learn(symbol, now, narrow, model.name == narrow)
    return out.T


def pack_section(ids: np.ndarray, counts: np.ndarray, block: int = BLOCK) -> bytes:
    """The bytes of a section: `counts` ids of each document, one after the other in `ids`."""
    times = np.bincount(ids, minlength=1)
    found = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]
    if len(found) > 1 << 16:
        raise ValueError("a section has more than 65536 different ids")
    rank = np.zeros(len(times), np.int32)
    rank[found] = np.arange(len(found))
    payloads = encode_blocks(rank[ids], block, Ranks(times[found]))
    head = struct.pack(_HEADER, MAGIC, _VERSION, block, len(payloads), len(counts), len(found), len(ids))
    sums = [zlib.crc32(ids[i * block : (i + 1) * block].astype("<u4").tobytes()) for i in range(len(payloads))]
    tables = [np.asarray(x, "<u4").tobytes() for x in (counts, found, times[found], [len(p) for p in payloads], sums)]
    body = b"".join([*tables, *payloads])
    return head + struct.pack("<I", zlib.crc32(body)) + body


def unpack_section(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of a section; damage raises ValueError."""
    magic, version, block, blocks, documents, different, total = struct.unpack_from(_HEADER, data)
    if magic != MAGIC or version != _VERSION:
        raise ValueError("not a section of token ids")
    at = struct.calcsize(_HEADER) + 4
    if zlib.crc32(data[at:]) != struct.unpack_from("<I", data, struct.calcsize(_HEADER))[0]:
        raise ValueError("section checksum differs")
    tables = []
    for n in (documents, different, different, blocks, blocks):
        tables.append(np.frombuffer(data, "<u4", n, at))
        at += 4 * n
    counts, ids, times, sizes, sums = tables
    ends = at + np.cumsum(sizes, dtype=np.int64)
    payloads = [data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    out = ids[decode_blocks(payloads, min(block, total), Ranks(times)).reshape(-1)[:total]].astype(np.int64)
    for i, wanted in enumerate(sums):
        if zlib.crc32(out[i * block : (i + 1) * block].astype("<u4").tobytes()) != wanted:
            raise ValueError(f"checksum of block {i} differs")
    return out, counts


_MARK = b" \x01 "
_WHOLE = 4  # of a byte's kinds: 0 white space, 1 letter, 2 digit, 3 punctuation, 4 what only the library's own rules split
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
_NAME_SLOTS = 20  # bits of the table of names met lately
_LONG = 64  # bytes from which a piece is hashed alone


def _kinds() -> np.ndarray:
    byte = np.arange(256)
    text = [chr(i) for i in range(128)]
    out = np.full(256, _WHOLE, np.uint8)
    out[33:127] = 3
    out[[c.isdigit() for c in text] + [False] * 128] = 2
    out[[c.isalpha() for c in text] + [False] * 128] = 1
    out[ord("'")] = _WHOLE
    out[(byte == 32) | (byte >= 9) & (byte <= 13)] = 0
    return out


_KIND = _kinds()
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_INSIDE = np.append((np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)) - np.uint64(1), np.uint64((1 << 64) - 1))  # the first bytes of eight
_ENCODERS: dict[str, Encoder] = {}


def _spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of some spans, end to end."""
    before = np.cumsum(sizes) - sizes
    return data[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def _names(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, never 0, eight bytes at a time."""
    room = np.zeros(len(data) // 8 * 8 + 16, np.uint8)
    room[: len(data)] = data
    eights = room.view("<u8")
    out = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    which, at, left = None, starts, np.minimum(sizes, _LONG)
    while len(at):
        place, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        value = eights.take(place) >> shift
        value |= (eights.take(place + 1) << np.uint64(1)) << (np.uint64(63) - shift)
        value &= _INSIDE.take(np.minimum(left, 8))
        if which is None:
            out = mix(out ^ value)
        else:
            out[which] = mix(out[which] ^ value)
        more = np.flatnonzero(left > 8)
        which = more if which is None else which[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > _LONG).tolist():
        span = data[starts[i] : starts[i] + sizes[i]].tobytes()
        out[i] = np.frombuffer(hashlib.blake2b(span, digest_size=8).digest(), np.uint64)[0]
    return out | np.uint64(1)


def encoder_of(path: str) -> Encoder:
    """The encoder of a file that this Python worker keeps, with the pieces it knows, from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    """Ids of texts by the tokenizers library. The vocabulary's pieces never cross white space, so each distinct piece is encoded once.

    Words of ASCII and of Latin letters up to U+00FF are made lower case and cut into runs of letters, digits and runs of punctuation here, all at
    once, if the file's rules are those known to do just that; the library then only applies its merges. Words with an apostrophe, another
    character, or the start of a special string go to it as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self.tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.kind = np.where(_KIND > 0, _WHOLE, 0).astype(np.uint8)
        self.merges = None
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        known = (rules["normalizer"] or {}).get("normalizers") == _NORMAL and cuts[:1] == [_CUT] and [x["type"] for x in cuts[1:]] == ["ByteLevel"]
        known = known and all(x["content"][:1].isascii() and not x["normalized"] for x in rules["added_tokens"])
        if known and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"] and rules["model"].get("end_of_word_suffix"):
            blanks = {"type": "CharDelimiterSplit", "delimiter": " "}
            plain = {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [blanks, cuts[1]]}, "added_tokens": []}
            self.merges = Tokenizer.from_str(json.dumps({**rules, **plain}))
            vocabulary = self.merges.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for x, i in vocabulary.items() if x.endswith(rules["model"]["end_of_word_suffix"])]] = True
            self.kind = _KIND.copy()
            for token in rules["added_tokens"]:
                self.kind[token["content"].encode()[:1][0]] = _WHOLE
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # names of pieces, ascending
        self.number = np.zeros(0, np.int32)  # their numbers, as they came
        self.where = np.zeros(0, np.int32)
        self.many = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.int32)
        self.lately = np.zeros(1 << _NAME_SLOTS, np.uint64)
        self.lately_number = np.zeros(1 << _NAME_SLOTS, np.int32)

    def _cut(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of all texts: their bytes, starts, sizes and whether the library has to split them; and the first piece of each row."""
        data, bounds = flat(column)
        kinds = self.kind.take(data)
        text = data
        if self.merges:
            text = _LOWER.take(data)
            lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF, but for two signs
            lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
            kinds[lead] = kinds[lead + 1] = 1
            upper = lead[data[lead + 1] < 0x9F] + 1
            text[upper] += 0x20
            odd = np.flatnonzero(kinds == _WHOLE)
            if len(odd):
                words = Words(column)
                inside = np.zeros(len(data) + 1, np.int8)
                hit = np.unique(np.searchsorted(words.starts, odd, "right") - 1)
                inside[words.starts[hit]] += 1
                inside[words.ends[hit]] -= 1
                inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
                kinds[inside] = _WHOLE
                np.copyto(text, data, where=inside)
        opens = np.ones(len(data) + 1, bool)
        np.not_equal(kinds[1:], kinds[:-1], out=opens[1:-1])
        opens[:-1] |= kinds == 2
        opens[bounds] = True  # words end with their row
        full = kinds > 0
        starts = np.flatnonzero(opens[:-1] & full)
        sizes = np.flatnonzero(opens[1:] & full) + 1 - starts
        return text, starts, sizes, kinds[starts] == _WHOLE, np.searchsorted(starts, bounds)

    def _merged(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Numbers of ids of plain pieces, and the ids. A blank stands behind each piece; its last id tells the pieces apart."""
        if not len(starts):
            return [np.zeros(0, np.int64), np.zeros(0, np.int32)]
        ends = np.cumsum(sizes + 1)
        line = np.full(int(ends[-1]), 32, np.uint8)
        line[np.repeat(ends - sizes - 1 - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))] = _spans(text, starts, sizes)
        line = line.tobytes()
        cuts = [0, *ends[255::256].tolist()]
        if cuts[-1] != len(line):
            cuts.append(len(line))
        lines = [line[i : j - 1].decode() for i, j in pairwise(cuts)]
        found = [np.array(x.ids, np.int32) for i in range(0, len(lines), 16) for x in self.merges.encode_batch_fast(lines[i : i + 16], add_special_tokens=False)]
        ids = np.concatenate(found)
        marks = np.flatnonzero(self.last[ids])
        if len(marks) != len(starts):
            raise ValueError("the vocabulary does not mark the ends of words")
        return [np.diff(marks, prepend=-1), ids]

    def _split(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Numbers of ids of whole words, and the ids."""
        if not len(starts):
            return [np.zeros(0, np.int64), np.zeros(0, np.int32)]
        # Many words go as one text with a mark behind each; the mark's id tells the words apart. The blanks are no ids.
        ends = np.cumsum(sizes + len(_MARK))
        line = np.frombuffer(_MARK * len(starts), np.uint8)
        line = np.insert(line, np.repeat(np.arange(len(starts)) * len(_MARK), sizes), _spans(text, starts, sizes)).tobytes()
        cuts = [0, *ends[63::64].tolist()]
        if cuts[-1] != len(line):
            cuts.append(len(line))
        lines = [line[i:j].decode() for i, j in pairwise(cuts)]
        found = [x.ids for i in range(0, len(lines), 64) for x in self.tokenizer.encode_batch_fast(lines[i : i + 64], add_special_tokens=False)]
        many, added = [], []
        for i, ids in enumerate(found):
            part = range(i * 64, min(i * 64 + 64, len(starts)))
            ids = np.array(ids, np.int32)
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(part):
                many.append(np.diff(marks, prepend=-1) - 1)
                added.append(np.delete(ids, marks))
            else:  # a word holds the mark
                alone = [self.tokenizer.encode(text[starts[k] : starts[k] + sizes[k]].tobytes().decode(), add_special_tokens=False).ids for k in part]
                many.append(np.array([len(x) for x in alone]))
                added += [np.array(x, np.int32) for x in alone]
        return [np.concatenate(many), np.concatenate(added)]

    def _learn(self, names: np.ndarray, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, whole: np.ndarray) -> None:
        plain = ~whole
        parts = [self._merged(text, starts[plain], sizes[plain]), self._split(text, starts[whole], sizes[whole])]
        many = np.concatenate([x[0] for x in parts])
        known = np.concatenate([self.known, names[plain], names[whole]])
        order = np.argsort(known, kind="stable")
        number = np.arange(len(self.many), len(self.many) + len(many), dtype=np.int32)
        self.known, self.number = known[order], np.concatenate([self.number, number])[order]
        self.where = np.concatenate([self.where, (len(self.flat) + np.cumsum(many) - many).astype(np.int32)])
        self.many = np.concatenate([self.many, many.astype(np.int32)])
        self.flat = np.concatenate([self.flat, *[x[1] for x in parts]])

    def _numbers(self, names: np.ndarray, *pieces: np.ndarray) -> np.ndarray:
        """Numbers of pieces by their names; unknown ones are learned."""
        slot = (names >> np.uint64(64 - _NAME_SLOTS)).view(np.int64)
        out = self.lately_number.take(slot)
        missed = np.flatnonzero(self.lately.take(slot) != names)
        if not len(missed):
            return out
        distinct, example, inverse = np.unique(names[missed], return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        fresh = self.known[place] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if fresh.any():
            text, *spans = pieces
            which = missed[example[fresh]]
            self._learn(distinct[fresh], text, *[x[which] for x in spans])
            place = np.searchsorted(self.known, distinct)
        number = self.number[place]
        at = slot[missed[example]]
        self.lately[at], self.lately_number[at] = distinct, number
        # Of pieces with one slot the last stays, in both tables.
        out[missed] = number[inverse]
        return out

    def encode(self, column: pa.Array, end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id behind it, and the number of ids of each text."""
        if len(self.known) > KNOWN:
            self._forget()
        text, starts, sizes, whole, first = self._cut(column)
        number = self._numbers(_names(text, starts, sizes), text, starts, sizes, whole)
        where, many = self.where.take(number), self.many.take(number)
        summed = np.append(0, np.cumsum(many, dtype=np.int64))
        counts = np.diff(summed[first]) + 1
        out = np.full(int(counts.sum()), end, np.int32)
        ends = np.cumsum(counts) - 1
        kept = np.ones(len(out), bool)
        kept[ends] = False
        out[kept] = self.flat.take(np.repeat(where - summed[:-1], many) + np.arange(summed[-1]))
        return out, counts


def _write(path: str, end: int, block: int, lanes: int):
    """Sorted (doc_id, text) to (part, section, first, doc_ids, data): `first` ids of the part stand before the section."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, section, before, encoder = TaskContext.get().partitionId(), 0, 0, encoder_of(path)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        waiting = 0

        def section_of() -> pa.RecordBatch:
            ids, counts = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
            names = [y for x in held for y in x[0].to_pylist()]
            row = [[part], [section], [before], [names], [pack_section(ids, counts, block)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            return pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["part", "section", "first", "doc_ids", "data"])

        for batch in batches:
            for some in slices(batch, "text", 1 << 21):
                ids, counts = encoder.encode(some.column(1), end)
                held.append((some.column(0), ids, counts))
                waiting += len(ids)
                if waiting >= block * lanes:
                    yield section_of()
                    section, before, held, waiting = section + 1, before + waiting, [], 0
        if held:
            yield section_of()

    return run


def write_files(docs: DataFrame, path: str | None = None, end: int = END, block: int = BLOCK, lanes: int = LANES) -> DataFrame:
    """Encode `docs` in ascending doc_id order into files in the shared folder; returns the table of their sections."""
    prepare(docs.sparkSession)
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    # Rows of one doc_id are spread by their texts.
    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    shape = "part int, section int, first long, doc_ids array<long>, data binary"
    return stored(ordered.mapInArrow(lambda b: _write(path, end, block, lanes)(b), shape), "token-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, counts = unpack_section(batch.column(3)[i].as_py())
            raw, ends = ids.astype("<u4"), np.cumsum(counts, dtype=np.int64)
            sums = [zlib.crc32(raw[e - n : e].tobytes()) for n, e in zip(counts.tolist(), ends.tolist(), strict=True)]
            names = batch.column(2)[i].values
            start = batch.column(1)[i].as_py() + ends - counts
            yield pa.record_batch(
                [pa.array([batch.column(0)[i].as_py()] * len(names), pa.int32()), names, pa.array(start, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                names=["part", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def read_files(files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = prepare(files.sparkSession)
    # A batch of sections is large, their texts are not: few at a time.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    found = stored(
        files.select("part", "first", "doc_ids", "data").mapInArrow(_read, "part int, doc_id long, inside long, n_tokens long, ids_crc32 long"), "token-rows"
    )
    prepare(spark)
    # One row per partition of the writing job.
    parts = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = stored(parts.select(F.col("part").alias("of"), before.alias("before")), "parts")
    out = found.join(parts, found.part == parts.of)
    return out.select("doc_id", (F.col("before") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32")
