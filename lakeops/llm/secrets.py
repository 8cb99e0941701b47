"""Secrets in texts: fixed patterns, and encoded keys and tokens that are reported only after their structure has been parsed.

Base kinds, by pattern alone, leftmost and without overlap: `assign`, `access`, `hex`. The method adds candidates in base64 or hex that
decode to something of the right build:
* `jwt`: three base64url parts; the header is a JSON object with a known "alg", the payload is a JSON object, and the signature has the
  length that the algorithm gives;
* `der`: a PKCS#1, PKCS#8 or SEC1 private key in base64, base64url, hex or a PEM block: every nested ASN.1 length fits its parent exactly. A key that is encrypted inside
  its PEM block counts if its headers name a known cipher, an initial value of the cipher's length and whole blocks follow;
* `openssh`: the openssh-key-v1 container, whose length-prefixed fields use up the data, in the same writings.

PEM blocks may have escaped line breaks and headers, and may be in base64 as a whole.

Positions are code points, ends exclusive. Null is the empty text and has no span. Equal rows give equal results; a row whose doc_id is null
is scanned like the others. Further columns of the input are not read (`redact` hands them on).
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lakeops.llm.work import prepare

# The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "jwt", "der", "openssh")

# Only texts with one of these are looked at: whatever a pattern above or below confirms has one. The shortest header of a token, {"alg":"none"}, has 19 characters.
_MAYBE = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{14}|[0-9a-fA-F]{16}|[A-Za-z0-9+/_-]{40}|[A-Za-z0-9_-]{19}\.[A-Za-z0-9_-]{2,}\.|-----BEGIN"
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
_BASE64 = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{64,}")
_URL64 = re.compile(r"(?<![A-Za-z0-9_+/-])(?:M|b3Blbn)[A-Za-z0-9_-]{33,}={0,2}")
_MARK = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]*PRIVATE KEY-----")
_BREAK = re.compile(r"\\+[nr]")  # a line break as JSON or an environment file writes it
_HEADER = re.compile(r"\s*([A-Za-z][A-Za-z0-9-]*):[ \t]*([^\r\n]*)\r?\n")
# Block sizes of the ciphers that encrypt a key inside its PEM block.
_CIPHERS = {"DES-CBC": 8, "DES-EDE3-CBC": 8, "AES-128-CBC": 16, "AES-192-CBC": 16, "AES-256-CBC": 16}
# Bytes of a signature by algorithm; RS and PS signatures are as long as their key, 128 bytes at least.
_SIGNATURE = {"none": 0, "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
_KEY_SIZED = {"RS256", "RS384", "RS512", "PS256", "PS384", "PS512"}
_SSH_MAGIC = b"openssh-key-v1\0"


def _der(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The (tag, start, end) items of a DER span, or None if a length does not fit."""
    items = []
    while start < end:
        if start + 2 > end:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            size = int.from_bytes(data[at : at + width], "big")
            if size < 0x80 or size >> (8 * (width - 1)) == 0:  # DER takes the shortest form
                return None
            at += width
        if at + size > end:
            return None
        items.append((tag, at, at + size))
        start = at + size
    return items


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are one PKCS#1, PKCS#8 (plain or encrypted) or SEC1 private key, with every nested length right."""
    outer = _der(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    items = _der(data, outer[0][1], outer[0][2])
    if not items:
        return False
    tags = [x[0] for x in items]
    value = lambda i: data[items[i][1] : items[i][2]]

    def algorithm(i: int) -> bool:
        inner = _der(data, items[i][1], items[i][2])
        return bool(inner) and inner[0][0] == 0x06

    if tags[:9] == [0x02] * 9 and value(0) in (b"\0", b"\1"):
        return len(items) <= 10 and all(x[2] > x[1] for x in items)
    if tags[:3] == [0x02, 0x30, 0x04] and value(0) in (b"\0", b"\1"):
        return algorithm(1) and items[2][2] > items[2][1]
    if tags[:2] == [0x02, 0x04] and value(0) == b"\1":
        return len(value(1)) in (24, 28, 32, 48, 66) and all(t in (0xA0, 0xA1) for t in tags[2:])
    return tags == [0x30, 0x04] and algorithm(0) and items[1][2] - items[1][1] >= 40


def is_openssh_key(data: bytes) -> bool:
    """Whether the bytes are an openssh-key-v1 container whose length-prefixed fields use them up."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at, fields = len(_SSH_MAGIC), []

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    for _ in range(3):
        fields.append(field())
    if None in fields or not fields[0] or not fields[1]:
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 64 or any(not field() for _ in range(keys)):
        return False
    return bool(field()) and at <= len(data) <= at + 16


def _key_kind(data: bytes) -> str | None:
    if data[:1] == b"\x30" and is_private_key(data):
        return "der"
    return "openssh" if is_openssh_key(data) else None


def _pem_kind(body: str) -> str | None:
    """Kind of the key between the marks of a PEM block; line breaks may be escaped, headers may come first."""
    body, headers = _BREAK.sub("\n", body), {}
    while (m := _HEADER.match(body)) is not None:
        headers[m[1]], body = m[2].strip(), body[m.end() :]
    data = _decoded("".join(body.split()))
    if data and headers.get("Proc-Type", "").replace(" ", "") == "4,ENCRYPTED":
        cipher, _, vector = headers.get("DEK-Info", "").partition(",")
        block = _CIPHERS.get(cipher.strip(), 0)
        return "der" if block and re.fullmatch(f"[0-9A-Fa-f]{{{2 * block}}}", vector.strip()) and len(data) % block == 0 else None
    return _key_kind(data or b"")


def pem_blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of PEM blocks with a key: a BEGIN mark with an END mark as the next one."""
    begin = None
    for m in _MARK.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin is not None:
            kind = _pem_kind(text[begin.end() : m.start()])
            if kind:
                yield begin.start(), m.end(), kind
            begin = None


def _binary_kind(data: bytes) -> str | None:
    """Kind of a decoded key, or of the first key of a decoded PEM file."""
    kind = _key_kind(data)
    if kind is None and b"-----BEGIN" in data:
        kind = next((k for _, _, k in pem_blocks(data.decode("latin-1"))), None)
    return kind


def _decoded(text: str, url: bool = False) -> bytes | None:
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url else None, validate=True)
    except binascii.Error:
        return None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """Whether three base64url parts are a signed token: JSON objects, a known algorithm and a signature of its length."""
    parts = [_decoded(x, url=True) for x in (header, payload, signature)]
    if None in parts:
        return False
    try:
        head, body = json.loads(parts[0]), json.loads(parts[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict):
        return False
    name, size = head.get("alg"), len(parts[2])
    if not isinstance(name, str):
        return False
    return size >= 128 if name in _KEY_SIZED else _SIGNATURE.get(name) == size


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds; matches that are too short are dropped, but what they cover stays used up."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    # A run of hex digits is as long as it can be, so asking for the length at once finds the same runs.
    return found + [(*m.span(), "hex") for m in _LONG_HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of encoded keys and tokens whose structure parses."""
    found = [(*m.span(), "jwt") for m in _JWT.finditer(text) if is_signed_token(*m.groups())]
    found += pem_blocks(text)
    writings: list[tuple[re.Pattern, Callable]] = [
        (_BASE64, lambda m: _decoded(m[0])),
        (_URL64, lambda m: _decoded(m[0], url=True) if "-" in m[0] or "_" in m[0] else b""),
        (_HEX_ANY, lambda m: binascii.unhexlify(m[0][: len(m[0]) // 2 * 2])),
    ]
    for pattern, decode in writings:
        for m in pattern.finditer(text):
            kind = _binary_kind(decode(m) or b"")
            if kind and not any(a <= m.start() and m.end() <= b and k == kind for a, b, k in found):
                found.append((*m.span(), kind))
    return found


def _joined(spans: list[tuple[int, int, str]]) -> str:
    spans.sort(key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_text(text: str) -> tuple[int, int, int, str, str, int]:
    """n_assign, n_access, n_hex, base_sha256, spans, n_confirmed of one text."""
    base = base_spans(text)
    more = confirmed_spans(text)
    kinds = [x[2] for x in base]
    digest = hashlib.sha256(_joined(base).encode()).hexdigest()
    return *(kinds.count(k) for k in KINDS[:3]), digest, _joined(base + more), len(more)


_CLEAN = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0)


def _suspects(column: pa.Array) -> list[bool]:
    return pc.match_substring_regex(column.cast(pa.large_string()).fill_null(""), _MAYBE).to_pylist()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        suspect = _suspects(batch.column(1))
        out = [scan_text(batch.column(1)[i].as_py()) if bad else _CLEAN for i, bad in enumerate(suspect)]
        columns = list(zip(*out, strict=True)) if out else [[] for _ in _CLEAN]
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))]
        yield pa.record_batch(arrays, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"])


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_confirmed."""
    prepare(docs.sparkSession)
    shape = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(_scan, shape)


def clean_text(text: str, mark: str = "[{kind}]") -> str:
    """The text with every span replaced by a mark; spans that overlap are one, named after the first."""
    spans = sorted(base_spans(text) + confirmed_spans(text), key=lambda x: (x[0], KINDS.index(x[2])))
    out, end = [], 0
    for start, stop, kind in spans:
        if start >= end:
            out += [text[end:start], mark.format(kind=kind)]
        end = max(end, stop)
    return "".join(out) + text[end:]


def _redact(at: int, length: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            suspect = _suspects(column)
            if any(suspect):
                texts = [clean_text(x) if bad else x for x, bad in zip(column.to_pylist(), suspect, strict=True)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type))
                if length is not None:
                    kind = batch.schema.field(length)
                    batch = batch.set_column(length, kind, pa.array([None if x is None else len(x) for x in texts], kind.type))
            yield batch

    return run


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with marks in place of secrets; all columns stay as they are but `text`, and `n_chars`, its code points, if it is there."""
    prepare(docs.sparkSession)
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    return docs.mapInArrow(_redact(docs.columns.index("text"), length), docs.schema)
