from __future__ import annotations

import base64
import hashlib
import json
import random
import re

from llm import data

from lakeops.llm import secrets as op


def der(tag: int, body: bytes) -> bytes:
    size = len(body)
    head = bytes([size]) if size < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(size.to_bytes((size.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + head + body


def rsa_key(rng: random.Random) -> bytes:
    number = lambda n: der(2, b"\x01" + rng.randbytes(n))
    return der(0x30, der(2, b"\0") + number(128) + number(3) + b"".join(number(n) for n in (128, 64, 64, 64, 64, 64)))


def pkcs8(rng: random.Random) -> bytes:
    return der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48") + der(5, b"")) + der(4, rsa_key(rng)))


def openssh(rng: random.Random) -> bytes:
    field = lambda b: len(b).to_bytes(4, "big") + b
    return b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(rng.randbytes(51)) + field(rng.randbytes(136))


def token(alg: str, size: int, rng: random.Random) -> str:
    part = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    return ".".join([part(json.dumps({"alg": alg, "typ": "JWT"}).encode()), part(b'{"sub":"1"}'), part(rng.randbytes(size))])


def brute(text: str) -> tuple:
    found = []
    for m in re.finditer(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, (name, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 18), ("hex", "[0-9a-f]+", 16)), 1):
        found += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    found.sort()
    return [sum(x[1] == k for x in found) for k in range(3)], hashlib.sha256(",".join(x[2] for x in found).encode()).hexdigest(), [x[2] for x in found]


def test_base_kinds_against_brute_force():
    rng = random.Random(5)
    bits = ["password", "PassWd", "ſecret", "secret", "toKen", "api_key", "apikey", "AKIA", "=", ": ", '"', "'", " ", "abcdef012345", "deadbeef00112233", "ABCDEFGH12345678", "é", "token=secret: ", "_", "-", "k"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        counts, digest, spans = brute(text)
        got = op.scan_text(text)
        assert (list(got[:3]), got[3]) == (counts, digest), text
        assert [s for s in got[4].split(",") if s.split(":")[0] in op.KINDS[:3]] == spans


def test_structures():
    rng = random.Random(6)
    for key, kind in ((rsa_key(rng), "der"), (pkcs8(rng), "der"), (openssh(rng), "openssh")):
        plain = base64.b64encode(key).decode()
        lines = "\n".join(plain[i : i + 64] for i in range(0, len(plain), 64))
        for text in (f"é {plain} end", f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----", f"k {key.hex()} z"):
            assert [x[2] for x in op.confirmed_spans(text)] == [kind], text[:60]
        broken = bytearray(key)
        broken[3 if kind == "der" else 18] ^= 0x5A  # an outer length no longer fits
        assert not op.confirmed_spans(base64.b64encode(bytes(broken)).decode())
        assert not op.confirmed_spans(base64.b64encode(key[:-7]).decode())
    good = token("HS256", 32, rng)
    assert op.confirmed_spans(f"see {good}.")[0] == (4, 4 + len(good), "jwt")
    for bad in (token("HS256", 31, rng), token("XX", 32, rng), "eyJh.bcde.fghi", "a.b.c", "www.example.com"):
        assert not op.confirmed_spans(bad)


def test_rows_and_redaction(spark):
    rng = random.Random(7)
    docs = data.awkward(spark)
    secret = spark.createDataFrame([(900, "x password = abcdefghijkl y " + token("ES256", 64, rng), "en", "a", 5, 1, True, 1, None)], docs.schema)
    both = docs.unionByName(secret)
    rows = {r["doc_id"]: r for r in op.scan(both).collect()}
    for r in both.collect():
        if r["doc_id"] is not None:
            assert rows[r["doc_id"]]["base_sha256"] == brute(r["text"] or "")[1]
    assert rows[100]["spans"] == "" and rows[900]["n_confirmed"] == 1 and rows[900]["n_assign"] == 1
    clean = {r["doc_id"]: r for r in op.redact(both).collect()}
    assert clean[900]["text"] == "x [assign] y [jwt]" and clean[900]["n_chars"] == len(clean[900]["text"])
    assert clean[100]["text"] is None and clean[5] == {r["doc_id"]: r for r in docs.collect()}[5]
    assert op.scan(data.nothing(spark)).count() == 0


def test_more_writings_of_keys():
    rng = random.Random(8)
    for key, kind in ((rsa_key(rng), "der"), (pkcs8(rng), "der"), (openssh(rng), "openssh")):
        plain = base64.b64encode(key).decode()
        lines = [plain[i : i + 64] for i in range(0, len(plain), 64)]
        pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(lines) + "\n-----END PRIVATE KEY-----\n"
        escaped = pem.replace("\n", "\\n")
        url = base64.urlsafe_b64encode(key).decode().rstrip("=")
        assert "-" in url or "_" in url
        for text in (f'{{"key": "{escaped}"}}', pem.replace("\n", "\\\\r\\\\n"), f"K={url};", "data: " + base64.b64encode(pem.encode()).decode(), f"Note: x\n{pem}"):
            assert [x[2] for x in op.confirmed_spans(text)] == [kind], text[:80]
        assert [x[2] for x in op.confirmed_spans(pem.replace("KEY-----\n", "KEY-----\nComment: mine\n\n", 1))] == [kind]
    body = base64.b64encode(rng.randbytes(608)).decode()
    locked = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: {},{}\n\n{}\n-----END RSA PRIVATE KEY-----"
    assert [x[2] for x in op.confirmed_spans(locked.format("AES-128-CBC", "0F" * 16, body))] == ["der"]
    for bad in (("AES-128-CBC", "0F" * 8, body), ("ROT-13", "0F" * 16, body), ("AES-128-CBC", "0F" * 16, body[:-8])):
        assert not op.confirmed_spans(locked.format(*bad))
    marks = "-----BEGIN PRIVATE KEY-----" * 20_000  # no quadratic search
    assert op.confirmed_spans(marks) == []


def test_no_text_with_a_span_is_passed_over():
    """The test that picks the texts to look at agrees with looking at all of them."""
    import pyarrow as pa

    rng = random.Random(9)
    part = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    heads = ['{"alg":"none"}', ' { "alg": "none"}', '{"a":1,"alg":"none"}', '\n{"alg":"none"}']
    key = rsa_key(rng)
    planted = [f"{part(h.encode())}.{part(b'{}')}." for h in heads] + [token("ES256", 64, rng), key.hex(), key.hex().upper(), base64.urlsafe_b64encode(key).decode()]
    planted += ["AKIA" + "A" * 14, "0123456789abcdef", "api-key", "apikey=abcdefghijkl", "PASSWD:'abcdefghijkl'"]
    bits = [*planted, "word", " ", "\n", "é", ".", "-", "_", "AKIA", "eyJ", "abcdef01", "=", "token"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 6))) for _ in range(2000)] + planted
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    (out,) = op._scan(iter([batch]))
    assert [tuple(r.values())[1:] for r in out.to_pylist()] == [op.scan_text(t) for t in texts]
    assert all(op.scan_text(t)[5] for t in planted[:8])


def test_a_block_behind_a_long_start():
    rng = random.Random(11)
    plain = base64.b64encode(rsa_key(rng)).decode()
    block = f"-----BEGIN RSA PRIVATE KEY-----\n{plain}\n-----END RSA PRIVATE KEY-----"
    for size in (10, 4090, 50_000):
        file = ("# note\n" * size)[:size].encode() + block.encode()
        for text in (f"x {base64.b64encode(file).decode()} y", f"x {file.hex()} y"):
            (span,) = op.confirmed_spans(text)
            assert span[2] == "der" and span[0] == 2 and span[1] == len(text) - 2
