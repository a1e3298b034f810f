"""Secrets of texts and of their encoded layers."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import time
import urllib.parse
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from kilowise.llm import secrets as s
from tests.llm.conftest import EXTRA

HEX = "0123456789abcdef" * 2


def _base(text):
    """The contract, read literally."""
    found = []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 6:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], s.KINDS.index(x[0])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "api_key", "apiKEY", "ſecret", "secret", "=", ":", " ", '"', "'", "abc", "x" * 7, "AKIA", "A1" * 9,
                                 "abcdef12" * 3, "é", "\U0001f600", "%70", "\\u0070", "\n"])).map("".join))
def test_base_is_the_contract(text):
    base, spans = s.find_secrets(text)
    assert base == _base(text)
    assert set(base) <= set(spans) and all(0 <= a < b <= len(text) for _, a, b in spans)


def test_layers_map_back():
    inner = "token = abcdefgh12345"
    quoted = urllib.parse.quote(inner, safe="")
    escaped = "".join(f"\\u{ord(c):04x}" for c in inner)
    b64 = base64.b64encode(inner.encode()).decode()
    twice = base64.b64encode(quoted.replace("t", "%74").encode()).decode()
    packed = base64.b64encode(gzip.compress(inner.encode())).decode()
    deep = base64.b64encode(zlib.compress(base64.b64encode(escaped.encode()))).decode()
    raw = "".join(f"%{b:02x}" for b in zlib.compress(inner.encode()))
    for layer in (quoted, escaped, b64, twice, packed, deep, raw):
        text = f"é😀 before {layer} after it"
        base, spans = s.find_secrets(text)
        at = text.index(layer)
        assert not base and any(k == "assign" for k, _, _ in spans), layer
        assert all(at <= a < b <= at + len(layer) for _, a, b in spans), layer


def test_layers_in_other_shapes():
    inner = b"what is this? yes ok? it is password=hunter2hunter2 end"
    bulk = b"".join(b"line %d of a file, with \xc3\xa9\n" % (i * i) for i in range(60)) + b"token = abcdefgh12345\n"
    wrapped = base64.encodebytes(gzip.compress(bulk, mtime=0)).decode().rstrip()
    assert wrapped.count("\n") > 3
    cases = [
        base64.urlsafe_b64encode(inner).decode(),
        base64.urlsafe_b64encode(zlib.compress(bulk)).decode(),
        wrapped,
        f"below\n{wrapped}\nend of it",
        f"-----BEGIN DATA-----\n{wrapped}\n-----END DATA-----",
        wrapped.replace("\n", "\r\n  "),
        base64.encodebytes(b"x" * 50 + inner).decode().rstrip(),
        urllib.parse.quote(zlib.compress(bulk), safe=""),
        urllib.parse.quote_plus(gzip.compress(bulk, mtime=0)),
        f"https://host.example/a?d={urllib.parse.quote(bz2.compress(bulk))}&e=1",
    ]
    for layer in cases:
        text = f"é😀 before: {layer} after it"
        base, spans = s.find_secrets(text)
        at = text.index(layer)
        assert not base and any(k == "assign" for k, _, _ in spans), layer
        assert all(at <= a < b <= at + len(layer) for _, a, b in spans), layer


def test_layers_of_any_bytes():
    """Latin-1 and stray bytes in base64, bare or packed; bare deflate; zlib of all window sizes; other escapes."""
    inner = "password=hunter2hunter2"
    latin = f"café {inner} naïve".encode("latin-1")
    bare = zlib.compressobj(9, zlib.DEFLATED, -15)
    bulk = b"some words, one after the other. " * 9 + inner.encode()
    layers = {
        "latin": base64.b64encode(latin),
        "stray": base64.b64encode(b"\x80\x81" + inner.encode()),
        "packed": base64.b64encode(gzip.compress(latin)),
        "bare": base64.b64encode(bare.compress(bulk) + bare.flush()),
        "url": "".join(f"%{b:02X}" for b in latin).encode(),
        "twice": "".join(f"%25{b:02X}" for b in zlib.compress(inner.encode())).encode(),
        "percent-u": "".join(f"%u{ord(c):04x}" for c in inner).encode(),
        "hex entity": "".join(f"&#x{ord(c):x};" for c in inner).encode(),
        "entity": "".join(f"&#{ord(c)};" for c in inner).encode(),
    }
    for bits in range(9, 16):
        for level in (0, 1, 6, 9):
            z = zlib.compressobj(level, zlib.DEFLATED, bits)
            layers[f"zlib {bits} {level}"] = base64.b64encode(z.compress(bulk) + z.flush())
    for name, layer in layers.items():
        text = f"é😀 before {layer.decode()} after it"
        at = text.index(layer.decode())
        spans = [x for x in s.find_secrets(text)[1] if x[0] == "assign"]
        assert spans and all(at <= a < b <= at + len(layer) for _, a, b in spans), name


def resolved(text):
    """A text with each escape resolved, level after level."""
    while True:
        new = re.sub(r"%([0-7][0-9A-Fa-f])", lambda m: chr(int(m[1], 16)), text)
        if new == text:
            return text
        text = new


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["%25", "25", "%70", "%2570", "%252570", "assword=", "password=", "%", "41", "abcdef", "%3d", "\n", "%253D"])).map("".join))
def test_escapes_are_resolved_to_the_end(text):
    """The kinds of secrets of the text with all levels resolved are found; spans lie where the text changes."""
    want = {k for k, _, _ in _base(resolved(text))} | {k for k, _, _ in _base(text)}
    assert want <= {k for k, _, _ in s.find_secrets(text)[1]}


def test_long_chains_take_linear_time():
    """A megabyte of escaped escapes, in three shapes, and of one letter; one finding for one secret."""
    start = time.process_time()
    chain = "password=hunter2" + "%25" * 2 + "25" * 500_000 + "41"
    base, spans = s.find_secrets(chain)
    assert base == [("assign", 0, 16)] and spans == [("assign", 0, 16), ("assign", 0, len(chain))] or len(spans) <= 3
    assert len(s.find_secrets("%25" * 350_000)[1]) == 0
    assert len(s.find_secrets("secret: abcdefg " + "%2525254" * 130_000)[1]) <= 3
    assert s.find_secrets("q" * 1_000_000)[1] == []
    assert time.process_time() - start < 40


def test_members_and_long_layers(monkeypatch):
    monkeypatch.setattr(s, "WINDOW", 1 << 18, raising=False)
    filler = "é, plain words in a line. " * 10_000
    secret = "password=hunter2hunter2"
    cut = 1 << 18
    deep = base64.b64encode(zlib.compress(bytes(random.Random(1).choices(range(97, 123), k=3 * cut)) + secret.encode())).decode()
    assert len(deep) > cut
    whole = {
        "members": gzip.compress(b"one, two. " * 20) + gzip.compress(secret.encode()),
        "streams": bz2.compress(b"one, two. ") + bz2.compress(secret.encode()),
        "blocks": lzma.compress(b"one, two. ") + lzma.compress(secret.encode()),
        "padded": gzip.compress(b"one, two. ") + bytes(512) + gzip.compress(secret.encode()),
        "end": gzip.compress(("é\n" * (23 << 20) + secret).encode()),  # over 64 MB
        "split": zlib.compress((" " * (cut - 4) + secret + "x" * cut).encode()),
        "nested": zlib.compress(f"{filler} {deep} {filler}".encode()),
        "escaped": zlib.compress(f"{filler} {urllib.parse.quote(base64.b64decode(deep))} {filler}".encode()),
    }
    for name, data in whole.items():
        layer = base64.b64encode(data).decode()
        assert s.find_secrets(f"see {layer} here")[1] == [("assign", 4, 4 + len(layer.rstrip("=")))], name


def test_wrapped_layer_is_one_finding():
    data = gzip.compress(" ".join(map(str, range(500))).encode() + b" password=hunter2hunter2 ", mtime=0)
    layer = base64.encodebytes(data).decode().rstrip()
    assert s.find_secrets(f"see:\n{layer}\nhere")[1] == [("assign", 5, 5 + len(layer.rstrip("=")))]


def test_cycles_and_bombs_end():
    text = "password=" + "%25" * 50 + "41 " + base64.b64encode(gzip.compress(b"a" * 200_000)).decode()
    base, spans = s.find_secrets(text)
    assert set(base) <= set(spans)
    assert s.find_secrets("") == ([], [])


def test_documents(spark, wide, rows, none):
    found = s.scan_documents(wide)
    want = sorted((r[0] is not None, r[0] or 0, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in _base(r[1] or "")).encode()).hexdigest()) for r in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["base_sha256"]) for r in found.collect()) == want
    assert s.scan_documents(none).count() == 0
    df = spark.createDataFrame([(1, f"key {HEX} AKIA{'A1' * 9}!", "z"), (2, None, "z"), (3, "", "z")], "doc_id long, text string, spans string")
    row = s.scan_documents(df).filter("doc_id = 1").first()
    assert (row["n_assign"], row["n_access"], row["n_hex"], row["spans"]) == (0, 1, 1, "hex:4:36,access:37:59")


def test_redact(spark, wide, none):
    b64 = base64.b64encode(b"my password is password=hunter22222").decode()
    df = spark.createDataFrame([(1, f"a {HEX} b {b64} c"), (2, None), (3, "plain")], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in s.redact(df).collect()}
    assert found[2] is None and found[3] == "plain" and HEX not in found[1] and "[secret]" in found[1] and found[1].endswith(" c")
    assert b64 not in found[1]
    out = s.redact(wide)
    assert out.columns == wide.columns and out.count() == wide.count() and set(EXTRA) < set(out.columns)
    assert s.redact(none).count() == 0
