"""Secret scan with a recursive decoding worklist.

Every text is scanned as it stands. Then its encoded layers are unwrapped: URL escapes, Unicode escapes,
base64, and compressed data inside them. A decoded layer goes on the worklist and is scanned and
unwrapped itself, until nothing new appears. A layer carries, for each of its characters, the place in
the document that it comes from, so that what is found inside is reported where it lies.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowise.llm.common import text_column

KINDS = ("assign", "access", "hex")
# An unpacked layer is held whole up to so many characters; a longer one is scanned in windows, however long it is,
# so a bomb takes time but no memory. Windows that cannot be cut between two values overlap.
WINDOW = 4 << 20
OVERLAP = 64 << 10
_PIECE_IN, _PIECE_OUT = 64 << 10, 1 << 20

# The three patterns and their least lengths.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_WORDS = (b"password", b"passwd", b"secret", b"token", b"api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_LEAST_VALUE = 6

# An escape may be escaped itself any number of times: %252541 is %2541 is %41 is A. All levels are resolved at once, so
# a chain of them takes time in proportion to its length.
_UNIT = re.compile(r"%(?=[0-9A-Fa-f]{2})((?:25)*+)([0-9A-Fa-f]{2})?+")
_URL = re.compile(r"(?:%(?=[0-9A-Fa-f]{2})(?:25)*+(?:[0-9A-Fa-f]{2})?+)+")
_URL_RUN = re.compile(r"[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]++")  # escapes and what URLs write as it is
_ESCAPE = re.compile(rb"%([0-9A-Fa-f]{2})")
# zlib data of any window size and level begin with method 8 and a check value that makes two bytes a multiple of 31.
_ZLIB = b"|".join(re.escape(bytes([a, b])) for a in range(0x08, 0x80, 0x10) for b in range(256) if (256 * a + b) % 31 == 0 and not b & 0x20)
_MAGIC = re.compile(rb"\x1f\x8b\x08|" + _ZLIB + rb"|BZh[1-9]|\xfd7zXZ\0", re.DOTALL)
_UNICODE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|[\\%]u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
# A run of either alphabet that may be wrapped over lines; of at least 16 characters in the first line, or wrapped.
_A = "[A-Za-z0-9+/_-]"
_BASE64 = re.compile(rf"(?<!{_A})(?:(?={_A}{{16}})|(?={_A}++[ \t]*\r?\n[ \t]*{_A})){_A}++(?:[ \t]*+\r?\n[ \t]*+{_A}++)*+")
_LINE = re.compile(rf"{_A}++")
_ALPHABETS = re.compile(r"[A-Za-z0-9+/]{16,}"), re.compile(r"[A-Za-z0-9_-]{16,}")
_LEAST_BASE64 = 16
_RUN_END = re.compile(rf"[^A-Za-z0-9+/_\s-]|(?<={_A})[ \t]+(?={_A})|\n[ \t\r]*\n")
_URL_END = re.compile(r"[^A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]")
_SAFE_CUT = re.compile(r"[.,;)(\]\[>!?]\s")  # nothing that is looked for goes on over this
_URL_SAFE = str.maketrans("-_", "+/")

Layer = tuple[str, np.ndarray, np.ndarray]  # text, and first and end place in the document of each character


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the secrets of one layer, in code points."""
    lower = text.encode("utf-8", "surrogatepass").lower()
    if any(w in lower for w in _WORDS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= _LEAST_VALUE:
                yield "assign", m.start(), m.end()
    if b"akia" in lower:
        for m in _ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _latin(error: UnicodeDecodeError) -> tuple[str, int]:
    """Bytes that are no UTF-8 are characters of their own; what is looked for is ASCII."""
    return error.object[error.start : error.end].decode("latin-1"), error.end


codecs.register_error("kilowise-latin", _latin)


def _whole(text: str, first: int, end: int) -> Layer:
    return text, np.broadcast_to(np.int64(first), len(text)), np.broadcast_to(np.int64(end), len(text))


def _bytes_layer(data: bytes, firsts: np.ndarray, ends: np.ndarray, spans: set, above: frozenset) -> tuple[Layer | None, int]:
    """The layer in bytes whose places are known one by one, which is the text they unpack to or are, and how many of
    the bytes surely belong to it: none where they are no UTF-8, since other bytes may begin elsewhere. What an unpacked text too long to be held has inside goes to ``spans``."""
    if _MAGIC.match(data):
        inner, kinds, used = _unpacked(data, above)
        if inner is not None or kinds:
            first, end = int(firsts[0]), int(ends[used - 1])
            spans.update((kind, first, end) for kind in kinds)
            return None if inner is None else _whole(inner, first, end), used
    try:
        text = data.decode()
    except UnicodeDecodeError:
        inner, kinds, used = _unpacked(data, above, raw=True)
        if inner is not None or kinds:
            place = int(firsts[0]), int(ends[used - 1])
            spans.update((kind, *place) for kind in kinds)
            return None if inner is None else _whole(inner, *place), used
        return (data.decode("latin-1"), firsts, ends), 0
    lead = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    last = np.append(lead[1:], len(data)) - 1
    return (text, firsts[lead], ends[last]), len(data)


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The whole layer with every match decoded; ``decode`` gives text and character ranges in the match."""
    text, first, end = layer
    parts, firsts, ends, at = [], [], [], 0
    for m in pattern.finditer(text):
        found = decode(m)
        if found is None:
            continue
        new, a, b = found
        parts += [text[at : m.start()], new]
        firsts += [first[at : m.start()], first[m.start() + a]]
        ends += [end[at : m.start()], end[m.start() + b - 1]]
        at = m.end()
    if not parts:
        return None
    return "".join([*parts, text[at:]]), np.concatenate([*firsts, first[at:]]), np.concatenate([*ends, end[at:]])


def _from_url(m: re.Match):
    """The bytes that escapes on end stand for in the end, as UTF-8. If they are not, escapes of escapes become plain
    escapes, as compressed bytes may be escaped so, and plain ones become characters of a byte each."""
    units = [(u.start(), u[1], u[2]) for u in _UNIT.finditer(m[0])]
    data = bytes(int(x, 16) if x else 0x25 for _, _, x in units)
    starts = np.array([at for at, _, _ in units])
    stops = np.append(starts[1:], len(m[0]))
    try:
        text = data.decode()
    except UnicodeDecodeError:
        if any(chain and x for _, chain, x in units):
            return "".join(f"%{b:02x}" for b in data), np.repeat(starts, 3), np.repeat(stops, 3)
        return data.decode("latin-1"), starts, stops
    lead = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return text, starts[lead], stops[np.append(lead[1:], len(data)) - 1]


def _from_unicode(m: re.Match):
    *codes, decimal = m.groups()
    code = int(decimal) if decimal else int(next(x for x in codes if x is not None), 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code), np.array([0]), np.array([len(m[0])])


def _from_url_run(run: str, first: np.ndarray, end: np.ndarray, spans: set, above: frozenset) -> Iterator[Layer]:
    """Compressed data in a run of escaped and unescaped bytes, wherever in the run it begins; "+" may be itself
    or a space."""
    for raw in {run.encode(), run.replace("+", " ").encode()}:
        data = _ESCAPE.sub(lambda e: bytes([int(e[1], 16)]), raw)
        if not _MAGIC.search(data):
            continue
        places, at = [], 0
        for e in _ESCAPE.finditer(raw):
            places += [np.arange(at, e.start()), [e.start()]]
            at = e.end()
        start = np.concatenate([*places, np.arange(at, len(raw))]).astype(np.int64)
        stop = np.append(start[1:], len(raw))
        at = 0
        while (m := _MAGIC.search(data, at)) is not None:
            inner, kinds, used = _unpacked(data[m.start() :], above)
            at = m.start() + max(used, 1)
            place = int(first[start[m.start()]]), int(end[stop[at - 1] - 1])
            spans.update((kind, *place) for kind in kinds)
            if inner is not None:
                yield _whole(inner, *place)


def _base64_places(text: str, lines: list[tuple[int, int]]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """The stretches of a run that may be one encoded value, longest first, each as its first line and its places.

    Besides the whole run these are, as words may stand on the lines around a value: the run without its first or
    last line, lines of one width with a shorter one behind and any one before, and each line with its parts in the
    one and the other alphabet.
    """
    n, width = len(lines), [b - a for a, b in lines]
    before = [0, *itertools.accumulate(width)]
    found = {(0, n), (1, n), (0, n - 1), (1, n - 1), *((i, i + 1) for i in range(n))}
    a = 0
    while a < n and n > 1:
        b = a + 1
        while b < n and width[b] == width[a]:
            b += 1
        after = b + 1 if b < n and width[b] < width[a] else b
        found.update((x, y) for x in (a, max(a - 1, 0)) for y in (b, after))
        a = b
    for a, b in sorted(found, key=lambda x: (before[x[0]] - before[x[1]], x)) if n > 1 else [(0, 1)]:
        if a < b and before[b] - before[a] >= _LEAST_BASE64:
            yield a, lines[a:b]
    for i, (a, b) in enumerate(lines):
        for alphabet in _ALPHABETS:
            yield from ((i, [m.span()]) for m in alphabet.finditer(text, a, b) if m.span() != (a, b))


def unwrap(layer: Layer, spans: set, above: frozenset) -> Iterator[Layer]:
    """The layers that are directly encoded in a layer. Secrets in those too long to be held are added to ``spans``;
    ``above`` are the digests of the compressed data around it, which are not unpacked again."""
    text, first, end = layer
    if "%" in text:
        decoded = _replaced(layer, _URL, _from_url)
        if decoded is not None:
            yield decoded
        for m in _URL_RUN.finditer(text):  # compressed bytes, of which URLs escape only some
            if "%" in m[0]:
                yield from _from_url_run(m[0], first[m.start() : m.end()], end[m.start() : m.end()], spans, above)
    if "\\" in text or "&#" in text or "%u" in text:
        decoded = _replaced(layer, _UNICODE, _from_unicode)
        if decoded is not None:
            yield decoded
    for m in _BASE64.finditer(text):
        lines = [x.span() for x in _LINE.finditer(text, m.start(), m.end())]
        known: set[int] = set()  # lines of a layer that is found
        for line, places in _base64_places(text, lines):
            if line in known:
                continue
            body = "".join(text[a:b] for a, b in places)
            if len(body) % 4 == 1:
                body = body[:-1]
            try:
                data = base64.b64decode(body.translate(_URL_SAFE) + "=" * (-len(body) % 4))
            except binascii.Error:
                continue
            if not data:
                continue
            # Byte j comes from the six-bit groups that its bits 8 j .. 8 j + 7 lie in.
            at = np.concatenate([np.arange(a, b) for a, b in places])
            bit = 8 * np.arange(len(data))
            found, used = _bytes_layer(data, first[at[bit // 6]], end[at[(bit + 7) // 6]], spans, above)
            if found is not None:
                yield found
            while used and line < len(lines) and lines[line][0] <= at[(8 * used - 1) // 6]:
                known.add(line)
                line += 1


def find_secrets(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Secrets of the text as it stands, and all with those of its decoded layers; sorted by start, then
    kind. Layers are unwrapped until none is new: one with the same text from the same place is not
    looked at again, which also ends cycles (a compressed layer may unpack to itself)."""
    rank = {k: i for i, k in enumerate(KINDS)}
    base = sorted(set(scan(text)), key=lambda s: (s[1], rank[s[0]], s[2]))
    places = None
    spans = set(base)
    work: list[Layer] = []
    if "%" in text or "\\" in text or "&#" in text or _BASE64.search(text):
        places = np.arange(len(text) + 1)
        work.append((text, places[:-1], places[1:]))
    _unwrap_all(work, spans, frozenset())
    return base, sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def _unwrap_all(work: list[Layer], spans: set, above: frozenset) -> None:
    """Add the secrets of all layers encoded in those of ``work``, at any depth."""
    seen: set[tuple[int, int, bytes]] = set()
    while work:
        layer = work.pop()
        for inner, first, end in unwrap(layer, spans, above):
            if not inner:
                continue
            mark = (int(first[0]), int(end[-1]), _digest(inner.encode("utf-8", "surrogatepass")))
            if mark not in seen:
                seen.add(mark)
                spans.update((kind, int(first[a]), int(end[b - 1])) for kind, a, b in scan(inner))
                work.append((inner, first, end))


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class _Text:
    """Text that comes in pieces of bytes. It is kept while it is short; of a long one only the kinds of its
    secrets are, which suffices, as all characters of an unpacked layer have one place in the document."""

    def __init__(self, above: frozenset) -> None:
        self.above = above
        self.decoder = codecs.getincrementaldecoder("utf-8")("kilowise-latin")
        self.n = 0
        self.rest = ""
        self.long = False
        self.kinds: set[str] = set()
        self.runs: list[_Run] = []

    def feed(self, data: bytes) -> None:
        self._take(self.decoder.decode(data))

    def _take(self, text: str) -> None:
        self.n += len(text)
        for run in self.runs:
            run.feed(text)
        self.rest += text
        while len(self.rest) >= WINDOW:
            self._cut()

    def _cut(self) -> None:
        self.long, text = True, self.rest
        ends = [m.end() for m in _SAFE_CUT.finditer(text, max(0, len(text) - OVERLAP))] or [m.end() for m in _SAFE_CUT.finditer(text)]
        if ends:
            self._window(text[: ends[-1]])
            self.rest = text[ends[-1] :]
            return
        self._window(text)
        for run in self.runs:
            if run.ended:
                self.kinds |= run.close()
        self.runs = [run for run in self.runs if not run.ended]
        if not self.runs:
            self._open(text)
        self.rest = text[-OVERLAP:]

    def _open(self, text: str) -> None:
        """Follow the values that the end of a window leaves open."""
        last = next((m for m in _BASE64.finditer(text) if m.end() >= len(text.rstrip())), None)
        if last is not None:
            lines = [m.start() for m in _LINE.finditer(text, last.start(), last.end())]
            for at in lines[:2]:
                self.runs.append(_Run(_RUN_END, _FromBase64(), _Layer(self.above)))
                self.runs[-1].feed(text[at:])
        url = next((m for m in _URL_RUN.finditer(text) if m.end() == len(text)), None)
        if url is not None and "%" in url[0]:
            for space in {"+", " "} if "+" in url[0] else {"+"}:
                self.runs.append(_Run(_URL_END, _FromUrl(space), _Anywhere(self.above)))
                self.runs[-1].feed(url[0])

    def _window(self, text: str) -> None:
        self.kinds.update(kind for kind, _, _ in scan(text))
        spans: set[tuple[str, int, int]] = set()
        _unwrap_all([_whole(text, 0, 1)], spans, self.above)
        self.kinds.update(kind for kind, _, _ in spans)

    def close(self) -> tuple[str | None, set[str]]:
        """The text if it is short, and the kinds in a long one; nothing if it is empty."""
        self._take(self.decoder.decode(b"", True))
        if not self.n:
            return None, set()
        if not self.long:
            return self.rest, set()
        self._window(self.rest)
        for run in self.runs:
            self.kinds |= run.close()
        return None, self.kinds


class _Packed:
    """Compressed data that comes in pieces: gzip, zlib, bzip2 and xz, member after member, or one stream of bare deflate."""

    def __init__(self, above: frozenset, raw: bool = False) -> None:
        self.text = _Text(above)
        self.raw = raw
        self.member = zlib.decompressobj(-15) if raw else None
        self.head = b""  # too short to tell what it is
        self.fed = self.used = self.members = 0
        self.over = False

    def feed(self, data: bytes) -> None:
        self.fed += len(data)
        data = self.head + data
        self.head = b""
        while not self.over:
            if self.member is None:
                if self.raw:
                    return
                if self.members:
                    data = data.lstrip(b"\0")  # padding between members
                if len(data) < 6:
                    self.head = data
                    return
                self.member = _member(data)
                if self.member is None:
                    self.over = True
                    return
            try:
                out = self.member.decompress(data, _PIECE_OUT)
            except (zlib.error, OSError, lzma.LZMAError, ValueError, EOFError):
                self.over = True
                return
            self.text.feed(out)
            if self.member.eof:
                data = self.member.unused_data
                self.member = None
                self.members += 1
                self.used = self.fed - len(data)
            elif hasattr(self.member, "unconsumed_tail"):
                data = self.member.unconsumed_tail
                if not data and len(out) < _PIECE_OUT:
                    return
            else:
                data = b""
                if self.member.needs_input:
                    return

    def close(self) -> tuple[str | None, set[str], int]:
        text, kinds = self.text.close()
        broken = self.member is not None and (not self.over or text is not None or kinds)
        return text, kinds, self.fed if broken else self.used


def _member(data: bytes):
    """What unpacks data that begins so; None if it is not compressed."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[0] & 0x8F == 8 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor()
    return None


def _unpacked(data: bytes, above: frozenset, raw: bool = False) -> tuple[str | None, set[str], int]:
    """Unpacked text if it is short, the kinds of secrets in a long one, and how many bytes of ``data`` it took.
    Nothing tells bare deflate (``raw``) from other bytes but that it comes to its end with the data."""
    digest = _digest(data)
    if digest in above:
        return None, set(), 0
    packed = _Packed(above | {digest}, raw)
    for at in range(0, len(data), _PIECE_IN):
        packed.feed(data[at : at + _PIECE_IN])
        if packed.over:
            break
    if raw and (packed.over or packed.used != len(data)):
        return None, set(), 0
    return packed.close()


class _Layer:
    """Decoded bytes that come in pieces: text or compressed data."""

    def __init__(self, above: frozenset) -> None:
        self.above, self.head, self.sinks = above, b"", None

    def feed(self, data: bytes) -> None:
        if self.sinks is None:
            self.head = data = self.head + data
            if len(data) < 16:
                return
            self.sinks = [_Text(self.above)] + ([_Packed(self.above)] if _MAGIC.match(data) else [])
        for sink in self.sinks:
            sink.feed(data)

    def close(self) -> set[str]:
        return set().union(*(_kinds(sink) for sink in self.sinks or []))


class _Anywhere:
    """Decoded bytes that come in pieces and have compressed data somewhere in their first one."""

    def __init__(self, above: frozenset) -> None:
        self.above, self.sinks = above, None

    def feed(self, data: bytes) -> None:
        if self.sinks is not None:
            for sink in self.sinks:
                sink.feed(data)
            return
        self.sinks, at = [], 0
        while (m := _MAGIC.search(data, at)) is not None:
            packed = _Packed(self.above)
            for i in range(m.start(), len(data), _PIECE_IN):
                packed.feed(data[i : i + _PIECE_IN])
            at = m.start() + max(packed.used, 1)
            if not packed.over:
                self.sinks.append(packed)
                return

    def close(self) -> set[str]:
        return set().union(*(_kinds(sink) for sink in self.sinks or []))


def _kinds(sink: _Text | _Packed) -> set[str]:
    """Kinds of secrets in a layer that has ended, be it short or long."""
    text, kinds, *_ = sink.close()
    if text is not None:
        sink = sink.text if isinstance(sink, _Packed) else sink
        sink._window(text)
        return sink.kinds
    return kinds


class _FromBase64:
    def __init__(self) -> None:
        self.rest = ""

    def __call__(self, text: str, last: bool) -> bytes:
        body = self.rest + "".join(text.split()).translate(_URL_SAFE)
        n = len(body) // 4 * 4
        self.rest, body = body[n:], body[:n]
        if last and len(self.rest) > 1:
            body += self.rest + "=" * (4 - len(self.rest))
        return base64.b64decode(body)


class _FromUrl:
    def __init__(self, plus: str) -> None:
        self.plus, self.rest = plus, ""

    def __call__(self, text: str, last: bool) -> bytes:
        text = self.rest + text
        at = text.rfind("%", max(0, len(text) - 2))
        self.rest, text = ("", text) if last or at < 0 else (text[at:], text[:at])
        return _ESCAPE.sub(lambda e: bytes([int(e[1], 16)]), text.replace("+", self.plus).encode())


class _Run:
    """An encoded value that goes on over the windows of a long layer, decoded as it comes."""

    def __init__(self, stop: re.Pattern, decode, sink: _Layer | _Anywhere) -> None:
        self.stop, self.decode, self.sink, self.ended = stop, decode, sink, False

    def feed(self, text: str) -> None:
        if not self.ended:
            m = self.stop.search(text)
            self.ended = m is not None
            self.sink.feed(self.decode(text if m is None else text[: m.start()], self.ended))

    def close(self) -> set[str]:
        if not self.ended:
            self.sink.feed(self.decode("", True))
        return self.sink.close()


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_decoded: counts and digest of the secrets of
    the text as it stands; ``spans`` are all, ``n_decoded`` those that only decoding shows.

    Null is the empty text. Repeated rows have equal results; an empty table gives an empty one; other
    columns are left out.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in text_column(batch):
                base, spans = find_secrets(text)
                kinds = [s[0] for s in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in KINDS), digest, _joined(spans), len(spans) - len(base)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long"
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret, decoded ones where their encoding stands, replaced by ``mark``. No row goes;
    columns stay as they are; a null text stays null, an empty one empty. Of secrets that overlap the first is replaced
    from its begin, and what goes on behind it up to its own end goes too. Repeated rows become alike; an empty table
    gives an empty one."""

    def one(text: str | None) -> str | None:
        if not text:
            return text
        parts, at = [], 0
        for _, a, b in find_secrets(text)[1]:
            if a >= at:
                parts += [text[at:a], mark]
            at = max(at, b)
        return "".join([*parts, text[at:]]) if parts else text

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        return pa.array((one(x.as_py()) for x in texts), pa.string())

    return docs.withColumn("text", cleaned(F.col("text").cast("string")))
