"""Secret scans with a recursive decoding worklist.

``scan_text`` looks for three kinds of secrets in a text, then unwraps encoded
parts of it and looks again in each decoded layer: percent-encoding, Unicode
escapes, base64, and zlib or gzip data inside base64. Base64 is joined over line
ends and read in all four alignments, so it may be wrapped and may stand behind a
path or a word; what is readable in it, from ``SHORTEST`` characters on, becomes a
layer, whatever bytes lie around. Layers wait in a worklist
until none is left; a layer whose text was seen before in the same place is not
taken again, which ends cycles. Every character of a layer carries the range of
the original text that it came from, so a find in any layer maps to a span of
the original, in code points.

A decompressed layer of over ``max_layer`` characters is never held whole: it is
inflated and scanned in windows, cut where no find and no encoded part can lie
across. Where nothing in a whole window allows a cut, the windows overlap by half,
the layer counts in ``skipped``, and its encoded part is ``opaque``: ``redact``
replaces all of it.

Defined results: null text counts as empty; spans of the given text are always
kept, whatever decoding finds; equal spans from several layers count once.
"""

from __future__ import annotations

import binascii
import codecs
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import arrow_map, texts_of

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
# Runs are taken whole, so the least length can stand in the pattern for these two.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
RUN = re.compile(r"[A-Za-z0-9+/_-]+")
#: A run of 16, or shorter ones on lines of their own, joined over the line ends.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+|[A-Za-z0-9+/_-]++(?=[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]))(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)*+={0,2}")
STANDARD = str.maketrans("-_", "+/")
#: No secret and no encoded secret is shorter than "token=" and six characters.
SHORTEST = 12
READABLE = re.compile(rf"[^\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\ud800-\udfff]{{{SHORTEST},}}")
#: The first bytes of gzip and zlib data.
MAGIC = re.compile(b"\x1f\x8b\x08|" + b"|".join(re.escape(bytes([a])) + b"[" + b"".join(re.escape(bytes([b])) for b in range(256) if (a * 256 + b) % 31 == 0 and not b & 32) + b"]" for a in range(8, 128, 16)))
#: A character that no find and no encoded part holds, or a space behind what is no keyword and before a word.
CUT = re.compile(r"""[^A-Za-z0-9+/_.=:"'%\\\s-]|(?<=[^dtnyDTNY"':=\s])\x20(?=[^\s:=])""", re.ASCII)
MAX_LAYER = 1 << 24
CHUNK = 1 << 16


def find(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the secrets of one layer."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


@dataclass
class Layer:
    """A text and, for each of its characters, the original range; None stands for the identity."""

    text: str
    starts: list[int] | None = None
    ends: list[int] | None = None
    path: tuple[str, ...] = ()
    #: The range of all characters, where it is one; stands for both lists.
    span: tuple[int, int] | None = None
    #: False for the windows of a layer after the first.
    counts: bool = True

    def range(self, start: int, end: int) -> tuple[int, int]:
        if self.span:
            return self.span
        if self.starts is None or self.ends is None:
            return start, end
        return min(self.starts[start:end]), max(self.ends[start:end])

    def replaced(self, parts: list[tuple[int, int, str, bool]], kind: str) -> Layer:
        """The layer with ranges replaced; an exact part keeps one character per group of its own."""
        text: list[str] = []
        starts: list[int] = []
        ends: list[int] = []
        at = 0
        for start, end, new, _ in [*parts, (len(self.text), len(self.text), "", False)]:
            text.append(self.text[at:start])
            if self.span:
                text.append(new)
                at = end
                continue
            starts += self.starts[at:start] if self.starts is not None else range(at, start)
            ends += self.ends[at:start] if self.ends is not None else range(at + 1, start + 1)
            if new:
                low, high = self.range(start, end)
                text.append(new)
                starts += [low] * len(new)
                ends += [high] * len(new)
            at = end
        if self.span:
            return Layer("".join(text), path=(*self.path, kind), span=self.span)
        return Layer("".join(text), starts, ends, (*self.path, kind))

    def part(self, start: int, end: int, new: str, kind: str) -> Layer:
        return Layer(new, path=(*self.path, kind), span=self.range(start, end))


@dataclass
class Found:
    base: list[tuple[str, int, int]]
    spans: list[tuple[str, int, int]]
    layers: int = 0
    skipped: int = 0
    opaque: list[tuple[int, int]] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)


def _unpacked(data: memoryview) -> Iterator[tuple[bytes, int]]:
    """What gzip or zlib data gives, as far as it is whole, in pieces, each with the bytes taken so far."""
    unpack, rest, at = zlib.decompressobj(47), data[:0], 0
    try:
        while not unpack.eof:
            if not rest:
                rest = data[at : at + CHUNK]
                at += len(rest)
            piece = unpack.decompress(rest, CHUNK)
            if not piece and not rest:
                return
            rest = unpack.unconsumed_tail
            yield piece, at - len(rest) - len(unpack.unused_data)
    except zlib.error:
        return


def _inflate(data: memoryview) -> tuple[bytes | None, int]:
    """All of what the data gives, None if it is over ``CHUNK`` bytes, and the bytes it takes."""
    out: list[bytes] | None = []
    size = taken = 0
    for piece, taken in _unpacked(data):
        size += len(piece)
        if out is not None:
            out = [*out, piece] if size <= CHUNK else None
    return None if out is None else b"".join(out), taken


def _windows(data: memoryview, like: Layer, found: Found, most: int) -> Iterator[Layer]:
    """A decompressed layer, in windows of at most ``most`` characters, with the path and span of ``like``."""
    decode = codecs.getincrementaldecoder("utf-8")("replace").decode
    parts: list[str] = []
    held, opaque, counts = 0, False, True
    for piece in chain((x for x, _ in _unpacked(data)), [None]):
        parts.append(decode(piece or b"", piece is None))
        held += len(parts[-1])
        if held <= most and piece is not None:
            continue
        text = "".join(parts)
        at = 0
        while len(text) - at > most:
            cut = _cut(text, at, at + most)
            if cut is None and not opaque:
                opaque = True
                found.skipped += 1
                found.opaque.append(like.range(0, 0))
            yield Layer(text[at : cut or at + most], path=like.path, span=like.span, counts=counts)
            at, counts = cut or at + max(1, most // 2), False
        parts, held = [text[at:]], len(text) - at
    yield Layer(parts[0], path=like.path, span=like.span, counts=counts)


def _cut(text: str, start: int, end: int) -> int | None:
    """The last place between two where no find and no encoded part can lie across."""
    back = 1 << 10
    while True:
        low = max(start + 1, end - back)
        if at := max((m.start() for m in CUT.finditer(text, low, end)), default=None):
            return at
        if low == start + 1:
            return None
        back <<= 4


def _percent(text: str) -> list[tuple[int, int, str, bool]]:
    """Percent-encoded characters, one part each, so that spans stay exact."""
    out = []
    for m in PERCENT.finditer(text):
        at = 0
        for c in bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape"):
            if "\udc80" <= c <= "\udcff":  # a byte that is no UTF-8 stays as it stands
                at += 3
                continue
            size = 3 * len(c.encode("utf-8"))
            out.append((m.start() + at, m.start() + at + size, c, True))
            at += size
    return out


def _escapes(text: str) -> list[tuple[int, int, str, bool]]:
    out: list[tuple[int, int, str, bool]] = []
    for run in ESCAPE.finditer(text):
        high: tuple[int, int] | None = None
        for m in ESCAPED.finditer(text, run.start(), run.end()):
            code = int(m[1] or m[2] or m[3], 16)
            if high and m[1] and 0xDC00 <= code < 0xE000:
                out.append((high[0], m.end(), chr(0x10000 + ((high[1] - 0xD800) << 10) + code - 0xDC00), True))
                high = None
            elif m[1] and 0xD800 <= code < 0xDC00:
                high = (m.start(), code)
            else:
                high = None
                if code < 0x110000 and not 0xD800 <= code < 0xE000:
                    out.append((m.start(), m.end(), chr(code), True))
    return out


class Block:
    """Base64 characters without the line ends between them, and where they stand in the layer."""

    def __init__(self, layer: Layer, start: int, end: int):
        self.layer, self.end = layer, end
        self.runs = [m.span() for m in RUN.finditer(layer.text, start, end)]
        self.token = "".join(layer.text[s:e] for s, e in self.runs)
        self.upto = [0, *accumulate(e - s for s, e in self.runs)]

    def line(self, i: int) -> int:
        return bisect_right(self.upto, i, 0, len(self.runs)) - 1

    def place(self, i: int, j: int) -> tuple[int, int]:
        """The layer's range of characters ``i`` to ``j``, with the padding behind the last one."""
        a, b = self.line(i), self.line(j - 1)
        return self.runs[a][0] + i - self.upto[a], self.end if j == len(self.token) else self.runs[b][0] + j - self.upto[b]

    def data(self, shift: int) -> bytes:
        n = len(self.token) - shift
        token = self.token[shift : len(self.token) - (n % 4 == 1)].translate(STANDARD)
        return binascii.a2b_base64(token + "=" * (-len(token) % 4))

    def part(self, shift: int, first: int, last: int, text: str, kind: str) -> Layer:
        """A layer from the bytes ``first`` to ``last``; each of a text's characters maps to the lines that hold it."""
        i, j = shift + 8 * first // 6, min(len(self.token), shift + (8 * last - 1) // 6 + 1)
        a, b = self.line(i), self.line(j - 1)
        if a == b or kind != "base64":
            return self.layer.part(*self.place(i, j), text, kind)
        ranges = [self.layer.range(*self.place(max(i, self.upto[k]), min(j, self.upto[k + 1]))) for k in range(a, b + 1)]
        starts, ends, at = [], [], first
        for c in text:
            size = len(c.encode("utf-8"))
            starts.append(ranges[self.line(shift + 8 * at // 6) - a][0])
            ends.append(ranges[self.line(shift + (8 * (at + size) - 1) // 6) - a][1])
            at += size
        return Layer(text, starts, ends, (*self.layer.path, kind))


def _base64(layer: Layer, found: Found, most: int) -> list[Layer | Iterator[Layer]]:
    out: list[Layer | Iterator[Layer]] = []
    for m in BASE64.finditer(layer.text):
        block = Block(layer, m.start(), m.end())
        token = block.token
        # Words and plain hex are no base64 that is worth a look.
        if len(token) < 16 or token.isalpha() and (token.islower() or token.isupper() or token.istitle()):
            continue
        for shift in range(4):
            data = block.data(shift)
            at = done = 0
            while magic := MAGIC.search(data, at):
                at = magic.start() + 1
                packed = memoryview(data)[magic.start() :]
                inner, size = _inflate(packed)
                text = inner.decode("utf-8", "replace") if inner is not None else ""
                if inner is None or READABLE.search(text):
                    out += _stretches(block, shift, data, done, magic.start())
                    done = at = magic.start() + size
                    part = block.part(shift, magic.start(), done, text, "compressed")
                    out.append(part if inner is not None and len(text) <= most else _windows(packed[:size], part, found, most))
            whole = _stretches(block, shift, data, done, len(data))
            out += whole
            if done == len(data) or not done and [len(x.text.encode("utf-8")) for x in whole] == [len(data)]:
                break  # nothing is left that another alignment could read
    return out


def _stretches(block: Block, shift: int, data: bytes, first: int, last: int) -> list[Layer]:
    """The readable parts of ``data`` between two bytes."""
    out, at, text = [], 0, data[first:last].decode("utf-8", "surrogateescape")
    for m in READABLE.finditer(text):
        first += len(text[at : m.start()].encode("utf-8", "surrogateescape"))
        at = m.end()
        size = len(m[0].encode("utf-8"))
        out.append(block.part(shift, first, first + size, m[0], "base64"))
        first += size
    return out


def scan_text(text: str, max_layer: int = MAX_LAYER) -> Found:
    """All finds of a text and of what can be decoded from it."""
    base = find(text)
    found = Found(base, [])
    spans, seen = set(base), set()
    work: list[Layer | Iterator[Layer]] = [Layer(text)]
    while work:
        layer = work.pop()
        if not isinstance(layer, Layer):
            windows = layer
            if (layer := next(windows, None)) is None:
                continue
            work.append(windows)
        mark = (hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), layer.range(0, len(layer.text)) if layer.text and layer.path else (0, 0))
        if mark in seen:
            continue
        seen.add(mark)
        if layer.path:
            found.layers += layer.counts
            for kind, start, end in find(layer.text):
                low, high = layer.range(start, end)
                if (kind, low, high) not in spans:
                    spans.add((kind, low, high))
                    found.paths.append(">".join(layer.path))
        if "%" in layer.text and (parts := _percent(layer.text)):
            work.append(layer.replaced(parts, "url"))
        if "\\" in layer.text and (parts := _escapes(layer.text)):
            work.append(layer.replaced(parts, "unicode"))
        work += _base64(layer, found, max_layer)
    found.spans = sorted(spans, key=order)
    found.base.sort(key=order)
    return found


def order(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_layer: int = MAX_LAYER) -> DataFrame:
    """``id_col``, the spans of the text as it stands (``base``), all ``spans``, ``n_layers`` and ``n_skipped``."""

    def run(batch: pa.RecordBatch) -> dict:
        found = [scan_text(t, max_layer) for t in texts_of(batch, "_t")]
        rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        return {"id": batch.column(0), "base": [rows(f.base) for f in found], "spans": [rows(f.spans) for f in found], "n_layers": [f.layers for f in found], "n_skipped": [f.skipped for f in found]}

    kind = df.select(id_col).schema[0].dataType.simpleString()
    span = "array<struct<kind: string, start: bigint, end: bigint>>"
    return arrow_map(df.select(F.col(id_col), F.col(text_col).alias("_t")), run, f"id {kind}, base {span}, spans {span}, n_layers int, n_skipped int").withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the base spans and the list of all spans."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select(id_col, *[count(k) for k in KINDS], F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"), "n_layers", "n_skipped")


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", max_layer: int = MAX_LAYER) -> DataFrame:
    """The rows of ``df`` with each span and opaque part of ``text_col`` replaced by ``mark``; overlapping ones become one."""

    def run(batch: pa.RecordBatch) -> dict:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        out = []
        for text in batch.column(text_col).to_pylist():
            found = scan_text(text or "", max_layer)
            spans = sorted([(start, end) for _, start, end in found.spans] + found.opaque)
            parts, at = [], 0
            for start, end in spans:
                if end <= at:
                    continue
                if start >= at:
                    parts += [text[at:start], mark]
                at = end
            out.append("".join([*parts, text[at:]]) if spans else text)
        return columns | {text_col: out}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return arrow_map(df, run, schema)
