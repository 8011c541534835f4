"""Secret scans through nested encodings.

Every text is a worklist of layers.  A layer is scanned for the base patterns;
then what it encodes becomes further layers: percent escapes and Unicode
escapes decoded in place, and base64 tokens, whose bytes may be compressed
(zlib, gzip, bzip2, xz; several streams on end).  Base64 that is no text as a
whole is read from all four alignments, as a prefix shifts it, and what lies
between bytes that are no text is scanned too; lines of it are also read as one.
Compressed bytes may stand in escapes as well.  Form encoding (a plus for a space) and
the backslashes of strings within strings are undone too.  Work ends when no new layer
appears; a layer whose text came up before from the same place is not entered again,
so cycles end too.  Each layer carries the span of the original text that its
characters came from: one for each, or one for all of them.  Layers are entered as
they are found, so only those on the way to the present one are held.

Defined results: a null text is an empty one.  Base spans are those of the text
itself; a finding of a deeper layer is added with the span of its encoding in
the original unless that kind and span is there already.  Texts of any length
are scanned whole.  A compressed layer of more than CHUNK bytes is scanned in chunks
while it is unpacked, which share OVERLAP bytes: a finding or an encoding longer than
that may be missed where a chunk ends in it.  One that unpacks to more than MAX_LAYER
bytes (a bomb) is read so far and counted in ``oversized``; what stands beside or
behind it is read all the same.
Rows are independent: repeated rows and ids repeat their results.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

KINDS = ("assign", "access", "hex")
CHUNK = 1 << 23         # bytes of a compressed layer held at once
OVERLAP = 1 << 16
MAX_LAYER = 1 << 31     # bytes that a compressed layer may unpack to

# The base patterns of the contract.
PATTERNS = {
    "assign": re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*"
                         r"[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 8, "access": 16, "hex": 32}

# [0-9a-f]+ meets almost every word.  Its matches are whole runs, so looking only
# for runs of 32 or more finds the same ones, several times as fast.
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\u[0-9A-Fa-f]{4})+"
                      r"|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_FORM = re.compile(r"\+|(?:%[0-9A-Fa-f]{2})+")
_QUOTED = re.compile(r"\\[\"'\\/bfnrt]")
_LITERAL = re.compile(r"(?:\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[abfnrtv0\\'\"])+")
_PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|x[\x01\x5e\x9c\xda]")
_PACKED_TEXT = re.compile(_PACKED.pattern.decode("latin-1"))
_BYTES = re.compile(r"[\x00-\xff]+")
# No finding, nor an encoding of one, is shorter than token= and eight characters.
_SOME_TEXT = re.compile(rb"[\t\n\r\x20-\x7e]{14}")
_NEXT_LINE = re.compile(r"[ \t]*(?:\r?\n|\r|(?:\\r)?\\n)[ \t]*([A-Za-z0-9+/_-]+={0,2})")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")


def scan(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, by start, then kind as listed."""
    out = []
    for m in PATTERNS["assign"].finditer(text):
        if len(m[2]) >= LEAST["assign"]:
            out.append((m.start(), "assign", m.end()))
    for m in PATTERNS["access"].finditer(text):
        if len(m[0]) >= LEAST["access"]:
            out.append((m.start(), "access", m.end()))
    for m in _LONG_HEX.finditer(text):
        out.append((m.start(), "hex", m.end()))
    return _ordered(out)


def _ordered(spans) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _utf8(data: bytes) -> str | None:
    """Text of the bytes, if they are text: UTF-8 without control characters."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if re.search(r"[\x00-\x08\x0e-\x1f\x7f]", text) else text


class Oversized(Exception):
    pass


def _tool(head: bytes):
    """A decompressor for what begins so, or None."""
    kinds = ((b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"BZh", bz2.BZ2Decompressor),
             (b"\xfd7zXZ\x00", lzma.LZMADecompressor))
    make = next((f for magic, f in kinds if head.startswith(magic)), None)
    if make is None and len(head) > 2 and head[0] & 15 == 8 and (head[0] << 8 | head[1]) % 31 == 0:
        make = zlib.decompressobj
    return make() if make else None


BROKEN = (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError)


def _unpack(data: bytes) -> tuple[bytes, int] | None:
    """One layer of compression taken off, all streams on end, and the bytes they
    took; None if there is none.  Raises where that is more than a chunk."""
    most, out, size, used, view = min(CHUNK, MAX_LAYER), [], 0, 0, memoryview(data)
    while used < len(data) and (tool := _tool(bytes(view[used:used + 6]))):
        try:
            got = tool.decompress(view[used:], most + 1 - size)
        except BROKEN:
            break
        if size + len(got) > most:
            raise Oversized
        if not tool.eof:
            break
        out.append(got)
        size += len(got)
        used = len(data) - len(tool.unused_data)
    return (b"".join(out), used) if used else None


def _chunks(data: bytes, took: list) -> Iterator[bytes]:
    """What the compressed streams at the start of ``data`` unpack to, in chunks that
    overlap; ``took`` gets the bytes of the streams read.  Raises behind MAX_LAYER bytes."""
    size, used, held, view = 0, 0, b"", memoryview(data)
    while used < len(data) and (tool := _tool(bytes(view[used:used + 6]))):
        source = view[used:]
        try:
            while not tool.eof:
                got = tool.decompress(source, CHUNK)
                # zlib hands back what it has not read, the others keep it.
                source = getattr(tool, "unconsumed_tail", b"")
                size += len(got)
                if size > MAX_LAYER:
                    raise Oversized
                held += got
                if len(held) >= CHUNK:
                    yield held
                    held = held[-OVERLAP:]
                if not got and not tool.eof:
                    break
        except BROKEN:
            break
        if not tool.eof:
            break
        used = took[0] = len(data) - len(tool.unused_data)
    if held:
        yield held


def _unpacked(data: bytes) -> bytes:
    """The bytes without any layers of compression."""
    seen = set()
    while data not in seen:
        seen.add(data)
        more = _unpack(data)
        if more is None:
            break
        data = more[0]
    return data


def _texts(data: bytes) -> list[tuple[str, str | None]]:
    """Texts that the bytes hold, and which bytes those are where they are not text as
    a whole: "all", their ASCII characters told apart, zero bytes as those of UTF-16
    read as line ends, or all "but zeros"."""
    text = _utf8(data)
    if text is not None:
        return [(text, None)]
    out = []
    if _SOME_TEXT.search(data):
        out.append((data.replace(b"\0", b"\n").decode("latin-1"), "all"))
    if b"\0" in data and _SOME_TEXT.search(bare := data.replace(b"\0", b"")):
        out.append((bare.decode("latin-1"), "but zeros"))
    return out


def _contents(data: bytes, closed: list, took: list | None = None) -> Iterator[bytes]:
    """The bytes without any layers of compression; those of more than a chunk in parts."""
    seen, took = set(), [0] if took is None else took
    while (mark := sha256(data).digest()) not in seen:
        seen.add(mark)
        try:
            got = _unpack(data)
        except Oversized:
            try:
                for part in _chunks(data, took):
                    yield from _contents(part, closed) if _tool(part[:6]) else (part,)
            except Oversized:
                closed.append(mark)
            return
        if got is None:
            break
        data = got[0]
    yield data


def _streams(data: bytes, at, closed: list) -> Iterator[tuple[str, int, int]]:
    """(text, start, end) of what compressed streams that start there hold; ``closed``
    grows by one for each that is too large."""
    end = 0
    for start in at:
        if start < end:
            continue
        rest, took = memoryview(data)[start:], [0]
        try:
            got = _unpack(rest)
        except Oversized:   # its end is not known before it is read
            stop, parts = len(data), _contents(bytes(rest), closed, took)
        else:
            if got is None:
                continue
            stop, parts, took = start + got[1], _contents(got[0], closed), [got[1]]
        for part in parts:
            for text, _ in _texts(part):
                yield text, start, stop
        end = start + took[0]


def _open(token: str) -> str | None:
    """Text held by a base64 token, through any layers of compression."""
    body = token.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except ValueError:
        return None
    return _utf8(_unpacked(data))


class Layer:
    """A text with, for each character, its start and end in the original.  ``start``
    None: the characters' own places; two numbers: the span of them all."""

    def __init__(self, text: str, start=None, end=None):
        self.text, self.start, self.end = text, start, end
        self.one = isinstance(start, int)

    def key(self) -> bytes:
        """Equal for layers of the same text from the same places."""
        digest = sha256()
        for at in range(0, len(self.text), CHUNK):
            digest.update(self.text[at:at + CHUNK].encode("utf-8", "surrogatepass"))
        if self.one:
            digest.update(f"\0{self.start}:{self.end}".encode())
        elif self.start is not None:
            digest.update(b"\1" + self.start.tobytes() + self.end.tobytes())
        return digest.digest()

    def span(self, i: int, j: int) -> tuple[int, int]:
        """Original span of the characters i to j."""
        if self.start is None:
            return i, j
        if self.one:
            return self.start, self.end
        return int(self.start[i:j].min()), int(self.end[i:j].max())

    def spread(self, text: str, lo: int, hi: int) -> Layer:
        """A layer of a text that the characters lo to hi encode as a whole."""
        return Layer(text, *map(int, self.span(lo, hi)))

    def held(self, token: str, parts: list, closed: list) -> Iterator[Layer]:
        """Layers in the base64 characters that stand in ``parts``, from every alignment."""
        body = token.rstrip("=").replace("-", "+").replace("_", "/")
        at = None if self.one else np.concatenate([np.arange(i, j) for i, j in parts])
        for skip in range(4):
            part = body[skip:]
            part = part[:len(part) - (len(part) % 4 == 1)]
            data = base64.b64decode(part + "=" * (-len(part) % 4))

            def char(i):
                return np.minimum(skip + i // 3 * 4, len(body) - 1)
            starts = sorted({0} | {m.start() for m in _PACKED.finditer(data)})
            for text, i, j in _streams(data, starts, closed):
                if self.one:
                    yield Layer(text, self.start, self.end)
                else:
                    yield self.spread(text, at[char(i)], at[char(j - 1 + 3) - 1] + 1)
            for text, which in _texts(data):
                if which is None:
                    text = data.decode("latin-1")
                if self.one:
                    yield Layer(text, self.start, self.end)
                    continue
                places = (np.flatnonzero(np.frombuffer(data, np.uint8)) if which == "but zeros"
                          else np.arange(len(data)))
                lo, hi = at[char(places)], at[np.minimum(char(places) + 3, len(body) - 1)]
                yield Layer(text, lo if self.start is None else self.start[lo],
                            hi + 1 if self.end is None else self.end[hi])

    def replaced(self, pattern: re.Pattern, decode) -> Layer | None:
        """The layer with every match decoded; None if nothing changed."""
        pieces, starts, ends, at = [], [], [], 0

        def keep(i: int, j: int) -> None:
            pieces.append(self.text[i:j])
            if self.one:
                return
            starts.append(np.arange(i, j) if self.start is None else self.start[i:j])
            ends.append(np.arange(i, j) + 1 if self.start is None else self.end[i:j])

        for m in pattern.finditer(self.text):
            new = decode(m[0])
            if new is None or new == m[0]:
                continue
            keep(at, m.start())
            pieces.append(new)
            if not self.one:
                lo, hi = self.span(m.start(), m.end())
                starts.append(np.full(len(new), lo))
                ends.append(np.full(len(new), hi))
            at = m.end()
        if not at:
            return None
        keep(at, len(self.text))
        if self.one:
            return Layer("".join(pieces), self.start, self.end)
        return Layer("".join(pieces), np.concatenate(starts), np.concatenate(ends))


def _percent(run: str) -> str:
    data = bytes.fromhex(run.replace("%", ""))
    text = _utf8(data)
    return data.decode("latin-1") if text is None else text


def _percent_bytes(run: str) -> str:
    return bytes.fromhex(run.replace("%", "")).decode("latin-1")


def _form(run: str) -> str:
    return " " if run == "+" else _percent(run)


def _quoted(run: str) -> str:
    """One level of the escapes of a string within a string."""
    return {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}.get(run[1], run[1])


def _literal(run: str) -> str:
    """A run of escapes as in a bytes literal: characters below 256."""
    simple = dict(zip("abfnrtv0", "\a\b\f\n\r\t\v\0"))
    return re.sub(r"\\(?:x(..)|u00(..)|(.))", lambda m: chr(int(m[1] or m[2], 16))
                  if m[1] or m[2] else simple.get(m[3], m[3]), run)


def _escape(run: str) -> str:
    codes = [int(x, 16) for x in re.findall(r"(?:\\u\{|\\U|\\u|\\x|&#[xX])([0-9A-Fa-f]+)", run)] \
        or [int(run[2:-1])]
    if run.startswith("\\x"):
        text = _utf8(bytes(codes))
        return bytes(codes).decode("latin-1") if text is None else text
    text = "".join(chr(c) if c <= 0x10ffff else "\ufffd" for c in codes)
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _packed(layer: Layer | None) -> Layer | None:
    """The layer, if compressed bytes may be in it."""
    return layer if layer and _PACKED_TEXT.search(layer.text) else None


def _tokens(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Runs of base64 characters and, joined, those that go on over lines, with the
    places of their parts."""
    end = 0
    for m in _BASE64.finditer(text):
        yield m[0], [m.span()]
        if m.start() < end:
            continue
        parts, end = [m.span()], m.end()
        while text[end - 1] != "=" and (more := _NEXT_LINE.match(text, end)):
            parts.append(more.span(1))
            end = more.end()
            if len(more[1]) < 16:
                break
        if len(parts) > 1:
            yield "".join(text[i:j] for i, j in parts), parts


def _inside(layer: Layer, closed: list) -> Iterator[Layer | None]:
    """The layers that a layer encodes, one level down."""
    text = layer.text
    if "%" in text:
        yield layer.replaced(_PERCENT, _percent)
        yield _packed(layer.replaced(_PERCENT, _percent_bytes))
        if "+" in text and _PERCENT.search(text):
            yield layer.replaced(_FORM, _form)
    if "\\" in text or "&#" in text:
        yield layer.replaced(_UNICODE, _escape)
    if '\\"' in text or "\\'" in text:
        yield layer.replaced(_QUOTED, _quoted)
    if "\\x" in text or "\\u00" in text:
        yield _packed(layer.replaced(_LITERAL, _literal))
    for m in _PACKED_TEXT.finditer(text):
        data = _BYTES.match(text, m.start())[0].encode("latin-1")
        for inner, _, size in _streams(data, [0], closed):
            yield layer.spread(inner, m.start(), m.start() + size)
    for token, parts in _tokens(text):
        try:
            inner = _open(token)
        except Oversized:       # more than a chunk: read in chunks below
            inner = None
        if inner:
            yield layer.spread(inner, parts[0][0], parts[-1][1])
        else:
            yield from layer.held(token, parts, closed)


def findings(text: str | None) -> tuple[list, list, int]:
    """(base spans, all spans, oversized layers) of a text."""
    text = text or ""
    base = scan(text)
    spans, seen, closed = set(base), set(), []
    work = [_inside(Layer(text), closed)]
    while work:
        layer = next(work[-1], work)
        if layer is work:
            work.pop()
        elif layer is not None and (key := layer.key()) not in seen:
            seen.add(key)
            for i, kind, j in scan(layer.text):
                lo, hi = layer.span(i, j)
                spans.add((lo, kind, hi))
            work.append(_inside(layer, closed))
    return base, _ordered(spans), len(closed)


def listed(spans) -> str:
    return ",".join(f"{kind}:{i}:{j}" for i, kind, j in spans)


def scanned(text: Column | str) -> Column:
    """struct(base, spans, oversized): spans listed as kind:start:end."""
    @F.pandas_udf("base string, spans string, oversized long")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [findings(t) for t in texts]
            yield pd.DataFrame({"base": [listed(b) for b, _, _ in rows],
                                "spans": [listed(s) for _, s, _ in rows],
                                "oversized": [n for _, _, n in rows]})
    return each(F.col(text) if isinstance(text, str) else text)


def redact(text: str | None) -> str | None:
    """The text with every finding's span replaced by its kind in brackets;
    overlapping findings are one, named by the first."""
    if not text:
        return text
    out, at, end = [], 0, -1
    for i, kind, j in findings(text)[1]:
        if i >= end:
            out += [text[at:i], f"[{kind}]"]
            at = end = j
        else:
            at = end = max(end, j)
    return "".join(out) + text[at:] if out else text


def redacted(text: Column | str) -> Column:
    """struct(text, n_chars): the text without its secrets, and its code points."""
    @F.pandas_udf("text string, n_chars long")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = [redact(t) for t in texts]
            yield pd.DataFrame({"text": pd.Series(out, dtype=object), "n_chars": pd.array(
                [None if t is None else len(t) for t in out], dtype="Int64")})
    return each(F.col(text) if isinstance(text, str) else text)
