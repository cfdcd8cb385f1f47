"""Secret scan with recursive decoding (operator 1).

A document is the first layer of a worklist. Each layer is scanned with the base patterns, then unwrapped in every
way that applies: URL escapes, Unicode and HTML escapes, base64 runs, and compressed bytes inside any of these. What
comes out is a layer again, until nothing unwraps any more. Each code point of a layer knows the span of the document
it came from, so a finding at any depth maps back to the document; what compressed bytes hold stands for one span as a
whole. A layer whose content was already seen at the same place is not taken again, which ends cycles such as a
compressed file that holds itself, and headers within a stream that was read to its end are not tried.

Rows stay where they are: one pass, no shuffle, memory in proportion to one text.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, map_batches, map_whole_rows, texts_of

KINDS = ("assign", "access", "hex")

# The base patterns. Letters are ASCII letters in either case only where the first pattern says so.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")  # a run of fewer fails, and a run has one match
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18

#: No secret fits into fewer decoded bytes than 16, so shorter base64 runs hold none.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:\r?\n[A-Za-z0-9+/_-]+)*")
_READABLE = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){12,}+")
_URL = re.compile("(?:%[0-9A-Fa-f]{2})+")
_PLUS = re.compile(r"%[0-9A-Fa-f]{2}\+|\+%[0-9A-Fa-f]{2}")
_BYTES = re.compile(r"(?:\\x[0-9A-Fa-f]{2})+")
_POINTS = re.compile(
    r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|%u[0-9A-Fa-f]{4}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&(?:quot|apos|amp|lt|gt);)"
)
_NAMED = {"&quot;": 34, "&apos;": 39, "&amp;": 38, "&lt;": 60, "&gt;": 62}
#: Both bytes of a zlib header make a multiple of 31; one with the bit for a dictionary cannot be read without it.
_ZLIB = b"|".join(
    re.escape(bytes([cmf])) + b"(?=[" + b"".join(re.escape(bytes([flg])) for flg in range(256) if (cmf * 256 + flg) % 31 == 0 and not flg & 0x20) + b"])"
    for cmf in range(0x08, 0x80, 0x10)
)
_PACKED = re.compile(rb"\x1f\x8b\x08|\x28\xb5\x2f\xfd|BZh[1-9]1AY&SY|\xfd7zXZ\x00|" + _ZLIB)

#: Bytes that one compressed layer may unpack to; a larger one is left alone and counted in n_refused.
MAX_UNPACKED = 64 << 20


class Layer(NamedTuple):
    """A text and, for each code point, the span of the document it stands for (None: itself; a number: one span for all)."""

    text: str
    starts: np.ndarray | int | None
    ends: np.ndarray | int | None
    path: str


class Packed(NamedTuple):
    """What compressed bytes held, and the one span of the document that all of it stands for."""

    content: bytes
    start: int
    end: int
    path: str


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches, sorted. ``kind`` counts in KINDS."""
    found = [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    lower = text.lower()  # may change lengths, never the ASCII letters
    if any(word in lower for word in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found.sort()
    return found


def _origin(layer: Layer, start: int, end: int) -> tuple[int, int]:
    if layer.starts is None:
        return start, end
    if isinstance(layer.starts, int):
        return layer.starts, layer.ends
    return int(layer.starts[start]), int(layer.ends[end - 1])


Places = np.ndarray | int


def _origins(layer: Layer, starts: np.ndarray, ends: np.ndarray) -> tuple[Places, Places]:
    """Spans of the document for spans of the layer, or the one span of all of it."""
    if layer.starts is None:
        return starts, ends
    if isinstance(layer.starts, int):
        return layer.starts, layer.ends
    return layer.starts[starts], layer.ends[ends - 1]


def _unpack(raw: memoryview) -> tuple[bytes | None, int]:
    """The content of compressed bytes as far as it can be read (None if more than MAX_UNPACKED), and the bytes it took if all was read."""
    try:
        if raw[:4] == b"\x28\xb5\x2f\xfd":
            out, tool = zstandard.ZstdDecompressor().stream_reader(raw).read(MAX_UNPACKED + 1), None
        else:
            tool = bz2.BZ2Decompressor() if raw[:3] == b"BZh" else lzma.LZMADecompressor() if raw[:2] == b"\xfd7" else zlib.decompressobj(47)
            out = tool.decompress(raw, MAX_UNPACKED + 1)
    except (zlib.error, zstandard.ZstdError, lzma.LZMAError, OSError, EOFError, ValueError):
        return b"", 0
    taken = len(raw) - len(tool.unused_data) if tool is not None and tool.eof else 0
    return (None if len(out) > MAX_UNPACKED else out), taken


def _from_bytes(raw: bytes, starts: Places, ends: Places, path: str) -> Iterator[Layer | Packed | None]:
    """Readable stretches of decoded bytes, and what compressed stretches hold; None for one that is too large."""
    one = isinstance(starts, int)
    for m in _READABLE.finditer(raw):
        text = m[0].decode("utf-8", "replace")
        if one:
            yield Layer(text, starts, ends, path)
            continue
        at = m.start() + (np.arange(len(text)) if len(text) == len(m[0]) else _char_offsets(text, len(m[0])))
        last = np.append(at[1:], m.end()) - 1
        yield Layer(text, starts[at], ends[np.minimum(last, len(ends) - 1)], path)
    whole, done = memoryview(raw), 0
    for m in _PACKED.finditer(raw):
        start = m.start()
        if start < done:
            continue  # part of a stream that was read to its end
        content, taken = _unpack(whole[start:])
        done = start + taken
        if content is None:
            yield None
        elif content:
            # No byte of it stands for a part of the packed bytes, so each stands for all of them.
            yield Packed(content, *((starts, ends) if one else (int(starts[start]), int(ends[-1]))), f"{path}>packed")


def _char_offsets(text: str, size: int) -> np.ndarray:
    """Byte offset of each code point; spread evenly where the bytes were not valid UTF-8."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    offsets = np.cumsum(widths) - widths
    return offsets if offsets[-1] + widths[-1] == size else np.arange(len(text)) * size // len(text)


def _base64(layer: Layer) -> Iterator[Layer | Packed | None]:
    for m in _BASE64.finditer(layer.text):
        chunks = [(m.start(), m[0])]
        if "\n" in m[0]:  # wrapped lines, or lines of their own
            at = m.start()
            for line in m[0].split("\n"):
                chunks.append((at, line.rstrip("\r")))
                at += len(line) + 1
        for at, chunk in chunks:
            one = isinstance(layer.starts, int)
            places = None if one else np.array([i for i, c in enumerate(chunk) if c not in "\r\n"], dtype=np.int64) + at
            letters = chunk.replace("\r", "").replace("\n", "").replace("-", "+").replace("_", "/")
            if len(letters) < 20:
                continue
            for shift in range(4):
                body = letters[shift:]
                body = body[: len(body) - (len(body) % 4 == 1)]
                raw = binascii.a2b_base64(body + "=" * (-len(body) % 4))
                if not (_READABLE.search(raw) or _PACKED.search(raw)):
                    continue
                if one:
                    yield from _from_bytes(raw, layer.starts, layer.ends, f"{layer.path}>base64")
                    continue
                k = np.arange(len(raw))
                first = shift + k // 3 * 4 + k % 3
                starts, ends = _origins(layer, places[first], places[first + 1] + 1)
                yield from _from_bytes(raw, starts, ends, f"{layer.path}>base64")


def _replaced(layer: Layer, parts: list[tuple[int, int, str, np.ndarray, np.ndarray]], path: str) -> Layer:
    """The layer with stretches exchanged. parts: start, end, new text, and its spans of this layer."""
    if isinstance(layer.starts, int):
        edges = [0, *(edge for part in parts for edge in part[:2]), len(layer.text)]
        same = [layer.text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
        return Layer("".join(x for pair in zip(same, [*(part[2] for part in parts), ""], strict=True) for x in pair), layer.starts, layer.ends, path)
    texts, starts, ends, at = [], [], [], 0
    for start, end, text, new_starts, new_ends in [*parts, (len(layer.text), len(layer.text), "", np.arange(0), np.arange(0))]:
        same = np.arange(at, start)
        texts += [layer.text[at:start], text]
        starts += [same, new_starts]
        ends += [same + 1, new_ends]
        at = end
    a, b = np.concatenate(starts), np.concatenate(ends)
    text = "".join(texts)
    return Layer(text, *(_origins(layer, a, b) if len(a) else (a, b)), path)


def _byte_escapes(layer: Layer, pattern: re.Pattern, width: int, name: str) -> Iterator[Layer | Packed | None]:
    """Runs of escaped bytes, ``width`` characters each."""
    path, parts = f"{layer.path}>{name}", []
    for m in pattern.finditer(layer.text):
        raw = binascii.unhexlify("".join(m[0][i + width - 2 : i + width] for i in range(0, len(m[0]), width)))
        text = raw.decode("utf-8", "replace")
        at = _char_offsets(text, len(raw))
        starts = m.start() + at * width
        parts.append((m.start(), m.end(), text, starts, np.append(starts[1:], m.end())))
        if _PACKED.search(raw):
            k = m.start() + np.arange(len(raw)) * width
            yield from _from_bytes(raw, *_origins(layer, k, k + width), path)
    if parts:
        yield _replaced(layer, parts, path)


def _url(layer: Layer) -> Iterator[Layer | Packed | None]:
    if "%" not in layer.text:
        return
    yield from _byte_escapes(layer, _URL, 3, "url")
    if _PLUS.search(layer.text):  # form encoding
        yield from _byte_escapes(layer._replace(text=layer.text.replace("+", " ")), _URL, 3, "url")


def _point(escape: str) -> int:
    if escape in _NAMED:
        return _NAMED[escape]
    if escape[1] == "#":
        return int(escape[3:-1], 16) if escape[2] in "xX" else int(escape[2:-1])
    return int(escape[2:].strip("{}"), 16)


def _unicode(layer: Layer) -> Iterator[Layer | Packed | None]:
    if "\\x" in layer.text:
        yield from _byte_escapes(layer, _BYTES, 4, "unicode")
    if "\\" not in layer.text and "&" not in layer.text and "%u" not in layer.text:
        return
    parts: list[tuple] = []
    for m in _POINTS.finditer(layer.text):
        point, start = _point(m[0]), m.start()
        if parts and parts[-1][1] == start and "\ud800" <= parts[-1][2] <= "\udbff" and 0xDC00 <= point < 0xE000:
            start, _, high, *_ = parts.pop()  # the second half of a pair
            point = 0x10000 + ((ord(high) - 0xD800) << 10) + point - 0xDC00
        parts.append((start, m.end(), chr(point) if point < 0x110000 else "�", np.array([start]), np.array([m.end()])))
    if parts:
        layer_out = _replaced(layer, parts, f"{layer.path}>unicode")
        yield layer_out._replace(text=re.sub("[\ud800-\udfff]", "�", layer_out.text))


def scan(text: str) -> tuple[list[tuple[int, int, int]], dict[tuple[int, int, int], str], int]:
    """Base spans; all spans with the layers that led to each, by (start, kind, end); layers that were too large."""
    base = base_spans(text)
    found = dict.fromkeys(base, "")
    refused, seen, work = 0, set(), [Layer(text, None, None, "")]
    while work:
        layer = work.pop()
        if isinstance(layer, Packed):
            inners = _from_bytes(*layer)
        else:
            inners = (inner for unwrap in (_url, _unicode, _base64) for inner in unwrap(layer))
        for inner in inners:
            if inner is None:
                refused += 1
                continue
            if isinstance(inner, Packed):
                # Of equal contents that end at one place the first, of the widest span, is enough.
                key = hashlib.blake2b(inner.content, digest_size=16).digest(), inner.end
            elif inner.text:
                a, b = _origin(inner, 0, len(inner.text))
                key = hashlib.blake2b(inner.text.encode(), digest_size=16).digest(), a, b
            else:
                continue
            if key in seen:
                continue
            seen.add(key)
            work.append(inner)
            if isinstance(inner, Layer):
                for start, kind, end in base_spans(inner.text):
                    a, b = _origin(inner, start, end)
                    found.setdefault((a, kind, b), inner.path[1:])
    return base, found, refused


_SPANS = "array<struct<kind:string,start:long,end:long,layers:string>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layers", pa.string())]))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans, n_refused): the base matches and all matches of each document, sorted by start and kind.

    Spans are in code points of the document, end exclusive; ``layers`` names the encodings that hid a finding. A null
    text counts as empty and has none. Repeated rows and null doc_ids are kept; other columns are not read. An empty
    table gives no rows.
    """

    def work(batches: Batches) -> Batches:
        for batch in batches:
            base, spans, refused = [], [], []
            for text in batch.column("text").to_pylist():
                own, found, n = scan(text)
                base.append([{"kind": KINDS[k], "start": a, "end": b, "layers": ""} for a, k, b in own])
                spans.append([{"kind": KINDS[k], "start": a, "end": b, "layers": found[a, k, b]} for a, k, b in sorted(found)])
                refused.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, _SPAN_TYPE), pa.array(spans, _SPAN_TYPE), pa.array(refused, pa.int64())],
                ["doc_id", "base", "spans", "n_refused"],
            )

    return map_batches(texts_of(docs, id_col, text_col), work, f"doc_id long, base {_SPANS}, spans {_SPANS}, n_refused long")


def _spelled(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts of the base matches, their digest, and all spans spelled out."""
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) AS long)").alias(f"n_{kind}") for kind in KINDS]
    return scanned.select("doc_id", *counts, F.sha2(_spelled("base"), 256).alias("base_sha256"), _spelled("spans").alias("spans"), "n_refused")


def mask(text: str, found: dict[tuple[int, int, int], str], label: str) -> str:
    """The text with each maximal covered stretch replaced by ``label``."""
    out, at = [], 0
    for start, _, end in sorted(found):
        if start >= at:
            out += [text[at:start], label]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame, text_col: str = "text", label: str = "[secret]") -> DataFrame:
    """The same rows and columns with every found span of ``text_col`` masked; a null text stays null."""
    def work(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
        texts = [None if text is None else mask(text, scan(text)[1], label) for text in batch.column(at).to_pylist()]
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return map_whole_rows(docs, work, text_col)
