from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import lzma
import re
import time
import tracemalloc
import urllib.parse
import zlib

import pytest
import zstandard

from ledgerloom.llm import secrets

SECRET = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'


def b64(value):
    return base64.b64encode(value if isinstance(value, bytes) else value.encode()).decode()


WRAPPED = {
    "base64": b64(SECRET),
    "base64 twice": b64(b64(SECRET)),
    "gzip": b64(gzip.compress(SECRET.encode())),
    "zlib": b64(zlib.compress(SECRET.encode())),
    "bz2": b64(bz2.compress(SECRET.encode())),
    "xz": b64(lzma.compress(SECRET.encode())),
    "zstd around zlib": b64(zstandard.compress(b64(zlib.compress(SECRET.encode())).encode())),
    "url": urllib.parse.quote(SECRET),
    "url twice": urllib.parse.quote(urllib.parse.quote(SECRET)),
    "form": urllib.parse.quote_plus(SECRET),
    "unicode": "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "braces": "".join(f"\\u{{{ord(c):x}}}" for c in SECRET),
    "bytes": "".join(f"\\x{ord(c):02x}" for c in SECRET),
    "html": "".join(f"&#{ord(c)};" for c in SECRET),
    "unicode in base64": b64("".join(f"\\u{ord(c):04x}" for c in SECRET)),
    "base64 in url": urllib.parse.quote(b64("é" + SECRET + "ü")),
    "gzip in url": "".join(f"%{c:02X}" for c in gzip.compress(SECRET.encode())),
}


@pytest.mark.parametrize("name", WRAPPED)
def test_wrapped_secret_is_found_where_it_stands(name):
    before, after = "Hé 😀 ", " end"
    base, found, refused = secrets.scan(before + WRAPPED[name] + after)
    inside = range(len(before), len(before) + len(WRAPPED[name]) + 1)
    kinds = {kind for start, kind, end in found if start in inside and end in inside}
    assert {0, 2} <= kinds and refused == 0
    assert all(start in inside and end in inside for start, _, end in found)


def test_spans_of_a_layer_are_exact():
    text = "see " + urllib.parse.quote("x=é;" + SECRET) + "."
    start = text.index("token")
    assert (start, 0, len(text) - len("%22.")) in secrets.scan(text)[1]


def brute(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


@pytest.mark.parametrize(
    "text",
    [
        SECRET,
        "token=secret=abcdefghijklmnop",
        "token=password:abcdefghijklmnop",
        "API_KEY: 'abcdefghijkl' apikey=abcdefghijk tokeN = abcdefghijk",
        "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop",
        "AKIAAKIA1234567890 AKIA123 xAKIA12345678901234Z",
        "0123456789abcdef0123 0123456789abcdeF0123456789abcdef",
        "",
    ],
)
def test_base_matches(text):
    assert secrets.base_spans(text) == brute(text)


def test_base_matches_stay():
    text = f"{SECRET} {WRAPPED['url twice']} secret=abc%41bcdefghijklmnop"
    base, found, _ = secrets.scan(text)
    assert base == brute(text) and set(base) <= set(found)


def test_a_file_that_holds_itself_ends():
    text = WRAPPED["gzip"] + " " + WRAPPED["gzip"]
    assert len({start for start, _, _ in secrets.scan(text)[1]}) == 2


def test_too_large_layer_is_counted(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_UNPACKED", 1000)
    assert secrets.scan(b64(zlib.compress(b"a" * 5000)))[2] > 0


def test_documents(make_docs, clashing):
    rows = [(1, f"a {SECRET} b {WRAPPED['base64']}"), (2, None), (3, ""), (None, SECRET), (4, "plain " * 30_000), (1, "plain")]
    found = secrets.digests(secrets.scan_documents(clashing(make_docs(rows), "base", "spans", "n_refused"))).collect()
    assert sorted((r.doc_id or -1, r.n_assign, r.n_access, r.n_hex) for r in found) == [(-1, 1, 0, 1), (1, 0, 0, 0), (1, 1, 0, 1), (2, 0, 0, 0), (3, 0, 0, 0), (4, 0, 0, 0)]
    one = next(r for r in found if r.doc_id == 1 and r.n_assign)
    spelled = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in brute(rows[0][1]))
    assert one.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
    assert one.spans.startswith(spelled + ",assign:") and one.spans.count(":") == 8
    assert {r.spans for r in found if not r.n_assign} == {""}


def test_masking(make_docs):
    rows = [(1, f"a {SECRET}! {WRAPPED['base64']}."), (2, None), (3, "clean")]
    masked = {r.doc_id: r for r in secrets.mask_documents(make_docs(rows)).collect()}
    assert masked[1].text == 'a [secret]"! [secret]' + WRAPPED["base64"][-2:] + "."
    assert masked[2].text is None and masked[3].text == "clean" and masked[3].lang == "en"


@pytest.mark.parametrize("level", [1, 6, 9])
@pytest.mark.parametrize("bits", [9, 12, 15])
def test_zlib_is_found_at_any_place(level, bits):
    tool = zlib.compressobj(level, zlib.DEFLATED, bits)
    packed = tool.compress(SECRET.encode()) + tool.flush()
    safe = base64.urlsafe_b64encode(packed).decode().rstrip("=")
    for text in (safe, "x/" + safe, "svg/" + safe, "https://k.example/mermaid/svg/" + safe, b64(b"\x00\x01head\xff" + packed), "".join(f"%{c:02X}" for c in b"\xfeab" + packed)):
        assert {0, 2} <= {kind for _, kind, _ in secrets.scan(text)[1]}, text


def nested(pack, times):
    packed = SECRET.encode()
    for _ in range(times):
        packed = pack(packed)
    return packed


@pytest.mark.parametrize("pack", [lambda x: gzip.compress(x, 9), lambda x: zlib.compress(x, 0), lambda x: gzip.compress(x, 0)])
def test_a_thousand_layers_end_soon(pack):
    for packed in (nested(pack, 26), nested(pack, 300 if len(pack(b"")) > 15 else 1000)):
        text = "x " + b64(packed) + " y"
        started = time.perf_counter()
        assert {0, 2} <= {kind for _, kind, _ in secrets.scan(text)[1]}
        assert time.perf_counter() - started < 5


def test_contents_that_come_back_are_taken_once(monkeypatch):
    """Whatever is unpacked, the same bytes come out: the worklist ends."""
    calls = []
    again = gzip.compress(b"secret=abcdefghijklmnop", 0)

    def same(raw):
        calls.append(len(raw))
        return again, 0

    monkeypatch.setattr(secrets, "_unpack", same)
    assert secrets.scan("x " + b64(again))[1] and len(calls) < 20


def test_large_packed_layers_take_little_memory():
    """8 MB of readable text in 11 KB: memory in proportion to the text, not to places of each byte."""
    text = "é " + b64(zlib.compress(b"all is well " * 700_000 + SECRET.encode(), 9))
    tracemalloc.start()
    found = secrets.scan(text)[1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {0, 2} <= {kind for _, kind, _ in found} and peak < 200 << 20


def test_layers_within_packed_layers_stand_for_all_of_it():
    for inner in (b64(SECRET), WRAPPED["url twice"], WRAPPED["unicode"], WRAPPED["html"], f"a {WRAPPED['bytes']} b {WRAPPED['gzip in url']}"):
        text = "see " + b64(gzip.compress(f"head {inner} tail".encode())) + "."
        spans = {(a, b) for a, _, b in secrets.scan(text)[1]}
        assert spans and all(a == 4 and len(text) - 4 <= b <= len(text) - 1 for a, b in spans), inner
