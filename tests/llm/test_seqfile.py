from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import seqfile

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_words_give_what_whole_texts_give(library):
    random.seed(3)
    letters = "aAbéß'st \n\t\x1c\x85\xa0 İ漢😀\x01́.,!1ϷΣσ*"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 25))) for _ in range(4000)]
    texts += ["a <|endoftext|>b", "x<|startoftext|>", "<|ENDOFTEXT|>", "it's WE'LL they'd", "word,,, (a), b!!) 12.5 3rd."]
    found = seqfile.WordCache(PATH).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(seqfile, "CACHE_WORDS", 3)
    cache = seqfile.WordCache(PATH)
    for text in ["alpha beta", "gamma delta.", "alpha. eps zeta", "beta gamma, delta", "eps alpha"] * 2:
        assert next(cache.encode([text])).tolist() == library.encode(text, add_special_tokens=False).ids


ROWS = [(5, "five words are in here"), (1, "Hello, world!"), (None, "no id"), (2, None), (3, ""), (4, "many words " * 3000), (1, "Hello, world!"), (1, "Another text")]


def expected(library):
    at, out = 0, []
    for doc_id, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("how", [{}, {"length": 8, "sequences": 2}, {"words_apart": False, "length": 16}])
def test_round_trip(library, make_docs, clashing, tmp_path, how):
    docs = clashing(make_docs(ROWS), "start", "n_tokens", "ids")
    found = seqfile.packed_documents(docs, PATH, folder=str(tmp_path / "out"), **how)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected(library)


def test_random_access(library, make_docs, tmp_path):
    files = seqfile.write_sequences(make_docs(ROWS), PATH, str(tmp_path), length=8, sequences=2)
    ids = []
    for name, _, n in files:
        opened = seqfile.SequenceFile(f"{tmp_path}/{name}.arrows")
        own = []
        for i in random.sample(range(len(opened)), len(opened)):
            sequence, mask = opened[i]
            assert len(sequence) == len(mask) == 8
            own.append((i, sequence[np.array(mask.to_pylist())].tolist()))
        own = [x for _, part in sorted(own) for x in part]
        assert len(own) == n
        ids += own
        sizes = {batch.num_rows for batch in opened.batches[:-1]}
        assert sizes <= {2} and opened.batches[0].schema.field("ids").type == pa.list_(pa.uint16(), 8)
    assert ids == [x for doc_id, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")) for x in [*library.encode(text or "", add_special_tokens=False).ids, 1]]


def test_written_again_gives_the_same_files(make_docs, tmp_path):
    first = seqfile.write_sequences(make_docs(ROWS), PATH, str(tmp_path))
    before = {p.name: p.read_bytes() for p in tmp_path.iterdir()}
    assert seqfile.write_sequences(make_docs(ROWS), PATH, str(tmp_path)) == first
    assert {p.name: p.read_bytes() for p in tmp_path.iterdir()} == before


def test_empty_table(make_docs, tmp_path):
    assert seqfile.packed_documents(make_docs(ROWS).limit(0), PATH, folder=str(tmp_path)).collect() == []


def test_capitals_with_combining_marks(library):
    random.seed(4)
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts = [letter + mark for letter in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for mark in marks]
    texts += ["T\u0308om", "J\u030ca", "H\u0331 W\u030aY\u030a.", "THE \u00c9T\u0308 AND", "T\u0323\u0308X, T\u0308"]
    texts += ["".join(random.choice(["T", "J", "a", "B", " ", ".", "\u00c9", "\u6f22", *random.sample(marks, 4)]) for _ in range(20)) for _ in range(2000)]
    for text, ids in zip(texts, seqfile.WordCache(PATH).encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_a_hot_id_and_a_hot_row_are_split(library, spark, make_docs, tmp_path):
    rows = [(None, f"row {i % 50} of none") for i in range(1000)] + [(7, "the same row")] * 1000 + [(i + 10, f"row {i}") for i in range(1000)]
    files = seqfile.write_sequences(make_docs(rows), PATH, str(tmp_path))
    assert sum(n for _, n, _ in files) == 3000 and max(n for _, n, _ in files) < 900
    found = sorted(map(tuple, seqfile.packed_documents(make_docs(rows), PATH, folder=str(tmp_path / "again")).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [None] * 1000 + [7] * 1000 + list(range(10, 1010))
    at = 0
    for _, start, n, _ in found:
        assert start == at
        at += n
    assert {r[2:] for r in found if r[0] == 7} == {(len(ids := [*library.encode("the same row").ids, 1]), zlib.crc32(np.array(ids, "<u4").tobytes()))}
