from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def ids_of(text):
    return np.frombuffer(bpe.encode_text(text, PATH, public_tokenizers.PATTERN), "<u4").tolist()


def test_random_texts_as_the_library(reference):
    random.seed(1)
    letters = "aaab'sllt  \n\t1é漢😀\x1c\x85​\xa0.!<|endoftext|>"
    for _ in range(3000):
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 30)))
        assert ids_of(text) == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, " " * 5000 + "x", "é" * 999, "the" * 1500])
def test_ties_and_long_pieces(reference, text):
    assert ids_of(text) == reference.encode_ordinary(text)


def test_very_long_piece(reference):
    random.seed(2)
    text = "".join(random.choice("abcdeth") for _ in range(50_000))
    assert ids_of(text) == reference.encode_ordinary(text)


def test_a_full_cache_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    cache = bpe.PieceCache(bpe.Encoder(bpe.load_ranks(PATH)))
    words = [" alpha", " beta", "gamma", " delta", " eps", "zeta", " eta", " alpha", "gamma", " theta"] * 3
    assert [np.frombuffer(cache[w], "<u4").tolist() for w in words] == [reference.encode_ordinary(w) for w in words]


def test_documents(reference, make_docs, clashing):
    rows = [(1, "Hello  world's 12"), (2, None), (3, ""), (None, "x\ny"), (4, "same"), (4, "same"), (5, "Zoë " * 20_000)]
    docs = clashing(make_docs(rows), "ids", "decoded", "n_tokens")
    found = bpe.digests(bpe.decode_documents(bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN), PATH)).collect()
    expected = []
    for doc_id, text in rows:
        ids = reference.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_empty_table(make_docs):
    encoded = bpe.encode_documents(make_docs([(1, "x")]).limit(0), PATH, public_tokenizers.PATTERN)
    assert bpe.digests(bpe.decode_documents(encoded, PATH)).collect() == []
