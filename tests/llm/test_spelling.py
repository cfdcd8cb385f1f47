from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerloom.llm import spelling


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced letter, by trying them all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    out = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best and n[best] >= 10 * n[w] else None
        out[w] = [w, form, w, n[w], len(near), n[form] if form else None]
    for row in out.values():
        while out[row[2]][1]:
            row[2] = out[row[2]][1]
    return sorted(map(tuple, out.values()))


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def noisy_words(seed, size, alphabet="abcé"):
    """Words and words within two edits of them."""
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        word = "".join(rng.choices(alphabet, k=rng.randint(6, 10)))
        words.add(word)
        for _ in range(rng.randint(0, 4)):
            i, what = rng.randrange(len(word)), rng.randrange(3)
            word = word[:i] + rng.choice(["", rng.choice(alphabet), rng.choice(alphabet) + word[i]][what : what + 1]) + word[i + 1 :]
            words.add(word)
    return sorted(words)


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_each_kind_of_edit_and_nothing_else(seed):
    words = noisy_words(seed, 150, "ab" if seed % 2 else "abcé")
    index = spelling.PositionIndex(words)
    for word in [*words, "", "a", "zzzzzzz", "ab" * 20]:
        kinds = [sorted(words[i] for i in index.members(bits)) for bits in index.near(word)]
        assert kinds == [sorted(w for w in words if one_edit(word, w) and len(w) == len(word) + d) for d in (0, 1, -1)]
        far = [words[i] for bits in index.near(word, 3) for i in index.members(bits)]
        assert sorted(far) == sorted(w for w in words if one_edit(word, w) and w[:3] != word[:3])


def test_empty_index():
    assert spelling.PositionIndex([]).near("abc") == (0, 0, 0)


@pytest.mark.parametrize("chunk", [1 << 14, 8])
def test_neighbours(spark, monkeypatch, chunk):
    """Blocks split into many indexes give the same as whole ones."""
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    monkeypatch.setattr(spelling, "HELD", 5)
    rng = random.Random(1)
    n = {w: rng.randint(2, 40) for w in noisy_words(7, 250, "ab") if len(w) >= 7}
    rows = spelling.neighbours(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)).collect()
    expected = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        if near:
            best = min(near, key=lambda v: (-n[v], v))
            expected[w] = (len(near), best, n[best])
    assert {r["word"]: (r["n_near"], r["near"], r["near_n"]) for r in rows} == expected and len(rows) == len(expected)


def test_roots_of_long_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w4"), ("y", "z")]
    ends = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert ends == {**{f"w{i}": "w9" for i in range(9)}, "x": "w9", "y": "z"}


def test_edge_rows(spark, make_docs, clashing):
    """Nulls, ties, repeated rows, one-word and letterless texts, letters beyond ASCII, a chain of forms, a very long text."""
    chain = "letterbox " * 400 + "leterbox " * 40 + "leterbo " * 4 + "Leterbos leterbos "
    rows = [
        (1, chain), (2, None), (3, ""), (4, "12 34 short"), (None, "garden-party gardens gardens"), (None, "gardens"),
        (5, "ÉCOLIERS Écoliers écoliers ecoliers ecoliers"), (5, "ÉCOLIERS Écoliers écoliers ecoliers ecoliers"),
        (6, "weather×÷ weather×÷ weather weather"), (7, "tiedword " * 40 + "tiedworm " * 40 + "tiedworn " * 3), (8, "abcdefgh " * 30000 + "abcdefg " * 2),
    ]
    docs = clashing(make_docs(rows), "word", "n", "half", "chunk", "index")
    assert found(spelling.variants(docs)) == brute(rows)
    assert spelling.variants(make_docs([])).collect() == [] and spelling.variants(make_docs([(1, None)])).collect() == []


def test_hot_rows(spark, make_docs):
    """One id for all rows, and a third of the words in one block."""
    rng = random.Random(3)
    rows = [(1, " ".join(f"common{rng.choice('abcdef')}{rng.choice('abc')}{rng.choice('xy')}" for _ in range(30))) for _ in range(200)]
    assert found(spelling.variants(make_docs(rows))) == brute(rows)


def test_documents(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(60).collect()]
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
