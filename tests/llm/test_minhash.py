from __future__ import annotations

import random
import re

import numpy as np
import pytest

from ledgerloom.llm import minhash


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    """Rows of near_duplicates by comparing all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {i: min((d for d in g if d is not None), default=None) for i, g in groups.items()}
    out = [(d, len(sets[i]), least[find(i)] if sets[i] else d, False) for i, (d, _) in enumerate(rows)]
    return sorted(((d, n, c, d is not None and d == c) for d, n, c, _ in out), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a B", "A b\x0bC", "a b c d a b c", "Ä É ä é\xa0n 漢 字", "x y " * 300])
def test_shingles(text):
    n, hashes = minhash.shingles(text)
    assert n == len(shingle_set(text)) == len(hashes) and (np.diff(hashes.astype(object)) > 0).all()


def naive_sketch(hashes):
    """The definition, one shingle and round at a time."""
    out = {}
    for i in range(2 * minhash.T):
        for h in hashes:
            z = int(minhash._mixed(np.array([(int(h) + (i + 1) * int(minhash._GOLDEN)) % 2**64], dtype=np.uint64))[0])
            place = z >> 56 if i < minhash.T else i - minhash.T
            value = i << 54 | z & (1 << 54) - 1
            out[place] = min(out.get(place, value), value)
        if len(out) == minhash.T:
            break
    return [out[i] for i in range(minhash.T)]


@pytest.mark.parametrize("n", [1, 2, 7, 40, 700])
def test_sketch(n):
    hashes = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    assert minhash.sketch(hashes).tolist() == naive_sketch(hashes)
    assert minhash.sketch(hashes[::-1].copy()).tolist() == minhash.sketch(hashes).tolist()


@pytest.mark.parametrize("n", [3, 30, 1000])
def test_agreeing_coordinates_are_concentrated_around_the_similarity(n):
    rng, off = np.random.default_rng(n), []
    for _ in range(60):
        both = rng.integers(0, 1 << 63, n + n // 3, dtype=np.uint64)
        a, b = both[:n], both[n // 3 :]
        off.append((minhash.sketch(a) == minhash.sketch(b)).mean() - len(np.intersect1d(a, b)) / len(both))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 1.2 * 0.5 / minhash.T**0.5


def near_copies(seed, groups=12, words=90):
    """Originals and copies with a few words changed, so that similarities lie on both sides of the threshold."""
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        text = [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randint(4, words))]
        rows.append(" ".join(text))
        for _ in range(rng.randint(0, 6)):
            other = list(text)
            for _ in range(rng.randint(0, 5)):
                other[rng.randrange(len(other))] = str(rng.random())
            rows.append(" ".join(other))
            text = rng.choice([text, other])
    ids = rng.sample(range(10 * len(rows)), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("seed", range(2))
def test_near_copies(make_docs, seed):
    rows = near_copies(seed)
    assert found(minhash.near_duplicates(make_docs(rows))) == brute(rows)


def test_variants_of_one_text_that_are_close_to_it_alone(make_docs, monkeypatch):
    """A crowded bucket: all are linked through the original and to nothing else; blocks of a few classes."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    base = [f"w{i}" for i in range(50)]
    rows = [(1000, " ".join(base))]
    rows += [(i, " ".join([*base[: 3 + i % 44], f"x{i}", *base[4 + i % 44 :]])) for i in range(130)]
    rows += [(2000 + i, " ".join([*base[:38], *(f"{i}y{j}" for j in range(12))])) for i in range(40)]  # candidates, but too far
    assert found(minhash.near_duplicates(make_docs(rows))) == brute(rows)


@pytest.mark.parametrize(("seed", "mixed"), [(s, m) for s in range(4) for m in (False, True)])
def test_spanning_links(seed, mixed):
    """Links join what is linked, no more and no fewer, given what is joined already."""
    rng = np.random.default_rng(seed)
    core = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(core)[: rng.integers(30, 41)], rng.integers(0, 1 << 63, rng.integers(0, 5), dtype=np.uint64)])) for _ in range(50)]
    labels = rng.integers(0, 45, len(sets))
    first = rng.random(len(sets)) < 0.5 if mixed else np.ones(len(sets), dtype=bool)

    def joined(links):
        names = labels.copy()
        for i, j in links:
            names[names == names[i]] = names[j]
        return {frozenset(np.flatnonzero(names == n).tolist()) for n in names}

    def linked(i, j):
        shared = len(np.intersect1d(sets[i], sets[j]))
        return 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared) and (not mixed or first[i] != first[j])

    every = [(i, j) for i in range(len(sets)) for j in range(i) if linked(i, j)]
    links = minhash.spanning_links(sets, np.array([len(s) for s in sets]), labels, first, 85)
    assert joined(links) == joined(every) and len(links) == len(joined([])) - len(joined(every)) and every


def test_edge_rows(make_docs, clashing):
    """Nulls, empty, short and repeated texts, repeated and missing ids, a very long text, rows at the threshold."""
    long = " ".join(str(i * 7919 % 9973) for i in range(60000))
    at = [f"t{i}" for i in range(102)]  # 100 shingles; a text that drops the last 15 shares 85 of 100
    rows = [
        (1, None), (2, ""), (3, " "), (4, "one"), (5, "One"), (6, "one two"), (7, "one two three"), (None, "one two three"), (None, "no other text"), (None, None),
        (8, long), (9, long + " end"), (10, " ".join(at)), (11, " ".join(at[:87])), (12, " ".join(at[:86])), (13, "same row here"), (13, "same row here"), (13, "another text of thirteen"),
        (20, "two one"), (19, "ONE\ttwo  THREE "),
    ]
    docs = clashing(make_docs(rows), "n", "c", "k", "h", "key", "component_id", "kept")
    assert found(minhash.near_duplicates(docs)) == brute(rows)
    assert minhash.near_duplicates(make_docs([])).collect() == []
    assert found(minhash.near_duplicates(make_docs([(1, None), (2, "")]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_a_third_of_the_rows_is_one_text(make_docs):
    rows = [(i if i % 2 else None, "the same words in every one of these rows") for i in range(300)] + near_copies(9)
    assert found(minhash.near_duplicates(make_docs(rows))) == brute(rows)


def test_documents(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert found(minhash.near_duplicates(documents)) == brute(rows)
