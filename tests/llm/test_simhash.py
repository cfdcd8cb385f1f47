from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n\t", "One", "a b c d", "A b\x0bC d\x0ce", "x y z w x y z w", "Ä É ç É\xa0n 漢 字 1", "a " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def brute_components(fps, distance):
    names = list(range(len(fps)))

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                names[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("blocks", [2, 3])
def test_links_connect_what_is_close_and_nothing_else(spark, blocks):
    random.seed(blocks)
    fps = []
    for _ in range(60):
        base = random.getrandbits(64)
        fps.append(base)
        for _ in range(random.randint(0, 8)):
            other = base
            for bit in random.sample(range(64), random.randint(1, 6)):
                other ^= 1 << bit
            fps.append(other)
            base = random.choice([base, other])
    fps = list(dict.fromkeys(fps))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    found = simhash.links(df, 4, blocks).collect()
    place = {f: i for i, f in enumerate(signed)}
    names = list(range(len(fps)))

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    for link in found:
        assert ((link.a ^ link.b) & (2**64 - 1)).bit_count() <= 4
        x, y = find(place[link.a]), find(place[link.b])
        names[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == brute_components(fps, 4)


def test_every_value_has_a_home_and_all_anchors_in_reach():
    random.seed(3)
    for first, width, distance in ((0, 7, 1), (3, 9, 1), (0, 8, 2)):
        cover = simhash.Cover(first, width, distance)
        values = np.arange(1 << width, dtype=np.uint64)
        words = values[cover.syndrome(values) == 0]
        near = np.bitwise_count(values[:, None] ^ words[None])
        homes = cover.home(values)
        assert np.isin(homes, words).all() and (np.bitwise_count(homes ^ values) <= 1).all()
        assert (homes >> np.uint64(cover.coded) == values >> np.uint64(cover.coded)).all()
        index, anchors = cover.anchors(values)
        assert sorted(zip(index.tolist(), anchors.tolist(), strict=True)) == sorted((v, int(words[w])) for v, w in zip(*np.nonzero(near <= distance + 1), strict=True))


def near_copy(text, seed):
    random.seed(seed)
    words = text.split()
    words[random.randrange(len(words))] = "changed"
    return " ".join(words)


def test_documents(make_docs, clashing):
    random.seed(4)
    long = " ".join(random.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(3000))
    rows = [(9, long), (4, long), (4, long), (2, None), (3, ""), (30, " \n"), (5, "a few words"), (None, long), (None, "quite alone here now"), (6, near_copy(long, 1)), (8, near_copy(long, 2))]
    docs = clashing(make_docs(rows), "fp", "root", "component_id", "first")
    found = simhash.near_duplicates(docs)
    fps = [simhash.fingerprint(t or "") for _, t in rows]
    groups = brute_components(fps, 4)
    smallest = {}
    for (doc_id, _), group in zip(rows, groups, strict=True):
        if doc_id is not None:
            smallest[group] = min(doc_id, smallest.get(group, doc_id))
    expected = [(i, f"{fp:016x}", smallest.get(g)) for (i, _), fp, g in zip(rows, fps, groups, strict=True)]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    kept = simhash.first_of_each(docs, found)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(smallest.values())) and ids.count(None) == 2


def test_a_dense_group_gives_few_links():
    random.seed(5)
    base = random.getrandbits(64)
    nodes = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    nodes = np.array(sorted(nodes), dtype=np.uint64)
    assert len(simhash.spanning_links(nodes, np.ones(len(nodes), dtype=bool), 4)) == len(nodes) - 1


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([(1, "x")]).limit(0)).collect() == []
