from __future__ import annotations

import random

import pytest

from ledgerloom.llm import decontaminate
from ledgerloom.llm.decontaminate import best_end, clean_documents, find_leaks, nearest, normal

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards box with a quite jolly gnome near the old mill"


def distances(item, text):
    """Least edits from the item to a stretch that ends at each place of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_bit_parallel_distance_against_the_table():
    random.seed(2)
    for _ in range(1500):
        item = "".join(random.choice("abc") for _ in range(random.randint(1, 12)))
        text = "".join(random.choice("abc") for _ in range(random.randint(1, 30)))
        row = distances(item, text)
        if min(row) < len(item):
            assert best_end(item, text, len(item)) == (min(row), row.index(min(row)))
            distance, start, end = nearest(item, text, len(item) - 1)
            assert (distance, end) == (min(row), row.index(min(row))) and edits(item, text[start:end]) == distance
        assert best_end(item, text, min(row) - 1) is None


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM), (2, ITEM), (3, "Yes."), (4, None), (5, ""), (None, "an item without id that is long enough to be looked for")]
    return spark.createDataFrame(rows, "item_id long, text string")


def changed(text, edits_wanted, seed):
    random.seed(seed)
    letters = list(text)
    for _ in range(edits_wanted):
        at = random.randrange(len(letters))
        action = random.choice("sid")
        if action == "s":
            letters[at] = random.choice("qxz")
        elif action == "i":
            letters.insert(at, random.choice("qxz"))
        else:
            del letters[at]
    return "".join(letters)


def test_every_passage_within_the_budget_is_found(spark, make_docs, benchmark):
    budget = int(decontaminate.ERROR_RATE * len(normal(ITEM)))
    filler = "some quite ordinary prose about nothing at all "
    rows = [(i, filler * (i % 4) + changed(ITEM, i % (2 * budget), i) + " " + filler) for i in range(60)]
    expected = {(i, item) for i, text in rows if min(distances(normal(ITEM), normal(text))) <= budget for item in (1, 2)}
    found = find_leaks(make_docs(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected) and 40 < len(expected) < 120
    for r in found:
        text = dict(rows)[r.doc_id]
        assert r.distance == min(distances(normal(ITEM), normal(text))) <= r.budget == budget
        assert normal(ITEM)[-12:-6] in normal(text[r.start : r.end]) or r.distance > 0


def test_case_punctuation_and_line_breaks_do_not_matter(make_docs, benchmark):
    text = "Intro:\n" + ITEM.upper().replace(" ", ",  ").replace("FOX", "“FOX”") + "!!"
    (one, two) = find_leaks(make_docs([(7, text)]), benchmark).collect()
    assert one.distance == two.distance == 0 and text[one.start : one.end].startswith("THE,") and text[one.start : one.end].endswith("MILL")


def test_edge_rows(make_docs, benchmark, clashing):
    rows = [(1, None), (2, ""), (3, "yes"), (4, "yes or no"), (None, ITEM), (5, "x " * 50_000 + ITEM), (5, "plain")]
    docs = clashing(make_docs(rows), "item_id", "_leak", "distance")
    found = find_leaks(docs, clashing(benchmark, "doc_id", "start"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(3, 3), (None, 1), (None, 2), (5, 1), (5, 2)}
    kept = clean_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def test_empty_tables(make_docs, benchmark):
    docs = make_docs([(1, ITEM)])
    assert find_leaks(docs.limit(0), benchmark).collect() == []
    assert find_leaks(docs, benchmark.limit(0)).collect() == []
    assert clean_documents(docs, benchmark.limit(0)).count() == 1


def test_blocks_of_items_give_the_same(make_docs, benchmark, monkeypatch):
    docs = make_docs([(1, ITEM), (2, "an item without id that is long enough to be looked for"), (3, "else")])
    whole = sorted(map(repr, find_leaks(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    assert sorted(map(repr, find_leaks(docs, benchmark).collect())) == whole and len(whole) == 3
