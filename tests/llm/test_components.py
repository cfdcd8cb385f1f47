from __future__ import annotations

import random

from ledgerloom.llm.common import cut, free_name, with_ids
from ledgerloom.llm.components import components


def brute(edges):
    names = {n: n for edge in edges for n in edge}

    def find(n):
        while names[n] != n:
            n = names[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        names[max(x, y)] = min(x, y)
    return {n: find(n) for n in names}


def run(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    rows = components(df).collect()
    found = {r.node: r.root for r in rows}
    assert len(found) == len(rows)
    return found


def test_random_links_a_chain_and_a_hub(spark):
    random.seed(1)
    edges = [(random.randrange(-150, 150), random.randrange(-150, 150)) for _ in range(160)]
    edges = [(a, b) for a, b in edges if a != b]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a chain
    edges += [(5000, 5001 + i) for i in range(200)] + [(5001, 5000)]  # a hub, and a link the other way round
    assert run(spark, edges) == brute(edges)


def test_no_links(spark):
    assert run(spark, []) == {}
    assert run(spark, [(3, 3)]) == {}


def test_ids_meet_any_columns(spark):
    df = spark.createDataFrame([(1, "a", "x"), (None, "b", "y"), (3, "c", "z")], "doc_id long, id_ string, `a.b` string")
    ids = spark.createDataFrame([(1,), (None,)], "doc_id long")
    assert sorted(r.id_ for r in with_ids(df, "doc_id", ids, "left_anti").collect()) == ["c"]
    assert sorted(r.id_ for r in with_ids(df, "doc_id", ids, "left_semi").collect()) == ["a", "b"]
    assert free_name(df, "id_") == "id__"


def test_written_steps_keep_rows_and_types(spark):
    df = spark.createDataFrame([(1, [2.5], None)], "a long, b array<double>, c string")
    again = cut(df)
    assert again.schema.simpleString() == df.schema.simpleString() and again.collect() == df.collect()
    assert cut(df.limit(0)).collect() == []
