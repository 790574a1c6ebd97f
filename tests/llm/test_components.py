"""Connected components with hubs: nodes whose edges are joined by broadcast."""

import random

from pyspark.sql import functions as F

from daybook.llm import components as parts


def union_find(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def test_hubs(spark, monkeypatch):
    rng = random.Random(3)
    # a star around a middle node, a path of 40, and stars whose hubs hang on one another
    edges = [(1000, x) for x in range(500, 1500) if x != 1000] + [(x, x + 1) for x in range(2000, 2040)]
    edges += [(h, 4000 + rng.randrange(900)) for h in (3000, 3001, 5000) for _ in range(300)] + [(3000, 6000), (6000, 6001)]
    for most in (5, 1000):
        monkeypatch.setattr(parts, "HUB_EDGES", most)
        found = dict(map(tuple, parts.components(spark.createDataFrame(edges, "a long, b long")).collect()))
        assert found == union_find(edges)


def test_hub_edges_are_not_dealt_out(spark):
    both = spark.createDataFrame([(1, x) for x in range(2, 3000)] + [(5000, 5001)], "a long, b long")
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    rows = parts._beside(both, least, 1000)
    assert rows.count() == both.count() and rows.where("m <> if(a = 1, 2, 5001)").count() == 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2


def test_chunks(spark, monkeypatch):
    rng = random.Random(4)
    edges = [(x, x + 1) for x in range(300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    edges += [(7, 7), (2000, 7), (2**62, -5), (-5, 8)] + [(2000, 7)] * 3
    df = spark.createDataFrame(rng.sample(edges, len(edges)), "a long, b long").repartition(5)
    for most in (20, 200, 200_000):  # many chunks, a few, one
        monkeypatch.setattr(parts, "CHUNK", most)
        found = dict(map(tuple, parts.components(df).collect()))
        want = union_find(e for e in edges if e[0] != e[1])
        assert found == want


def test_one_chunk_takes_no_rounds(spark, monkeypatch):
    """A path of 300 nodes took nine stored tables or more, each with a shuffle."""
    made, stored = [], parts.stored
    monkeypatch.setattr(parts, "stored", lambda df, label: made.append(label) or stored(df, label))
    found = parts.components(spark.createDataFrame([(x, x + 1) for x in range(300)], "a long, b long"))
    assert {r.root for r in found.collect()} == {0} and len(made) == 2
