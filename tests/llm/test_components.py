"""Connected components on chains, stars and random graphs."""

import random

import pytest

from cumulus.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def graph(kind):
    rng = random.Random(3)
    if kind == "chain":
        ids = list(range(60))
        rng.shuffle(ids)
        return list(zip(ids, ids[1:]))
    if kind == "star":
        return [(50, i) for i in range(100) if i != 50] + [(200, 201)]
    if kind == "odd":
        return [(1, 2), (2, 1), (1, 1), (3, 3), (None, 4), (5, None), (-7, 2), (1, 2)]
    return [(rng.randrange(90), rng.randrange(90)) for _ in range(60)]


@pytest.mark.parametrize("kind", ["chain", "star", "odd", "random"])
def test_components(spark, kind):
    edges = graph(kind)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == plain(edges) and len(got) == len(plain(edges))


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
