import random

import pytest

from fragstream.llm import graph
from fragstream.llm.common import Scratch


def brute(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {x: top(x) for x in up}


@pytest.mark.parametrize("least", [64, 2])
@pytest.mark.parametrize("edges", [
    [],
    [(1, 1), (None, 2), (3, None)],
    [(i, i + 1) for i in range(60)],
    [(i, 500 + i % 3) for i in range(300)],
    [(60 - i, 0) for i in range(60)] + [(100, 101), (101, 99), (99, 99)],
    "random",
])
def test_components(spark, monkeypatch, least, edges):
    monkeypatch.setattr(graph, "EDGES", least)
    if edges == "random":
        rng = random.Random(4)
        edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    with Scratch(spark) as scratch:
        got = graph.components(spark.createDataFrame(edges, "a long, b long"), scratch, "t").collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.component for r in got} == brute(edges)
