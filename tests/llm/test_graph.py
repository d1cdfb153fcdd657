"""Connected components against union-find, with least neighbours sent to all tasks and with hot nodes joined apart."""

import random

import pytest

from lakespan.llm import graph
from lakespan.llm.scratch import Scratch

R = random.Random(1)
GRAPHS = {
    "path": [(i, i + 1) for i in range(40)],
    "star": [(1500, x) for x in range(3000) if x != 1500],
    "random": [(a, b) for a, b in ((R.randrange(-400, 400), R.randrange(-400, 400)) for _ in range(420)) if a != b],
    "repeats": [(2, 1), (1, 2), (1, 2)],
    "none": [],
}


def least(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up) if find(x) != x}


@pytest.mark.parametrize("sent", [graph.SENT, 0])
@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, monkeypatch, name, sent):
    monkeypatch.setattr(graph, "SENT", sent)
    rows = graph.components(spark.createDataFrame(GRAPHS[name], "u long, v long"), Scratch(spark, "graph"), "cc").collect()
    assert sorted((r.u, r.v) for r in rows) == sorted(least(GRAPHS[name]).items())
