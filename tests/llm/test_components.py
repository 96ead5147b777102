import random

import pytest

from slotwise.llm.components import connected_components


def plain(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


CASES = {
    "none": [],
    "loop": [(1, 1), (2, 3)],
    "path": [(i, i + 1) for i in range(60)],
    "star": [(0, i) for i in range(1, 80)] + [(500, 7)],
    "repeated": [(1, 2), (2, 1), (1, 2), (3, 2)],
    "random": [(random.Random(i).randrange(150), random.Random(i + 999).randrange(150)) for i in range(110)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    edges = CASES[name]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["component"] for r in found} == plain(edges)


def test_text_nodes(spark):
    found = connected_components(spark.createDataFrame([("b", "a"), ("c", "b")], "a string, b string")).collect()
    assert {tuple(r) for r in found} == {("a", "a"), ("b", "a"), ("c", "a")}
