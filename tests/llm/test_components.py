from __future__ import annotations

import random

from chatlake.llm.components import components


def test_components_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2001 + i) for i in range(300)] + [(5, 5)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: root(i) for i in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
