"""Connected components against union-find."""

from __future__ import annotations

import random

from aerolap.llm.components import components


def _brute(edges):
    parent: dict = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_random_graphs_chains_hubs_and_odd_edges(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(501, 700)]
    noise = [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(90)]
    odd = [(7, 7), (None, 3), (3, None), (-5, 8), (8, -5), (8, -5)]
    edges = chain + hub + noise + odd
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == _brute(edges)
    assert components(df.limit(0)).count() == 0
