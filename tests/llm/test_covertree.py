"""Embedding near-duplicates against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from aerolap.llm import covertree as C
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, threshold):
    parent = {r[0]: r[0] for r in rows if r[0] is not None}
    links = dict.fromkeys(parent, 0)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    groups: dict = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        a = np.array(v, float)
        if (norm := np.linalg.norm(a)) > 0:
            groups.setdefault((label, len(v)), []).append((i, a / norm))
    for members in groups.values():
        x = np.stack([a for _, a in members])
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        for p, (i, _) in enumerate(members):
            links[i] += int(linked[p].sum())
            for q in np.flatnonzero(linked[p, :p]):
                a, b = root(i), root(members[q][0])
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], root(i), root(i) == i) for i in parent}


def _vector(v):
    return [float(np.float32(x)) for x in v]


def vectors(n=600):
    rng, rows = np.random.default_rng(0), []
    for i in range(n):
        if rows and i % 3:
            v = np.array(rows[rng.integers(max(0, i - 40), i)][2]) + rng.normal(0, .05 * (i % 4), 8)
        else:
            v = rng.normal(0, 1, 8)
        rows.append((i, i % 2, _vector(v)))
    one = [1.0] * 7
    return rows + [
        (n, None, _vector(rng.normal(0, 1, 8))), (n + 1, 0, None), (n + 2, 0, [0.0] * 8),
        (n + 3, 0, [float("nan"), *one]), (n + 4, 0, [None, *one]), (n + 5, 0, []),
        (n + 6, 0, [1.0, 2.0]), (n + 7, 0, [2.0, 4.0]), (n + 8, 1, rows[1][2]),
        (n + 9, 1, rows[1][2]), (n + 10, 0, [float("inf"), *one]), (None, 0, rows[0][2])]


@pytest.mark.parametrize(("threshold", "options"), [
    (0.93, {}), (0.93, {"block": 32, "max_centres": 20}), (0.99, {"block": 16})])
def test_equal_to_all_pairs(spark, threshold, options):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = C.near_duplicates(df, threshold=threshold, **options).collect()
    assert len(got) == len(rows)
    want = brute(rows, threshold)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got
            if r.vec_id is not None} == want
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [
        (0, None, None)]


def test_query_equal_to_all_pairs(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in
            spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op10_embedding_copies"](spark, SF_SMALL).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(rows, 0.93)


def test_tree_covers_its_points_and_halves():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    top = C.tree(x, np.arange(400), 0, 2.0)
    stack = [(top, None)]
    while stack:
        node, parent = stack.pop()
        far = np.linalg.norm(x[node.points] - node.centre, axis=1)
        assert far.max() <= node.radius + 1e-12
        if parent is not None:
            assert node.radius <= parent.radius / 2 + 1e-12
        if node.children:
            parts = np.concatenate([c.points for c in node.children])
            assert sorted(parts) == sorted(node.points)
            assert (node.children[0].centre == node.centre).all()  # nested levels
        stack += [(c, node) for c in node.children]


def _spread_with_copies(n=500, dim=64, seed=3):
    """Unit vectors spread over many dimensions, a third of them near one of 20 others."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, 3):
        x[i] = x[1 + 3 * (i % 20)] + rng.normal(size=dim) * (0.1 if i % 2 else 0.36)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nodes(top):
    stack = [top]
    while stack:
        node = stack.pop()
        yield node
        stack += node.children


def test_levels_are_built_whatever_the_spread():
    x = _spread_with_copies()
    for node in _nodes(C.tree(x, np.arange(len(x)), 0, 2.0)):
        assert bool(node.children) == (len(node.points) > C.LEAF)
        centres = x[node.heads] if node.children else x[:0]
        apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
        assert (apart[~np.eye(len(centres), dtype=bool)] > node.radius / 2 - 1e-9).all()


@pytest.mark.parametrize("threshold", [0.5, 0.93, 0.9999])
def test_traversal_of_two_trees_prunes_and_is_exact(threshold):
    x = _spread_with_copies()
    half = len(x) // 2
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    first, second = (C.tree(x, p, int(p[0]), 2.0) for p in
                     (np.arange(half), np.arange(half, len(x))))
    walk = C.Traversal(x, np.ones(len(x), np.int64), threshold)
    walk.meet(first, second)
    assert walk.links[:half].tolist() == linked[:half, half:].sum(1).tolist()
    for node in (first, second):
        walk.meet(node, node)
    assert walk.links.tolist() == linked.sum(1).tolist()
    assert all(walk.root(i) == walk.root(j) for i, j in zip(*np.nonzero(linked)))
    assert walk.pruned > walk.met // 2


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_trees_of_the_table_have_levels_and_prune(spark, name):
    rows = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet").where(
        C.usable(C.F.col("embedding"))).select("label", "embedding").distinct().collect()
    for label in {r.label for r in rows}:
        x = np.array([r.embedding for r in rows if r.label == label], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        top = C.tree(x, np.arange(len(x)), 0, 2.0)
        assert bool(top.children) == (len(x) > C.LEAF)
        walk = C.Traversal(x, np.ones(len(x), np.int64), 0.93)
        walk.meet(top, top)
        assert len(x) <= C.LEAF or walk.pruned > 0.9 * walk.met


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 1, [1.0, 0.0], "a"), (1, 1, [1.0, 0.0], "a")],
                               "vec_id long, label int, embedding array<float>, n_links string")
    assert sorted(tuple(r) for r in C.near_duplicates(df).collect()) == [(1, 1, 1, True)] * 2
    assert C.near_duplicates(df.limit(0)).count() == 0


def test_vectors_that_share_an_id_are_judged_by_themselves(spark):
    df = spark.createDataFrame(
        [(1, 0, [1.0, 0.0]), (5, 0, [1.0, 0.01]), (5, 0, [0.0, 1.0]), (1, 0, [-1.0, 0.0]), (7, 0, [-1.0, 0.01])],
        "vec_id long, label int, embedding array<float>")
    got = sorted((r.vec_id, r.component_id, r.n_links, r.kept) for r in C.near_duplicates(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (5, 1, 1, False), (5, 5, 0, True), (7, 1, 1, False)]
