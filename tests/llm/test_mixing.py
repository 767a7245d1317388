"""Source mixing against SQL and against the reshare rule."""

from __future__ import annotations

import random

from aerolap.llm import mixing as M
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import _digest, duck


def test_query_equals_sql(spark):
    df = QUERIES["op4_source_mix"](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(M.ORACLE_SQL)
    assert sorted(df.columns) == sorted(rel.columns)
    rows, want = [tuple(r) for r in df.collect()], rel.fetchall()
    assert _digest(df.columns, rows, False) == _digest(rel.columns, want, False)


def _reshare(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Targets by the rule itself: fill by weight, cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    got, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        step = {s: left * w[s] / total for s in open_}
        left = 0.0
        for s, x in step.items():
            room = cap * sizes[s] - got[s]
            got[s] += min(x, room)
            left += max(0.0, x - room)
            if x >= room:
                open_.discard(s)
    return got


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_targets_budgets_and_nulls(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40])), rng.choice(["b", "a", "é", None, "hot", "hot"]),
             "x") for i in range(600)]
    rows += [(1000, None, "a", None), (1001, "", None, None), (None, "a b c", "b", None),
             (5, "w w", "hot", None), (5, "w w", "hot", None)]
    got = M.plan(_table(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = _reshare(sizes)
    taken: dict = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 40 / 2
    key = lambda r: str(tuple(r))
    again = M.plan(_table(spark, rows[::-1]).repartition(9)).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_take_and_empty(spark):
    rows = [(i, "a b c d", "s", "z") for i in range(8)] + [(9, "a b", None, "z")]
    df = _table(spark, rows)
    mixed = M.take(df)
    assert mixed.columns == df.columns
    want = {r.doc_id: r.copies for r in M.plan(df).collect()}
    got: dict = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}
    assert M.plan(df.limit(0)).count() == 0 and M.take(df.limit(0)).count() == 0
    assert {r.taken for r in M.plan(_table(spark, [(1, None, "a", "")])).collect()} == {0}
