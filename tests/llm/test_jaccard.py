"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from aerolap.llm import jaccard as J
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, percent):
    """{doc_id: (shingles, component, links)} over rows of (id, text) with distinct ids."""
    sets = {i: _set(t, k) for i, t in rows}
    lists: dict = {}
    for i, s in sets.items():
        for x in s:
            lists.setdefault(x, []).append(i)
    parent, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        common = Counter(j for x in s for j in lists[x] if j > i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i), links[i]) for i, s in sets.items()}


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(300)]
    rows: list = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 15, 40, 100, 200]))]
        for _ in range(rng.choice([1, 2, 5, 25])):
            d = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                p, op = rng.randrange(len(d)), rng.random()
                if op < 0.5:
                    d[p] = rng.choice(vocabulary)
                elif op < 0.75 and len(d) > 1:
                    del d[p]
                else:
                    d.insert(p, rng.choice(vocabulary))
            rows.append((len(rows), " ".join(d)))
    n = len(rows)
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "A b"), (n + 4, "a B")]


def _join(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return {r.doc_id: (r.n_shingles, r.component_id, r.n_links)
            for r in J.join(df, **options).collect()}


@pytest.mark.parametrize("options", [
    {"k": 3, "percent": 90},
    {"k": 5, "percent": 80},
    {"k": 3, "percent": 90, "block_sets": 8, "block_shingles": 1000, "broadcast_ids": 10},
    {"k": 5, "percent": 80, "block_sets": 8, "block_shingles": 1000, "screen_sets": 5},
])
def test_equal_to_all_pairs(spark, options):
    rows = corpus()
    want = brute(rows, options["k"], options["percent"])
    assert any(v[2] > 3 for v in want.values())
    assert _join(spark, rows, **options) == want


def test_query_equal_to_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in
           QUERIES["op9_ngram_jaccard"](spark, SF_SMALL).collect()}
    assert got == brute(docs, 3, 90)


def test_linked_sets_share_a_block_key():
    rng = np.random.default_rng(0)
    shared = np.unique(rng.integers(0, 2 ** 63, 40).astype(np.uint64))
    for percent, common in ((80, None), (90, None), (80, shared), (90, shared[::2])):
        blocks = J.Blocks(percent, common)
        for _ in range(400):
            n = int(rng.integers(5, 300))
            own = rng.integers(0, 2 ** 63, max(1, n - 40 * int(rng.integers(2)))).astype(np.uint64)
            a = np.unique(np.concatenate([own, shared[:int(rng.integers(41))]]))
            drop, add = (int(rng.integers(0, 1 + n * (100 - percent) // 100)) for _ in range(2))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2 ** 63, add).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            linked = 100 * common >= percent * (len(a) + len(b) - common)
            if linked and len(a) != common or linked and len(b) != common:
                assert len(np.intersect1d(blocks.keys(a), blocks.keys(b)))


def test_repeated_ids_nulls_extra_columns_and_empty(spark):
    df = spark.createDataFrame(
        [(1, "a b c d", 1, "x"), (1, "a b c d", 1, "x"), (2, "A B C D", 9, None),
         (3, "e f g", 2, "y"), (3, "a b c d", 2, "y"), (None, "a b c d", 0, "z")],
        "doc_id long, text string, component_id long, f1 string")
    rows = sorted(J.join(df).collect(), key=str)
    assert len(rows) == 6
    assert sorted((r.doc_id, r.component_id) for r in rows if r.doc_id is not None) == [
        (1, 1), (1, 1), (2, 1), (3, 1), (3, 3)]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert all(r.n_links == 3 for r in rows if r.doc_id in (1, 2))
    kept = J.keep_one(df, k=3, percent=90)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]
    assert J.join(df.limit(0)).count() == 0 and J.keep_one(df.limit(0)).count() == 0


def _brute_rows(rows, k, percent):
    """(id, component id, links) and kept rows, each row judged by its own text."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    known = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    links = {i: [j for j in known if j != i and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
             for i in known}
    group = {}
    for i in known:
        if i in group:
            continue
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        group |= dict.fromkeys(seen, frozenset(seen))
    out = [(d, min(rows[j][0] for j in group[i]) if i in group else d, len(links.get(i, ())))
           for i, (d, _) in enumerate(rows)]
    return out, [min(rows[j][0] for j in g) for g in set(group.values())]


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    a, b = "a b c d e f g h i j k l", "q r s t u v w x y z"
    near = a + " m"
    for rows in ([(1, a), (5, near), (5, b)], [(1, a), (1, b), (2, near), (3, "no link at all")],
                 [(1, a), (1, near), (1, b), (2, b)]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        want, heads = _brute_rows(rows, 3, 80)
        got = J.join(df, k=3, percent=80).collect()
        assert sorted((r.doc_id, r.component_id, r.n_links) for r in got) == sorted(want)
        kept = [(r.doc_id, r.text) for r in J.keep_one(df, k=3, percent=80).collect()]
        assert sorted(d for d, _ in kept) == sorted(heads) and len(set(kept)) == len(kept)


def test_random_tables_with_repeated_ids(spark):
    rng = np.random.default_rng(7)
    words = list("abcdefghijklmnopqrstuvwxyz")
    for seed in range(2):
        base = [list(rng.choice(words, 20)) for _ in range(5)]
        rows = []
        for _ in range(60):
            w = list(base[rng.integers(5)])
            for _ in range(rng.integers(3)):
                w[rng.integers(20)] = str(rng.choice(words))
            rows.append((None if rng.random() < .05 else int(rng.integers(1, 15)),
                         None if rng.random() < .05 else " ".join(w)))
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        want, heads = _brute_rows(rows, 3, 60)
        got = J.join(df, k=3, percent=60).collect()
        assert sorted(((r.doc_id, r.component_id, r.n_links) for r in got), key=repr) == sorted(want, key=repr)
        kept = [r for r in J.keep_one(df, k=3, percent=60).collect() if r.doc_id is not None and r.text]
        assert sorted(r.doc_id for r in kept) == sorted(heads)


@pytest.mark.parametrize("sizes", [(1, 90), (50, 70), (900, 1100), (20_000, 26_000)])
@pytest.mark.parametrize("two_sides", [False, True])
def test_screening_rules_out_no_link(sizes, two_sides):
    """Sets of one linked component stay together; unlike ones are told apart."""
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(6):
        base = rng.integers(0, 1 << 63, rng.integers(*sizes)).astype(np.uint64)
        for _ in range(5):
            drop = rng.random(len(base)) < rng.choice([0, 0.05, 0.1, 0.3])
            more = rng.integers(0, 1 << 63, rng.integers(0, len(base) // 10 + 1)).astype(np.uint64)
            sets.append(np.unique(np.concatenate([base[~drop], more, base[:1]])))
    side = np.array([i % 2 if two_sides else 0 for i in range(len(sets))])
    for percent in (80, 90):
        first = J.may_link([J.parities(s) for s in sets], np.array([len(s) for s in sets]),
                           side, percent)
        for i, a in enumerate(sets):
            assert first[first[i]] == first[i]
            for j, b in enumerate(sets[:i]):
                shared = len(np.intersect1d(a, b))
                if (100 * shared >= percent * (len(a) + len(b) - shared)
                        and (not two_sides or side[i] != side[j])):
                    assert first[i] == first[j]
        if sizes == (900, 1100):  # bins enough to tell unrelated sets apart
            assert len(set(first.tolist())) >= 6


def test_parities_fold_and_bound_the_difference():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    b = np.unique(np.concatenate([a[100:], rng.integers(0, 1 << 63, 200).astype(np.uint64)]))
    x, y = (np.frombuffer(J.parities(s), "<u8") for s in (a, b))
    assert len(x) == 16 and len(y) == 32
    y = y[:16] ^ y[16:]
    assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
    assert len(J.parities(a[:1])) == 8
    assert len(J.parities(np.arange(40_000, dtype=np.uint64))) == J.MAX_BINS // 8
