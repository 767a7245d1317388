"""Balanced label propagation: its law, its links and its edge cases."""

from __future__ import annotations

import zlib
from collections import Counter

from aerolap.llm import sharding as S
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_MID


def _check(rows, n):
    slots: dict = {}
    for r in rows:
        assert 0 <= r.shard < n and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_is_even_and_keeps_copies_together(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = QUERIES["op3_balanced_shards"](spark, SF_MID).collect()
    assert Counter(r.doc_id for r in rows) == Counter(docs.keys())
    _check(rows, 24)
    load, places = Counter(), {}
    for r in rows:
        text = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(text) + 8, zlib.crc32(text))
        load[r.shard] += r.size
        places.setdefault(text, []).append(r.shard)
    mean = sum(load.values()) / 24
    assert max(load.values()) <= mean * 1.02 and min(load.values()) >= mean * 0.98
    groups = [p for p in places.values() if len(p) > 1]
    assert sum(len(set(p)) == 1 for p in groups) >= 0.9 * len(groups)


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string")


def test_hot_group_is_split_evenly(spark):
    rows = [(i, "copy " * 20, "x") for i in range(400)]
    rows += [(1000 + i, f"text {i} " + "w" * (i % 90), "x") for i in range(800)]
    got = S.shard(_table(spark, rows), n=6).collect()
    _check(got, 6)
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 6
    hot = Counter(r.shard for r in got if r.doc_id < 1000)
    assert len(hot) >= 3  # more than one shard holds


def test_all_documents_linked(spark):
    rows = [(i, f"pair {i // 2} " + "z" * (i // 2 % 50), "x") for i in range(600)]
    got = S.shard(_table(spark, rows), n=5).collect()
    _check(got, 5)
    load, places = Counter(), {}
    for r in got:
        load[r.shard] += r.size
        places.setdefault(r.text_crc32, set()).add(r.shard)
    mean = sum(load.values()) / 5
    assert max(load.values()) <= 1.05 * mean and min(load.values()) >= 0.95 * mean
    assert sum(len(p) == 1 for p in places.values()) > 0.5 * len(places)


def test_nulls_repeats_and_empty(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "", None), (2, "", None), (2, "é", None)]
    got = S.shard(_table(spark, rows), n=3).collect()
    _check(got, 3)
    assert sorted((r.size, r.text_crc32 if r.text_crc32 is not None else -1) for r in got) == [
        (8, -1), (8, -1), (8, 0), (8, 0), (10, zlib.crc32("é".encode()))]
    assert S.shard(_table(spark, rows).limit(0), n=3).count() == 0


def test_level_fills_the_lowest_first():
    assert S.level([0, 0, 0], 6) == [2, 2, 2]
    assert S.level([5, 0, 1], 3) == [0, 2, 1]
    assert abs(sum(S.level([3, 9, 4, 0], 7.5)) - 7.5) < 1e-9
