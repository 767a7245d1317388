"""Packed rows: best fit, nothing lost, nothing mixed up."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from aerolap.llm import packing as P
from aerolap.llm.catalog import QUERIES, vocabulary
from aerolap.session import scratch_path
from tests.conftest import SF_SMALL


def _naive(lengths, size):
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(size - n)
    return sorted(rooms)


def test_best_fit_decreasing_equals_a_scan():
    rng = random.Random(4)
    for _ in range(300):
        size = rng.choice([1, 5, 16, 31, 64])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 60))]
        rows = P.best_fit_decreasing(lengths, size)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(size - sum(lengths[i] for i in r) for r in rows) == _naive(lengths, size)


def _documents(rows, length):
    """Token ids per document id, put together from the packed rows."""
    parts: dict = {}
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<u4")
        assert len(ids) == length and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert r.position_resets == r.cu_seqlens[:-1] and r.n_segments == len(r.doc_ids)
        assert not ids[r.n_tokens:].any()
        for d, at, a, b in zip(r.doc_ids, r.token_offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            assert a < b
            parts.setdefault(d, []).append((at, ids[a:b].tobytes()))
    out = {}
    for d, p in parts.items():
        p.sort()
        assert [at for at, _ in p] == list(np.cumsum([0, *[len(b) // 4 for _, b in p[:-1]]]))
        out[d] = b"".join(b for _, b in p)
    return out


def test_query_is_lossless_and_full(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    rows = QUERIES["op1_packed_rows"](spark, SF_SMALL).collect()
    bpe = vocabulary(spark).bpe()
    assert _documents(rows, P.LENGTH) == {r.doc_id: bpe.encode(r.text) for r in docs}
    assert len({r.pack_id for r in rows}) == len(rows)
    assert sum(r.n_tokens for r in rows) > 0.95 * P.LENGTH * (len(rows) - 8)


def test_small_rows_buffers_nulls_and_files(spark):
    df = spark.createDataFrame(
        [(1, "a b c d e f g h i j k", 1), (2, None, 1), (3, "", 1), (None, "x y", 1), (4, "z " * 99, 1)],
        "doc_id long, text string, n_tokens int").coalesce(1)
    v = vocabulary(spark)
    packed = P.pack(df, v, length=8, buffer_tokens=10)
    path = P.write_packed(packed, scratch_path(spark, "t_packed"))
    rows = spark.read.parquet(path).collect()
    bpe = v.bpe()
    assert _documents(rows, 8) == {1: bpe.encode("a b c d e f g h i j k"), None: bpe.encode("x y"),
                                   4: bpe.encode("z " * 99)}
    got = packed.select("cu_seqlens", P.position_ids(F.col("cu_seqlens")).alias("p")).collect()
    for r in got:
        assert r.p == [i for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]) for i in range(b - a)]
    assert P.pack(df.limit(0), v).count() == 0
