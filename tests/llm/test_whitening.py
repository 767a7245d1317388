"""Whitening against a dense solver, exact sums, and odd tables."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from aerolap.llm import whitening as W
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, n string, component int"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA)


def _expected(rows, k=8):
    """(x, deviations, eigenvalues, vectors, trace) of the usable rows, by dense algebra."""
    good = [v for _, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max(map(len, good))
    x = [[math.floor(1024 * c) + 100000 for c in (*v, *[0.0] * (dim - len(v)))] for v in good]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[c - s / n for c, s in zip(v, sums, strict=True)] for v in x])
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    return centred, deviations, e[::-1][:k], u[:, ::-1][:, :k], np.trace(cov)


def _check(got, rows, k=8):
    centred, deviations, e, u, trace = _expected(rows, k)
    k = min(k, centred.shape[1])
    assert len(got) == len(centred) * k
    assert sorted({r.deviation for r in got}) == sorted(set(deviations))
    for c in range(k):
        mine = sorted([r for r in got if r.component == c + 1], key=lambda r: r.vec_id)
        want = centred @ u[:, c] / math.sqrt(e[c])
        found = np.array([r.whitened for r in mine])
        if found @ want < 0:
            found = -found
        assert np.abs(found - want).max() < 1e-8
        assert [r.deviation for r in mine] == deviations
        assert abs(mine[0].explained / (e[c] / trace) - 1) < 1e-9
        assert mine[0].n == len(centred) and mine[0].identity_error < 1e-9


def test_query_equals_dense_solver(spark):
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in
            spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    _check(QUERIES["op11_whitened_embeddings"](spark, SF_SMALL).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(6) * [5, 4, 3, 2, 1, .5]).tolist()) for i in range(40)]
    rows += [(40 + i, rows[7][1]) for i in range(3)] + [(50, rows[0][1][:4])]
    odd = [(60, None), (61, [1.0, None, 1.0]), (62, [math.nan] * 6), (63, [math.inf, 0.0])]
    _check(W.whiten(_vectors(spark, rows + odd).repartition(5)).collect(), rows)
    assert W.whiten(_vectors(spark, odd)).collect() == []
    assert W.whiten(_vectors(spark, rows).limit(0)).collect() == []


def test_no_variance_and_large_entries(spark):
    same = W.whiten(_vectors(spark, [(None, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(same) == 4
    assert {(r.whitened, r.explained, r.identity_error, r.deviation) for r in same} == {(None, 0.0, None, 0)}
    line = W.whiten(_vectors(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])).collect()
    assert {r.component for r in line if r.whitened is not None} == {1}
    assert {r.identity_error < 1e-9 for r in line} == {True}
    far = W.whiten(_vectors(spark, [(1, [1e300]), (2, [0.0])])).collect()
    assert [r.deviation for r in far] == [None, None] and {abs(r.whitened) for r in far} == {1.0}
    exact = W.whiten(_vectors(spark, [(1, [2.0 ** 19, 3.0]), (2, [0.0, 1.0])])).collect()
    assert {r.deviation for r in exact} == {2 ** 58 + 2 ** 22}


def test_empty_vectors_and_slices():
    column = pa.array([[1.0], None, [], [2.0, 3.0]], pa.list_(pa.float32())).slice(1)
    rows, v = W.vectors_of(column)
    assert rows.tolist() == [1, 2] and v.tolist() == [[0.0, 0.0], [2.0, 3.0]]


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 2, 90), 1.5 ** -np.arange(60.0), np.r_[np.ones(20), np.full(30, .5)],
    np.r_[3.0, 3.0, 3.0, np.zeros(12)], np.zeros(5), np.array([4.0])])
def test_eigenpairs(spectrum):
    rng = np.random.default_rng(len(spectrum))
    q, _ = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))
    a = q * spectrum @ q.T
    e, u, r = W.eigenpairs(lambda z: a @ z, len(spectrum), 8)
    want = np.sort(spectrum)[::-1][:8]
    scale = max(1.0, spectrum.max())
    assert np.abs(e - want).max() < 1e-12 * scale and r.max() < 1e-12 * scale
    assert np.abs(a @ u - u * e).max() < 1e-12 * scale
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12


def test_minres_solves_an_indefinite_system():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = np.c_[rng.standard_normal((30, 3)), np.zeros(30)]
    x = W.minres(lambda z: a @ z, b, 200, 1e-11)
    assert np.abs(a @ x - b).max() < 1e-7
