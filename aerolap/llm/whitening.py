"""Whitening of embeddings by Jacobi-Davidson (operator 11).

Vectors become integers first (:func:`integers`), so sums and means are exact.
The covariance is never formed: the solver only needs its product with a block
of vectors, and one Spark job per product adds up ``Y^T (Y U)`` over the
centred rows ``Y``, which lie as packed blocks in a written table
(:class:`Products`). What moves is one row per dimension and task, combined
before it is collected; the driver holds vectors of one row's length only.

:func:`eigenpairs` is a block Jacobi-Davidson solver: Rayleigh-Ritz over a
subspace gives the current pairs; for each wanted pair the correction equation,
projected off the pair and all locked vectors, is solved roughly by MINRES (all
wanted pairs in lockstep, so a step is one distributed product); the
corrections extend the subspace. A pair is locked once its residual is at the
rounding level of double precision relative to the largest eigenvalue. The
search ends when the wanted pairs are locked and no Ritz value left may exceed
them.

Defined results for odd input: rows whose vector is null or holds null or
non-finite entries are left out; a vector shorter than the longest one counts
as filled up with zeros; scaled entries beyond ±2^40 count as that bound;
repeated rows count repeatedly; ids may be null, repeated and of any type; a
tie of eigenvalues takes any basis of their space. A component without
variance (eigenvalue at the rounding level of the largest) has ``whitened`` null and
``explained`` 0 and is left out of ``identity_error``; a ``deviation`` beyond a long is
null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm.common import discard, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Scaled entries are bounded so that block sums stay exact in 64 bits.
LIMIT = 2 ** 40
#: Entries of a packed block (1 MB).
BLOCK_ENTRIES = 2 ** 17
#: Steps of an inner solve, and the share of a residual that it may leave.
INNER_STEPS, INNER_LEFT = 4, 0.05
#: Residual, over the largest eigenvalue and the root of the dimension, that counts as zero.
ROUNDING = 16 * np.finfo(float).eps


def vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows (numbers) with a usable vector, and these vectors, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    bad = np.bincount(row, ~np.isfinite(flat), len(lengths)) > 0
    usable = column.is_valid().to_numpy(zero_copy_only=False) & ~bad
    out = np.zeros((len(lengths), int(lengths[usable].max(initial=0))))
    keep = usable[row]
    out[row[keep], at[keep]] = flat[keep]
    return np.flatnonzero(usable), out[usable]


def integers(vectors: np.ndarray, dim: int) -> np.ndarray:
    """``floor(SCALE * c) + SHIFT`` as longs, filled up to ``dim`` columns."""
    out = np.full((len(vectors), dim), SHIFT, dtype=np.int64)
    scaled = np.clip(np.floor(SCALE * vectors), -LIMIT, LIMIT)
    out[:, :vectors.shape[1]] += scaled.astype(np.int64)
    return out


def packed(frame: DataFrame, vec_col: str) -> DataFrame:
    """Blocks of integer vectors: rows, dimension, and the numbers as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, vectors = vectors_of(batch.column(0))
            x = integers(vectors, vectors.shape[1])
            step = max(1, BLOCK_ENTRIES // max(1, x.shape[1]))
            parts = [x[i:i + step] for i in range(0, len(x), step)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(p) for p in parts], pa.int64()),
                 pa.array([p.shape[1] for p in parts], pa.int64()),
                 pa.array([p.tobytes() for p in parts], pa.binary())], ["n", "dim", "x"])

    return frame.select(vec_col).mapInArrow(run, "n long, dim long, x binary")


def _block(n: int, dim: int, data: bytes, want: int) -> np.ndarray:
    x = np.frombuffer(data, dtype=np.int64).reshape(n, dim)
    if dim == want:
        return x
    return np.concatenate([x, np.full((n, want - dim), SHIFT, dtype=np.int64)], axis=1)


def block_sums(blocks: DataFrame, dim: int, width: int, kind: type,
               fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``fn(block)``, a matrix of ``width`` columns, over all blocks.

    A task adds up its blocks and returns the sum's rows; Spark adds the rows
    of equal number, so the driver receives one matrix however many tasks run.
    """
    whole = kind is int
    dtype = np.int64 if whole else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for n, d, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                part = fn(_block(n.as_py(), d.as_py(), data.as_buffer(), dim))
                if whole:  # sums over tasks may pass 64 bits: Python's whole numbers
                    part = part.astype(object)
                total = part if total is None else total + part
        if total is not None:
            cells = [[str(v) for v in c] for c in total.T] if whole else list(total.T)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()),
                 *[pa.array(c, pa.string() if whole else pa.float64()) for c in cells]],
                ["j", *[f"v{i}" for i in range(width)]])

    columns = [f"v{i}" for i in range(width)]
    schema = "j int, " + ", ".join(f"{c} {'string' if whole else 'double'}" for c in columns)
    rows = blocks.mapInArrow(run, schema).groupBy("j").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)") if whole else F.col(c)).alias(c) for c in columns]
    ).orderBy("j").collect()
    return np.array([[int(v) if whole else v for v in r[1:]] for r in rows],
                    dtype=object if whole else dtype)


@dataclass
class Products:
    """The centred rows of a table and products with their covariance."""

    blocks: DataFrame
    dim: int
    n: int
    #: Exact sums per dimension, and the mean as a whole part and a rest.
    sums: list[int]
    whole: np.ndarray
    rest: np.ndarray
    jobs: int = 0

    @classmethod
    def of(cls, blocks: DataFrame) -> Products | None:
        n, dim = blocks.agg(F.sum("n"), F.max("dim")).first()
        if not n or not dim:
            return None
        sums = [int(v) for v in block_sums(
            blocks, dim, 1, int, lambda x: x.sum(axis=0, keepdims=True).T)[:, 0]]
        whole = [(2 * s + n) // (2 * n) for s in sums]
        rest = [(s - n * w) / n for s, w in zip(sums, whole, strict=True)]
        return cls(blocks, dim, n, sums, np.array(whole, dtype=np.int64), np.array(rest))

    def _mean_product(self, width: int, fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        whole, rest = self.whole, self.rest
        self.jobs += 1
        return block_sums(self.blocks, self.dim, width, float,
                          lambda x: fn((x - whole).astype(np.float64) - rest)) / self.n

    def times(self, u: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``u``."""
        return self._mean_product(u.shape[1], lambda y: y.T @ (y @ u))

    def trace(self) -> float:
        return float(self._mean_product(1, lambda y: (y * y).sum(axis=0)[:, None]).sum())

    def covariance(self, u: np.ndarray) -> np.ndarray:
        """Covariance of the rows projected on ``u``, around their own mean."""
        def moments(y: np.ndarray) -> np.ndarray:
            w = y @ u
            return np.concatenate([w.T @ w, w.sum(axis=0, keepdims=True)])
        m = self._mean_product(u.shape[1], moments)
        return m[:-1] - np.outer(m[-1], m[-1])


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int,
           left: float) -> np.ndarray:
    """MINRES (Paige and Saunders, 1975) for all columns of ``b`` in lockstep.

    ``apply`` is a symmetric operator, one per column. A column stops once its
    residual is at most ``left`` of its right side, or when its Lanczos vectors end.
    """
    norm = np.linalg.norm
    size = norm(b, axis=0)
    tiny = size * np.finfo(float).eps + np.finfo(float).tiny
    live = size > 0
    x, w, w_old, v_old = (np.zeros_like(b) for _ in range(4))
    v = b / np.where(live, size, 1)
    beta, eta = np.zeros_like(size), size.copy()
    c_old, c, s_old, s = (np.ones_like(size), np.ones_like(size), np.zeros_like(size),
                          np.zeros_like(size))
    for _ in range(steps):
        if not live.any():
            break
        av = apply(v)
        alpha = (v * av).sum(axis=0)
        new = av - alpha * v - beta * v_old
        beta_new = norm(new, axis=0)
        delta = c * alpha - c_old * s * beta
        r1 = np.hypot(delta, beta_new)
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        live = live & (r1 > tiny)
        safe = np.where(live, r1, 1)
        w_new = (v - r3 * w_old - r2 * w) / safe
        c_old, c, s_old, s = c, np.where(live, delta / safe, 1), s, np.where(live, beta_new / safe, 0)
        x = x + np.where(live, c * eta, 0) * w_new
        eta = np.where(live, -s * eta, eta)
        w_old, w, v_old = w, w_new, v
        v = new / np.where(beta_new > tiny, beta_new, 1)
        live = live & (np.abs(eta) > left * size) & (beta_new > tiny)
        beta = beta_new
    return x


def _orthonormal(t: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """The directions of ``t`` that are new beside the (orthonormal) bases."""
    out = np.empty((len(t), 0))
    for column in t.T:
        v = column.copy()
        size = np.linalg.norm(v)
        for _ in range(3):
            for q in (*bases, out):
                v = v - q @ (q.T @ v)
        length = np.linalg.norm(v)
        if size > 0 and length > 1e-8 * size:
            v = v / length
            for q in (*bases, out):
                v = v - q @ (q.T @ v)
            out = np.concatenate([out, (v / np.linalg.norm(v))[:, None]], axis=1)
    return out


def eigenpairs(times: Callable[[np.ndarray], np.ndarray], dim: int, k: int,
               seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric operator, their unit vectors and residuals.

    ``times(block)`` gives the operator's product with a block of vectors.
    """
    k = min(k, dim)
    rng = np.random.default_rng(seed)
    most = min(dim, 8 * k)
    locked, locked_values, residuals = np.empty((dim, 0)), [], []
    basis = _orthonormal(rng.standard_normal((dim, min(dim, k + 4))))
    images = times(basis)
    fresh = False
    while True:
        h = basis.T @ images
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        scale = max([abs(v) for v in (*locked_values, *values[:1])], default=0.0)
        zero = ROUNDING * scale * np.sqrt(dim)
        gaps = images - basis * values
        gaps = gaps - locked @ (locked.T @ gaps)
        sizes = np.linalg.norm(gaps, axis=0)
        whole = locked.shape[1] + basis.shape[1] == dim
        wanted = min(k - len(locked_values), len(values))
        # a complete subspace with fresh products is as exact as double precision allows
        done = np.array([sizes[i] <= zero or (whole and fresh) for i in range(len(values))], dtype=bool)
        if whole and not fresh and not done[:wanted].all():
            images, fresh = times(basis), True
            continue
        fresh = False
        lock = [i for i in range(wanted) if done[i]]
        if lock:
            locked = np.concatenate([locked, basis[:, lock]], axis=1)
            locked_values += [float(values[i]) for i in lock]
            residuals += [float(sizes[i]) for i in lock]
            keep = [i for i in range(len(values)) if i not in lock]
            basis, images = basis[:, keep], images[:, keep]
            values, gaps, sizes = values[keep], gaps[:, keep], sizes[keep]
        if len(locked_values) >= k:
            # may a vector left out of the subspace, or not yet settled, still come before these?
            rival = len(values) and not whole and values[0] + sizes[0] > min(locked_values) + zero
            if not rival:
                break
            if values[0] > min(locked_values) and sizes[0] <= zero:
                drop = int(np.argmin(locked_values))
                out, image = locked[:, [drop]], locked[:, [drop]] * locked_values[drop]
                locked = np.delete(locked, drop, axis=1)
                basis, images = np.concatenate([basis, out], 1), np.concatenate([images, image], 1)
                del locked_values[drop], residuals[drop]
                continue
        if not len(values):
            basis = _orthonormal(rng.standard_normal((dim, min(dim - locked.shape[1], k))), locked)
            images = times(basis)
            continue
        if basis.shape[1] > most - k and locked.shape[1] + most < dim:
            basis, images = basis[:, :2 * k], images[:, :2 * k]
        # at least one target: the rival, once all wanted pairs are locked
        targets = np.flatnonzero(sizes[:max(1, k - len(locked_values))] > zero)
        u, theta = basis[:, targets], values[targets]

        def project(z: np.ndarray, u=u, locked=locked) -> np.ndarray:
            z = z - locked @ (locked.T @ z)
            return z - u * (u * z).sum(axis=0)

        right = project(-gaps[:, targets])
        steps = minres(lambda z, p=project, t=theta: p(times(z) - z * t), right, INNER_STEPS, INNER_LEFT)
        new = _orthonormal(project(steps), locked, basis)
        if not new.shape[1]:
            room = dim - locked.shape[1] - basis.shape[1]
            new = _orthonormal(rng.standard_normal((dim, min(room, k))), locked, basis)
        if new.shape[1]:
            basis, images = (np.concatenate([basis, new], axis=1),
                             np.concatenate([images, times(new)], axis=1))
    order = np.argsort(locked_values)[::-1][:k]
    return np.array(locked_values)[order], locked[:, order], np.array(residuals)[order]


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Each usable vector on the leading components of all of them, scaled to unit variance.

    Returns the id, component, n, deviation, whitened, explained, identity_error.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("vec_id", kind), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])
    blocks, path = written(packed(embeddings, vec_col), "whitening_blocks")
    rows = Products.of(blocks)
    if rows is None:
        discard(spark, path)
        return spark.createDataFrame([], schema)
    values, vectors, _ = eigenpairs(rows.times, rows.dim, components)
    trace = rows.trace()
    flat = values <= ROUNDING * rows.dim * max(values[0], 0.0)
    scaled = vectors / np.sqrt(np.where(flat, 1.0, values))
    explained = np.where(flat, 0.0, values / (trace if trace > 0 else 1.0))
    error = None
    if not flat.all():
        settled = scaled[:, ~flat]
        error = float(np.abs(rows.covariance(settled) - np.eye(settled.shape[1])).max())
    discard(spark, path)
    n, dim, whole, rest = rows.n, rows.dim, rows.whole, rows.rest
    shift = np.array([s - n * int(w) for s, w in zip(rows.sums, whole, strict=True)], dtype=np.int64)
    k, empty = len(values), flat

    def deviations(y: np.ndarray) -> list:
        """Sums of ``(n * y - shift) ** 2``, exact: in 64 bits where they fit."""
        if len(y) and dim * (float(n) * (float(np.abs(y).max()) + 1)) ** 2 < 2.0 ** 62:
            return ((n * y - shift) ** 2).sum(axis=1).tolist()
        exact = ((y.astype(object) * n - shift) ** 2).sum(axis=1)
        return [int(v) if v < 2 ** 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, found = vectors_of(batch.column(1))
            y = integers(found, dim) - whole
            w = (y.astype(np.float64) - rest) @ scaled
            m = len(y)
            ids = batch.column(0).take(pa.array(np.repeat(usable, k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)),
                 pa.array([v for v in deviations(y) for _ in range(k)], pa.int64()),
                 pa.array(w.ravel(), mask=np.tile(empty, m)), pa.array(np.tile(explained, m)),
                 pa.array([error] * (m * k), pa.float64())], names=schema.names)

    return embeddings.select(id_col, vec_col).mapInArrow(run, schema)
