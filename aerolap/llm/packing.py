"""Packed token rows (operator 1).

Documents are encoded, cut into segments of at most ``length`` tokens (an
overlong document is split without loss: full rows, then the rest), and the
segments are packed into rows of ``length`` by best-fit decreasing: longest
first, each into the fullest row that still has room. A segment tree over the
remaining capacities finds that row in logarithmic time.

A task packs what it reads, ``BUFFER_TOKENS`` tokens at a time, so nothing is
shuffled, memory does not depend on the task's input, and a lost task is
simply repeated. Rows are full but for the last few of each buffer.

Each packed row carries ``input_ids`` (one row of the id matrix: ``length``
little-endian unsigned 32-bit ids, padded with ``pad``), ``cu_seqlens``
(cumulative segment lengths, from 0), ``position_resets`` (where positions
start again from 0), and, per segment, the document's id and the token offset
of the segment in it.

Defined results: null and empty texts have no tokens and take no place;
repeated rows are packed each; a null id is carried as null; very long texts
are split like any other; an empty table gives no rows. Extra columns are not
read. Row ids name the task's partition and the row in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolap.llm.bpe import Vocabulary, text_slices

LENGTH = 2048
BUFFER_TOKENS = 1_000_000
SCHEMA = ("pack_id long, n_tokens int, n_segments int, doc_ids array<bigint>, "
          "token_offsets array<int>, cu_seqlens array<int>, position_resets array<int>, "
          "input_ids binary")
_ARROW = pa.schema([
    ("pack_id", pa.int64()), ("n_tokens", pa.int32()), ("n_segments", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())), ("token_offsets", pa.list_(pa.int32())),
    ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
    ("input_ids", pa.binary())])


class Capacities:
    """Open rows by remaining capacity, in a segment tree over 0..length."""

    def __init__(self, length: int):
        self._size = 1 << length.bit_length()
        self._open = [0] * (2 * self._size)  # open rows below each tree node
        self._rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, capacity: int, row: int) -> None:
        self._rows[capacity].append(row)
        i = capacity + self._size
        while i:
            self._open[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least capacity of at least ``need``, removed; or None."""
        i, tree = need + self._size, self._open
        if not tree[i]:
            # up to the first right sibling with an open row, then down to its left end
            while i > 1 and (i & 1 or not tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self._size:
                i <<= 1
                if not tree[i]:
                    i += 1
        capacity = i - self._size
        while i:
            tree[i] -= 1
            i >>= 1
        return capacity, self._rows[capacity].pop()


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Rows as lists of segment numbers; every length is between 1 and ``length``."""
    room, rows = Capacities(length), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = room.take(lengths[i])
        if found is None:
            found = (length, len(rows))
            rows.append([])
        capacity, row = found
        rows[row].append(i)
        if capacity > lengths[i]:
            room.put(capacity - lengths[i], row)
    return rows


def segments(n: int, length: int) -> list[tuple[int, int]]:
    """(offset, length) of the segments of a document of ``n`` tokens."""
    return [(at, min(length, n - at)) for at in range(0, n, length)]


def _pack(held: list[tuple[int, bytes]], length: int, pad: int, first_id: int):
    parts = [(doc, at, n, ids) for doc, ids in held for at, n in segments(len(ids) // 4, length)]
    filler = np.array([pad], "<u4").tobytes()
    cols: list[list] = [[] for _ in _ARROW.names]
    for row in best_fit_decreasing([p[2] for p in parts], length):
        ends = np.cumsum([0, *[parts[i][2] for i in row]])
        ids = b"".join(parts[i][3][4 * parts[i][1]:4 * (parts[i][1] + parts[i][2])] for i in row)
        values = (first_id + len(cols[0]), int(ends[-1]), len(row), [parts[i][0] for i in row],
                  [parts[i][1] for i in row], ends.tolist(), ends[:-1].tolist(),
                  ids + filler * (length - int(ends[-1])))
        for c, v in zip(cols, values):
            c.append(v)
    for at in range(0, len(cols[0]), 512):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[at:at + 512], f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _packer(vocabulary: Vocabulary, length: int, pad: int, buffer_tokens: int):
    def run(batches):
        bpe = vocabulary.bpe()
        next_id = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            for at, n in text_slices(batch.column(1)):
                part = batch.slice(at, n)
                for doc, ids in zip(part.column(0), bpe.encode_batch(part.column(1))):
                    if len(ids := ids.as_py()):
                        held.append((doc.as_py(), ids))
                        size += len(ids) // 4
                    if size >= buffer_tokens:
                        for out in _pack(held, length, pad, next_id):
                            next_id += out.num_rows
                            yield out
                        held, size = [], 0
            pa.default_memory_pool().release_unused()
        yield from _pack(held, length, pad, next_id)

    return run


def pack(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, pad: int = 0, buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """Packed rows of all documents (see :data:`SCHEMA`)."""
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        _packer(vocabulary, length, pad, buffer_tokens), SCHEMA)


def position_ids(cu_seqlens: Column) -> Column:
    """Positions of a packed row's tokens, from 0 in every segment."""
    return F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(cu_seqlens) - 1),
        lambda i: F.sequence(F.lit(0), F.element_at(cu_seqlens, i + 1)
                             - F.element_at(cu_seqlens, i) - 1)))


def write_packed(packed: DataFrame, path: str) -> str:
    """The packed rows as Parquet files; returns the path."""
    packed.write.parquet(path)
    return path
