"""Benchmark decontamination (operator 12).

Words are maximal runs of ASCII letters, digits and characters beyond ASCII,
A-Z in lower case. Every ``n`` consecutive words of a benchmark item are a
window; an item with fewer words is one window of its length. The windows make
a hash set that is broadcast: the words of the benchmark are numbered, and a
window is its numbers' polynomial hash. Documents are scanned whole: their words
become numbers, all their windows are hashed at once, and what the set holds is
verified number by number, so a hash never decides. A word inside any occurrence
of a window is hit.

:func:`scan` gives the hits of each text, :func:`remove_spans` cuts the hit
words out of the texts, :func:`remove_documents` drops the documents that have any.

What is broadcast at once comes from at most :data:`PART_BYTES` of benchmark
text. A larger benchmark is dealt into parts by a hash of its distinct rows, and
the documents are scanned once for each, their hits merged from written tables
in between; a single item is never divided.

Defined results for odd input: null and empty texts have no words, no hits and
stay as they are; items without a word have no window; repeated items count
once, items of equal text each; a null item id is listed as ``null``; rows of
documents are independent, so repeated rows and ids get equal results; very
long texts are read whole, in slices of words; an empty table gives an empty
result, an empty benchmark no hits. Further columns of any name pass through
:func:`remove_spans` and :func:`remove_documents`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm.common import discard, written

WINDOW = 10
#: Benchmark text behind one broadcast.
PART_BYTES = 8 * 2 ** 20
#: Bytes of text whose words are held at a time, and of texts scanned together.
SLICE_BYTES = 2 ** 20
#: Odd multipliers of the window hash; the next one is taken where two windows collide.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
FILTER_BITS = 20

#: Bytes of a text: lower case where it is part of a word, else a blank. All bytes of
#: characters beyond ASCII are 128 and more.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_WORD = re.compile(rb"[^ ]+")

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_HITS = pa.struct([("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])


def words_in(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def numbers(text: bytes | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The text's words by their numbers, -1 for words that the benchmark does not have."""
    parts = [np.fromiter(map(vocabulary.get, ws, repeat(-1)), np.int32, len(ws))
             for ws in words_in(text or b"")]
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def _hashes(ids: np.ndarray, n: int, multiplier: int) -> np.ndarray:
    """The hash of each window of ``n`` numbers."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    if len(out):
        wide = ids.astype(np.uint64)
        for k in range(n):
            out *= np.uint64(multiplier)
            out += wide[k:k + len(out)]
            out ^= out >> np.uint64(29)
    return out


@dataclass
class Windows:
    """All windows of one length: sorted hashes, their words, the items that have each."""

    n: int
    multiplier: int
    hashes: np.ndarray
    words: np.ndarray
    first_item: np.ndarray
    items: np.ndarray

    @classmethod
    def of(cls, n: int, rows: np.ndarray, owners: np.ndarray) -> Windows:
        """``rows`` holds a window in each row, ``owners`` the item of each."""
        unique, which = np.unique(rows, axis=0, return_inverse=True)
        for multiplier in MULTIPLIERS:
            hashes = np.array([_hashes(r, n, multiplier)[0] for r in unique], np.uint64)
            order = np.argsort(hashes, kind="stable")
            if not (np.diff(hashes[order]) == 0).any():
                break
        else:
            raise ValueError("windows collide under every multiplier")
        place = np.empty(len(unique), np.int64)
        place[order] = np.arange(len(unique))
        pairs = np.unique(np.stack([place[which.ravel()], owners], axis=1), axis=0)
        return cls(n, multiplier, hashes[order], unique[order],
                   np.searchsorted(pairs[:, 0], np.arange(len(unique) + 1)), pairs[:, 1])

    def __post_init__(self) -> None:
        self.filter = np.zeros(2 ** FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows occur among the numbers, and which."""
        hashes = _hashes(ids, self.n, self.multiplier)
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        which = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[which] == hashes[at]
        at, which = at[same], which[same]
        same = np.ones(len(at), bool)
        for k in range(self.n):
            same &= ids[at + k] == self.words[which, k]
        return at[same], which[same]


@dataclass
class Part:
    """The hash set of a part of the benchmark. Items are in the order of their names."""

    vocabulary: dict[bytes, int]
    items: list[str]
    windows: list[Windows]

    @classmethod
    def of(cls, rows: list[tuple[str, bytes]], n: int) -> Part:
        vocabulary: dict[bytes, int] = {}
        names = sorted({name for name, _ in rows})
        number = {name: i for i, name in enumerate(names)}
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for name, text in rows:
            ids = np.array([vocabulary.setdefault(w, len(vocabulary))
                            for ws in words_in(text) for w in ws], np.int32)
            if len(ids):
                size = min(n, len(ids))
                found = np.lib.stride_tricks.sliding_window_view(ids, size)
                by_length.setdefault(size, []).append((found, number[name]))
        windows = [Windows.of(size, np.concatenate([w for w, _ in found]),
                              np.concatenate([np.full(len(w), i) for w, i in found]))
                   for size, found in sorted(by_length.items())]
        return cls(vocabulary, names, windows)

    def find(self, texts: list[bytes | None]) -> list[dict]:
        """Number of words, hit spans (of word numbers) and items of each text."""
        ids = [numbers(t, self.vocabulary) for t in texts]
        # a number that no window has keeps windows inside their text
        flat = np.concatenate([x for one in ids for x in (one, [np.int32(-1)])]).astype(np.int32)
        sizes = np.array([len(one) for one in ids])
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        edges = np.zeros(len(flat) + 1, np.int64)
        owned = [np.empty((0, 2), np.int64)]
        for w in self.windows:
            at, which = w.find(flat)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + w.n, -1)
            text = np.searchsorted(starts, at, side="right") - 1
            pairs = np.unique(np.stack([text, which], axis=1), axis=0)
            counts = w.first_item[pairs[:, 1] + 1] - w.first_item[pairs[:, 1]]
            offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            found = w.items[np.repeat(w.first_item[pairs[:, 1]], counts) + offset]
            owned.append(np.stack([np.repeat(pairs[:, 0], counts), found], axis=1))
        change = np.diff(np.concatenate([[0], np.cumsum(edges) > 0]).astype(np.int8))
        first, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        out = [{"n_words": int(n), "spans": [], "items": []} for n in sizes]
        for a, b, t in zip(first, end, np.searchsorted(starts, first, side="right") - 1, strict=True):
            out[t]["spans"].append({"first": int(a - starts[t]), "end": int(b - starts[t])})
        for t, i in np.unique(np.concatenate(owned), axis=0):
            out[t]["items"].append(self.items[i])
        return out


def parts(benchmark: DataFrame, n: int, item_col: str, text_col: str,
          part_bytes: int) -> Iterator[Part]:
    """The benchmark's hash sets, one after another."""
    rows = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("name"),
        F.col(text_col).cast("binary").alias("text")).where("octet_length(text) > 0").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // part_bytes))
    for p in range(count):
        mine = rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == p)
        yield Part.of([(r.name, bytes(r.text)) for r in mine.collect()], n)


def merge(a: dict | None, b: dict) -> dict:
    """The hits of one text from two parts, as one."""
    if not a or not a["spans"]:
        return b
    spans: list[dict] = []
    for s in sorted(a["spans"] + b["spans"], key=lambda s: s["first"]):
        if spans and s["first"] <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], s["end"])
        else:
            spans.append(dict(s))
    return {"n_words": b["n_words"], "spans": spans, "items": sorted({*a["items"], *b["items"]})}


def _slices(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    taken: list[bytes | None] = []
    size = 0
    for t in texts:
        taken.append(t)
        size += len(t or b"")
        if size >= SLICE_BYTES:
            yield taken
            taken, size = [], 0
    if taken:
        yield taken


def hits(spark: SparkSession, part: Part, text: Column, earlier: Column) -> Column:
    """Hits of the part in a text, merged with those of earlier parts (or null)."""
    shared = spark.sparkContext.broadcast(part)

    @F.arrow_udf(HITS)
    def run(texts: pa.Array, before: pa.Array) -> pa.Array:
        found = [h for some in _slices(texts.to_pylist()) for h in shared.value.find(some)]
        if before.null_count < len(before):
            found = [merge(a, b) for a, b in zip(before.to_pylist(), found, strict=True)]
        return pa.array(found, _HITS)

    return run(text.cast("binary"), earlier)


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text_col: str = "text",
         item_col: str = "item_id", benchmark_text_col: str = "text", out: str = "hits",
         part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with a column ``out``: n_words, spans (first, end: numbers of words), items."""
    spark, path = docs.sparkSession, None
    found = docs.withColumn(out, F.lit(None).cast(HITS))
    for k, part in enumerate(parts(benchmark, n, item_col, benchmark_text_col, part_bytes)):
        if k:
            old = path
            found, path = written(found, "benchmark_hits")
            if old:
                discard(spark, old)
        found = found.withColumn(out, hits(spark, part, F.col(text_col), F.col(out)))
    return found


def n_hit(hits: Column) -> Column:
    """Words inside hit spans."""
    return F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])


def cut(text: bytes, spans: list[dict]) -> str:
    """The text without the words of the spans and what stands between them."""
    left, at, k = [], 0, 0
    begin = 0
    for i, word in enumerate(_WORD.finditer(text.translate(_FOLD))):
        if k < len(spans) and i == spans[k]["first"]:
            begin = word.start()
        if k < len(spans) and i == spans[k]["end"] - 1:
            left.append(text[at:begin])
            at, k = word.end(), k + 1
    left.append(text[at:])
    return b"".join(left).decode()


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents with hit words cut out of their texts; columns as in ``docs``."""
    @F.arrow_udf(T.StringType())
    def shorter(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([None if t is None else cut(t, s) if s else t.decode()
                         for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    found = scan(docs, benchmark, text_col=text_col, out="__hits", **options)
    text = F.col(f"`{text_col}`")
    spans = F.col("__hits")["spans"]
    clean = F.when(F.size(spans) > 0, shorter(text.cast("binary"), spans)).otherwise(text)
    return found.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit; columns as in ``docs``."""
    found = scan(docs, benchmark, out="__hits", **options)
    return found.where(F.size(F.col("__hits")["spans"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark, **options)
    h = F.col("hits")
    return found.select(
        "doc_id", h["n_words"].alias("n_words"), n_hit(h).alias("n_hit"),
        F.size(h["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(h["items"], ","), 256).alias("items_sha256"),
        (F.size(h["spans"]) > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH w AS (SELECT r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
           FROM (SELECT row_number() OVER () AS r, * FROM documents)),
i AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
b AS (SELECT DISTINCT item, len(g) AS n, array_to_string(g, ' ') AS g
      FROM (SELECT item, unnest(list_transform(range(1, greatest(len(ws) - 10, 0) + 2), lambda k: ws[k:k + 9])) AS g
            FROM i WHERE len(ws) > 0)),
g AS (SELECT r, n, unnest(range(1, len(ws) - n + 2)) AS k,
             unnest(list_transform(range(1, len(ws) - n + 2), lambda k: array_to_string(ws[k:k + n - 1], ' '))) AS g
      FROM w, (SELECT DISTINCT n FROM b) WHERE len(ws) >= n),
h AS (SELECT r, k, n, item FROM g JOIN b USING (n, g)),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS x FROM h) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (r) LEFT JOIN m USING (r)
"""
