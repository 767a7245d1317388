"""N-gram Jaccard join with set-relation skipping (operator 9).

A document's set holds its distinct ``k``-word shingles (ASCII letters lower
case, words are runs of characters other than ASCII white space). Two sets
link when ``100 * intersection >= percent * union``. The method follows
"Leveraging set relations in exact set similarity join" (Wang et al., 2017):
skip index entries block by block, and derive a set's answers from those of a
highly similar set.

1. *Equal sets* have equal answers: they form one class, of which one member
   goes on.
2. *Block index.* Shingle hashes are sorted; their positions are cut into
   blocks by hash range, more than ``H`` blocks where at most ``H`` shingles can
   differ between two linked sets of that size. So linked sets agree on a
   whole block, and the index lists classes by block content: two sets that
   agree on none are skipped without being compared. Sets are indexed by size
   class, and in the next one as well if a partner may lie there. Empty blocks
   and common shingles are dealt with in :class:`Blocks`; no pair is lost.
3. The lists join classes to *candidate groups*, which chance agreements make
   large. A group is *screened* first: of each set only the parities of its
   shingles in at most 16,384 bins are compared. Sets that differ in ``d`` bins
   differ by ``d`` shingles or more, so no link is lost, and what remains
   together are groups of sets that are nearly all linked.
4. Groups, in the screening and after it, are compared in blocks of bounded
   size: one task compares one block with another; blocks whose sizes rule
   out a link are skipped. No task holds a whole large group.
5. Inside a task, sets are taken in order of size. A set's overlaps with all
   others come from inverted lists, read only where sizes allow a link; if a
   set computed before is highly similar, its overlaps are copied instead and
   corrected for the few shingles by which the two sets differ.

All pairs of different sets that link are found, with exact counts (64-bit
shingle hashes; sets are told apart by 128 bits); only a spanning forest and
a count per class leave a task. Copies are never expanded.

Defined results: a text with 1 to k-1 words has one shingle, the sequence of
its words; a null text or one without words has an empty set, links with
nothing and is its own component; rows with a null id get a count of
shingles but no component and link with nothing; rows that share an id and a
text are copies of each other, rows that share an id only are judged each by
its own text; an empty table gives an empty result. Extra columns are not read. Very long texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolap.llm.common import discard, released, written
from aerolap.llm.components import components

#: A task compares at most two blocks of so many sets and shingles.
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 20
#: Screening compares blocks of so many sets, of at most so many bins a set (2 kB).
SCREEN_SETS = 4096
MAX_BINS = 1 << 14
#: Up to so many places of candidate sets (under 40 MB) are broadcast, more are joined by
#: shuffling.
BROADCAST_IDS = 200_000
_LEVELS = 3  # of hashes without common shingles, and then with them
#: Common shingles: in COMMON_IN sets or more of one sampled in SAMPLE; at most MAX_COMMON of
#: them (8 MB), the most frequent. They steer the index only; links do not depend on them.
SAMPLE = 8
COMMON_IN = 4
MAX_COMMON = 1_000_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33, _S32 = np.uint64(33), np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection)."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, k: int):
        self.k = k
        self._words: dict[bytes, int] = {}
        self._factors = _mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)

    def _hash(self, word: bytes) -> int:
        if len(self._words) > 200_000:
            self._words.clear()
        h = self._words[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self._words.get
        h = np.array([known(w) or self._hash(w) for w in words], np.uint64)
        width = min(self.k, len(words))
        total = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            total += h[i:len(h) - width + 1 + i] * self._factors[i]
        return np.unique(_mix(total))


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    a = _mix(tokens ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = _mix(tokens + np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def parities(tokens: np.ndarray) -> bytes:
    """For each bin whether it holds an odd number of the set's shingles, as bits.

    There is a bin or more for each shingle up to ``MAX_BINS``, a power of two, at least 64;
    a shingle's bin is its hash's low bits, so half as many bins are the xor of the halves.
    """
    bins = min(max(64, 1 << (len(tokens) - 1).bit_length()), MAX_BINS)
    held = np.bincount((_mix(tokens) & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").tobytes()


class Blocks:
    """Index keys of sets: the content of position blocks, by size class.

    Where linked sets can differ by ``h`` shingles, ``h + 1 + spare`` blocks
    agree on ``spare + 1`` at least. A set with at most ``spare`` empty blocks
    lists its others and is done; a set with more is listed again by another
    hash. Of two linked sets, either one is done at some level, and then they
    agree there on a block that is not empty, or both go on to the next; the
    last level lists empty blocks as well. Common shingles (any fixed set of
    them) are left out of the first levels' blocks, which only makes sets less
    different there, so that a block is selective.
    """

    def __init__(self, percent: int, common: np.ndarray | None = None):
        self.percent = percent
        self.common = np.empty(0, np.uint64) if common is None else common
        self._low = [1]

    def _class(self, n: int) -> int:
        """Size classes grow by the square of the largest ratio of linked sizes."""
        while self._low[-1] <= n:
            last = self._low[-1]
            self._low.append(max(last + 1, -(-last * 10_000 // self.percent ** 2)))
        return int(np.searchsorted(self._low, n, "right")) - 1

    def _rare(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return tokens
        at = np.searchsorted(self.common, tokens)
        at[at == len(self.common)] = 0
        return tokens[self.common[at] != tokens]

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        n = len(tokens)
        c = self._class(n)
        classes = [c]
        if 100 * n >= self.percent * self._low[c + 1]:
            self._class(self._low[c + 1])
            classes.append(c + 1)
        rare = self._rare(tokens)
        out = []
        for c in classes:
            differ = 2 * (self._low[c + 1] - 1) * (100 - self.percent) // (100 + self.percent)
            if not differ:
                continue  # equal sets only, and those are one class
            spare = 1 + (differ + 1) // 8
            blocks = differ + 1 + spare
            for level in range(2 * _LEVELS):
                content = rare if level < _LEVELS else tokens
                if level:
                    content = np.sort(_mix(content ^ np.uint64(level * 0x9E3779B97F4A7C15
                                                               % (1 << 64))))
                key, filled = self._level(content, blocks, (level << 56) + (c << 40))
                done = blocks - int(filled.sum()) <= spare
                out.append(key if level == 2 * _LEVELS - 1 and not done else key[filled])
                if done:
                    break
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    @staticmethod
    def _level(tokens: np.ndarray, blocks: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(tokens), dtype=np.uint64)])
        block = ((tokens >> _S32) * np.uint64(blocks)) >> _S32
        ends = np.searchsorted(block, np.arange(blocks + 1, dtype=np.uint64))
        content = sums[ends[1:]] - sums[ends[:-1]]
        key = _mix(content + _mix(np.arange(blocks, dtype=np.uint64) + np.uint64(salt)))
        return key, ends[1:] > ends[:-1]


# --- comparing inside a task ----------------------------------------------

def link(sets: list[np.ndarray], mult: np.ndarray, side: np.ndarray, percent: int
         ) -> tuple[np.ndarray, np.ndarray]:
    """Links of the sets and the first set of each one's local component.

    Counts each linked pair of different sets once per end, weighted by the
    partner's multiplicity. If ``side`` has two values, only pairs across count.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets = [sets[i] for i in order]
    mult, side = mult[order], side[order]
    m = len(sets)
    n = np.array([len(s) for s in sets])
    across = len(set(side.tolist())) > 1
    flat = np.concatenate(sets)
    _, token, df = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), n)
    by_token = np.argsort(token, kind="stable")  # within a token by size, as the sets are
    lists = owner[by_token]
    start = np.concatenate([[0], np.cumsum(df)])
    shared = df > 1
    ids = np.split(token, np.cumsum(n)[:-1])
    low = np.searchsorted(n, -(-n * percent // 100))          # sizes that may link
    high = np.searchsorted(n, n * 100 // percent, "right")

    def tally(tokens: np.ndarray, weight: int, into: np.ndarray, x: int) -> None:
        for t in tokens[shared[tokens]].tolist():
            entries = lists[start[t]:start[t + 1]]
            if entries[0] < low[x] or entries[-1] >= high[x]:  # skip what size rules out
                entries = entries[np.searchsorted(entries, low[x]):
                                  np.searchsorted(entries, high[x])]
            into[entries] += weight

    overlap = np.zeros((m, m), np.int32)
    best, like = np.zeros(m, np.int32), np.full(m, -1)  # the most similar set computed before
    parent = np.arange(m)
    links = np.zeros(m, np.int64)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x in range(m):
        row = overlap[x]
        y = like[x]
        if (y >= 0 and n[x] + n[y] - 2 * best[x] < n[x] // 2
                and low[x] >= low[y] and high[x] <= high[y]):
            row[:] = overlap[y]
            tally(np.setdiff1d(ids[y], ids[x], assume_unique=True), -1, row, x)
            tally(np.setdiff1d(ids[x], ids[y], assume_unique=True), 1, row, x)
        else:
            tally(ids[x], 1, row, x)
        row[:low[x]] = 0
        row[high[x]:] = 0
        closer = row > best
        closer[:x + 1] = False
        best[closer] = row[closer]
        like[closer] = x
        linked = 100 * row.astype(np.int64) >= percent * (n[x] + n - row)
        linked[x] = False
        if across:
            linked &= side != side[x]
        partners = np.flatnonzero(linked)
        links[x] = mult[partners].sum()
        a = root(x)
        for p in partners[partners > x].tolist():
            b = root(p)
            if a != b:
                a, b = min(a, b), max(a, b)
                parent[b] = a
    first = np.array([root(i) for i in range(m)])
    out_links, out_first = np.zeros(m, np.int64), np.zeros(m, np.int64)
    out_links[order] = links
    out_first[order] = order[first]
    return out_links, out_first


def may_link(bits: list[bytes], n: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """The first set of each one's local component, where sets join that :func:`parities`
    do not rule out as linked. If ``side`` has two values, only pairs across count."""
    m = len(bits)
    order = np.argsort(n, kind="stable")
    n, side = n[order], side[order]
    across = len(set(side.tolist())) > 1
    words = [np.frombuffer(bits[i], "<u8") for i in order]
    width = np.array([len(w) for w in words])  # grows with the size
    high = np.searchsorted(n, n * 100 // percent, "right")
    label = np.arange(m)
    for w in np.unique(width).tolist():
        start, stop = np.searchsorted(width, [w, w + 1])
        end = high[stop - 1]
        folded = np.stack([np.bitwise_xor.reduce(words[i].reshape(-1, w), axis=0)
                           for i in range(start, end)])
        for x in range(start, stop):
            mine, others = folded[x - start], folded[x + 1 - start:high[x] - start]
            differ = np.bitwise_count(others ^ mine).sum(axis=1, dtype=np.int64)
            both = n[x] + n[x + 1:high[x]]
            near = 100 * (both - differ) >= percent * (both + differ)
            if across:
                near &= side[x + 1:high[x]] != side[x]
            met = label[x + 1:high[x]][near]
            if (met != label[x]).any():
                joined = np.unique(np.append(met, label[x]))
                label[np.isin(label, joined)] = joined[0]
    first = np.zeros(m, np.int64)
    first[order] = order[label]
    return first


def _by_unit(cols: dict) -> dict:
    """Rows of each comparison of a task, by its group and blocks; a class counts once."""
    units: dict = {}
    for i in range(len(cols["grp"])):
        key = (cols["grp"][i], cols["first"][i], cols["second"][i])
        units.setdefault(key, {})[cols["f1"][i], cols["f2"][i]] = i
    return {key: list(rows.values()) for key, rows in units.items() if len(rows) > 1}


def _screen(percent: int):
    def run(group: pa.Table) -> pa.Table:
        cols = group.to_pydict()
        rep, other = [], []
        for (_, a, b), rows in _by_unit(cols).items():
            first = may_link([cols["bins"][i] for i in rows],
                             np.array([cols["n"][i] for i in rows], np.int64),
                             np.array([cols["block"][i] for i in rows]) if a != b
                             else np.zeros(len(rows), np.int64), percent)
            for i, f in zip(rows, first.tolist()):
                if i != rows[f]:
                    rep.append(cols["rep"][i])
                    other.append(cols["rep"][rows[f]])
        return pa.table({"rep": pa.array(rep, pa.int64()), "other": pa.array(other, pa.int64())})

    return run


def _compare(percent: int):
    def run(group: pa.Table) -> pa.Table:
        cols = group.to_pydict()
        rep, other, links = [], [], []
        for (_, a, b), rows in _by_unit(cols).items():
            found, first = link(
                [np.frombuffer(cols["tokens"][i], "<u8") for i in rows],
                np.array([cols["mult"][i] for i in rows], np.int64),
                np.array([cols["block"][i] for i in rows]) if a != b
                else np.zeros(len(rows), np.int64), percent)
            for i, n, f in zip(rows, found.tolist(), first.tolist()):
                if n:
                    rep.append(cols["rep"][i])
                    other.append(cols["rep"][rows[f]])
                    links.append(n)
        return pa.table({"rep": pa.array(rep, pa.int64()), "other": pa.array(other, pa.int64()),
                         "links": pa.array(links, pa.int64())})

    return run


# --- the join -------------------------------------------------------------

def _sets(k: int):
    def run(batches):
        shingles = Shingler(k)
        for batch in batches:
            ids, texts = batch.columns
            n, f1, f2, bins = [], [], [], []
            for t in texts:
                s = shingles(t.as_py())
                a, b = fingerprint(s) if len(s) else (None, None)
                n.append(len(s))
                f1.append(a)
                f2.append(b)
                bins.append(parities(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                 pa.array(f2, pa.int64()), pa.array(bins, pa.binary())],
                ["doc_id", "n_shingles", "f1", "f2", "bins"])

    return run


def _shingles(k: int):
    def run(batches):
        shingles = Shingler(k)
        for batch in batches:
            for t in batch.column(0):
                s = shingles(t.as_py())
                if len(s):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s.view(np.int64)),
                         pa.array(np.full(len(s), fingerprint(s)[0], np.int64))],
                        ["shingle", "node"])

    return run


def _common(rows: DataFrame, k: int) -> np.ndarray:
    """The common shingles, sorted."""
    sampled = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("common")), F.lit(SAMPLE)) == 0)
    counts = (sampled.select("text").mapInArrow(_shingles(k), "shingle long, node long")
              .distinct().groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= COMMON_IN))
    top = counts.orderBy(F.desc("n"), "shingle").limit(MAX_COMMON).select("shingle").collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def _index(k: int, percent: int, common):
    def run(batches):
        shingles, blocks = Shingler(k), Blocks(percent, common.value)
        seen: set[tuple[int, int]] = set()  # equal sets of one task are listed once
        for batch in batches:
            keys, nodes = [], []
            for t in batch.column(0):
                s = shingles(t.as_py())
                if not len(s):
                    continue
                mark = fingerprint(s)
                if mark in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(mark)
                got = blocks.keys(s).view(np.int64)
                keys.append(got)
                nodes.append(np.full(len(got), mark[0], np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))],
                    ["block_key", "node"])

    return run


def _tokens(k: int):
    """Replaces the text (last column) by the set; rows whose set is not the class's go."""
    def run(batches):
        shingles = Shingler(k)
        for batch in batches:
            names = batch.schema.names[:-1]
            got = [shingles(t.as_py()) for t in batch.column("text")]
            same = [len(s) > 0 and fingerprint(s) == (a.as_py(), b.as_py())
                    for s, a, b in zip(got, batch.column("f1"), batch.column("f2"))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names],
                 pa.array([s.tobytes() for s in got], pa.binary())],
                [*names, "tokens"]).filter(pa.array(same))

    return run


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
         percent: int = 90, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links.

    ``n_links`` counts the other rows that link directly, copies included. The options
    are those of :func:`linked_classes`.
    """
    members, named = linked_classes(docs, id_col, text_col, k, percent, **options)
    same = (members["f1"] == named["f1"]) & (members["f2"] == named["f2"])
    return members.join(named, same & members["doc_id"].isNotNull(), "left").select(
        "doc_id", "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _units(candidates: DataFrame, percent: int, block_sets: int, block_size: int, size: str
           ) -> tuple[DataFrame, str]:
    """The comparisons of candidate groups: ``candidates`` with their ``block`` and the
    unit (a task's bundle of comparisons) and the two blocks (first, second) of each
    comparison that the block takes part in.

    Blocks lie in size classes of the group, at most about ``block_sets`` sets and
    ``block_size`` of the column ``size`` in each. Also the path of what was written.
    """
    ratio = float(np.log(100 / percent))
    candidates = candidates.withColumn("bucket", F.floor(F.log("n") / ratio).cast("int"))
    per = candidates.groupBy("grp", "bucket").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_sets),
                   F.ceil(F.sum(size) / block_size)).cast("int").alias("parts"),
        F.count(F.lit(1)).alias("sets"), F.sum(size).alias("total"))
    whole = per.groupBy("grp").agg(F.sum("sets").alias("sets"), F.sum("total").alias("total"))
    small = (F.col("sets") <= block_sets) & (F.col("total") <= block_size)
    sizes, sizes_path = written(
        per.join(whole.select("grp", small.alias("small")), "grp").select(
            "grp", "bucket", "parts", "small"), "jaccard_sizes")
    blocks = sizes.select("grp", "small", "bucket", F.when(F.col("small"), F.array(F.lit(0)))
                          .otherwise(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    blocks = (blocks.select("grp", "small", F.when(F.col("small"), 0).otherwise(F.col("bucket"))
                            .alias("bucket"), F.explode("part").alias("part")).distinct()
              .withColumn("block", F.col("bucket").cast("long") * (1 << 32) + F.col("part")))
    left = blocks.select("grp", "small", F.col("bucket").alias("b1"), F.col("block").alias("first"))
    right = blocks.select("grp", F.col("bucket").alias("b2"), F.col("block").alias("second"))
    # buckets further apart than one differ too much in size
    near = left.join(right, "grp").where("first <= second AND b2 - b1 <= 1")
    n_sets, n_total = candidates.agg(F.count(F.lit(1)), F.sum(size)).first()
    bundles = max(1, -(-n_sets // block_sets), -(-(n_total or 0) // block_size))
    unit = F.when(F.col("small"), F.pmod(F.xxhash64("grp"), F.lit(bundles))).otherwise(
        F.xxhash64("grp", "first", "second"))
    units = near.select("grp", "first", "second", unit.alias("unit"))
    units = units.select("grp", "first", "second", "unit", F.col("first").alias("block")).union(
        units.where("first <> second").select("grp", "first", "second", "unit",
                                              F.col("second").alias("block")))
    parted = candidates.join(sizes, ["grp", "bucket"]).select(
        *candidates.drop("bucket").columns, F.when(F.col("small"), 0).otherwise(
            F.col("bucket").cast("long") * (1 << 32)
            + F.pmod(F.xxhash64("rep"), F.col("parts"))).alias("block"))
    return parted.join(units, ["grp", "block"]), sizes_path


def linked_classes(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int,
                   block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES,
                   broadcast_ids: int = BROADCAST_IDS, screen_sets: int = SCREEN_SETS
                   ) -> tuple[DataFrame, DataFrame]:
    """The documents with their sets' fingerprints, and the classes with their components.

    First (doc_id, n_shingles, f1, f2) per document; then per class f1, f2, least_id,
    component_id, n_links, and ``leads`` for one class of each component: of those that have
    the smallest id the one with the smallest fingerprint.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    members, _ = written(rows.mapInArrow(
        released(_sets(k)), "doc_id long, n_shingles long, f1 long, f2 long, bins binary"),
        "jaccard_members")
    # a class is known by a number of its own (``rep``): classes of different texts may
    # share their smallest id
    classes, classes_path = written(
        members.where("f1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("f1", "f2").agg(
            F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("mult"),
            F.first("n_shingles").alias("n"), F.first("bins").alias("bins"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "jaccard_classes")

    # a key's list is linked through its smallest class; a list has at most one
    # row per class and task, and every set has many keys, so no list is a
    # large part of all rows
    known = rows.where("doc_id IS NOT NULL")
    common = spark.sparkContext.broadcast(_common(known, k))
    index = known.select("text").mapInArrow(
        released(_index(k, percent, common)), "block_key long, node long")
    listed = index.select("node", F.expr("min(node) OVER (PARTITION BY block_key)").alias("least"))
    pairs = listed.where("node <> least").distinct()
    groups = components(pairs.select("least", "node"))
    listed_sets, listed_path = written(
        classes.join(groups.withColumnRenamed("component", "grp"),
                     classes["f1"] == F.col("node")).drop("node"), "jaccard_listed")
    common.destroy()

    screens, screen_path = _units(listed_sets.withColumn("size", F.octet_length("bins")), percent,
                                  screen_sets, screen_sets * MAX_BINS // 8, "size")
    near, near_path = written(
        screens.select("rep", "f1", "f2", "n", "bins", "grp", "first", "second", "block", "unit")
        .groupBy("unit").applyInArrow(_screen(percent), "rep long, other long"), "jaccard_near")
    candidates, candidates_path = written(
        listed_sets.drop("grp", "bins").join(
            components(near).withColumnRenamed("component", "grp"),
            F.col("rep") == F.col("node")).drop("node"), "jaccard_candidates")
    discard(spark, listed_path, screen_path, near_path)

    compared, sizes_path = _units(candidates, percent, block_sets, block_shingles, "n")
    places, places_path = written(
        compared.groupBy("rep", "least_id", "mult", "f1", "f2", "block").agg(
            F.collect_list(F.struct("unit", "grp", "first", "second")).alias("units")),
        "jaccard_places")
    n_places = places.agg(F.sum(F.size("units"))).first()[0] or 0
    texts = rows.join(F.broadcast(places) if n_places <= broadcast_ids else places,
                      rows["doc_id"] == places["least_id"]).select(
        "rep", "mult", "f1", "f2", "block", "units", "text")
    sets = texts.mapInArrow(
        released(_tokens(k)), texts.drop("text").schema.add("tokens", "binary"))
    found, _ = written(
        sets.select("rep", "mult", "f1", "f2", "block", "tokens", F.inline("units"))
        .groupBy("unit").applyInArrow(_compare(percent), "rep long, other long, links long"),
        "jaccard_links")
    discard(spark, candidates_path, sizes_path, places_path)

    linked = components(found.select("rep", "other"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    placed, placed_path = written(
        classes.join(counts, "rep", "left")
        .join(linked.withColumnRenamed("node", "rep"), "rep", "left")
        .select("f1", "f2", "least_id", F.coalesce("component", "rep").alias("component"),
                (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "jaccard_placed")
    heads = placed.groupBy("component").agg(F.min(F.struct("least_id", "f1", "f2")).alias("head"))
    named, _ = written(
        placed.join(heads, "component").select(
            "f1", "f2", "least_id", F.col("head.least_id").alias("component_id"), "n_links",
            (F.struct("least_id", "f1", "f2") == F.col("head")).alias("leads")), "jaccard_named")
    discard(spark, classes_path, placed_path)
    return members, named


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
             percent: int = 80, **options) -> DataFrame:
    """One document of each component (the smallest id); columns as in ``docs``.

    Rows without words or without an id stay. Rows that share an id are told apart by
    their texts: of rows equal in both one stays, others are each kept or not by
    their own component.
    """
    members, named = linked_classes(docs, id_col, text_col, k, percent, **options)
    heads = named.where("leads").select("f1", "f2", F.col("least_id").alias("__head"))
    known = members.where("doc_id IS NOT NULL")
    n, ids = known.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    nameless = docs.where(docs[id_col].isNull())
    if n == ids:
        stay, _ = written(heads.select("__head").union(
            known.where("f1 IS NULL").select("doc_id")), "jaccard_kept")
        return docs.join(stay, docs[id_col].cast("long") == F.col("__head"),
                         "left_semi").unionByName(nameless)

    # repeated ids: the text of each row decides, by its set
    @F.arrow_udf("struct<f1 long, f2 long>")
    def mark(texts: pa.Array) -> pa.Array:
        shingles = Shingler(k)
        marks = [fingerprint(s) if len(s) else (None, None) for s in map(shingles, texts.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([m[i] for m in marks], pa.int64()) for i in (0, 1)], ["f1", "f2"])

    marked, _ = written(docs.where(docs[id_col].isNotNull()).withColumn(
        "__mark", mark(F.col(f"`{text_col}`"))), "jaccard_marked")
    own = ((marked[id_col].cast("long") == heads["__head"])
           & (marked["__mark"]["f1"] == heads["f1"]) & (marked["__mark"]["f2"] == heads["f2"]))
    stay = marked.join(heads, own, "left_semi").dropDuplicates([id_col, "__mark"])
    wordless = marked.where(marked["__mark"]["f1"].isNull())
    return stay.unionByName(wordless).drop("__mark").unionByName(nameless)
