"""Merkle manifest of a dataset (operator 13).

Every row is a leaf: the digest of its fields. Per source, the leaves in order
of their ids are hashed together in runs of :data:`ARITY` until one node, the
source's subroot, is left; the subroots, in order of the sources, give the
root in the same way.

The levels are built bottom up and stored as parent-linked rows, one per run:
the digests of the run's nodes, and the run and place of the node they become.
A recursive query then climbs from each leaf to the root: it appends the
siblings of each run to the leaf's proof and folds the leaf's own digest (of
the tampered row, where there is one) with them. It climbs in two queries,
since leaves below one node share the rest of the way: the first climbs
:data:`PACK_LEVELS` levels leaf by leaf, the second carries the at most
``ARITY ** PACK_LEVELS`` leaves that have met in a node as one row, so that
what moves per level and leaf is little more than its digest.

``H(x, y, ...)`` is the lowercase hex SHA-256 of the inputs, concatenated;
digests count as hex text. A field is ``-`` if null, else its length in UTF-8
bytes, ``:``, and its value.

Positions come from a sort by ranges whose partitions are counted, so that no
task holds a whole source, and equal rows may be dealt over many tasks.
Defined results for odd input: null ids come first in their source and are
never tampered with; rows of equal id are ordered by their leaf, and equal
rows are as many leaves; null and empty texts are leaves like others; a null
source is a source of its own, the first one; with a single source its subroot
is the root; the proof of a leaf without siblings is the digest of nothing; an
empty table gives an empty result. Columns that are not fields are ignored.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolap.llm.common import discard, written

ARITY = 3
PACK_LEVELS = 3
#: Levels of so few nodes are made by one task, without an exchange.
SMALL = 30_000
#: Leaves or nodes that a task writes at least; so few runs are sent to the packs that climb them.
FILE_ROWS = 10_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree above the subroots; the sources' trees are numbered from 0.
TOP = -1
_NONE = "X''"


def field_text(value: Column) -> Column:
    """``-`` for null, else byte length, ``:``, value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The leaf of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in columns]), 256))


def tampered(doc_id: Column) -> Column:
    """Is the row with this id one that the check tampers with?"""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def numbered(df: DataFrame, group: str, order: Sequence[Column], name: str
             ) -> tuple[DataFrame, DataFrame, str]:
    """Rows with ``_row``, and where each group's rows start among them.

    Sorted by group and ``order`` over ranges, ``_row`` rises by one inside a
    partition. The second table has, for each group and partition, ``_first``
    (its first ``_row``), ``_offset`` (rows of the group before it) and ``_n``
    (rows of the group): a row's place is ``_row - _first + _offset``.
    """
    keys = [F.col(group).asc_nulls_first(), *order, F.col("_tie")]
    rows, path = written(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id()).drop("_tie"), name)
    blocks = rows.groupBy(group, F.shiftright("_row", 33).alias("_block")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_count"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        group, "_block", "_first", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"),
        F.sum("_count").over(whole).alias("_n"))
    return rows, starts, path


def _dealt(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of or made from about ``rows`` rows, over no more tasks than these need."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def _next(tree: Column, level: Column, pos: Column, n: Column, n_trees: int) -> list[Column]:
    """Tree, level, run and place in the run of node ``pos`` of a level with ``n`` nodes.

    The last node of a source's tree goes on as a leaf of the top tree; the
    root has no run.
    """
    last = n == 1
    end = last & ((tree == TOP) | F.lit(n_trees == 1))
    node = F.when(last, tree).otherwise(pos)
    return [F.when(end, None).otherwise(F.when(last, F.lit(TOP)).otherwise(tree)).cast("long").alias("tree"),
            F.when(end, None).otherwise(F.when(last, F.lit(0)).otherwise(level)).cast("int").alias("level"),
            F.when(end, None).otherwise(F.floor(node / ARITY)).cast("long").alias("run"),
            F.when(end, None).otherwise(node % ARITY).cast("int").alias("place")]


def _levels(nodes: DataFrame, total: int, largest: int, n_trees: int
            ) -> list[tuple[DataFrame, str, int]]:
    """The runs of each level above the ``total`` ``nodes`` (tree, pos, digest, n), written,
    their path, and how many they are at most.

    A run: its tree, level and number, its nodes' digests, its own digest, the
    number of nodes of its level, and where it goes on.
    """
    levels, level = [], 0
    while largest > 1:
        place = F.col("pos") % ARITY
        if total <= SMALL:  # one task has them all, without an exchange
            nodes = nodes.coalesce(1)
        runs = nodes.where("n > 1").groupBy("tree", F.floor(F.col("pos") / ARITY).alias("run")).agg(
            *[F.coalesce(F.max(F.when(place == i, F.col("digest"))), F.expr(_NONE)).alias(f"c{i}")
              for i in range(ARITY)], F.ceil(F.max("n") / ARITY).alias("n"))
        digest = F.unhex(F.sha2(_hex(F.concat(*[f"c{i}" for i in range(ARITY)])), 256))
        goes = [c.alias(f"next_{k}") for c, k in zip(
            _next(F.col("tree"), F.lit(level + 1), F.col("run"), F.col("n"), n_trees),
            ("tree", "level", "run", "place"), strict=True)]
        runs, path = written(_dealt(runs.select(
            "tree", F.lit(level).alias("level"), "run", *[f"c{i}" for i in range(ARITY)],
            digest.alias("digest"), "n", *goes), total), f"merkle_level_{level}")
        # every run but a tree's last one is full, and no run has a lone node of a whole tree
        total, largest = min(total, total // ARITY + n_trees), -(-largest // ARITY)
        levels.append((runs, path, total))
        nodes, level = runs.select("tree", F.col("run").alias("pos"), "digest", "n"), level + 1
    return levels


_CLIMB = """
WITH RECURSIVE climb({columns}) AS (
  SELECT {columns} FROM {{start}}
  UNION ALL
  SELECT {hint} {key}, r.next_tree, r.next_level, r.next_run, r.next_place, {step}
  FROM (SELECT * FROM climb WHERE {going}) c
  JOIN (SELECT *, {before} AS before, {after} AS after
        FROM {{runs}} LATERAL VIEW explode(sequence(0, {last})) AS place) r
    ON r.tree = c.tree AND r.level = c.level AND r.run = c.run AND r.place = c.place)
SELECT * FROM climb WHERE NOT coalesce({going}, false)
"""
_BEFORE = ("CASE place " + " ".join(
    f"WHEN {p} THEN concat({', '.join([_NONE, *[f'c{i}' for i in range(p)]])})"
    for p in range(ARITY)) + " END")
_AFTER = ("CASE place " + " ".join(
    f"WHEN {p} THEN concat({', '.join([_NONE, *[f'c{i}' for i in range(p + 1, ARITY)]])})"
    for p in range(ARITY)) + " END")
_FOLD = "unhex(sha2(lower(hex(concat(r.before, {0}, r.after))), 256))"


@contextlib.contextmanager
def _unlimited(spark: SparkSession):
    """A recursive query may return as many rows as there are."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def climb(start: DataFrame, runs: DataFrame, key: str, values: Sequence[str],
          step: Sequence[str], going: str, total: int, n_runs: int, name: str,
          gather: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, str]:
    """Rows of ``start``, which stand for ``total`` leaves, carried up the (at most)
    ``n_runs`` runs by a recursive query while ``going`` holds; written after ``gather``."""
    columns = [key, "tree", "level", "run", "place", *values]
    query = _CLIMB.format(columns=", ".join(columns), key=f"c.{key}", step=", ".join(step),
                          hint="/*+ BROADCAST(r) */" if n_runs <= FILE_ROWS else "",
                          going=going, before=_BEFORE, after=_AFTER, last=ARITY - 1)
    spark = start.sparkSession
    with _unlimited(spark):
        return written(_dealt(gather(spark.sql(query, start=start, runs=runs)), total), name)


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             fields: Sequence[str] = FIELDS, text_col: str = "text",
             tamper: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root that the check recomputes.

    Where ``tamper`` holds (default: :func:`tampered` of the id), the check folds
    the leaf of the row whose text has lost its ``\\n`` characters. Returns
    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and
    n_siblings, the number of digests in the proof.
    """
    spark = docs.sparkSession
    touched = tampered(F.col(id_col)) if tamper is None else tamper
    leaf = leaf_digest([F.col(c) for c in fields])
    other = leaf_digest([F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text_col else F.col(c)
                         for c in fields])
    altered = touched & F.coalesce(F.instr(F.col(text_col), "\n") > 0, F.lit(False))
    rows, starts, rows_path = numbered(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    leaf.alias("leaf"), F.when(altered, other).alias("altered")),
        "source", [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "merkle_leaves")
    starts, starts_path = written(starts, "merkle_blocks")

    sources, firsts, sources_path = numbered(
        starts.groupBy("source").agg(F.first("_n").alias("n")).withColumn("_all", F.lit(0)),
        "_all", [F.col("source").asc_nulls_first()], "merkle_sources")
    trees = sources.join(firsts, F.shiftright(sources["_row"], 33) == firsts["_block"]).select(
        F.col("source").alias("_source"), "n", (F.col("_row") - F.col("_first") + F.col("_offset"))
        .alias("tree"))
    trees, trees_path = written(trees, "merkle_trees")
    n_trees, largest, total = trees.agg(
        F.count(F.lit(1)), *[F.coalesce(f("n"), F.lit(0)) for f in (F.max, F.sum)]).first()

    places = starts.join(trees, starts["source"].eqNullSafe(trees["_source"])).select(
        F.col("source").alias("_source"), "_block", "_first", "_offset", "tree", "n")
    leaves, leaves_path = written(
        rows.join(places, rows["source"].eqNullSafe(places["_source"])
                  & (F.shiftright(rows["_row"], 33) == places["_block"])).select(
            F.col("_row").alias("leaf_no"), "doc_id", "leaf", "altered", "tree",
            (F.col("_row") - F.col("_first") + F.col("_offset")).alias("pos"), "n"), "merkle_placed")
    discard(spark, rows_path, starts_path, sources_path)

    built = _levels(leaves.select("tree", "pos", F.col("leaf").alias("digest"), "n"), total, largest,
                    n_trees)
    # subroots: the one node left of a tree, or its lone leaf
    subroots = leaves.where("n = 1").select("tree", F.col("leaf").alias("digest"))
    for runs, *_ in built:
        subroots = subroots.union(runs.where("n = 1").select("tree", "digest"))
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest",
                          F.lit(n_trees).cast("long").alias("n"))
    above = _levels(top, n_trees, n_trees, n_trees)
    ends = above[-1][0].select("digest") if above else subroots.select("digest")
    root = F.lit(next((bytes(r.digest) for r in ends.take(1)), None)).cast("binary")

    goes = _next(F.col("tree"), F.lit(0), F.col("pos"), F.col("n"), n_trees)
    first = leaves.select("leaf_no", *goes, F.coalesce("altered", "leaf").alias("fold"),
                          F.expr(_NONE).alias("path"))

    def stored(levels: list[tuple[DataFrame, str, int]]) -> DataFrame:
        if not levels:  # no level at all: runs that nothing joins
            return leaves.where("false").selectExpr(
                "tree", "0 AS level", "pos AS run", *[f"leaf AS c{i}" for i in range(ARITY)],
                "leaf AS digest", "n", "tree AS next_tree", "0 AS next_level", "pos AS next_run",
                "0 AS next_place")
        return spark.read.schema(levels[0][0].schema).parquet(*[p for _, p, _ in levels])

    low_levels, high_levels = built[:PACK_LEVELS], built[PACK_LEVELS:] + above
    packs, packs_path = climb(
        first, stored(low_levels), "leaf_no", ["fold", "path"],
        [_FOLD.format("c.fold"), "concat(c.path, r.before, r.after)"],
        f"tree >= 0 AND level < {PACK_LEVELS}", total, sum(n for *_, n in low_levels), "merkle_packs",
        lambda low: low.groupBy("tree", "level", "run", "place").agg(
            F.min("leaf_no").alias("pack"),
            F.collect_list(F.struct("leaf_no", "fold", "path")).alias("leaves")))
    start = packs.select("pack", "tree", "level", "run", "place", F.col("leaves.fold").alias("folds"),
                         F.expr(_NONE).alias("path"), F.lit(None).cast("binary").alias("subroot"))
    here = "CASE c.place " + " ".join(f"WHEN {i} THEN r.c{i}" for i in range(ARITY)) + " END"
    high, high_path = climb(
        start, stored(high_levels), "pack", ["folds", "path", "subroot"],
        [f"transform(c.folds, f -> {_FOLD.format('f')})", "concat(c.path, r.before, r.after)",
         f"CASE WHEN c.tree = {TOP} AND c.level = 0 THEN {here} ELSE c.subroot END"],
        "tree IS NOT NULL", total, sum(n for *_, n in high_levels), "merkle_high")
    ended = packs.select("pack", "leaves").join(high.select("pack", "folds", "path", "subroot"), "pack")
    ended = ended.select(F.explode(F.arrays_zip("leaves", "folds")).alias("leaf"), "path", "subroot")
    proof = F.concat("leaf.leaves.path", "path")
    ended = ended.select(
        F.col("leaf.leaves.leaf_no").alias("_leaf_no"), F.sha2(_hex(proof), 256).alias("proof_sha256"),
        F.floor(F.octet_length(proof) / 32).cast("int").alias("n_siblings"),
        F.col("leaf.folds").alias("folded"), "subroot")
    out, _ = written(leaves.join(ended, leaves["leaf_no"] == ended["_leaf_no"]).select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.coalesce("subroot", root)).alias("subroot"),
        _hex(root).alias("root"), "proof_sha256", _hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == root).alias("verified"), "n_siblings"), "merkle_manifest")
    discard(spark, leaves_path, trees_path, packs_path, high_path,
            *[p for _, p, _ in built + above])
    return out


ORACLE_SQL = """
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, *, source AS s FROM documents),
f AS (SELECT r, doc_id, s, text,
             list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
                            lambda x: coalesce(strlen(x)::VARCHAR || ':' || x, '-')) AS head,
             replace(text, chr(10), '') AS cut FROM d),
h AS (SELECT r, doc_id, s, sha256(array_to_string(head, '') || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
             sha256(array_to_string(head, '') || coalesce(strlen(cut)::VARCHAR || ':' || cut, '-')) AS other,
             list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(doc_id::VARCHAR) + 1),
                                                              lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
                         lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                           lambda x, _: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))) AS crc FROM f),
leaves AS (SELECT r, doc_id, s, leaf, CASE WHEN crc % 2 = 1 THEN other ELSE leaf END AS start,
                  row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY s) AS n FROM h),
trees AS (SELECT s, row_number() OVER (ORDER BY s NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT s FROM h)),
up(tree, level, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM leaves JOIN trees ON leaves.s IS NOT DISTINCT FROM trees.s
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM up WHERE n > 1 GROUP BY tree, level, pos // 3, n),
subs AS (SELECT tree, h AS subroot FROM up WHERE n = 1),
top(level, pos, n, h) AS (
  SELECT 0, tree, (SELECT count(*) FROM trees), subroot FROM subs
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
runs AS (SELECT tree, level, pos // 3 AS run, n, list(h ORDER BY pos) AS hs FROM up WHERE n > 1 GROUP BY ALL
         UNION ALL SELECT -1, level, pos // 3, n, list(h ORDER BY pos) FROM top WHERE n > 1 GROUP BY ALL),
climb(r, tree, level, pos, n, fold, proof) AS (
  SELECT r, tree, 0, pos, n, start, '' FROM leaves JOIN trees ON leaves.s IS NOT DISTINCT FROM trees.s
  UNION ALL
  SELECT c.r, CASE WHEN c.n = 1 THEN -1 ELSE c.tree END, CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
         CASE WHEN c.n = 1 THEN c.tree ELSE c.pos // 3 END,
         CASE WHEN c.n = 1 THEN (SELECT count(*) FROM trees) ELSE (c.n + 2) // 3 END,
         CASE WHEN c.n = 1 THEN c.fold ELSE sha256(array_to_string(g.hs[:c.pos % 3], '') || c.fold
                                                   || array_to_string(g.hs[c.pos % 3 + 2:], '')) END,
         CASE WHEN c.n = 1 THEN c.proof ELSE c.proof || array_to_string(g.hs[:c.pos % 3], '')
                                             || array_to_string(g.hs[c.pos % 3 + 2:], '') END
  FROM climb c LEFT JOIN runs g ON g.tree = c.tree AND g.level = c.level AND g.run = c.pos // 3
  WHERE c.n > 1 OR c.tree >= 0)
SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root,
       c.fold = t.h AS verified, (strlen(c.proof) // 64)::INT AS n_siblings
FROM leaves l JOIN trees ON l.s IS NOT DISTINCT FROM trees.s JOIN subs s ON s.tree = trees.tree
JOIN climb c ON c.r = l.r AND c.tree = -1 AND c.n = 1 JOIN top t ON t.n = 1
"""
