"""Mixing sources to target weights (operator 4).

Every document gets a key that a hash of its id makes random. Within each
source the rows are range-sorted by that key (blocks are ranges of the key, as
many as the square root of the source's documents), distributed prefix sums give the words
before each document, and the mix takes documents up to the source's budget:
whole epochs first, then one more pass cut where the running sum meets what
is left. Documents are taken whole, so a source misses its budget by at most
half of the document at the cut.

Targets: sources in code-point order (null last) weigh ``weights`` in turn
and share ``share`` times all words; a target stops at ``max_epochs`` times
its source's words and the excess is shared again by weight among the others
until none is above its limit. Each round is one aggregation over the sources
table; the loop ends when no further source is capped.

Defined results: a null or empty text has size 0 and is taken 0 words; null
is a source of its own; ties of the key (repeated ids) are ordered by size
and share a cut in that order; an empty table gives an empty result; sources
without words have target 0. Everything follows from the rows' values alone,
so reruns and other partitionings agree. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolap.llm.common import discard, running_sums, word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"
_KEY_DIGITS = 7


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, n_docs, target.

    ``sizes`` has the columns source and size.
    """
    spark = sizes.sparkSession
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.lit(1)).alias("n_docs"))
    # rank over ranges of the names: no task sorts all sources
    ranged, ranged_path = written(
        per.repartitionByRange(F.col("source").asc_nulls_last())
        .withColumn("_range", F.spark_partition_id()), "mix_sources")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(
        Window.partitionBy("_range").orderBy(F.col("source").asc_nulls_last())) - 1
    ranked, ranked_path = written(
        ranged.withColumn("_place", place).join(offsets, "_range").select(
            "source", "source_size", "n_docs",
            F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                         ((F.col("_place") + F.col("_offset")) % len(weights) + 1).cast("int"))
            .alias("weight")), "mix_ranked")
    discard(spark, ranged_path)
    limit = F.col("source_size") * max_epochs
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped = share * total, 0.0, -1
    if total:
        level = budget / ranked.agg(F.sum("weight")).first()[0]
        while True:
            over = limit < F.col("weight") * F.lit(level)
            n, fixed, free = ranked.agg(
                F.count_if(over), F.sum(F.when(over, limit)),
                F.sum(F.when(~over, F.col("weight")))).first()
            if n == capped or not free:
                level = level if free else math.inf
                break
            capped, level = n, (budget - (fixed or 0)) / free
    return ranked.select("source", "source_size", "n_docs",
                         F.least(limit.cast("double"), F.col("weight") * F.lit(level))
                         .alias("target") if total else F.lit(0.0).alias("target"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", weights: Sequence[int] = WEIGHTS, share: float = SHARE,
         max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Words the mix takes of each document.

    Returns doc_id, size, source, source_size, target, copies, taken.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"),
                                                          F.lit(""))))
    sizes, _ = written(
        docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("size"),
                    F.col(source_col).alias("source"), digest.alias("_key")), "mix_sizes")
    sources = targets(sizes, weights, share, max_epochs)
    rows = sizes.join(sources.withColumnRenamed("source", "_source"),
                      sizes["source"].eqNullSafe(F.col("_source"))).drop("_source")
    blocks = F.ceil(F.sqrt("n_docs"))
    position = F.conv(F.substring("_key", 1, _KEY_DIGITS), 16, 10).cast("long")
    rows = rows.withColumn("_block", F.floor(position * blocks / 16 ** _KEY_DIGITS))
    rows = running_sums(rows, ["source"], "_block", ["_key", "doc_id", "size"], "size", "_before")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
                    ).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("_epochs", epochs)
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    more = (F.col("size") > 0) & (F.col("_before") + F.col("size") / 2 <= rest)
    copies = F.when(F.col("size") > 0, F.col("_epochs")).otherwise(F.lit(0)) + more.cast("long")
    return rows.select("doc_id", "size", "source", "source_size", "target",
                       copies.cast("int").alias("copies"),
                       (copies * F.col("size")).alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each document as often as the plan takes it, columns as in ``docs``.

    Rows that share an id and a source are taken alike; nulls match nulls.
    """
    mixed = (plan(docs, id_col, text_col, source_col, **options)
             .groupBy("doc_id", "source").agg(F.max("copies").alias("__mix_copies"))
             .where(F.col("__mix_copies") > 0)
             .select(F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"),
                     "__mix_copies"))
    return (docs.join(mixed, docs[id_col].eqNullSafe(F.col("__mix_id"))
                      & docs[source_col].eqNullSafe(F.col("__mix_source")))
            .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


ORACLE_SQL = f"""
WITH s AS (
  SELECT doc_id, source, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size,
             list_extract([5, 2, 1], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT) AS w
      FROM s GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size / w AS ratio FROM p),
l AS (SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM p)
              - coalesce(sum(2 * source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY ratio DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS level, ratio FROM r),
t AS (SELECT source, source_size,
             least(2.0::DOUBLE * source_size, w * (SELECT max(level) FROM l)) AS target FROM r),
c AS (SELECT doc_id, size, source_size, target,
             CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS e,
             coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size = 0 THEN 0
             ELSE (e + CASE WHEN before + size / 2.0::DOUBLE <= target - e * source_size THEN 1 ELSE 0 END) * size
        END)::BIGINT AS taken
FROM c
"""
