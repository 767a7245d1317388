"""Sharding by balanced label propagation (operator 3).

Documents with equal texts are linked. Every linked document starts in a
random shard; then, round by round, each one looks where its neighbours are
and asks to move to the shard that holds most of its group. A shard accepts
movers, in the order of their groups' hashes, as long as its capacity lasts, so
sizes stay even while fewer links are cut. A group larger than a shard asks for
as many shards as it needs. Documents without links, and those beyond a shard's
capacity (neighbours next to each other), then fill the shards up to one level:
from the largest size class to the smallest, so the last differences are those
of small documents.

Only DataFrame operations are used. A group's members meet as one row per
group and shard (aggregated before the shuffle), never as pairs; running sums
are taken over hash ranges (:func:`aerolap.llm.common.running_sums`), and the
driver holds one number per shard.

Defined results: a document's size is its text in UTF-8 bytes plus ``HEADER``
(a null text has no bytes, no checksum and no links; empty texts are equal
texts); repeated rows are documents of their own; a null id is allowed; an
empty table gives an empty result. Placement follows from the rows' values;
rows equal in all of them may swap. Extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolap.llm.common import discard, running_sums, written

HEADER = 8
ROUNDS = 5
SIZE_CLASSES = 6
_SPAN = 1 << 30


def _loads(df: DataFrame, n: int, shard: str = "shard") -> list[int]:
    """Bytes per shard; one row per shard reaches the driver."""
    out = [0] * n
    for r in df.groupBy(shard).agg(F.sum("size").alias("bytes")).collect():
        out[r[0]] = r["bytes"]
    return out


def _spot(*cols: str) -> Column:
    """A hash in [0, _SPAN)."""
    return F.pmod(F.xxhash64(*cols), F.lit(_SPAN))


def _block(spot: Column, blocks: int) -> Column:
    return F.floor(spot * blocks / _SPAN)


def _at(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _propagate(linked: DataFrame, groups: DataFrame, n: int, capacity: int, blocks: int,
               rounds: int) -> tuple[DataFrame, str]:
    """Rounds of moves; returns the written labels (with a column shard)."""
    spark = linked.sparkSession
    labels, path = written(linked.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "grp", F.lit("start")), F.lit(n)).cast("int")),
        "shard_labels")
    for _ in range(rounds):
        here = labels.groupBy("grp", "shard").agg(F.sum("size").alias("here"))
        most = Window.partitionBy("grp").orderBy(F.desc("here"), F.xxhash64("grp", "shard"))
        wanted, wanted_path = written(
            here.withColumn("_place", F.row_number().over(most)).join(groups, "grp")
            .where("_place <= shards").groupBy("grp").agg(
                F.sort_array(F.collect_list("shard")).alias("wanted")), "shard_wanted")
        asked = labels.join(wanted, "grp").withColumn("asks", F.when(
            F.array_contains("wanted", F.col("shard")), F.col("shard")).otherwise(
            F.element_at("wanted", (F.pmod(F.xxhash64("doc_id", F.lit("ask")), F.size("wanted"))
                                    + 1).cast("int")))).drop("wanted")
        asked, asked_path = written(asked, "shard_asked")
        # what does not ask to leave takes up capacity
        left = [max(0, capacity - b) for b in _loads(asked.where("asks = shard"), n)]
        movers = running_sums(
            asked.where("asks <> shard").withColumn("_block", _block(F.col("at"), blocks)),
            ["asks"], "_block", ["at", "doc_id"], "size", "_before")
        accepted = F.col("_before") + F.col("size") <= _at(left, F.col("asks"))
        cols = [c for c in labels.columns if c != "shard"]
        moved = movers.select(*cols, F.when(accepted, F.col("asks")).otherwise(
            F.col("shard")).alias("shard"), accepted.alias("moved"))
        stayed = asked.where("asks = shard").select(*cols, "shard", F.lit(False).alias("moved"))
        new, new_path = written(moved.union(stayed), "shard_labels")
        discard(spark, path, wanted_path, asked_path)
        path, labels = new_path, new.drop("moved")
        if not new.where("moved").limit(1).count():
            break
    return labels, path


def level(loads: list[float], amount: float) -> list[float]:
    """What each shard gets of ``amount`` so that the lowest end up at one level."""
    order = sorted(loads)
    total, k = 0.0, 0
    height = order[0]
    while True:
        k += 1
        total += order[k - 1]
        height = (amount + total) / k
        if k == len(order) or height <= order[k]:
            return [max(0.0, height - x) for x in loads]


def _fill(free: DataFrame, loads: list[int], n: int, blocks: int) -> DataFrame:
    """Shards for unplaced documents, size class by size class."""
    largest = free.agg(F.max("size")).first()[0]
    if largest is None:
        return free.withColumn("shard", F.lit(None).cast("int"))
    tier = F.least(F.floor(F.log(F.lit(largest) / F.col("size")) / math.log(4)),
                   F.lit(SIZE_CLASSES - 1)).cast("int")
    placed, _ = written(running_sums(
        free.withColumn("_tier", tier).withColumn("_block", _block(F.col("at"), blocks)),
        ["_tier"], "_block", ["at", "doc_id"], "size", "_before"), "shard_free")
    amounts = {r["_tier"]: r["bytes"] for r in
               placed.groupBy("_tier").agg(F.sum("size").alias("bytes")).collect()}
    middle = F.col("_before") + F.col("size") / 2
    shard = F.lit(n - 1)
    loads = [float(x) for x in loads]
    for t in sorted(amounts):
        ends, total = [], 0.0
        for share in level(loads, amounts[t]):
            total += share
            ends.append(total)
        ends[-1] = math.inf
        # the shard whose stretch holds the document's middle; empty stretches hold none
        own = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= middle))
        for r in (placed.where(F.col("_tier") == t).groupBy(own.alias("shard"))
                  .agg(F.sum("size").alias("bytes")).collect()):
            loads[r["shard"]] += r["bytes"]
        shard = F.when(F.col("_tier") == t, own).otherwise(shard)
    return placed.withColumn("shard", shard.cast("int"))


def shard(docs: DataFrame, n: int = 24, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """Even shards by bytes: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = F.col(text_col)
    items, items_path = written(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + HEADER).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("grp")),
        "shard_items")
    rows, total = items.agg(F.count(F.lit(1)), F.sum("size")).first()
    capacity = (total or 0) // n
    blocks = max(1, math.isqrt(rows))  # as many blocks as rows in a block
    groups, groups_path = written(
        items.where("grp IS NOT NULL").groupBy("grp").agg(
            F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_bytes")).where("_n > 1").select(
            "grp", F.ceil(F.sqrt("_n")).cast("int").alias("parts"),
            F.least(F.lit(n), F.ceil(F.col("_bytes") / max(1, capacity))).cast("int")
            .alias("shards")), "shard_groups")
    # a large group is handled in parts, each of them a small stretch of the order
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.col("parts"))
    known, known_path = written(
        items.join(groups.select("grp", "parts"), "grp", "left").select(
            "doc_id", "size", "text_crc32", "grp", part.alias("part")).withColumn(
            "at", F.when(F.col("part").isNull(), _spot("doc_id", "size", "text_crc32"))
            .otherwise(_spot("grp", "part"))), "shard_known")
    labels, labels_path = _propagate(known.where("part IS NOT NULL"), groups.select("grp", "shards"),
                                     n, capacity, blocks, rounds)
    columns = ["doc_id", "size", "text_crc32"]
    loads = _loads(labels, n)
    lone = known.where("part IS NULL").select(*columns, "at")
    if max(loads) > capacity:  # what found no room is placed anew, in the order of its groups
        ranked, ranked_path = written(running_sums(
            labels.withColumn("_block", _block(F.col("at"), blocks)),
            ["shard"], "_block", ["at", "doc_id"], "size", "_before"), "shard_ranked")
        fits = F.col("_before") + F.col("size") <= capacity
        lone = lone.union(ranked.where(~fits).select(*columns, "at"))
        labels = ranked.where(fits)
        loads = _loads(labels, n)
    placed = labels.select(*columns, "shard").union(
        _fill(lone, loads, n, blocks).select(*columns, "shard"))
    placed, _ = written(placed.withColumn("_one", F.lit(1)).withColumn(
        "_at", _spot("doc_id", "text_crc32")), "shard_placed")
    discard(spark, items_path, groups_path, known_path, labels_path)
    slots = running_sums(placed.withColumn("_block", _block(F.col("_at"), max(1, math.isqrt(rows // n)))),
                         ["shard"], "_block", ["_at", "doc_id"], "_one", "slot")
    return slots.select(*columns, F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
