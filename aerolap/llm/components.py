"""Connected components of an edge table.

Alternates the large-star and small-star steps (Kiveris et al., "Connected
components in MapReduce and beyond", 2014) until the edges are stars around
the smallest node. An edge points from its larger end ``u`` to its smaller end
``v``. The large step moves an edge's lower end to that node's smallest
neighbour; the small step links all lower neighbours of a node to the smallest
of them. Neighbours are found by an aggregation (combined before the shuffle)
and joined back from a written table, so a hub's edges are never gathered in
one task: an adaptive join splits them. Rounds grow with the logarithm of the
longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolap.llm.common import discard, written


def _least(edges: DataFrame) -> tuple[DataFrame, str]:
    """Each node's smallest lower neighbour."""
    return written(edges.groupBy("u").agg(F.min("v").alias("least"))
                   .withColumnRenamed("u", "node"), "least")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (two long columns).

    Self-loops and null ends are ignored; an edge may occur repeatedly and in
    either direction. The component is its smallest node.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    e, path = written(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while True:
        parents, parents_path = _least(e)
        moved, moved_path = written(
            e.join(parents, e["v"] == parents["node"], "left").select(
                "u", F.coalesce("least", "v").alias("v"), F.col("least").isNotNull().alias("moved")),
            "moved")
        n, n_moved = moved.agg(F.count(F.lit(1)), F.count_if("moved")).first()
        if not n_moved and parents.count() == n:  # every node has one edge, to a smallest node
            discard(spark, parents_path, moved_path)
            break
        lower, lower_path = _least(moved)
        linked = moved.join(lower, moved["u"] == lower["node"]).where("v <> least").select(
            F.col("v").alias("u"), F.col("least").alias("v"))
        new, new_path = written(
            linked.union(lower.select("node", "least")).distinct(), "edges")
        discard(spark, path, parents_path, moved_path, lower_path)
        e, path = new, new_path
    ends = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))
                      .distinct())
