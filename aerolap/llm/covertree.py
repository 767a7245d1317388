"""Embedding near-duplicates by cover-tree dual traversal (operator 10).

Vectors of one label (and one dimension) link if their cosine is at least
``threshold``; on unit vectors that is a Euclidean distance of at most
``sqrt(2 - 2 * threshold)``, so the triangle inequality applies.

1. *Equal vectors* are one point with a multiplicity.
2. *Upper level.* At most ``MAX_CENTRES`` points, picked by hash, are the
   centres of cells; each point joins the nearest centre of its label. Cells
   are cut into blocks of about ``block`` points, and pairs of cells whose
   centres are further apart than both covering radii and the threshold allow
   are pruned. Every point is in a cell; the sample steers only which pairs
   are pruned, never which are found.
3. *Dual traversal.* A task takes one pair of blocks. It builds a cover tree
   of each (nested levels, covering radii halving from level to level, built
   down to ``LEAF`` points whatever the spread) and descends both together,
   a level of each at a time: a pair of nodes too far apart for any link is
   pruned, a pair close enough that all its points link is counted as a whole,
   and pairs of points are compared by their cosines in double precision.

A task returns, per point, the number of links and one spanning-forest edge,
so dense groups of copies stay linear in size; components follow from those
edges.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components, or have a null label or id, link with nothing
(``n_links`` 0, their own component); vectors of different lengths never
link; rows that share an id are judged each by its own vector; an empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolap.llm.common import discard, written
from aerolap.llm.components import components

MAX_CENTRES = 1024
BLOCK = 1024
LEAF = 16
#: Rows of a matrix of distances that a task holds at once.
STRIP = 256
_SLACK = 1e-7  # on distances, far above rounding; only bounds use it


def _norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def usable(v: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double"))
                                                           == F.lit(float("inf"))))
    n = _norm(v)
    return F.coalesce((F.size(v) > 0) & ~odd & (n > 0) & (n < float("inf")), F.lit(False))


# --- inside a task --------------------------------------------------------

class Node:
    """A centre, its covering radius, the points below it, and the next level's nodes."""

    __slots__ = ("centre", "radius", "points", "children", "heads", "radii")

    def __init__(self, centre: np.ndarray, radius: float, points: np.ndarray, children: list,
                 heads: np.ndarray):
        self.centre, self.radius, self.points, self.children = centre, radius, points, children
        #: centres and radii of the next level; in a leaf, the points themselves
        self.heads = heads
        self.radii = np.array([c.radius for c in children]) if children else np.zeros(len(heads))

    def below(self, i: int, x: np.ndarray) -> Node:
        """The i-th node of the next level; a leaf's point is a node of its own."""
        if self.children:
            return self.children[i]
        one = self.heads[i:i + 1]
        return Node(x[one[0]], 0.0, one, [], one)


def _distances(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def _net(x: np.ndarray, points: np.ndarray, reach: float) -> list[np.ndarray]:
    """The points in groups around centres further apart than ``reach``; a group begins
    with its centre, the first group with the first point."""
    parts, left = [], points
    while len(left):
        heads = left[:STRIP]
        near = _distances(x[heads] @ x[left].T) <= reach
        free = np.ones(len(left), bool)
        for i in range(len(heads)):
            if free[i]:
                free[i] = False
                mine = near[i] & free
                parts.append(np.concatenate([heads[i:i + 1], left[mine]]))
                free &= ~mine
        left = left[free]
    return parts


def tree(x: np.ndarray, points: np.ndarray, centre: int, scale: float) -> Node:
    """Cover tree of some unit vectors around one of them.

    The levels are nested: a node's centre is the centre of its first child, and
    children cover their points within ``scale / 2``. Every node of more than ``LEAF``
    points has a next level, however many children that takes.
    """
    far = np.sqrt(np.maximum(((x[points] - x[centre]) ** 2).sum(1), 0))
    radius = float(far.max(initial=0.0))
    if len(points) > LEAF and radius > _SLACK:
        scale = min(scale, radius)
        parts = _net(x, np.concatenate([[centre], points[points != centre]]), scale / 2)
        if len(parts) > 1:
            return Node(x[centre], radius, points,
                        [tree(x, p, int(p[0]), scale / 2) for p in parts],
                        np.array([p[0] for p in parts]))
    return Node(x[centre], radius, points, [], points)


class Traversal:
    def __init__(self, x: np.ndarray, mult: np.ndarray, threshold: float):
        self.x, self.mult, self.threshold = x, mult, threshold
        self.reach = float(np.sqrt(2 - 2 * threshold))
        self.links = np.zeros(len(x), np.int64)
        self.parent = np.arange(len(x))
        self.met = self.pruned = 0  # pairs of nodes, and those ruled out by their radii

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return int(i)

    def union(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def _all(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        """Every point of ``a`` links with every other one of ``b``."""
        self.links[a] += self.mult[b].sum() - (self.mult[a] if same else 0)
        if not same:
            self.links[b] += self.mult[a].sum()
        first = int(a[0])
        for j in [*a.tolist(), *b.tolist()]:
            self.union(first, j)

    def _compare(self, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> None:
        """Links between points ``a`` and ``b``, each pair given once."""
        self.links[a] += linked @ self.mult[b]
        self.links[b] += self.mult[a] @ linked
        for i in np.flatnonzero(linked.any(1)).tolist():
            partners = b[linked[i]]
            first = self.root(int(a[i]))
            for j in partners[self.parent[partners] != first].tolist():
                self.union(first, j)

    def meet(self, a: Node, b: Node) -> None:
        """All links between two nodes' points.

        The next levels of both meet as one matrix of distances: pairs beyond the covering
        bounds are pruned, pairs of single points compared, and the others descended.
        """
        if a is b and 2 * a.radius <= self.reach - _SLACK:
            return self._all(a.points, a.points, True)
        single_b = self._single(b)
        for at in range(0, len(a.heads), STRIP):
            heads, radii = a.heads[at:at + STRIP], a.radii[at:at + STRIP]
            single = self._single(a)[at:at + STRIP]
            cosines = self.x[heads] @ self.x[b.heads].T
            far = _distances(cosines)
            both = radii[:, None] + b.radii[None, :]
            once = np.ones(far.shape, bool)
            if a is b:  # each pair once; a node with itself below
                once = np.arange(at, at + len(heads))[:, None] < np.arange(len(b.heads))
            pairs = once & (far <= both + (self.reach + _SLACK))
            self.met += int(np.count_nonzero(once))
            self.pruned += int(np.count_nonzero(once & ~pairs))
            points = single[:, None] & single_b[None, :]
            self._compare(heads, b.heads, pairs & points & (cosines >= self.threshold))
            for i, j in np.argwhere(pairs & ~points).tolist():
                first, second = a.below(at + i, self.x), b.below(j, self.x)
                if far[i, j] + both[i, j] <= self.reach - _SLACK:
                    self._all(first.points, second.points, False)
                else:
                    self.meet(first, second)
        if a is b:
            for child in a.children:
                if len(child.points) > 1:
                    self.meet(child, child)

    @staticmethod
    def _single(node: Node) -> np.ndarray:
        if not node.children:
            return np.ones(len(node.heads), bool)
        return np.array([len(c.points) == 1 for c in node.children])


def _unit(packed: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(p, "<f8") for p in packed])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x ** 2).sum(1, keepdims=True))


def _meet_blocks(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        cols = group.select(["rep", "mult", "block", "first", "second", "vector"]).to_pydict()
        x = _unit(cols["vector"])
        block = np.array(cols["block"])
        walk = Traversal(x, np.array(cols["mult"], np.int64), threshold)
        first, second = cols["first"][0], cols["second"][0]
        nodes = [tree(x, p, int(p[0]), 2.0) for p in
                 (np.flatnonzero(block == k) for k in dict.fromkeys((first, second))) if len(p)]
        if len(nodes) == (1 if first == second else 2):
            walk.meet(nodes[0], nodes[-1])
        at = np.flatnonzero(walk.links)
        reps = cols["rep"]
        return pa.table({"rep": pa.array([reps[i] for i in at], pa.int64()),
                         "other": pa.array([reps[walk.root(i)] for i in at], pa.int64()),
                         "links": pa.array(walk.links[at])})

    return run


def _nearest(centres: dict):
    """Cell (index of the nearest centre of the group, or -1) and the distance to it."""
    def run(batches):
        names = ["label", "dim", "rep", "mult"]
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in [*names, "vector"]}
            packed = [np.array(v, "<f8").tobytes() for v in cols["vector"]]
            cell = np.full(batch.num_rows, -1, np.int32)
            far = np.full(batch.num_rows, 2.0)
            keys = list(zip(cols["label"], cols["dim"]))
            for key in set(keys):
                at = [i for i, k in enumerate(keys) if k == key]
                ids, c = centres.get(key, ((), None))
                if not len(ids):
                    continue
                d = _unit([packed[i] for i in at]) @ c.T
                near = d.argmax(1)
                cell[at] = np.array(ids)[near]
                far[at] = np.sqrt(np.maximum(2 - 2 * d[np.arange(len(at)), near], 0)) + _SLACK
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(cell), pa.array(far),
                 pa.array(packed, pa.binary())], [*names, "cell", "far", "vector"])

    return run


# --- the operator ---------------------------------------------------------

def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93,
                    max_centres: int = MAX_CENTRES, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    good = rows.where(usable(F.col("vector")) & F.col("label").isNotNull()
                      & F.col("vec_id").isNotNull())
    # a point is known by a number of its own (``rep``): different vectors may share their
    # smallest id
    points, points_path = written(
        good.groupBy("label", "vector").agg(F.min("vec_id").alias("least_id"),
                                            F.count(F.lit(1)).alias("mult"))
        .withColumn("dim", F.size("vector")).withColumn("rep", F.monotonically_increasing_id()),
        "vector_points")

    # centres: a share of the points by hash, at most max_centres in all
    n = points.count()
    share = min(1.0, max(1.0 / block, 1e-12) * min(1.0, max_centres * block / max(n, 1)))
    mark = F.xxhash64("rep", F.lit("centre"))
    sample = (points.where(mark < F.lit(min(2 ** 63 - 1, int(share * 2 ** 64) - 2 ** 63)))
              .orderBy(mark, "rep").limit(max_centres).select("label", "dim", "vector").collect())
    centres: dict = {}
    for i, r in enumerate(sample):
        centres.setdefault((r["label"], r["dim"]), ([], []))
        centres[r["label"], r["dim"]][0].append(i)
        centres[r["label"], r["dim"]][1].append(np.array(r["vector"], "<f8").tobytes())
    centres = {k: (ids, _unit(v)) for k, (ids, v) in centres.items()}
    held, held_path = written(
        points.select("label", "dim", "rep", "mult", "vector").mapInArrow(
            _nearest(centres), points.select("label", "dim", "rep", "mult").schema
            .add("cell", "integer").add("far", "double").add("vector", "binary")), "vector_cells")

    # cells and the pairs of them that may hold a link: at most max_centres^2 / 2 of the
    # sampled centres; groups without a centre have one cell of their own
    cells = held.groupBy("label", "dim", "cell").agg(
        F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).withColumn(
        "parts", F.ceil(F.col("n") / block).cast("int"))
    reach = float(np.sqrt(2 - 2 * threshold))
    radius = {r["cell"]: r["radius"] for r in
              cells.where("cell >= 0").select("cell", "radius").collect()}
    near = []
    for ids, c in centres.values():
        d = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
        r = np.array([radius.get(i, -9.0) for i in ids])
        ok = d <= r[:, None] + r[None, :] + reach + _SLACK
        near += [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(ok)))
                 if r[i] >= 0 and r[j] >= 0]
    near_cells = spark.createDataFrame(near, "cell int, cell2 int")
    parts = cells.select("label", "dim", "cell", F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    key = (F.col("cell").cast("long") * (1 << 32) + F.col("part"))
    blocks = parts.select("label", "dim", "cell", key.alias("block"))
    other = blocks.select(F.col("label").alias("label2"), F.col("dim").alias("dim2"),
                          F.col("cell").alias("cell2"), F.col("block").alias("second"))
    pairs = (blocks.where("cell >= 0").join(near_cells, "cell").join(other, "cell2")
             .select("label", "dim", F.col("block").alias("first"), "second")
             .where("first <= second"))
    alone = blocks.where("cell < 0").join(
        other.where("cell2 < 0"), (F.col("label") == F.col("label2"))
        & (F.col("dim") == F.col("dim2"))).select(
        "label", "dim", F.col("block").alias("first"), "second").where("first <= second")
    units, units_path = written(pairs.union(alone).withColumn(
        "unit", F.xxhash64("label", "dim", "first", "second")), "vector_units")
    places = units.select("*", F.col("first").alias("block")).union(
        units.where("first <> second").select("*", F.col("second").alias("block")))
    sized, sized_path = written(cells.select("label", "dim", "cell", "parts"), "vector_sizes")
    members = held.join(sized, ["label", "dim", "cell"]).select(
        "label", "dim", "rep", "mult", "vector",
        (F.col("cell").cast("long") * (1 << 32)
         + F.pmod(F.xxhash64("rep"), F.col("parts"))).alias("block"))
    found, _ = written(
        members.join(places, ["label", "dim", "block"]).groupBy("unit").applyInArrow(
            _meet_blocks(threshold), "rep long, other long, links long"), "vector_links")
    discard(spark, held_path, units_path, sized_path)

    linked = components(found.select("rep", "other"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    placed, placed_path = written(
        points.join(counts, "rep", "left")
        .join(linked.withColumnRenamed("node", "rep"), "rep", "left")
        .select(F.col("label").alias("_label"), F.col("vector").alias("_vector"), "least_id",
                F.coalesce("component", "rep").alias("_group"),
                (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("_links")),
        "vector_placed")
    heads = placed.groupBy("_group").agg(F.min("least_id").alias("_component"))
    named, _ = written(placed.join(heads, "_group").select(
        "_label", "_vector", "_component", "_links"), "vector_named")
    discard(spark, points_path, placed_path)
    own = (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector"))
    joined = rows.join(named, own & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("_component", "vec_id")
    return joined.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"),
                         (F.col("vec_id") == component).alias("kept"))
