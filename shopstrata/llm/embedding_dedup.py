"""Embedding near-duplicates by dual traversal of cover trees.

Distances are angles. A tree's levels halve their radius; every node knows its covering
radius, so a pair of nodes whose centres are further apart than both radii and the threshold
angle together is dropped with all its points. What is left at the leaves is compared by
cosine in double precision, so the pairs are exact.

The upper levels are spread over the cluster: vectors of one label go to the nearest of a few
pivots and into blocks of about ``LEAF`` points, block pairs are pruned by the same bound, and
each surviving pair is one group of rows with trees of its own. Equal vectors are one point
with a multiplicity. A task returns link counts and a spanning forest, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.components import components
from shopstrata.llm.near_dedup import _changes, consecutive
from shopstrata.llm.scratch import Scratch

THRESHOLD = 0.93
LEAF = 2048
PIVOTS = 64  # most pivots of a label
SALT_ROWS = 8192  # rows of a label that are assigned in one task
EPS = 1e-9


# ---- cover trees ------------------------------------------------------------------


class Node:
    """A centre, the radius that covers all points below, child nodes and single points."""

    __slots__ = ("centre", "radius", "children", "points")

    def __init__(self, centre: int, radius: float):
        self.centre, self.radius, self.children, self.points = centre, radius, [], []


def angles(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ centre, -1.0, 1.0))


def build(unit: np.ndarray) -> Node:
    """The cover tree of unit vectors: each level's nodes cover half the radius of the one above."""
    everything = np.arange(len(unit))
    root = Node(0, float(angles(unit, unit[0]).max()))
    open_nodes = [(root, everything, math.pi / 2)]
    while open_nodes:
        node, members, radius = open_nodes.pop()
        while len(members):
            distance = angles(unit[members], unit[members[0]])
            near = distance <= radius
            near[0] = True
            inside, members, first = members[near], members[~near], int(members[0])
            if len(inside) == 1 or radius < 1e-4:
                node.points += inside.tolist()
            else:
                child = Node(first, float(distance[near].max()))
                node.children.append(child)
                open_nodes.append((child, inside, radius / 2))
    return root


def traverse(left: np.ndarray, right: np.ndarray, same: bool, threshold: float, found) -> None:
    """Calls ``found(points of left, points of right, linked?)`` for each leaf pair that bounds do not rule out."""
    reach = math.acos(threshold) + EPS
    one = build(left)
    two = one if same else build(right)
    stack = [(one, two)]
    while stack:
        a, b = stack.pop()
        twin = same and a is b
        if a.points and b.points:
            found(a.points, b.points, left[a.points] @ right[b.points].T >= threshold, twin)
        for x, y, flip in ((a, b, False), (b, a, True)):
            if flip and twin or not (x.points and y.children):
                continue
            mine, theirs = (right, left) if flip else (left, right)
            cosines = mine[x.points] @ theirs[[c.centre for c in y.children]].T
            close = np.arccos(np.clip(cosines, -1, 1)) <= np.array([c.radius for c in y.children]) + reach
            for j in np.flatnonzero(close.any(0)).tolist():
                held = Node(x.points[0], 0.0)
                held.points = [p for p, near in zip(x.points, close[:, j]) if near]
                stack.append((y.children[j], held) if flip else (held, y.children[j]))
        if a.children and b.children:
            cosines = left[[c.centre for c in a.children]] @ right[[c.centre for c in b.children]].T
            bound = np.add.outer([c.radius for c in a.children], [c.radius for c in b.children]) + reach
            for i, j in np.argwhere(np.arccos(np.clip(cosines, -1, 1)) <= bound).tolist():
                if not twin or i <= j:
                    stack.append((a.children[i], b.children[j]))


class Links:
    """Link counts and a spanning forest, from blocks of links."""

    def __init__(self, left: int, right: int, copies_left: np.ndarray, copies_right: np.ndarray, same: bool):
        self.counts_left = np.zeros(left, np.int64)
        self.counts_right = self.counts_left if same else np.zeros(right, np.int64)
        self.copies_left, self.copies_right = copies_left, copies_right
        self.same, self.edges = same, set()

    def add(self, rows, columns, linked: np.ndarray, twin: bool) -> None:
        if twin:
            linked = np.triu(linked, 1)
        if not linked.any():
            return
        rows, columns = np.asarray(rows), np.asarray(columns)
        np.add.at(self.counts_left, rows, linked @ self.copies_right[columns])
        np.add.at(self.counts_right, columns, self.copies_left[rows] @ linked)
        some_rows, some_columns = linked.any(1), linked.any(0)
        linked, rows, columns = linked[some_rows][:, some_columns], rows[some_rows], columns[some_columns]
        # smallest row label reachable inside the block
        label, none = np.arange(len(rows)), len(rows)
        while True:
            of_columns = np.where(linked, label[:, None], none).min(0)
            new = np.minimum(label, np.where(linked, of_columns[None], none).min(1))
            if (new == label).all():
                break
            label = new
        self.edges.update(zip(rows.tolist(), (False,) * len(rows), rows[label].tolist()))
        self.edges.update(zip(columns.tolist(), (True,) * len(columns), rows[of_columns].tolist()))


def unit_rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    table = flat.reshape(len(column), -1)
    table = table / np.abs(table).max(1, keepdims=True)
    return table / np.linalg.norm(table, axis=1, keepdims=True)


# ---- over tables ------------------------------------------------------------------


def usable(vector):
    """Not null, not empty, all components present and finite, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0) & (F.size(vector) > 0), F.lit(False))


def assign(points: DataFrame, pivots: DataFrame, tasks: int) -> DataFrame:
    """Adds ``node`` and ``angle``: the nearest pivot of the label."""
    rows = points.select("label", "dim", "salt", F.lit(1).alias("kind"), "cls", "copies", "vector").unionByName(
        pivots.select("label", "dim", "salt", F.lit(0).alias("kind"), F.col("node").alias("cls"), F.lit(0).cast("bigint").alias("copies"), "vector"))
    keys = ["label", "dim", "salt"]

    def work(batches):
        for batch in consecutive(batches, *keys):
            starts = _changes(batch, keys).tolist()
            for low, high in zip(starts, [*starts[1:], batch.num_rows]):
                part = batch.slice(low, high - low)
                split = int((part.column("kind").to_numpy() == 0).sum())
                if not split or split == part.num_rows:
                    continue
                unit = unit_rows(part.column("vector"))
                cosines = unit[split:] @ unit[:split].T
                nearest = cosines.argmax(1)
                rest = part.slice(split)
                yield pa.RecordBatch.from_arrays([
                    *[rest.column(c) for c in ("label", "dim", "cls", "copies", "vector")],
                    part.column("cls").take(pa.array(nearest)),
                    pa.array(np.arccos(np.clip(cosines[np.arange(len(nearest)), nearest], -1, 1)))],
                    ["label", "dim", "cls", "copies", "vector", "node", "angle"])

    types = dict(points.dtypes)
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys, "kind", "cls").mapInArrow(
        work, f"label {types['label']}, dim int, cls bigint, copies bigint, vector {types['vector']}, node bigint, angle double")


def compare(pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n) over sorted groups (pair, side, cls, copies, vector).

    Rows with null b count links of a; the others are forest edges.
    """
    def work(batches):
        for batch in consecutive(batches, "pair"):
            starts = _changes(batch, ("pair",)).tolist()
            for low, high in zip(starts, [*starts[1:], batch.num_rows]):
                part = batch.slice(low, high - low)
                split = int((part.column("side").to_numpy() == 0).sum())
                unit = unit_rows(part.column("vector"))
                cls, copies = part.column("cls").to_numpy(), part.column("copies").to_numpy()
                same = split == part.num_rows
                second = slice(0, split) if same else slice(split, None)
                links = Links(split, part.num_rows - split, copies[:split], copies[second], same)
                traverse(unit[:split], unit[second], same, threshold, links.add)
                at = np.flatnonzero(links.counts_left)
                names, counts = [cls[:split][at]], [links.counts_left[at]]
                if not same:
                    at = np.flatnonzero(links.counts_right)
                    names.append(cls[second][at])
                    counts.append(links.counts_right[at])
                a, n = np.concatenate(names), np.concatenate(counts)
                edges = list(links.edges)
                ends = [cls[second][i] if right else cls[:split][i] for i, right, _ in edges]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([a, np.array(ends, np.int64)])),
                    pa.array([None] * len(a) + [int(cls[:split][j]) for _, _, j in edges], pa.int64()),
                    pa.array(np.concatenate([n, np.zeros(len(edges), np.int64)]))], ["a", "b", "n"])

    return pairs.mapInArrow(work, "a bigint, b bigint, n bigint")


def near_vectors(table: DataFrame, scratch: Scratch, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    Vectors of one label and length are linked when their cosine is at least ``threshold``. Null
    labels and vectors that are null, empty, zero or hold null or non-finite components are
    linked with nothing. Rows that repeat are vectors of their own, linked with each other.
    """
    spark = table.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    vector = F.col(vector_col)
    given = scratch.table(table.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.size(vector).alias("dim"),
        F.md5(F.to_json(F.struct(vector)).cast("binary")).alias("digest"),
        (usable(vector) & F.col(label_col).isNotNull()).alias("usable"), vector.alias("vector")), "given")
    classes = scratch.table(
        given.where("usable").groupBy("label", "dim", "digest").agg(
            F.count("*").alias("copies"), F.min("id").alias("least"), F.first("vector").alias("vector"))
        .withColumn("cls", F.monotonically_increasing_id()), "classes")

    # the upper levels: pivots, nodes, blocks
    totals = classes.groupBy("label", "dim").agg(F.count("*").alias("total"))
    pivots_of = F.least(F.lit(PIVOTS), F.ceil(F.col("total") / LEAF)).cast("int")
    salts_of = F.ceil(F.col("total") / SALT_ROWS).cast("int")
    sized = classes.join(totals, ["label", "dim"]).withColumn(
        "salt", F.pmod(F.xxhash64("cls", F.lit(2)), salts_of).cast("int"))
    pivots = sized.groupBy("label", "dim", F.pmod(F.xxhash64("cls", F.lit(1)), pivots_of).alias("node")).agg(
        F.first("total").alias("total"), F.min_by("vector", F.xxhash64("cls", F.lit(3))).alias("vector"))
    pivots = scratch.table(pivots, "pivots")
    spread = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), salts_of - 1)))
    placed = scratch.table(assign(sized, spread, tasks), "placed")
    nodes = placed.groupBy("label", "dim", "node").agg(F.count("*").alias("points"), F.max("angle").alias("radius"))
    nodes = scratch.table(nodes.join(pivots.drop("total"), ["label", "dim", "node"]), "nodes")

    blocks = nodes.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.ceil(F.col("points") / LEAF).cast("int") - 1)))
    block = F.struct("node", "chunk")
    left = blocks.select("label", "dim", block.alias("i"), F.col("vector").alias("v"), F.col("radius").alias("r"))
    right = blocks.select("label", "dim", block.alias("j"), F.col("vector").alias("w"), F.col("radius").alias("s"))
    dot = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda t, p: t + p)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot("v", "w") / F.sqrt(dot("v", "v") * dot("w", "w")))))
    pairs = scratch.table(left.join(right, ["label", "dim"]).where("i <= j").where(
        (F.col("i") == F.col("j")) | (apart <= F.col("r") + F.col("s") + math.acos(threshold) + 1e-6)
    ).select(F.monotonically_increasing_id().alias("pair"), "label", "dim", "i", "j"), "pairs")
    sides = pairs.select("label", "dim", "pair", F.explode(
        F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("b"), F.lit(0).alias("side"))))
        .otherwise(F.array(F.struct(F.col("i").alias("b"), F.lit(0).alias("side")),
                           F.struct(F.col("j").alias("b"), F.lit(1).alias("side"))))).alias("s"))
    sides = sides.select("label", "dim", "pair", "s.b.node", "s.b.chunk", "s.side")
    chunked = placed.join(nodes.select("label", "dim", "node", "points"), ["label", "dim", "node"]).withColumn(
        "chunk", F.pmod(F.xxhash64("cls", F.lit(4)), F.ceil(F.col("points") / LEAF)).cast("int"))
    met = chunked.join(sides, ["label", "dim", "node", "chunk"]).select("pair", "side", "cls", "copies", "vector")
    met = met.repartition(tasks, "pair").sortWithinPartitions("pair", "side", "cls")
    found = scratch.table(compare(met, threshold), "found")

    counts = found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    parts = components(found.where("b IS NOT NULL").select("a", "b"), scratch, "linked")
    rooted = classes.select("label", "dim", "digest", "cls", "copies", "least").join(
        parts.withColumnRenamed("node", "cls"), "cls", "left").join(counts, "cls", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "cls"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.table(rooted.join(least, "root").select(
        "label", "dim", "digest", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    valid = given.where("usable").join(named, ["label", "dim", "digest"]).select("id", "n_links", "component_id")
    alone = given.where("NOT usable").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return valid.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return near_vectors(table, Scratch(spark, "embeddings")).withColumnRenamed("id", "vec_id")
