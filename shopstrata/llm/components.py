"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.scratch import Scratch

PART_ROWS = 100_000  # edges in a partition; a step over few edges has few tasks


def _fingerprint(edges: DataFrame):
    return edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("a"),
        F.sum(F.xxhash64("v", "u") % 999_983).alias("b")).first()


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node reachable.

    Both kinds of step replace edges by edges to the smallest neighbour, so the table never
    outgrows the input much; a hub's rows are reduced map-side and split as a skewed join.
    Each step is written to the shared folder, so a lost executor repeats one step at most.
    """
    now = scratch.table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{label}-0")
    mark, step = _fingerprint(now), 0
    while mark.n:
        parts = -(-mark.n // PART_ROWS)
        # large star: larger neighbours go to the smallest neighbour
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.table(both.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), f"{label}-m{step}")
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large = scratch.table(large.coalesce(parts), f"{label}-l{step}")
        # small star: smaller neighbours and the node itself go to the smallest of them
        least = scratch.table(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), f"{label}-s{step}")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).distinct()
        step += 1
        before, now = mark, scratch.table(small.coalesce(parts), f"{label}-{step}")
        mark = _fingerprint(now)
        scratch.drop(f"{label}-m{step - 1}", f"{label}-l{step - 1}", f"{label}-s{step - 1}", f"{label}-{step - 1}")
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
