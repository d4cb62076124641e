"""Exact deduplication with a split for heavy hitters, in DataFrame functions only.

A Misra-Gries summary (``approx_top_k``, Spark's frequent-items sketch) over the text digests
names every digest that can hold more than a small share of the rows. Its candidates are then
counted exactly; that table has at most ``HEAVY`` rows, so it is broadcast and settles the
large groups on the map side. All other digests go through an ordinary shuffle, in which no
group can hold more rows than the sketch's error allows (about 3.5 / ``TRACKED`` of the input).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstrata.functions.columns import named
from shopstrata.llm.scratch import Scratch, documents, one_row_each, unused

HEAVY = 1024  # most digests treated as heavy: the bound of the broadcast
TRACKED = 16384  # counters of a sketch
SKETCHES = 32  # sketches, each over a share of the partitions; a frequent digest is frequent in one of them

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone; the quick form where a text has nothing beyond ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_digest(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def heavy_groups(keys: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """Exact (digest, keep_id, group_size) of at most ``heavy`` frequent digests.

    Sketches are merged for a share of the partitions each, so none gathers all tasks' counters;
    their candidates are at most ``SKETCHES * heavy`` digests, a bounded broadcast.
    """
    sketches = keys.groupBy((F.spark_partition_id() % SKETCHES).alias("_share")).agg(
        F.expr(f"approx_top_k(_digest, {int(heavy)}, {int(tracked)})").alias("top"))
    candidates = sketches.select(F.explode("top").alias("c")).where("c.count > 1").select(
        F.col("c.item").alias("_digest")).distinct()
    counted = keys.join(F.broadcast(candidates), "_digest", "left_semi").groupBy("_digest").agg(
        F.max("_id").alias("_keep"), F.count("*").alias("_size"))
    return counted.orderBy(F.col("_size").desc(), "_digest").limit(heavy)


def mark_copies(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """(id, digest, keep_id, group_size, kept) for every row.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The largest
    id of a group stays; a null id stays only in a group of nulls. Rows that repeat both id
    and text are all marked kept. An empty table gives an empty result. Other columns are
    not looked at.
    """
    keys = scratch.table(
        docs.select(F.col(id_col).alias("_id"), text_digest(F.col(text_col)).alias("_digest")), "keys")
    groups = scratch.table(heavy_groups(keys, heavy, tracked), "heavy")
    large = keys.join(F.broadcast(groups), "_digest")
    small = keys.join(F.broadcast(groups), "_digest", "left_anti")
    same = Window.partitionBy("_digest")
    small = small.withColumns({"_keep": F.max("_id").over(same), "_size": F.count("*").over(same)})
    columns = ["_id", "_digest", "_keep", "_size"]
    return large.select(columns).unionByName(small.select(columns)).select(
        F.col("_id").alias("id"), F.col("_digest").alias("digest"), F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"), F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"))


def drop_copies(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged, one row for each distinct text.

    Decisions are made on (id, digest) alone; texts are not shuffled for them. The dropped
    rows' keys come back as an anti-join. Of rows that repeat id and text the least by all
    columns stays.
    """
    key, digest, gone_id, gone_digest = unused(docs, "_id", "_digest", "_gone_id", "_gone_digest")
    marked = mark_copies(docs, scratch, id_col, text_col)
    names = [F.col("id").alias(gone_id), F.col("digest").alias(gone_digest)]
    gone = scratch.table(marked.where(~F.col("kept")).select(*names).distinct(), "gone")
    repeated = scratch.table(
        marked.where("kept").groupBy("id", "digest").count().where("count > 1").select(*names), "repeated")
    keyed = docs.withColumns({key: named(id_col), digest: text_digest(named(text_col))})
    same = F.col(key).eqNullSafe(F.col(gone_id)) & (F.col(digest) == F.col(gone_digest))
    left = keyed.join(gone, same, "left_anti")
    if repeated.isEmpty():
        return left.select(*map(named, docs.columns))
    once = one_row_each(left.join(repeated, same, "left_semi"), [key, digest])
    return left.join(repeated, same, "left_anti").unionByName(once).select(*map(named, docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_copies(documents(spark, sf_dir), Scratch(spark, "exact-dedup"))
    return marked.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL = """
WITH keyed AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents),
grouped AS (
    SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM keyed GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM keyed JOIN grouped USING (text_sha256)
"""
