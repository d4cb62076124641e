"""Rendezvous hashing of stable keys over weighted shards, in DataFrame functions only.

Each shard draws a score for a record from the record's key and the shard's own number; the
highest score wins. A shard that is added can only win records for itself, and one that is
removed gives up only its own, so a change of the count moves the least number of records.
With a weight w the score is -w / ln(u), which makes a shard's share proportional to w.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstrata.llm.scratch import Scratch, documents

SHARDS = 24
RUN_ROWS = 50_000  # rows that are numbered together; a run stays about this long at any size


def uniform(key: Column, shard: int) -> Column:
    """A number in (0, 1) that depends on key and shard only."""
    digest = F.md5(F.concat(F.lit(f"{shard}:"), key).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that wins the key; ties go to the smaller number. A null key counts as ''."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = F.array(*[
        F.struct((-F.lit(float(w)) / F.ln(uniform(text, n))).alias("score"), F.lit(-n).alias("shard"))
        for n, w in enumerate(weights)
    ])
    return (-F.array_max(scores)["shard"]).cast("int")


def grown(key: Column, shard: Column, weights: Sequence[float], added: float) -> Column:
    """Shard after one more shard joins: the old winner stays unless the new one beats it."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    score = lambda n, w: -F.lit(float(w)) / F.ln(uniform(text, n))
    old = F.array_max(F.array(*[score(n, w) for n, w in enumerate(weights)]))
    return F.when(score(len(weights), added) > old, F.lit(len(weights))).otherwise(shard).cast("int")


def with_slots(rows: DataFrame, scratch: Scratch, run_rows: int = RUN_ROWS) -> DataFrame:
    """Adds ``slot``, gapless from 0 within each ``shard``, ordered by a hash of ``_order``, then ``_order``.

    A shard is never numbered in one task: its rows are cut into runs by hash, runs are
    counted, and a row's slot is its place in its run plus the rows of the runs before.
    """
    kept = scratch.table(rows, "sharded")
    total = kept.count()
    runs = max(1, -(-total // (run_rows * 4)))
    placed = kept.withColumn("_hash", F.md5(F.coalesce(F.col("_order").cast("string"), F.lit("")).cast("binary")))
    placed = placed.withColumn(
        "_run", F.floor(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("double") / float(1 << 32) * runs))
    before = Window.partitionBy("shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    counted = placed.groupBy("shard", "_run").agg(F.count("*").alias("_n"))
    starts = counted.select("shard", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_run").orderBy("_hash", "_order", *[
        c for c in kept.columns if c not in ("shard", "_order")])
    return (
        placed.withColumn("_place", F.row_number().over(within) - 1)
        .join(starts, ["shard", "_run"])
        .withColumn("slot", F.col("_start") + F.col("_place"))
        .drop("_hash", "_run", "_place", "_start")
    )


def assign(docs: DataFrame, scratch: Scratch, weights: Sequence[float] = (1.0,) * SHARDS,
           id_col: str = "doc_id", text_col: str = "text", run_rows: int = RUN_ROWS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    The law is ``key``: id and shard weights decide, nothing else. Rows that repeat an id
    share its shard and get slots of their own; a null id is a key of its own. A null text has no bytes and the
    checksum of the empty text. The size is UTF-8 bytes plus 8 for the id.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.col(id_col)
    sharded = docs.select(
        key.alias("_order"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), rendezvous(key, weights).alias("shard"))
    sharded = sharded.withColumn("grown_shard", grown(F.col("_order"), F.col("shard"), weights, 1.0))
    return with_slots(sharded, scratch, run_rows).select(
        F.col("_order").alias("id"), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long"), "grown_shard")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir), Scratch(spark, "sharding")).withColumnRenamed("id", "doc_id")

