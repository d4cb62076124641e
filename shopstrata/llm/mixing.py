"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order, served twice over at most. A
document's virtual finish time is the cumulative size of its queue divided by the source's
target. All queues are merged by a global range sort on that time and cut at the total budget,
so at any point of the mix the sources stand at their target proportions.

Queues are summed in runs of bounded length (cut by the shuffle's hash), never a whole source
in one task; the merged order is summed within and then over the ranges of the sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstrata.functions.columns import named
from shopstrata.llm.scratch import Scratch, documents, unused, word_count

WEIGHTS = (5, 2, 1)  # of the sources in code point order, repeating
SHARE = 1.5  # budget as a share of all sizes
REPEATS = 2  # most times that a document is taken
RUN_ROWS = 10_000  # rows that are summed together; a run stays about this long at any size


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The budget is shared by weight; a target stops at ``REPEATS`` times its source's size and
    the excess goes to the others. Sources that reach their limit are those with the smallest
    limit per weight, so one sorted pass finds the level of the rest. One row for each source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_n", F.row_number().over(order) - 1).withColumn(
        "_weight", F.element_at(cycle, (F.col("_n") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_limit", F.col("source_size") * REPEATS)
    by_level = Window.orderBy(F.col("_limit") / F.col("_weight"), "_n")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = (total * share - F.coalesce(F.sum("_limit").over(before), F.lit(0))) / F.sum("_weight").over(onward)
    open_at = F.when(level * F.col("_weight") <= F.col("_limit"), level)
    found = ranked.withColumn("_open", open_at)
    common = F.first("_open", ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return found.select(
        "source", "source_size",
        F.least(F.col("_limit").cast("double"), F.coalesce(common, F.lit(float("inf"))) * F.col("_weight")).alias("target"))


def shuffle_key(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(id, mark, source, size, source_size, target, times) for every row; ``mark`` is a hash of the text.

    ``times`` says how often the mix takes the whole document: 0, 1 or 2. Null texts have size 0
    and are never taken; null sources form one source, last in order. Rows that repeat are
    documents of their own. The result depends on the rows only, not on their order.
    """
    sized = scratch.table(docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("mark"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        shuffle_key(F.col(id_col)).alias("_key")), "sized")
    runs = max(1, -(-sized.count() // RUN_ROWS))
    sized = sized.withColumn(
        "_run", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / float(1 << 32) * runs))

    sums = scratch.table(sized.groupBy("source", "_run").agg(F.sum("size").alias("_sum")), "runs")
    goal = scratch.table(targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size"))), "targets")
    before = Window.partitionBy("source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "_run", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    starts = starts.join(goal, starts["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    within = Window.partitionBy("source", "_run").orderBy("_key", "id", "size")
    queued = sized.withColumn("_place", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    queued = queued.join(
        starts, queued["source"].eqNullSafe(starts["source"]) & (queued["_run"] == starts["_run"])
    ).drop(starts["source"], starts["_run"])
    # a row for each time that the document stands in its queue
    queue = scratch.table(queued.select(
        "_row", "id", "source", "size", "source_size", "target", "_key",
        F.explode(F.array(*[F.lit(n) for n in range(REPEATS)])).alias("_epoch"),
        (F.col("_start") + F.col("_place")).alias("_cumulative"),
    ).where("size > 0").withColumn(
        "_finish", (F.col("_epoch") * F.col("source_size") + F.col("_cumulative")) / F.col("target")), "queue")

    order = ["_finish", "_epoch", "_key", "id", "size"]
    ranges = max(1, -(-queue.count() // RUN_ROWS))
    merged = scratch.table(
        queue.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
        .select("_row", "_range", "target", *order), "merged")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = merged.groupBy("_range").agg(F.sum("size").alias("_sum"))
    offsets = offsets.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    budget = goal.agg((F.sum("source_size") * share).alias("_budget"))
    limits = offsets.withColumn("_budget", budget.scalar())
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    taken = (
        merged.withColumn("_sum", F.sum("size").over(inside)).join(limits, "_range")
        .where(F.col("_offset") + F.col("_sum") <= F.col("_budget"))
        .groupBy("_row").agg(F.count("*").alias("times"))
    )
    sized = sized.join(taken, "_row", "left")
    return sized.join(goal, sized["source"].eqNullSafe(goal["source"])).select(
        "id", "mark", sized["source"].alias("source"), "size", "source_size", "target",
        F.coalesce("times", F.lit(0)).cast("int").alias("times"))


def mixed(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: rows of ``docs`` with all columns, each as often as it is taken.

    Rows that repeat both id and text count as often as the one taken most.
    """
    mark, copy, key, text, times = unused(docs, "_mark", "_copy", "_key", "_text", "_times")
    found = mix(docs, scratch, id_col, text_col).where("times > 0")
    found = scratch.table(
        found.groupBy(F.col("id").alias(key), F.col("mark").alias(text)).agg(F.max("times").alias(times)), "taken")
    marked = docs.withColumn(mark, F.xxhash64(named(text_col)))
    same = marked[id_col].eqNullSafe(found[key]) & (marked[mark] == found[text])
    return marked.join(found, same).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*map(named, docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir), Scratch(spark, "mixing")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


_WORDS = r"len(string_split_regex(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+'))"
SQL = rf"""
WITH sized AS (
    SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key,
           CASE WHEN coalesce(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '') = '' THEN 0
                ELSE {_WORDS} END::BIGINT AS size
    FROM documents),
sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
    FROM sized GROUP BY source),
weighted AS (
    SELECT *, CASE n % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, source_size * 2 AS cap
    FROM sizes),
levels AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
               - coalesce(sum(cap) OVER (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / sum(weight) OVER (ORDER BY cap / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted),
goals AS (
    SELECT source, source_size,
           least(cap::DOUBLE, coalesce((SELECT arg_min(level, (cap / weight, n)) FROM levels WHERE level * weight <= cap),
                                       'inf'::DOUBLE) * weight) AS target
    FROM levels),
queue AS (
    SELECT doc_id, size, key, epoch, target,
           ((epoch * source_size + sum(size) OVER (PARTITION BY s.source, epoch ORDER BY key, doc_id, size
                ROWS UNBOUNDED PRECEDING))::BIGINT)::DOUBLE / target AS finish
    FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source, range(2) e(epoch)
    WHERE size > 0),
merged AS (
    SELECT doc_id, sum(size) OVER (ORDER BY finish, epoch, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS used FROM queue),
taken AS (
    SELECT doc_id, count(*) AS times FROM merged
    WHERE used::DOUBLE <= (SELECT sum(source_size)::DOUBLE * 1.5::DOUBLE FROM goals) GROUP BY doc_id)
SELECT s.doc_id, s.size, g.source_size, g.target, (s.size * coalesce(t.times, 0))::BIGINT AS taken
FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN taken t ON s.doc_id = t.doc_id
"""
