"""Running a stream until what is available has been processed."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata import storage

SHARES = 32  # tasks that the rows of one key go to at first
ANY_AGE = "36500d"  # file streams pass over files older than a week by default


def drain(
    stream: DataFrame,
    handle: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    output_mode: str = "update",
) -> None:
    """Pass every micro-batch to ``handle(rows, source, batch)``, then stop.

    ``source`` is the stream's lasting identity, stored in its checkpoint. A batch is
    delivered again after a failure, always with the same source and batch number;
    a fresh checkpoint is a new source, so its batch 0 is not taken for an old one.
    No ``.format`` after ``foreachBatch``: it would replace the handler.
    """
    spark = stream.sparkSession

    def deliver(rows: DataFrame, batch: int) -> None:
        identity = json.loads(storage.read_text(spark, f"{checkpoint}/metadata"))["id"]
        handle(rows, identity, batch)

    query = (
        stream.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that is available to a parquet folder, each row exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_table(spark: SparkSession, table: str, max_files: int | None = None) -> DataFrame:
    """A stream over a parquet table: the rows it has, then those appended later.

    ``table`` is a path, or the name of a table in the catalog. A file that is delivered
    late with an old time is not passed over.
    """
    path = table
    if "/" not in table:
        details = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'")
        path = details.first().data_type
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def dedup_stream(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str | None = None,
    delay: str | None = None,
    thin: bool = True,
) -> DataFrame:
    """First arrival per key, remembered in the checkpoint across runs.

    Without an event time every key is remembered for ever. With one, a key is
    forgotten ``delay`` after it was seen, which bounds the state; rows that come more than that
    after the newest time of earlier batches are dropped. Without an event time ``thin``
    drops repeats within shares of the input first, so that the rows of a very frequent key are
    few by the time they meet in one task. With one it could drop the timely row of a
    key in favour of a late one, so nothing is dropped beforehand.

    The fact tables need none of this: there the table itself is the memory.
    """
    if thin and event_time is None:
        stream = without_near_repeats(stream, keys)
    if event_time is not None:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def without_near_repeats(df: DataFrame, keys: Sequence[str], shares: int = SHARES) -> DataFrame:
    """The first row of each key in each of ``shares`` shares of the input's partitions.

    Spark's deduplication sends all rows of a key to one task. Here the share is a part of the key,
    so a frequent key goes to as many tasks, and ``shares`` rows of it are left. In a stream
    the state of this step holds a key once for each share that it came in.
    """
    share = "_share"
    while share in df.columns:
        share += "_"
    parted = df.withColumn(share, F.spark_partition_id() % F.lit(shares))
    return parted.dropDuplicates([*keys, share]).drop(share)
