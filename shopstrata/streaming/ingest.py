"""Landing folder to bronze: every file once, every row kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopstrata.operators.commit_log import CommitLog
from shopstrata.sources import landing
from shopstrata.streaming.runner import drain

BATCH = "_ingest_batch"


def bronze_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, path, BATCH)


def ingest_landing(
    spark: SparkSession,
    folder: str,
    bronze_path: str,
    checkpoint: str,
    schema: StructType | None = None,
    pattern: str = "*.csv",
    max_files: int = 1000,
    texts: Sequence[str] = (),
) -> None:
    """Load the files that have arrived since the last run.

    The stream carries file names only; each batch of files is then read as an
    ordinary, adaptively planned job. ``max_files`` bounds a batch. Columns in ``texts``
    stay text where the schema is inferred.
    """
    expected = schema or landing.kept_schema(spark, folder, f"{checkpoint}/schema.json", pattern, texts)
    log = bronze_log(spark, bronze_path)

    def load(rows: DataFrame, source: str, batch: int) -> None:
        if log.find(source, batch) is not None:
            return
        paths = [row.path for row in rows.collect()]  # at most max_files names
        strings = landing.read_as_strings(spark, paths)
        if strings is not None:
            log.append(bronze_rows(strings, expected), source, batch)

    files = landing.stream_landing_files(spark, folder, pattern, max_files)
    drain(files, load, f"{checkpoint}/stream", output_mode="append")


def bronze_rows(strings: DataFrame, schema: StructType) -> DataFrame:
    return landing.rescued(strings, schema).withColumn("ingest_timestamp", F.current_timestamp())
