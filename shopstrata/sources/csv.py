"""Headered CSV scans and lineage columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_by_header(
    spark: SparkSession, path: str, delimiter: str = ",", columns: Sequence[str] | None = None
) -> DataFrame:
    """Every column, or those named, as a string under its header's name. ``path`` may be a glob.

    Files are expected to share one header.
    """
    found = spark.read.option("header", True).option("delimiter", delimiter).csv(path)
    return found if columns is None else found.select(*columns)


def scan_with_schema(
    spark: SparkSession, path: str, schema: StructType, delimiter: str = ","
) -> DataFrame:
    """Columns typed by ``schema``.

    Spark fills a given schema by position. ``enforceSchema=False`` makes it check
    each file's header, so a file with reordered columns fails instead of being
    read wrongly.
    """
    reader = spark.read.option("header", True).option("delimiter", delimiter)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def with_lineage(
    df: DataFrame, file_column: str = "source_file", time_column: str = "ingest_timestamp"
) -> DataFrame:
    """Add the file each row came from and the time it was read; batch or stream."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(file_column),
        F.current_timestamp().alias(time_column),
    )
