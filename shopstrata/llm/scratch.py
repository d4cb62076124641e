"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from shopstrata.functions.columns import named
from shopstrata.session import scratch_folder


class Scratch:
    """Writes intermediate results as Parquet and reads them back, which cuts their lineage.

    A lost executor then costs the tasks of one step only. The folder lies below
    ``spark.checkpoint.dir`` (see ``scratch_folder``) and goes when the driver ends;
    ``drop`` frees a table earlier.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = scratch_folder(spark, label)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until ``df`` has no such columns."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def one_row_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of ``keys``: the least by all columns that can be ordered."""
    ordered = [named(f.name) for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType != VariantType()]
    row = F.struct(*map(named, df.columns))
    (kept,) = unused(df, "_kept")
    return df.groupBy(*map(named, keys)).agg(F.min_by(row, F.struct(*ordered)).alias(kept)).select(f"{kept}.*")


def gives_back(work: Callable) -> Callable:
    """A function over Arrow batches whose worker returns its free memory when it is done.

    Workers are used again for other stages; what an allocator keeps would add up over them.
    """
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return run


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand whole texts to Python in batches of so many rows; a batch lies in a worker's memory at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def word_count(text):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column; null has none."""
    inner = F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(F.coalesce(inner, F.lit("")) == "", F.lit(0)).otherwise(
        F.size(F.split(inner, r"[\x20\x09-\x0D]+"))
    ).cast("long")
