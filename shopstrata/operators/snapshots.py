"""Whole-table overwrite: each write is a new committed version, readers take the newest."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from shopstrata import storage
from shopstrata.functions.columns import named
from shopstrata.operators.names import NamedView


def with_columns_of(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` it lacks added as typed nulls.

    A column present in both must have the same type in both.
    """
    present = {f.name: f.dataType for f in df.schema}
    for field in schema:
        if field.name in present and present[field.name] != field.dataType:
            raise TypeError(
                f"column {field.name} is {field.dataType.simpleString()} in the table "
                f"but {present[field.name].simpleString()} in the new rows"
            )
    missing = [f for f in schema if f.name not in present]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def versions(self) -> list[int]:
        names = storage.child_names(self.spark, self.path)
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def exists(self) -> bool:
        return bool(self.versions())

    def location(self) -> str:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no table at {self.path}")
        return f"{self.path}/v={versions[-1]}"

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.location())

    def register(self, schema: str, name: str) -> str:
        """Give the newest version a lasting name in the catalog; to be called again after a write."""
        view = NamedView(self.spark, schema, name)
        return view.replace(f"SELECT * FROM {view.external(self.location(), self.read().schema)}")

    def overwrite(
        self,
        df: DataFrame,
        keep_columns: bool = True,
        cluster_by: Sequence[str] = (),
    ) -> int:
        """Replace the rows.

        ``keep_columns`` keeps columns of the old table that ``df`` lacks, as nulls,
        and refuses a changed type; without it the schema is replaced as well.
        ``cluster_by`` lays rows out by range, so later filters on those columns
        skip files and row groups.
        """
        versions = self.versions()
        if keep_columns and versions:
            df = with_columns_of(df, self.read().schema)
        if cluster_by:
            columns = [named(c) for c in cluster_by]
            # The hash lets a range be cut inside one value that holds much of the table.
            spread = F.xxhash64(*[named(f.name) for f in df.schema if not isinstance(f.dataType, MapType)])
            df = df.repartitionByRange(*columns, spread).sortWithinPartitions(*columns)
        number = versions[-1] + 1 if versions else 0
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(staged)
        storage.publish(self.spark, staged, f"{self.path}/v={number}")
        return number

    def vacuum(self, keep: int = 2) -> None:
        """Drop versions older than the newest ``keep`` and leftovers of failed writes.

        Called by the writer, between writes; running readers need the newest few versions.
        """
        storage.remove(self.spark, f"{self.path}/_staging")
        for number in self.versions()[:-keep]:
            storage.remove(self.spark, f"{self.path}/v={number}")
