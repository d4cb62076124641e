"""Catalog names for tables that live in folders: external tables, and views over them.

A name is a view; what it reads are external tables whose names carry a hash of folder and
columns. A table that moves to a new folder gets a new external table, then the view is
replaced in one step, then tables it no longer reads are dropped (their files stay). A
session that reads while this happens sees the old rows or the new ones.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def columns_sql(schema: StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


class NamedView:
    """The view ``schema.name`` and the external tables that it reads."""

    def __init__(self, spark: SparkSession, schema: str, name: str):
        self.spark, self.schema, self.name = spark, schema, name
        self.used: set[str] = set()

    def external(self, path: str, columns: StructType, partition: str | None = None) -> str:
        """The name of an external table over a folder; made if there is none yet.

        ``partition`` names the column that sub-folders stand for; those there now are found.
        """
        mark = hashlib.md5(f"{path}\n{columns.json()}".encode()).hexdigest()[:12]
        table = f"{self.name}__{mark}"
        self.used.add(table)
        full = f"{quoted(self.schema)}.{quoted(table)}"
        by = f"PARTITIONED BY ({quoted(partition)})" if partition else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({columns_sql(columns)}) USING parquet {by} LOCATION '{path}'")
        if partition:
            self.spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        self.spark.sql(f"REFRESH TABLE {full}")
        return full

    def replace(self, query: str) -> str:
        full = f"{quoted(self.schema)}.{quoted(self.name)}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {full} AS {query}")
        for row in self.spark.sql(f"SHOW TABLES IN {quoted(self.schema)} LIKE '{self.name}__*'").collect():
            if row.tableName not in {t.lower() for t in self.used} | self.used:
                self.spark.sql(f"DROP TABLE {quoted(self.schema)}.{quoted(row.tableName)}")
        return full.replace("`", "")
