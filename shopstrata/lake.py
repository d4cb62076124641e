"""The layered tables below one root folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shopstrata import schemas
from shopstrata.operators.commit_log import CommitLog
from shopstrata.operators.keyed_table import KeyedTable
from shopstrata.operators.snapshots import SnapshotTable
from shopstrata.sources.landing import FILE_TIME, SOURCE_FILE
from shopstrata.streaming.ingest import bronze_log

NEWEST_FILE = (FILE_TIME, SOURCE_FILE)

LAYERS = ("raw", "bronze", "silver", "gold")
PREFIX = {"bronze": "brz_", "silver": "slv_", "gold": "gld_"}

DIMENSION_TABLES = {
    "bronze": ("brands", "category", "products", "customers", "calendar"),
    "silver": ("brands", "category", "products", "customers", "calendar"),
    "gold": ("dim_products", "dim_customers", "dim_date"),
}


FACT_NAMES = ("order_items", "order_returns", "order_shipments")


class Lake:
    """Paths, tables and checkpoints; the root replaces catalog and storage settings."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{PREFIX[layer]}{name}"

    def landing(self, name: str) -> str:
        return f"{self.root}/raw/raw_landing/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root}/checkpoint/{layer}/{name}"

    def snapshot(self, layer: str, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path(layer, name))

    def bronze_facts(self, name: str) -> CommitLog:
        return bronze_log(self.spark, self.path("bronze", name))

    def keyed(self, layer: str, name: str, keys: Sequence[str], **options) -> KeyedTable:
        return KeyedTable(self.spark, self.path(layer, name), keys, **options)

    # Facts. Silver keeps the row of the newest file, whichever batch brings it, so the result
    # is the same however files are cut into batches; gold follows silver's feed.

    def silver_order_items(self) -> KeyedTable:
        return self.keyed("silver", "order_items", schemas.ORDER_ITEM_KEYS, order_by=[*NEWEST_FILE, "dt", "order_ts"], keep="greatest")

    def silver_order_returns(self) -> KeyedTable:
        return self.keyed("silver", "order_returns", schemas.RETURN_KEYS, order_by=[*NEWEST_FILE, "return_ts"], keep="greatest")

    def silver_order_shipments(self) -> KeyedTable:
        return self.keyed("silver", "order_shipments", schemas.SHIPMENT_KEYS, order_by=[*NEWEST_FILE, "order_dt"], keep="greatest")

    def gold_order_items(self) -> KeyedTable:
        # Laid out by date and order: the summary's window and a batch's keys both skip rows.
        return self.keyed(
            "gold", "fact_order_items", schemas.GOLD_ORDER_ITEM_KEYS, cluster_by=["transaction_date", "transaction_id"]
        )

    def gold_order_returns(self) -> KeyedTable:
        return self.keyed("gold", "order_returns", schemas.RETURN_KEYS)

    def gold_order_shipments(self) -> KeyedTable:
        return self.keyed("gold", "order_shipments", schemas.SHIPMENT_KEYS)

    def daily_summary(self) -> KeyedTable:
        # A sale without currency has its own summary row, which later runs must find.
        return self.keyed(
            "gold", "fact_daily_orders_summary", schemas.SUMMARY_KEYS,
            match_null_keys=True, sort_by=["date_id"],
        )

    # Catalog names

    def create_namespaces(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")

    def publish(self, layer: str, name: str, rows: DataFrame) -> None:
        """Give current rows a name for SQL in this session, such as ``gld_dim_products``."""
        rows.createOrReplaceTempView(f"{PREFIX[layer]}{name}")

    def tables(self) -> dict[tuple[str, str], SnapshotTable | KeyedTable | CommitLog]:
        """Every table there is, by layer and name."""
        named: dict[tuple[str, str], SnapshotTable | KeyedTable | CommitLog] = {
            (layer, name): self.snapshot(layer, name)
            for layer, names in DIMENSION_TABLES.items() for name in names
        }
        named |= {("bronze", name): self.bronze_facts(name) for name in FACT_NAMES}
        named |= {
            ("silver", "order_items"): self.silver_order_items(),
            ("silver", "order_returns"): self.silver_order_returns(),
            ("silver", "order_shipments"): self.silver_order_shipments(),
            ("gold", "fact_order_items"): self.gold_order_items(),
            ("gold", "order_returns"): self.gold_order_returns(),
            ("gold", "order_shipments"): self.gold_order_shipments(),
            ("gold", "fact_daily_orders_summary"): self.daily_summary(),
        }
        return {
            at: table for at, table in named.items()
            if (table.numbers() if isinstance(table, CommitLog) else table.exists())
        }

    def publish_all(self) -> list[str]:
        """Name the current rows of every table there is, for this session; returns the names."""
        for (layer, name), table in self.tables().items():
            self.publish(layer, name, table.read())
        return [f"{PREFIX[layer]}{name}" for layer, name in self.tables()]

    def register_all(self) -> list[str]:
        """Name every table there is in the schema of its layer, for all sessions of the catalog.

        ``gold.gld_fact_order_items`` and the others then read what was committed when this was
        last called; jobs call it when they are done.
        """
        self.create_namespaces()
        return [table.register(layer, f"{PREFIX[layer]}{name}") for (layer, name), table in self.tables().items()]
