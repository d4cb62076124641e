"""The three fact flows: bronze rows to silver upserts, silver's change feed to gold upserts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from shopstrata.operators.commit_log import CommitLog
from shopstrata.operators.keyed_table import KeyedTable, feed_images, newest_images
from shopstrata.plans import gold, silver
from shopstrata.streaming.ingest import BATCH
from shopstrata.streaming.runner import drain

Transform = Callable[[DataFrame], DataFrame]

@dataclass(frozen=True)
class Fact:
    name: str
    clean: Transform
    enrich: Transform
    texts: tuple[str, ...] = ()  # columns that cleaning parses; they are text whatever the first files hold


ORDER_ITEMS = Fact(
    "order_items", silver.clean_order_items, gold.order_items, ("quantity", "unit_price", "discount_pct"))
ORDER_RETURNS = Fact("order_returns", silver.clean_order_returns, gold.order_returns)
ORDER_SHIPMENTS = Fact("order_shipments", silver.clean_order_shipments, gold.order_shipments)
FACTS = {fact.name: fact for fact in (ORDER_ITEMS, ORDER_RETURNS, ORDER_SHIPMENTS)}


def bronze_to_silver(
    bronze: CommitLog, table: KeyedTable, clean: Transform, checkpoint: str, max_files: int | None = None
) -> None:
    """Clean and upsert the bronze rows that arrived since the last run."""

    def load(rows: DataFrame, source: str, batch: int) -> None:
        table.upsert(clean(rows.drop(BATCH)), source, batch)

    drain(bronze.stream(max_files), load, checkpoint)


def silver_to_gold(
    source_table: KeyedTable, table: KeyedTable, enrich: Transform, checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Upsert what changed in silver since the last run.

    One batch may hold several commits of a key, so the newest image is taken first.
    Keys are renamed by ``enrich`` at most, so its result has one row per key as well.
    """

    def load(rows: DataFrame, source: str, batch: int) -> None:
        table.upsert(enrich(newest_images(rows, source_table.keys)), source, batch, one_row_per_key=True)

    drain(feed_images(source_table.stream_changes(max_files)), load, checkpoint)
