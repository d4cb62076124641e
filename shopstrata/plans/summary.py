"""Daily sales per currency, recomputed in full once and then for the last days only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.functions.columns import exact_total
from shopstrata.functions.lookups import SUMMARY_WINDOW_DAYS
from shopstrata.operators.keyed_table import KeyedTable


def daily_summary(gold_order_items: DataFrame) -> DataFrame:
    return gold_order_items.groupBy(
        "date_id", F.col("unit_price_currency").alias("currency")
    ).agg(
        F.sum("quantity").alias("total_quantity"),
        exact_total(F.col("gross_amount")).alias("total_gross_amount"),
        exact_total(F.col("discount_amount")).alias("total_discount_amount"),
        exact_total(F.col("tax_amount")).alias("total_tax_amount"),
        exact_total(F.col("net_amount")).alias("total_amount"),
    )


def recent(
    gold_order_items: DataFrame, days: int = SUMMARY_WINDOW_DAYS, newest: dt.date | None = None
) -> DataFrame:
    """Rows dated at most ``days`` before the newest date, both ends included.

    A ``newest`` date that is known already saves a pass over the dates. Else the bound is a
    scalar subquery: Spark runs it first and hands the value to the parquet scan. Either way
    files, row groups and pages outside the window are skipped.
    """
    if newest is not None:
        start = F.lit(newest - dt.timedelta(days=days))
    else:
        start = gold_order_items.agg(F.date_sub(F.max("transaction_date"), days)).scalar()
    return gold_order_items.filter(F.col("transaction_date") >= start)


def refresh_daily_summary(
    gold_order_items: DataFrame, table: KeyedTable, days: int = SUMMARY_WINDOW_DAYS, newest: dt.date | None = None
) -> int:
    """Create the summary, or restate its last days; older dates keep their values."""
    source = recent(gold_order_items, days, newest) if table.exists() else gold_order_items
    return table.upsert(daily_summary(source), one_row_per_key=True)


def refresh_from_table(gold_order_items: KeyedTable, table: KeyedTable, days: int = SUMMARY_WINDOW_DAYS) -> int:
    """The same from the stored table, whose newest date is found without reading rows."""
    newest = gold_order_items.newest("transaction_date") if table.exists() else None
    return refresh_daily_summary(gold_order_items.read(), table, days, newest)
