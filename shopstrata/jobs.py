"""Runnable jobs over a lake root.

    python -m shopstrata.jobs --root <folder> all
    python -m shopstrata.jobs --root <folder> dimensions order_items summary

Raw files are expected below ``<root>/raw/raw_landing/<entity>``. Jobs run in the
order given; ``all`` is every job in dependency order.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from shopstrata import schemas
from shopstrata.lake import Lake
from shopstrata.operators.keyed_table import KeyedTable
from shopstrata.operators.quality import require_unique
from shopstrata.operators.snapshots import SnapshotTable
from shopstrata.plans import gold, silver, summary
from shopstrata.session import build_session
from shopstrata.sources.csv import scan_by_header, scan_with_schema, with_lineage
from shopstrata.streaming.facts import FACTS, bronze_to_silver, silver_to_gold
from shopstrata.streaming.ingest import ingest_landing


@dataclass(frozen=True)
class Dimension:
    folder: str
    schema: StructType
    clean: Callable
    file_column: str
    time_column: str
    same_schema: bool = True  # silver keeps bronze's column types
    by_header: bool = False  # columns are taken by name, in whatever order the file has them


DIMENSIONS = {
    "brands": Dimension("brands", schemas.BRANDS, silver.brands, "source_file", "ingested_at", by_header=True),
    "category": Dimension("category", schemas.CATEGORY, silver.category, "_source_file", "_ingested_at"),
    "products": Dimension("products", schemas.PRODUCTS, silver.products, "file_name", "ingest_timestamp"),
    "customers": Dimension("customers", schemas.CUSTOMERS, silver.customers, "file_name", "ingest_timestamp"),
    "calendar": Dimension(
        "date", schemas.CALENDAR, silver.calendar, "_source_file", "_ingested_at", same_schema=False
    ),
}


def replace(table: SnapshotTable, rows: DataFrame, keep_columns: bool = True) -> None:
    table.overwrite(rows, keep_columns)
    table.vacuum()


def load_bronze_dimension(lake: Lake, name: str) -> None:
    spec = DIMENSIONS[name]
    files = f"{lake.landing(spec.folder)}/*.csv"
    if spec.by_header:
        raw = scan_by_header(lake.spark, files, columns=spec.schema.names)
    else:
        raw = scan_with_schema(lake.spark, files, spec.schema)
    replace(lake.snapshot("bronze", name), with_lineage(raw, spec.file_column, spec.time_column))


def build_silver_dimension(lake: Lake, name: str) -> None:
    spec = DIMENSIONS[name]
    rows = spec.clean(lake.snapshot("bronze", name).read())
    replace(lake.snapshot("silver", name), rows, keep_columns=spec.same_schema)


def build_gold_dimensions(lake: Lake) -> None:
    products, brands, category, customers, calendar = (
        lake.snapshot("silver", name).read()
        for name in ("products", "brands", "category", "customers", "calendar")
    )
    # A repeated code would repeat products.
    require_unique(brands, ["brand_code"], "silver brands")
    require_unique(category, ["category_code"], "silver category")
    dimensions = {
        "dim_products": gold.products(products, brands, category),
        "dim_customers": gold.customers(customers),
        "dim_date": gold.dates(calendar),
    }
    for name, rows in dimensions.items():
        replace(lake.snapshot("gold", name), rows, keep_columns=False)


def dimensions(lake: Lake) -> None:
    for name in DIMENSIONS:
        load_bronze_dimension(lake, name)
        build_silver_dimension(lake, name)
    build_gold_dimensions(lake)


def silver_table(lake: Lake, fact: str) -> KeyedTable:
    return getattr(lake, f"silver_{fact}")()


def gold_table(lake: Lake, fact: str) -> KeyedTable:
    return getattr(lake, f"gold_{fact}")()


def fact_flow(lake: Lake, name: str, max_files: int = 1000) -> None:
    """Landing files through bronze and silver to gold, whatever arrived since the last run."""
    fact = FACTS[name]
    ingest_landing(
        lake.spark, lake.landing(name), lake.path("bronze", name),
        lake.checkpoint("bronze", name), max_files=max_files, texts=fact.texts,
    )
    bronze = lake.bronze_facts(name)
    if not bronze.numbers():
        return
    bronze_to_silver(
        bronze, silver_table(lake, name), fact.clean, lake.checkpoint("silver", name), max_files
    )
    silver_to_gold(
        silver_table(lake, name), gold_table(lake, name), fact.enrich, lake.checkpoint("gold", name), max_files
    )
    for table in (silver_table(lake, name), gold_table(lake, name)):
        table.vacuum()


def daily_summary(lake: Lake) -> None:
    summary.refresh_from_table(lake.gold_order_items(), lake.daily_summary())
    lake.daily_summary().vacuum()


JOBS: dict[str, Callable[..., None]] = {
    "dimensions": dimensions,
    **{name: partial(fact_flow, name=name) for name in FACTS},
    "summary": daily_summary,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder of the lake")
    parser.add_argument("--max-files", type=int, default=1000, help="most files in one stream batch")
    parser.add_argument("jobs", nargs="+", choices=[*JOBS, "all"])
    options = parser.parse_args(arguments)
    lake = Lake(build_session(), options.root)
    for job in JOBS if "all" in options.jobs else options.jobs:
        more = {"max_files": options.max_files} if job in FACTS else {}
        JOBS[job](lake, **more)
    lake.register_all()


if __name__ == "__main__":
    main()
