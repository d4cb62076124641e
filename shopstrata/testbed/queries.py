"""Every operator run over the given tables; ``oracles`` holds the same results as SQL.

Queries about files, streams and tables stage their input in a scratch folder
first. Clock and path columns are left out of results, floats and decimals come
back as doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, StructType

from shopstrata import schemas
from shopstrata.functions.columns import named
from shopstrata.functions.lookups import BRAND_CODES, CATEGORY_CODES, REPORTED_CATEGORIES
from shopstrata.lake import Lake
from shopstrata.operators import quality
from shopstrata.operators.keyed_table import KeyedTable
from shopstrata.operators.latest import latest_per_key
from shopstrata.plans import gold, silver, summary
from shopstrata.session import scratch_folder, shuffles_freed
from shopstrata.sources import landing
from shopstrata.sources.csv import scan_by_header, scan_with_schema, with_lineage
from shopstrata.streaming import facts
from shopstrata.streaming.ingest import BATCH, bronze_log, ingest_landing
from shopstrata.streaming.runner import append_stream, dedup_stream, stream_table
from shopstrata.testbed import retail

UNSTABLE = (
    "processed_time", "ingest_timestamp", "source_file", landing.FILE_TIME, "_commit_timestamp", landing.RESCUED,
)
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}  # a third of the plain text, at little work
FIRST_ARRIVAL = "1999-01-01"  # staged arrivals are cut at this date


def result(df: DataFrame, *dropped: str) -> DataFrame:
    """Without clock and path columns, and with one type for fractional numbers."""
    kept = df.drop(*UNSTABLE, *dropped)
    return kept.select(*[
        named(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (FloatType, DecimalType)) else named(f.name)
        for f in kept.schema
    ])


def write_csv(df: DataFrame, folder: str, mode: str = "append", **options: str) -> None:
    with shuffles_freed(df.sparkSession):
        (
            df.write.mode(mode).option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .options(**options).csv(folder)
        )


# ---- sources -------------------------------------------------------------------


def scan_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "scan-header")
    write_csv(retail.customers(spark, sf_dir), f"{folder}/customers")
    return result(scan_by_header(spark, f"{folder}/customers/*.csv"))


def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "scan-schema")
    write_csv(retail.products(spark, sf_dir), f"{folder}/products")
    return result(scan_with_schema(spark, f"{folder}/products/*.csv", schemas.PRODUCTS))


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_lineage(retail.table(spark, sf_dir, "lineitem"))
    table_name = F.regexp_extract("source_file", r"/(\w+\.parquet)", 1)
    return rows.groupBy(table_name.alias("source_table")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("ingest_timestamp").alias("stamped_count")
    )


def schema_infer_persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "infer")
    write_csv(retail.order_shipments(spark, sf_dir), f"{folder}/landing")
    landing.kept_schema(spark, f"{folder}/landing", f"{folder}/schema.json")
    stored = landing.kept_schema(spark, f"{folder}/landing", f"{folder}/schema.json")
    rows = scan_with_schema(spark, f"{folder}/landing/*.csv", stored)
    return result(rows.withColumn("order_id", F.col("order_id").cast("bigint")))


def rescued_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in two layouts: without a column, and reordered with one that nobody declared."""
    folder = scratch_folder(spark, "rescue")
    items = retail.order_items(spark, sf_dir).withColumn("order_ts", F.col("order_ts").cast("date"))
    first, second = _two_arrivals(items, "dt")
    write_csv(first.drop("channel"), f"{folder}/landing")
    write_csv(second.select(*reversed(items.columns)), f"{folder}/landing")
    declared = StructType.fromDDL(
        "order_id bigint, item_seq int, dt date, order_ts date, customer_id bigint, product_id bigint, coupon_code string, "
        "unit_price_currency string, quantity int, unit_price string, discount_pct string, tax_amount double")
    ingest_landing(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/checkpoint", declared)
    return bronze_log(spark, f"{folder}/bronze").read().drop(
        "source_file", landing.FILE_TIME, "ingest_timestamp", BATCH)


def _two_arrivals(df: DataFrame, date_column: str) -> tuple[DataFrame, DataFrame]:
    early = named(date_column) < F.lit(FIRST_ARRIVAL).cast("date")
    return df.filter(early), df.filter(~early)


# ---- streams -------------------------------------------------------------------


def stream_ingest_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "ingest")
    write_csv(retail.order_items(spark, sf_dir), f"{folder}/landing")
    ingest_landing(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/checkpoint")
    rows = bronze_log(spark, f"{folder}/bronze").read()
    keys = {c: F.col(c).cast("bigint") for c in ("order_id", "customer_id", "product_id")}
    return result(rows.withColumns(keys), BATCH)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: some files, no new file, more files. Shows which batch brought each row."""
    folder = scratch_folder(spark, "resume")
    events = retail.table(spark, sf_dir, "events")
    middle = F.col("ts") < events.agg(
        F.expr("timestampadd(SECOND, cast(timestampdiff(SECOND, min(ts), max(ts)) / 2 as int), min(ts))")
    ).scalar()

    def run() -> None:
        ingest_landing(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/checkpoint")

    write_csv(events.filter(middle), f"{folder}/landing")
    run()
    run()
    write_csv(events.filter(~middle), f"{folder}/landing")
    run()
    rows = bronze_log(spark, f"{folder}/bronze").read()
    ids = {c: F.col(c).cast("bigint") for c in ("event_id", "user_id")}
    return result(rows.withColumns(ids).withColumnRenamed(BATCH, "ingest_batch"))


def stream_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "table-scan")
    append_stream(retail.stream(spark, sf_dir, "lineitem"), f"{folder}/copy", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/copy")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line once, exact repeats dropped: rows are keyed by order, line and what they say."""
    folder = scratch_folder(spark, "dedup")
    stream = retail.stream(spark, sf_dir, "lineitem")
    append_stream(dedup_stream(stream, stream.columns), f"{folder}/first", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/first")


def stream_dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each order line, whichever came first; what it says is a row of the source."""
    folder = scratch_folder(spark, "dedup-keys")
    keys = ["l_orderkey", "l_linenumber"]
    append_stream(
        dedup_stream(retail.stream(spark, sf_dir, "lineitem"), keys), f"{folder}/first", f"{folder}/checkpoint")
    first = spark.read.parquet(f"{folder}/first")
    return first.join(retail.table(spark, sf_dir, "lineitem"), first.columns, "left_semi").select(keys)


def stream_dedup_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs under a watermark of two days: the older events; the newer ones with repeats of the
    last day before them; all events again, and all under new ids. Of the last run only new ids
    within two days of the newest event are neither repeats nor late.
    """
    folder = scratch_folder(spark, "dedup-bounded")
    events = retail.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    middle = events.agg(F.expr("date_trunc('DAY', min(ts)) + interval 15 days")).scalar()
    older = events.filter(F.col("ts") < middle)
    newer = events.filter(F.col("ts") >= middle - F.expr("interval 1 day"))
    again = events.unionByName(events.withColumn("event_id", -1 - F.col("event_id")))
    for part in (older, newer, again):
        part.write.mode("append").parquet(f"{folder}/events")
        stream = stream_table(spark, f"{folder}/events")
        append_stream(dedup_stream(stream, ["event_id"], "ts", "2 days"), f"{folder}/first", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/first")


def stream_first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrival per key with the table as memory: early shipments stay, later ones are ignored."""
    folder = scratch_folder(spark, "first-arrival")
    table = KeyedTable(spark, f"{folder}/table", schemas.SHIPMENT_KEYS, ["order_dt"], keep="existing")
    return result(_streamed_shipments(spark, sf_dir, folder, table).read())


def stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "upsert-latest")
    table = KeyedTable(spark, f"{folder}/table", schemas.SHIPMENT_KEYS, ["order_dt"], keep="greatest")
    return result(_streamed_shipments(spark, sf_dir, folder, table, late_first=True).read())


def _streamed_shipments(
    spark: SparkSession, sf_dir: str, folder: str, table: KeyedTable, late_first: bool = False
) -> KeyedTable:
    """Two arrivals of shipments, each followed by a run of the silver stream."""
    bronze = bronze_log(spark, f"{folder}/bronze")
    arrivals = _two_arrivals(retail.order_shipments(spark, sf_dir), "order_dt")
    for part in reversed(arrivals) if late_first else arrivals:
        bronze.append(part)
        facts.bronze_to_silver(bronze, table, silver.clean_order_shipments, f"{folder}/checkpoint")
    return table


def change_feed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold shipments kept up through silver's change feed, both commits read in one run."""
    folder = scratch_folder(spark, "feed-latest")
    source = KeyedTable(spark, f"{folder}/silver", schemas.SHIPMENT_KEYS, ["order_dt"])
    target = KeyedTable(spark, f"{folder}/gold", schemas.SHIPMENT_KEYS)
    _streamed_shipments(spark, sf_dir, folder, source)
    facts.silver_to_gold(source, target, gold.order_shipments, f"{folder}/gold-checkpoint")
    return result(target.read())


# ---- tables --------------------------------------------------------------------


def _upserted_shipments(spark: SparkSession, sf_dir: str, label: str, **options) -> KeyedTable:
    """Late shipments first, then the early ones, which replace them."""
    folder = scratch_folder(spark, label)
    table = KeyedTable(spark, f"{folder}/table", schemas.SHIPMENT_KEYS, ["order_dt"], **options)
    cleaned = silver.clean_order_shipments(retail.order_shipments(spark, sf_dir))
    early, late = _two_arrivals(cleaned, "order_dt")
    table.upsert(late)
    table.upsert(early)
    return table


def _land_items(rows: DataFrame, folder: str, **options: str) -> None:
    # a key's rows lie in one file, so which of them is the newest does not depend on the clock
    write_csv(rows.repartition("order_id"), folder, **options)


def _take_in_items(
    spark: SparkSession, lake: Lake, folder: str, max_files: int = 1000, pattern: str = "*.csv"
) -> None:
    """Landing files that have arrived since the last call go through bronze to silver."""
    ingest_landing(
        spark, folder, lake.path("bronze", "order_items"), lake.checkpoint("bronze", "order_items"), pattern=pattern,
        max_files=max_files, texts=facts.ORDER_ITEMS.texts)
    facts.bronze_to_silver(
        lake.bronze_facts("order_items"), lake.silver_order_items(), silver.clean_order_items,
        lake.checkpoint("silver", "order_items"))


def _silver_items(lake: Lake) -> DataFrame:
    keys = {c: F.col(c).cast("bigint") for c in ("order_id", "customer_id", "product_id")}
    return result(lake.silver_order_items().read().withColumns(keys))


def silver_clean_then_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with plain numbers first, so that schemas are inferred from these; then words and signs.

    The files arrive compressed, and stay as they are.
    """
    lake = Lake(spark, scratch_folder(spark, "clean-then-dirty"))
    early, late = _two_arrivals(retail.order_items(spark, sf_dir), "dt")
    plain = early.withColumns({
        "quantity": F.when(F.col("quantity") == "Two", "2").when(F.col("quantity") != "x1", F.col("quantity")),
        "unit_price": F.replace("unit_price", F.lit("$"), F.lit("")),
        "discount_pct": F.replace("discount_pct", F.lit("%"), F.lit(""))})
    for rows in (plain, late):
        _land_items(rows, lake.landing("order_items"), **PACKED)
        _take_in_items(spark, lake, lake.landing("order_items"), pattern="*.csv.gz")
    return _silver_items(lake)


def silver_batch_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files in one batch, and in batches of few files."""
    lakes = {cut: Lake(spark, scratch_folder(spark, f"cuts-{cut}")) for cut in ("one", "several")}
    files = lakes["one"].landing("order_items")
    _land_items(retail.order_items(spark, sf_dir), files)
    for cut, most in (("one", 1000), ("several", 3)):
        _take_in_items(spark, lakes[cut], files, most)
    made = [_silver_items(lake).withColumn("cut", F.lit(cut)) for cut, lake in lakes.items()]
    return made[0].unionByName(made[1])


def upsert_unconditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(_upserted_shipments(spark, sf_dir, "upsert").read())


def upsert_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with a snapshot before the second upsert and one after it."""
    table = _upserted_shipments(spark, sf_dir, "upsert-settled", settle_bytes=0)
    table.settle()
    return result(table.read())


def change_feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(_upserted_shipments(spark, sf_dir, "feed", settle_bytes=0).changes())


def overwrite_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, scratch_folder(spark, "overwrite-merge"))
    rows = retail.products(spark, sf_dir)
    table = lake.snapshot("bronze", "products")
    table.overwrite(rows.select("product_id", "sku", "rating_count"))
    table.overwrite(rows.select("product_id", "sku", "material"))
    return result(table.read())


def overwrite_replace_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, scratch_folder(spark, "overwrite-replace"))
    table = lake.snapshot("silver", "calendar")
    table.overwrite(retail.calendar(spark, sf_dir))
    table.overwrite(silver.calendar(table.read()), keep_columns=False)
    return result(table.read())


# ---- reports -------------------------------------------------------------------


def value_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each code occurs after mapping, for both maps."""
    brands = retail.products(spark, sf_dir).replace(BRAND_CODES, subset=["brand_code"])
    categories = retail.brands(spark, sf_dir).replace(CATEGORY_CODES, subset=["category_code"])
    counted = [
        df.groupBy(F.lit(kind).alias("kind"), F.col(column).alias("code")).agg(F.count(F.lit(1)).alias("n"))
        for kind, df, column in (("brand", brands, "brand_code"), ("category", categories, "category_code"))
    ]
    return counted[0].unionByName(counted[1])


def distinct_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_within(
        retail.products(spark, sf_dir), "category_code", "brand_code", REPORTED_CATEGORIES
    )


def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_report(retail.order_shipments(spark, sf_dir), schemas.SHIPMENT_KEYS)


def null_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_key_report(retail.customers(spark, sf_dir), ["customer_id"])


def min_max_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    returns = silver.clean_order_returns(retail.order_returns(spark, sf_dir))
    return quality.value_ranges(returns, "order_dt", "return_ts")


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(
        retail.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


# ---- silver --------------------------------------------------------------------


def _silver(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return result(getattr(silver, name)(getattr(retail, name)(spark, sf_dir)))

    return query


def cleaned_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = silver.clean_order_items(retail.order_items(spark, sf_dir))
    return latest_per_key(items, schemas.ORDER_ITEM_KEYS, ["dt", "order_ts"])


def cleaned_order_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    returns = silver.clean_order_returns(retail.order_returns(spark, sf_dir))
    return latest_per_key(returns, schemas.RETURN_KEYS, ["return_ts"])


def cleaned_order_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipments = silver.clean_order_shipments(retail.order_shipments(spark, sf_dir))
    return latest_per_key(shipments, schemas.SHIPMENT_KEYS, ["order_dt"])


# ---- gold ----------------------------------------------------------------------


def dim_products_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(gold.products(
        silver.products(retail.products(spark, sf_dir)),
        silver.brands(retail.brands(spark, sf_dir)),
        silver.category(retail.category(spark, sf_dir)),
    ))


def dim_customers_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(gold.customers(silver.customers(retail.customers(spark, sf_dir))))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(gold.dates(silver.calendar(retail.calendar(spark, sf_dir))))


def sold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.order_items(cleaned_order_items(spark, sf_dir))


def daily_summary_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_summary(sold_items(spark, sf_dir))


def daily_summary_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary written with rows laid out by date, then read back."""
    lake = Lake(spark, scratch_folder(spark, "summary"))
    table = lake.snapshot("gold", "daily_orders_summary")
    table.overwrite(daily_summary_full(spark, sf_dir), cluster_by=["date_id"])
    return table.read()


def daily_summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run without the last ten days, second run over everything."""
    lake = Lake(spark, scratch_folder(spark, "summary-incremental"))
    items = lake.snapshot("gold", "fact_order_items")
    items.overwrite(sold_items(spark, sf_dir), cluster_by=["transaction_date"])
    rows = items.read()
    cut = rows.agg(F.date_sub(F.max("transaction_date"), 10)).scalar()
    summary.refresh_daily_summary(rows.filter(F.col("transaction_date") < cut), lake.daily_summary())
    summary.refresh_daily_summary(rows, lake.daily_summary())
    return lake.daily_summary().read()


def daily_summary_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored gold table and its summary, then corrections of any date and a second run of the summary.

    Sales of one part in thirteen have no currency. Only the last days are restated.
    """
    lake = Lake(spark, scratch_folder(spark, "summary-restated"))
    gold_items = lake.gold_order_items()
    unknown = F.when(F.col("product_id") % 13 != 0, F.col("unit_price_currency"))
    sold = sold_items(spark, sf_dir).withColumn("unit_price_currency", unknown)
    gold_items.upsert(sold, one_row_per_key=True)
    gold_items.settle()
    summary.refresh_from_table(gold_items, lake.daily_summary())
    corrected = sold.filter(F.col("transaction_id") % 5 == 0).withColumns({
        "quantity": F.col("quantity") + 3, "tax_amount": F.col("tax_amount") + 0.25})
    gold_items.upsert(corrected, one_row_per_key=True)
    lake.daily_summary().settle()
    summary.refresh_from_table(gold_items, lake.daily_summary())
    return lake.daily_summary().read()


def daily_summary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.top_rows(daily_summary_full(spark, sf_dir), [F.desc("date_id"), F.asc("currency")], 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_csv_header": scan_csv_header,
    "scan_csv_schema": scan_csv_schema,
    "lineage_columns": lineage_columns,
    "schema_infer_persist": schema_infer_persist,
    "rescued_data": rescued_data,
    "stream_ingest_append": stream_ingest_append,
    "stream_table_scan": stream_table_scan,
    "stream_resume": stream_resume,
    "stream_dedup": stream_dedup,
    "stream_dedup_keys": stream_dedup_keys,
    "stream_dedup_bounded": stream_dedup_bounded,
    "stream_first_arrival": stream_first_arrival,
    "stream_upsert_latest": stream_upsert_latest,
    "silver_clean_then_dirty": silver_clean_then_dirty,
    "silver_batch_cuts": silver_batch_cuts,
    "upsert_unconditional": upsert_unconditional,
    "upsert_settled": upsert_settled,
    "change_feed_rows": change_feed_rows,
    "change_feed_latest": change_feed_latest,
    "overwrite_merge_schema": overwrite_merge_schema,
    "overwrite_replace_schema": overwrite_replace_schema,
    "value_map": value_map,
    "distinct_by_category": distinct_by_category,
    "duplicate_report": duplicate_report,
    "null_key_report": null_key_report,
    "min_max_report": min_max_report,
    "dedup_latest": dedup_latest,
    "silver_brands": _silver("brands"),
    "silver_category": _silver("category"),
    "silver_calendar": _silver("calendar"),
    "silver_products": _silver("products"),
    "silver_customers": _silver("customers"),
    "silver_order_items": lambda spark, sf_dir: result(cleaned_order_items(spark, sf_dir)),
    "silver_returns": lambda spark, sf_dir: result(cleaned_order_returns(spark, sf_dir)),
    "silver_shipments": lambda spark, sf_dir: result(cleaned_order_shipments(spark, sf_dir)),
    "dim_products_join": dim_products_join,
    "dim_customers_region": dim_customers_region,
    "dim_date": dim_date,
    "gold_order_items": sold_items,
    "gold_returns": lambda spark, sf_dir: result(gold.order_returns(cleaned_order_returns(spark, sf_dir))),
    "gold_shipments": lambda spark, sf_dir: result(
        gold.order_shipments(cleaned_order_shipments(spark, sf_dir))
    ),
    "daily_summary_full": daily_summary_full,
    "daily_summary_clustered": daily_summary_clustered,
    "daily_summary_incremental": daily_summary_incremental,
    "daily_summary_restated": daily_summary_restated,
    "daily_summary_topk": daily_summary_topk,
}
