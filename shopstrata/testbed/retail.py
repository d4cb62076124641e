"""Retail-shaped raw rows derived from the given star-schema tables.

The given tables are clean, so each value that a cleaning step exists for is made
dirty by a rule on the row itself: text quantities, currency signs, blanks, case,
decimal commas, missing keys. ``raw_sql`` states the same rules for the check engine.
Every row of the source table is used, but returns are the returned lines only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.functions.lookups import BRAND_CODES
from shopstrata.streaming.runner import stream_table

BRANDS = 25  # p_brand runs from Brand#1 to Brand#25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stream over a given table, be it one file or a folder: only a glob may name either."""
    return stream_table(spark, f"{sf_dir}/{name}.parque[t]")


def _pick(index: Column, *values: str | None) -> Column:
    """The value at a position counted from zero."""
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _digits(value: Column) -> Column:
    return value.cast("string")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    priority = F.substring("o_orderpriority", 1, 1)
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("item_seq"),
        F.col("l_shipdate").cast("date").alias("dt"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7), "Web")
        .when(F.col("l_linestatus") == "O", "web").otherwise("app").alias("channel"),
        F.when(priority == "1", " SAVE10 ").when(priority == "2", "  ")
        .when(priority == "3", "Festive").alias("coupon_code"),
        F.when(F.col("l_returnflag") == "A", "INR").when(F.col("l_returnflag") == "N", "USD")
        .otherwise("AED").alias("unit_price_currency"),
        F.when(F.col("l_partkey") % 97 == 13, "x1").when(F.col("l_quantity") == 2, "Two")
        .otherwise(_digits(F.col("l_quantity").cast("int"))).alias("quantity"),
        F.concat(F.lit("$"), _digits(F.col("l_extendedprice").cast("decimal(12,2)"))).alias("unit_price"),
        F.concat(_digits(F.round(F.col("l_discount") * 100).cast("int")), F.lit("%")).alias("discount_pct"),
        (F.col("l_quantity") * F.col("l_tax")).alias("tax_amount"),
    )


def order_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_dt"),
        F.date_format("l_shipdate", "yyyy-MM-dd 23:00:00").alias("return_ts"),
        _pick(F.col("l_linenumber") % 4, " damaged ", "Wrong Item", None, "late").alias("reason"),
    )


def order_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("shipment_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("order_dt"),
        _pick(
            F.col("l_suppkey") % 6, " bluedart ", "Delhivery", "XPRESSBEES", " EcomExpress", "DHL", None
        ).alias("carrier"),
    )


def _brand_number(brand: Column) -> Column:
    return F.regexp_replace(brand, "[^0-9]", "").cast("int")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    number = _brand_number(F.col("p_brand"))
    codes = list(BRAND_CODES)[:BRANDS]
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), _digits(key)).alias("product_id"),
        F.col("p_name").alias("sku"),
        _pick(key % 8, "hnk", "ce", "app", "grcy", "bpc", "spt", "toy", "bks").alias("category_code"),
        F.when(key % 31 == 5, "zzzz").otherwise(_pick(number - 1, *codes)).alias("brand_code"),
        F.split("p_name", " ").getItem(0).alias("color"),
        _pick(size % 4, "S", "M", "L", None).alias("size"),
        F.col("p_type").alias("material"),
        F.when(size == 50, "g").when(size % 7 == 0, _digits(size * 10))
        .otherwise(F.concat(_digits(size * 10), F.lit("g"))).alias("weight_grams"),
        F.concat(_digits(size), F.lit(",5")).alias("length_cm"),
        (size * 0.25).cast("float").alias("width_cm"),
        (size * 0.75).cast("float").alias("height_cm"),
        F.when(size % 5 == 0, None).when(size % 2 == 0, -size).otherwise(size).alias("rating_count"),
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = _brand_number(F.col("p_brand"))
    names = list(BRAND_CODES.values())[:BRANDS]
    numbered = table(spark, sf_dir, "part").select(number.alias("n")).distinct()
    name = _pick(F.col("n") - 1, *names)
    return numbered.select(
        F.concat(F.lit("b"), _digits(F.col("n"))).alias("brand_code"),
        F.concat(F.lit(" "), F.substring(name, 1, 4), F.lit("-"), F.substring(name, 5, 99), F.lit(" "))
        .alias("brand_name"),
        _pick(F.col("n") % 10, "HNK", "CE", "APP", "GROCERY", "BPC", "SPT", "TOYS", "BOOKS", "toys", None)
        .alias("category_code"),
    )


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every code in upper and in lower case, once per part size, under two names."""
    n = F.col("p_size") % 16
    code = _pick(n % 8, "hnk", "ce", "app", "grcy", "bpc", "spt", "toy", "bks")
    name = _pick(
        n % 8, "Home and Kitchen", "Consumer Electronics", "Apparel", "Grocery",
        "Beauty and Personal Care", "Sports", "Toys", "Books",
    )
    return table(spark, sf_dir, "part").select(
        F.when(n < 8, F.upper(code)).otherwise(code).alias("category_code"),
        F.when(n < 8, name).otherwise(F.upper(name)).alias("category_name"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 50 == 7, None).otherwise(F.concat(F.lit("C"), _digits(key))).alias("customer_id"),
        F.when(key % 11 == 3, None).when(key % 11 == 4, "5")
        .otherwise(F.concat(_digits(key + 9000000000), F.lit(".0"))).alias("phone"),
        _digits(nation).alias("country_code"),
        _pick(
            nation % 7, "India", "Australia", "United Kingdom", "United States",
            "United Arab Emirates", "Singapore", "Canada",
        ).alias("country"),
        _pick(key % 9, "MH", "VIC", "ENG", "CA", "DU", "SG", "ON", "WA", "ZZ").alias("state"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, so each date comes many times and in several spellings."""
    day, key = F.col("day"), F.col("o_orderkey")
    week = F.weekofyear(day)
    dated = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    name = F.date_format(day, "EEEE")
    return dated.select(
        day.alias("date"),
        F.year(day).alias("year"),
        F.when(key % 2 == 0, F.upper(name)).otherwise(F.lower(name)).alias("day_name"),
        F.when(F.dayofmonth(day) == 13, None).otherwise(F.quarter(day)).alias("quarter"),
        F.when(key % 3 == 0, -week).otherwise(week).alias("week_of_year"),
    )
