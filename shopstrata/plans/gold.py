"""Silver to gold: three conformed dimensions and the three enriched facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.functions import columns as c
from shopstrata.functions.lookups import (
    DOMESTIC_CARRIERS,
    MISSING,
    OTHER_REGION,
    REGIONS,
    RETURN_POLICY_DAYS,
)


def products(silver_products: DataFrame, silver_brands: DataFrame, silver_category: DataFrame) -> DataFrame:
    """Products with the name of their brand and of that brand's category.

    ``category_name`` follows the brand, ``category_code`` is the product's own.
    A brand without a known category counts as not available. Brands and categories
    grow with the data, so Spark decides by size whether to broadcast them.
    """
    brand_names = silver_brands.join(
        silver_category.select("category_code", "category_name"), "category_code"
    ).select("brand_code", "brand_name", "category_name")
    joined = silver_products.join(brand_names, "brand_code", "left")
    order = [
        "product_id", "sku", "category_code", "category_name", "brand_code", "brand_name",
        "color", "size", "material", "weight_grams", "length_cm", "width_cm", "height_cm",
        "rating_count",
    ]
    lineage = [n for n in silver_products.columns if n not in order]
    return joined.na.fill(MISSING, subset=["category_name", "brand_name"]).select(*order, *lineage)


def region_map(spark: SparkSession) -> DataFrame:
    rows = [
        (country, state, region)
        for country, states in REGIONS.items()
        for state, region in states.items()
    ]
    return spark.createDataFrame(rows, "country string, state string, region string")


def customers(silver_customers: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Customers with their sales region, ``Other`` where the map has none.

    The map is a constant of 35 rows, so broadcasting it is safe at any scale.
    """
    lookup = region_map(silver_customers.sparkSession) if regions is None else regions
    side = F.broadcast(lookup) if regions is None else lookup
    return silver_customers.join(side, ["country", "state"], "left").na.fill({"region": OTHER_REGION})


def dates(silver_calendar: DataFrame) -> DataFrame:
    return silver_calendar.withColumns({
        "date_id": c.date_key(F.col("date")),
        "month_name": F.date_format("date", "MMMM"),
        "is_weekend": c.yes_no(F.upper("day_name").isin("SATURDAY", "SUNDAY")),
    })


def order_items(silver: DataFrame) -> DataFrame:
    """The 18-column contract. The discount is taken on the gross amount rounded up."""
    gross = F.col("quantity") * F.col("unit_price")
    discount = F.ceil(gross) * (F.col("discount_pct") / 100)
    return silver.select(
        c.date_key(F.col("dt")).alias("date_id"),
        F.col("dt").alias("transaction_date"),
        F.col("order_ts").alias("transaction_ts"),
        F.col("order_id").alias("transaction_id"),
        "customer_id",
        F.col("item_seq").alias("seq_no"),
        "product_id",
        "channel",
        "coupon_code",
        c.yes_no(F.col("coupon_code").isNotNull()).alias("coupon_flag"),
        "unit_price_currency",
        "quantity",
        "unit_price",
        gross.alias("gross_amount"),
        F.col("discount_pct").alias("discount_percent"),
        discount.alias("discount_amount"),
        "tax_amount",
        (gross - discount + F.col("tax_amount")).alias("net_amount"),
    )


def order_returns(silver: DataFrame) -> DataFrame:
    days = F.datediff("return_ts", "order_dt")
    return silver.withColumns({
        "date_id": c.date_key(F.col("order_dt")),
        "return_days": days,
        "within_policy": c.yes_no(days <= RETURN_POLICY_DAYS),
        "is_late_return": c.yes_no(days > RETURN_POLICY_DAYS),
    })


def order_shipments(silver: DataFrame) -> DataFrame:
    domestic = F.col("carrier").isin(*DOMESTIC_CARRIERS)
    weekend = F.dayofweek("order_dt").isin(1, 7)  # 1 is Sunday
    return silver.withColumns({
        "carrier_group": F.when(domestic, "Domestic").otherwise("International"),
        "is_weekend_shipment": F.coalesce(weekend, F.lit(False)),
    })
