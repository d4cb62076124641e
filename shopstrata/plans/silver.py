"""Bronze to silver: cleaning of the five dimensions and the three facts.

Every function takes and returns a DataFrame. The ``clean_*`` functions work row
by row, so batch jobs and stream batches share them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.functions import columns as c
from shopstrata.functions.lookups import BRAND_CODES, CATEGORY_CODES, CHANNEL_NAMES, MISSING
from shopstrata.operators.latest import latest_per_key


def brands(bronze: DataFrame) -> DataFrame:
    """The brand code is derived from the brand's name; what the file says is not used."""
    name = F.trim("brand_name")
    tidy = bronze.withColumns({"brand_name": name, "brand_code": c.letters_and_digits(name)})
    return tidy.replace(CATEGORY_CODES, subset=["category_code"])


def category(bronze: DataFrame) -> DataFrame:
    """Upper-case first, so that ``toy`` and ``TOY`` are one category."""
    return latest_per_key(bronze.withColumn("category_code", F.upper("category_code")), ["category_code"])


def calendar(bronze: DataFrame) -> DataFrame:
    year = F.col("year")
    return latest_per_key(bronze, ["date"]).withColumns({
        "day_name": F.initcap("day_name"),
        "quarter": c.year_label("Q", F.col("quarter"), year),
        "week_of_year": c.year_label("Week", F.abs("week_of_year"), year),
    })


def products(bronze: DataFrame) -> DataFrame:
    return bronze.replace(BRAND_CODES, subset=["brand_code"]).withColumns({
        "category_code": F.upper("category_code"),
        "weight_grams": c.without_unit(F.col("weight_grams")),
        "length_cm": c.decimal_comma(F.col("length_cm")),
        "width_cm": F.col("width_cm").try_cast("decimal(10,1)"),
        "height_cm": F.col("height_cm").try_cast("decimal(10,1)"),
        "rating_count": F.abs("rating_count"),
    })


def customers(bronze: DataFrame) -> DataFrame:
    return (
        bronze.na.drop(subset=["customer_id"])
        .withColumn("phone", F.coalesce(c.before_dot(F.col("phone")), F.lit(MISSING)))
    )


def clean_order_items(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "quantity": c.spelled_quantity(F.col("quantity").cast("string")),
        "unit_price": c.dollar_amount(F.col("unit_price").cast("string")),
        "discount_pct": c.percentage(F.col("discount_pct").cast("string")),
        "tax_amount": F.col("tax_amount").try_cast("double"),
        "coupon_code": c.tidy_lower(F.col("coupon_code")),
        "channel": c.recoded(F.col("channel"), CHANNEL_NAMES),
        "processed_time": F.current_timestamp(),
    })


def clean_order_returns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "order_dt": F.col("order_dt").try_cast("date"),
        "return_ts": F.col("return_ts").try_cast("timestamp"),
        "reason": c.tidy_upper(F.col("reason")),
        "processed_time": F.current_timestamp(),
    })


def clean_order_shipments(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "order_dt": F.col("order_dt").try_cast("date"),
        "carrier": c.tidy_upper(F.col("carrier")),
        "processed_time": F.current_timestamp(),
    })
