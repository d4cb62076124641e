"""Column contracts of the raw drops and the gold order items.

Fixed values: names, types and order are those of the files to be read.
Spark does not enforce nullability on files, so keys are checked in
``operators.quality`` instead of being declared non-null here.
"""

from pyspark.sql.types import (
    DateType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


BRANDS = _struct(brand_code=StringType, brand_name=StringType, category_code=StringType)

CATEGORY = _struct(category_code=StringType, category_name=StringType)

PRODUCTS = _struct(
    product_id=StringType,
    sku=StringType,
    category_code=StringType,
    brand_code=StringType,
    color=StringType,
    size=StringType,
    material=StringType,
    weight_grams=StringType,
    length_cm=StringType,
    width_cm=FloatType,
    height_cm=FloatType,
    rating_count=IntegerType,
)

CUSTOMERS = _struct(
    customer_id=StringType,
    phone=StringType,
    country_code=StringType,
    country=StringType,
    state=StringType,
)

CALENDAR = _struct(
    date=DateType,
    year=IntegerType,
    day_name=StringType,
    quarter=IntegerType,
    week_of_year=IntegerType,
)

ORDER_ITEM_KEYS = ("order_id", "item_seq")
RETURN_KEYS = ("order_id",)
SHIPMENT_KEYS = ("order_id", "shipment_id")
GOLD_ORDER_ITEM_KEYS = ("transaction_id", "seq_no")
SUMMARY_KEYS = ("date_id", "currency")
