"""One golden row per cleaning rule."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopstrata import schemas
from shopstrata.plans import gold, silver


def table(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_brand_code_comes_from_the_trimmed_name(spark):
    raw = table(spark, schemas.BRANDS, ("x", " Aqua-Pure ", "GROCERY"))
    assert rows(silver.brands(raw)) == [("AquaPure", "Aqua-Pure", "GRCY")]


def each(spark, schema, build, clean, cases, *columns):
    """Clean one row per case and compare in order of the cases."""
    raw = spark.createDataFrame([build(case[0]) for case in cases], schema)
    numbered = raw.coalesce(1).withColumn("_n", F.monotonically_increasing_id())
    got = clean(numbered).orderBy("_n").select(*columns).collect()
    assert [tuple(r) for r in got] == [tuple(case[1:]) for case in cases]


def test_category_codes_of_brands(spark):
    cases = [("GROCERY", "GRCY"), ("BOOKS", "BKS"), ("TOYS", "TOY"), ("grocery", "grocery"), (None, None)]
    each(spark, schemas.BRANDS, lambda code: ("x", "B", code), silver.brands, cases, "category_code")


def test_category_case_variants_are_one_category(spark):
    raw = table(spark, schemas.CATEGORY, ("toy", "Toys"), ("TOY", "Toys"), ("bks", "Books"))
    assert rows(silver.category(raw)) == [("BKS", "Books"), ("TOY", "Toys")]


def test_calendar(spark):
    day = dt.date(2024, 1, 15)
    raw = table(spark, schemas.CALENDAR, (day, 2024, "mONDAY", 1, -3), (day, 2024, "mONDAY", 1, -3))
    assert rows(silver.calendar(raw)) == [(day, 2024, "Monday", "Q1-2024", "Week3-2024")]


def test_calendar_missing_part_gives_empty_label(spark):
    raw = table(spark, schemas.CALENDAR, (dt.date(2024, 1, 15), 2024, "Monday", None, None))
    assert rows(silver.calendar(raw), "quarter", "week_of_year") == [("", "")]


def product(**changes):
    base = dict(
        product_id="P1", sku="s", category_code="toy", brand_code="stcr", color="red", size="M",
        material="wood", weight_grams="250g", length_cm="12,5", width_cm=12.25, height_cm=12.25, rating_count=-7,
    )
    return tuple({**base, **changes}.values())


def test_products(spark):
    raw = table(spark, schemas.PRODUCTS, product())
    assert rows(silver.products(raw)) == [(
        "P1", "s", "TOY", "SteelCraft", "red", "M", "wood", 250, 12.5, Decimal("12.3"), Decimal("12.3"), 7,
    )]


def test_weight(spark):
    cases = [("250g", 250), ("250", 250), ("g", None), ("", None), (None, None)]
    each(spark, schemas.PRODUCTS, lambda t: product(weight_grams=t), silver.products, cases, "weight_grams")


def test_brand_codes_of_products(spark):
    cases = [("stcr", "SteelCraft"), ("STCR", "STCR"), ("zzzz", "zzzz"), (None, None)]
    each(spark, schemas.PRODUCTS, lambda c: product(brand_code=c), silver.products, cases, "brand_code")


def test_bad_length_and_missing_rating_become_null(spark):
    raw = table(spark, schemas.PRODUCTS, product(length_cm="long", rating_count=None))
    assert rows(silver.products(raw), "length_cm", "rating_count") == [(None, None)]


def test_customers(spark):
    raw = table(
        spark, schemas.CUSTOMERS,
        ("C1", "987.0", "91", "India", "MH"), ("C2", "5", "91", "India", "MH"),
        ("C3", None, "91", "India", "MH"), (None, "1", "91", "India", "MH"),
    )
    assert rows(silver.customers(raw), "customer_id", "phone") == [
        ("C1", "987"), ("C2", "5"), ("C3", "Not Available"),
    ]


ITEM = (
    "order_id bigint, item_seq int, customer_id bigint, product_id bigint, dt date, order_ts timestamp, "
    "channel string, coupon_code string, unit_price_currency string, quantity string, unit_price string, "
    "discount_pct string, tax_amount string"
)


def item(**changes):
    base = dict(
        order_id=1, item_seq=1, customer_id=7, product_id=9, dt=dt.date(2024, 1, 6),
        order_ts=dt.datetime(2024, 1, 6, 10), channel="web", coupon_code=" SAVE ", unit_price_currency="USD",
        quantity="3", unit_price="$19.99", discount_pct="10%", tax_amount="1.5",
    )
    return tuple({**base, **changes}.values())


def test_quantity(spark):
    cases = [("Two", 2), ("3", 3), ("x1", None), ("two", None), (None, None)]
    each(spark, ITEM, lambda q: item(quantity=q), silver.clean_order_items, cases, "quantity")


def test_money_percent_and_coupon(spark):
    cleaned = silver.clean_order_items(table(spark, ITEM, item()))
    assert rows(cleaned, "unit_price", "discount_pct", "tax_amount", "coupon_code") == [(19.99, 10.0, 1.5, "save")]


def test_channel(spark):
    cases = [("web", "Website"), ("app", "Mobile"), ("Web", "Web"), (" web", " web"), (None, None)]
    each(spark, ITEM, lambda c: item(channel=c), silver.clean_order_items, cases, "channel")


def test_gold_amounts(spark):
    sold = gold.order_items(silver.clean_order_items(table(spark, ITEM, item())))
    assert len(sold.columns) == 18
    [row] = sold.collect()
    assert row.date_id == 20240106
    assert row.gross_amount == pytest.approx(59.97)
    assert row.discount_amount == pytest.approx(6.0)
    assert row.net_amount == pytest.approx(55.47)


def test_gold_net_amount_is_null_when_a_part_is(spark):
    sold = gold.order_items(silver.clean_order_items(table(spark, ITEM, item(tax_amount="none"))))
    assert rows(sold, "gross_amount", "net_amount")[0][1] is None


def test_coupon_flag(spark):
    for coupon, flag in [(None, 0), ("save", 1), ("  ", 1)]:
        sold = gold.order_items(silver.clean_order_items(table(spark, ITEM, item(coupon_code=coupon))))
        assert rows(sold, "coupon_flag") == [(flag,)]


def test_returns(spark):
    cases = [
        ("2024-01-16 23:00:00", 20240101, 15, 1, 0, "DAMAGED"),
        ("2024-01-17 00:00:00", 20240101, 16, 0, 1, "DAMAGED"),
        ("2023-12-31 00:00:00", 20240101, -1, 1, 0, "DAMAGED"),
        (None, 20240101, None, 0, 0, "DAMAGED"),
        ("soon", 20240101, None, 0, 0, "DAMAGED"),
    ]
    each(
        spark, "order_id bigint, order_dt string, return_ts string, reason string",
        lambda returned: (1, "2024-01-01", returned, " damaged "),
        lambda raw: gold.order_returns(silver.clean_order_returns(raw)), cases,
        "date_id", "return_days", "within_policy", "is_late_return", "reason",
    )


def test_shipments(spark):
    cases = [
        ((" bluedart ", "2024-01-06"), "Domestic", True),
        (("DHL", "2024-01-07"), "International", True),
        ((None, "2024-01-08"), "International", False),
        (("ecomexpress", None), "Domestic", False),
    ]
    each(
        spark, "order_id bigint, shipment_id int, order_dt string, carrier string",
        lambda case: (1, 1, case[1], case[0]),
        lambda raw: gold.order_shipments(silver.clean_order_shipments(raw)), cases,
        "carrier_group", "is_weekend_shipment",
    )


def test_region_map_has_35_rows_and_unknown_states_are_other(spark):
    assert gold.region_map(spark).count() == 35
    raw = table(spark, schemas.CUSTOMERS, ("C1", "1", "91", "India", "MH"), ("C2", "1", "91", "India", "ZZ"))
    placed = gold.customers(raw)
    assert placed.columns[:2] == ["country", "state"]
    assert rows(placed, "customer_id", "region") == [("C1", "West"), ("C2", "Other")]


def test_gold_products_take_the_category_name_of_their_brand(spark):
    products = silver.products(table(
        spark, schemas.PRODUCTS, product(), product(product_id="P2", brand_code="zzzz"),
    ))
    brands = table(spark, schemas.BRANDS, ("SteelCraft", "Steel-Craft", "BKS"))
    category = table(spark, schemas.CATEGORY, ("BKS", "Books"), ("TOY", "Toys"))
    named = gold.products(products, brands, category)
    assert rows(named, "product_id", "category_code", "category_name", "brand_name") == [
        ("P1", "TOY", "Books", "Steel-Craft"),
        ("P2", "TOY", "Not Available", "Not Available"),
    ]
    assert named.columns[:6] == [
        "product_id", "sku", "category_code", "category_name", "brand_code", "brand_name",
    ]


def test_gold_dates(spark):
    raw = table(
        spark, schemas.CALENDAR,
        (dt.date(2024, 1, 6), 2024, "SATURDAY", 1, 1), (dt.date(2024, 1, 8), 2024, "monday", 1, 2),
    )
    assert rows(gold.dates(silver.calendar(raw)), "date_id", "month_name", "is_weekend") == [
        (20240106, "January", 1), (20240108, "January", 0),
    ]
