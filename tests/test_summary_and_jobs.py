"""The daily summary and the jobs end to end on a small lake."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows

from shopstrata import jobs
from shopstrata.plans import summary

GOLD = (
    "date_id int, transaction_date date, unit_price_currency string, quantity int, gross_amount double, "
    "discount_amount double, tax_amount double, net_amount double, transaction_id bigint, seq_no int"
)


def sale(day, amount=1.0, currency="USD", n=1):
    return (int(day.strftime("%Y%m%d")), day, currency, 1, amount, 0.1, 0.2, amount + 0.1, n, 1)


def days(first, count):
    return [first + dt.timedelta(days=i) for i in range(count)]


def test_window_is_thirty_days_back_inclusive(spark):
    sales = spark.createDataFrame([sale(d) for d in days(dt.date(2023, 12, 1), 62)], GOLD)
    assert rows(sales.agg({"transaction_date": "max"})) == [(dt.date(2024, 1, 31),)]
    kept = [r[0] for r in rows(summary.recent(sales).select("transaction_date").distinct())]
    assert len(kept) == 31 and kept[0] == dt.date(2024, 1, 1)


def test_window_of_nothing_is_nothing(spark):
    assert summary.recent(spark.createDataFrame([], GOLD)).count() == 0


def test_totals_do_not_depend_on_partitioning(spark):
    data = [sale(dt.date(2024, 1, 1), amount=0.1 * n, n=n) for n in range(1000)]
    totals = {
        rows(summary.daily_summary(spark.createDataFrame(data, GOLD).repartition(n)))[0] for n in (1, 3, 8)
    }
    assert len(totals) == 1
    assert totals.pop()[3] == pytest.approx(49950.0)


def test_later_runs_restate_the_window_only(spark, lake):
    table = lake.daily_summary()
    history = [sale(d, n=i) for i, d in enumerate(days(dt.date(2023, 12, 1), 62))]
    summary.refresh_daily_summary(spark.createDataFrame(history, GOLD), table)
    assert table.read().count() == 62
    corrections = [sale(dt.date(2023, 12, 15), 500.0, n=901), sale(dt.date(2024, 1, 20), 7.0, n=902)]
    new_day = [sale(dt.date(2024, 2, 1), 3.0, n=903), sale(dt.date(2024, 2, 1), 4.0, None, n=904)]
    everything = spark.createDataFrame(history + corrections + new_day, GOLD)
    for _ in range(2):  # twice: the row without a currency must not be added again
        summary.refresh_daily_summary(everything, table)
    totals = {(r.date_id, r.currency): r.total_gross_amount for r in table.read().collect()}
    assert len(totals) == table.read().count() == 64
    assert totals[20231215, "USD"] == 1.0  # older than the window: not restated
    assert totals[20240120, "USD"] == 8.0
    assert totals[20240201, "USD"] == 3.0 and totals[20240201, None] == 4.0


def test_window_bound_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([sale(d) for d in days(dt.date(2023, 12, 1), 62)], GOLD).write.parquet(f"{tmp_path}/g")
    plan = summary.daily_summary(summary.recent(spark.read.parquet(f"{tmp_path}/g")))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "tax_amount" in line)
    assert "transaction_date" in scan and "seq_no" not in scan and "transaction_id" not in scan
    assert "transaction_date#" in scan.split("DataFilters:")[1] and "subquery" in scan.split("DataFilters:")[1]


def scanned_rows(plan) -> list[int]:
    """Rows that left each scan of an executed plan, adaptive stages included."""
    found = []
    if "Scan" in plan.nodeName():
        found.append(plan.metrics().apply("numOutputRows").value())
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    if plan.nodeName() == "AdaptiveSparkPlan":
        below.append(plan.executedPlan())
    elif plan.nodeName().endswith("QueryStage"):
        below.append(plan.plan())
    return found + [n for child in below for n in scanned_rows(child)]


def test_window_skips_row_groups_of_the_gold_table(spark, lake):
    sales = [sale(d, n=1000 * i + j) for i, d in enumerate(days(dt.date(2020, 1, 1), 400)) for j in range(40)]
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("parquet.block.size", "20000")  # many row groups in a small table
    try:
        table = lake.gold_order_items()
        table.upsert(spark.createDataFrame(sales, GOLD))
        table.settle()
    finally:
        settings.unset("parquet.block.size")
    totals = summary.daily_summary(summary.recent(table.read()))
    assert len(totals.collect()) == 31
    assert sum(scanned_rows(totals._jdf.queryExecution().executedPlan())) < len(sales) / 3


def write(root: Path, entity: str, name: str, text: str):
    folder = root / "raw" / "raw_landing" / entity
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


ITEMS = "order_id,item_seq,customer_id,product_id,dt,order_ts,channel,coupon_code,unit_price_currency,quantity,unit_price,discount_pct,tax_amount\n"


@pytest.fixture
def root(tmp_path):
    write(tmp_path, "brands", "b.csv", "brand_code,brand_name,category_code\nx, Steel-Craft ,TOYS\n")
    write(tmp_path, "category", "c.csv", "category_code,category_name\ntoy,Toys\nTOY,Toys\n")
    write(
        tmp_path, "products", "p.csv",
        "product_id,sku,category_code,brand_code,color,size,material,weight_grams,length_cm,width_cm,height_cm,rating_count\n"
        'P1,s1,toy,stcr,red,M,wood,250g,"12,5",12.25,3.0,-7\n',
    )
    write(
        tmp_path, "customers", "c.csv",
        "customer_id,phone,country_code,country,state\nC1,987.0,91,India,MH\n,1,91,India,MH\n",
    )
    write(tmp_path, "date", "d.csv", "date,year,day_name,quarter,week_of_year\n2024-01-06,2024,sATURDAY,1,-1\n")
    write(
        tmp_path, "order_items", "1.csv",
        ITEMS + "1,1,C1,P1,2024-01-06,2024-01-06 10:00:00,web, SAVE ,USD,Two,$10.00,10%,1.5\n"
        "1,2,C1,P1,2024-01-06,2024-01-06 10:00:00,app,,USD,3,$19.99,0%,0\n",
    )
    write(
        tmp_path, "order_returns", "1.csv",
        "order_id,order_dt,return_ts,reason\n1,2024-01-06,2024-01-20 09:00:00, late \n1,2024-01-06,2024-01-25 09:00:00,x\n",
    )
    write(tmp_path, "order_shipments", "1.csv", "order_id,shipment_id,order_dt,carrier\n1,1,2024-01-06, bluedart \n")
    return tmp_path


def test_all_jobs_twice_then_new_files(spark, root):
    from shopstrata import Lake

    lake = Lake(spark, str(root))
    for _ in range(2):
        for job in jobs.JOBS.values():
            job(lake)
    read = lambda name: lake.snapshot("gold", name).read()
    assert rows(read("dim_products"), "product_id", "category_name", "brand_name", "weight_grams") == [
        ("P1", "Toys", "Steel-Craft", 250),
    ]
    assert read("dim_products").columns[-2:] == ["file_name", "ingest_timestamp"]
    assert rows(read("dim_customers"), "customer_id", "region", "phone") == [("C1", "West", "987")]
    assert rows(read("dim_date"), "date_id", "quarter", "is_weekend") == [(20240106, "Q1-2024", 1)]
    sold = lake.gold_order_items().read()
    assert rows(sold, "transaction_id", "seq_no", "quantity", "channel", "coupon_flag") == [
        (1, 1, 2, "Website", 1), (1, 2, 3, "Mobile", 0),
    ]
    assert rows(lake.gold_order_returns().read(), "order_id", "return_days", "is_late_return") == [(1, 19, 1)]
    assert rows(lake.gold_order_shipments().read(), "carrier_group", "is_weekend_shipment") == [("Domestic", True)]
    assert rows(lake.daily_summary().read(), "date_id", "currency", "total_quantity") == [(20240106, "USD", 5)]

    write(
        root, "order_items", "2.csv",
        ITEMS + "1,2,C1,P1,2024-01-07,2024-01-07 10:00:00,app,,USD,4,$19.99,0%,0\n"
        "2,1,C1,P1,2024-01-07,2024-01-07 11:00:00,app,,USD,lots,$1.00,0%,0\n",
    )
    jobs.main(["--root", str(root), "--max-files", "10", "order_items", "summary"])
    assert rows(lake.gold_order_items().read(), "transaction_id", "seq_no", "quantity") == [
        (1, 1, 2), (1, 2, 4), (2, 1, None),
    ]
    assert rows(lake.daily_summary().read(), "date_id", "total_quantity") == [(20240106, 2), (20240107, 4)]
    assert len(lake.publish_all()) == 5 + 5 + 3 + 7 + 3
    assert spark.sql("SELECT count(*) FROM brz_order_items").first()[0] == 4
    assert spark.sql("SELECT count(*) FROM gld_fact_order_items JOIN gld_dim_products USING (product_id)").first()[0] == 3
