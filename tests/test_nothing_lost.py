"""Values, rows and files that must not get lost on the way."""

import math
import os
import time
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopstrata import Lake, jobs
from shopstrata.functions.columns import exact_total
from shopstrata.operators.latest import latest_per_key
from shopstrata.session import scratch_folder
from shopstrata.sources import landing
from shopstrata.streaming.facts import FACTS
from shopstrata.streaming.ingest import bronze_log, ingest_landing
from shopstrata.streaming.runner import append_stream, dedup_stream, stream_table

ITEMS = "order_id,item_seq,customer_id,product_id,dt,order_ts,channel,coupon_code,unit_price_currency,quantity,unit_price,discount_pct,tax_amount\n"


def write(root, entity, name, text, age=0.0):
    folder = root / "raw" / "raw_landing" / entity
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    then = time.time() - age
    os.utime(folder / name, (then, then))


def item(seq, quantity, price="2", discount="0"):
    return f"1,{seq},C1,P1,2024-01-06,2024-01-06 10:00:00,web,,USD,{quantity},{price},{discount},0\n"


def test_dirty_values_after_clean_first_files(spark, tmp_path):
    write(tmp_path, "order_items", "1.csv", ITEMS + item(1, 3) + item(2, 4, "5", "10"))
    lake = Lake(spark, str(tmp_path))
    jobs.fact_flow(lake, "order_items")
    write(tmp_path, "order_items", "2.csv", ITEMS + item(3, "Two", "$2.50", "20%"))
    jobs.fact_flow(lake, "order_items")
    sold = lake.gold_order_items().read()
    assert rows(sold, "seq_no", "quantity", "unit_price", "gross_amount") == [(1, 3, 2.0, 6.0), (2, 4, 5.0, 20.0), (3, 2, 2.5, 5.0)]
    assert dict(lake.bronze_facts("order_items").read().dtypes)["quantity"] == "string"
    assert FACTS["order_items"].texts == ("quantity", "unit_price", "discount_pct")


@pytest.mark.parametrize("max_files", [1, 10])
def test_silver_is_the_same_for_any_cut_into_batches(spark, tmp_path, max_files):
    # the newer file has the smaller quantity, and arrives under the smaller name
    write(tmp_path, "order_items", "b.csv", ITEMS + item(1, 9), age=100)
    write(tmp_path, "order_items", "a.csv", ITEMS + item(1, 3) + item(2, 5), age=50)
    lake = Lake(spark, str(tmp_path))
    jobs.fact_flow(lake, "order_items", max_files=max_files)
    assert rows(lake.silver_order_items().read(), "item_seq", "quantity") == [(1, 3), (2, 5)]
    # an older file that is delivered last does not replace newer rows
    write(tmp_path, "order_items", "c.csv", ITEMS + item(1, 7) + item(3, 1), age=8 * 86400)
    jobs.fact_flow(lake, "order_items", max_files=max_files)
    assert rows(lake.silver_order_items().read(), "item_seq", "quantity") == [(1, 3), (2, 5), (3, 1)]
    assert rows(lake.gold_order_items().read(), "seq_no", "quantity") == [(1, 3), (2, 5), (3, 1)]


def test_inference_reads_all_files_and_headers(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text("k,v\n1,1\n")
    (folder / "b.csv").write_text("k,v\n2,2\n")
    (folder / "c.csv").write_text("v,k,w\n2.5,3000000000,x\n")
    found = landing.kept_schema(spark, str(folder), f"{tmp_path}/schema.json", texts=["t"])
    assert found.simpleString() == "struct<k:bigint,v:double,w:string,t:string>"


def test_late_files_reach_table_streams(spark, tmp_path):
    source, out = f"{tmp_path}/t", f"{tmp_path}/out"
    spark.range(5).write.parquet(source)
    append_stream(stream_table(spark, source), out, f"{tmp_path}/c")
    spark.range(5, 10).write.parquet(f"{tmp_path}/late")
    for file in (tmp_path / "late").glob("part-*"):
        os.rename(file, f"{source}/{file.name}")
        os.utime(f"{source}/{file.name}", (time.time() - 8 * 86400,) * 2)
    append_stream(stream_table(spark, source), out, f"{tmp_path}/c")
    assert spark.read.parquet(out).count() == 10


def test_stream_over_a_named_table(spark, tmp_path):
    spark.range(3).write.option("path", f"{tmp_path}/t").saveAsTable("named_source")
    try:
        append_stream(stream_table(spark, "named_source"), f"{tmp_path}/out", f"{tmp_path}/c")
    finally:
        spark.sql("DROP TABLE named_source")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_totals_hold_all_numbers(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(exact_total(F.col("x")).alias("t")).first().t

    assert total(5.0, 1e19) == pytest.approx(1e19)
    assert math.isnan(total(5.0, float("nan")))
    assert total(1.0, float("inf")) == float("inf")
    assert total(0.1, 0.2, None) == 0.1 + 0.2
    assert total(5e18, 5e18) == 1e19 and total(*[9e18] * 30) == 2.7e20 and total(1e30, 1.0, -1e30) == 1.0
    assert total(*[1e-7] * 1000) == math.fsum([1e-7] * 1000) and total(1e-30, 2e-30) == pytest.approx(3e-30)
    assert total(float("inf"), 1e300, 2.0) == float("inf") and math.isnan(total(float("inf"), float("-inf")))
    assert total(None) is None


def test_no_thinning_under_a_watermark(spark, tmp_path):
    spark.sql("SELECT 1 AS k, timestamp'2024-01-01' AS at").write.parquet(f"{tmp_path}/t")
    bounded = dedup_stream(stream_table(spark, f"{tmp_path}/t"), ["k"], "at", "10 minutes")
    assert "MapInArrow" not in bounded._jdf.queryExecution().analyzed().toString()


def test_reserved_header_names_are_rescued(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    names = ["k", "source_file", "_corrupt_record", "_rescued_data", "_metadata", "ingest_timestamp", "_ingest_batch", "file_modified"]
    (folder / "a.csv").write_text(",".join(names) + "\n" + ",".join(f"v{i}" for i in range(len(names))) + "\n")
    ingest_landing(spark, str(folder), f"{tmp_path}/bronze", f"{tmp_path}/checkpoint")
    [row] = bronze_log(spark, f"{tmp_path}/bronze").read().collect()
    assert row.k == "v0" and row.source_file.endswith("a.csv")
    assert all(f'"{name}_":"v{i}"' in row["_rescued_data"] for i, name in enumerate(names) if i)


def test_brands_in_another_column_order(spark, tmp_path):
    write(tmp_path, "brands", "b.csv", "category_code,brand_code,brand_name\nTOYS,x, Steel-Craft \n")
    lake = Lake(spark, str(tmp_path))
    jobs.load_bronze_dimension(lake, "brands")
    assert rows(lake.snapshot("bronze", "brands").read(), "brand_code", "category_code") == [("x", "TOYS")]


def test_keyless_rows_take_no_part_in_the_reduction(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, 4), (None, 4)], "k int, v int")
    kept = latest_per_key(df, ["k"], ["v"], null_keys="each")
    assert rows(kept) == [(None, 4), (None, 4), (1, 3)]
    assert "monotonically" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_no_local_scratch_on_a_cluster():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: {"spark.master": "yarn"}.get(key, default)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(cluster, "x")


def test_a_small_batch_reads_few_rows_of_the_target(spark, tmp_path):
    from test_summary_and_jobs import scanned_rows

    from shopstrata.operators.keyed_table import KeyedTable

    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("parquet.block.size", "20000")  # many row groups in a small table
    try:
        table = KeyedTable(spark, f"{tmp_path}/t", ["k"])
        table.upsert(spark.range(200_000).select(F.col("id").alias("k"), F.lit(1).alias("v")))
        table.settle()
    finally:
        settings.unset("parquet.block.size")
    wanted = spark.createDataFrame([(70_000,)], "k bigint")
    old = table._old_rows(wanted, [0], 1000)
    assert rows(old) == [(70_000, 1)]
    assert sum(scanned_rows(old._jdf.queryExecution().executedPlan())) < 20_000
