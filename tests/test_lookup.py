"""What upserts and the summary read of a settled table: few rows, or footers only."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_summary_and_jobs import GOLD, sale, scanned_rows

from shopstrata.operators import zorder
from shopstrata.operators.keyed_table import KeyedTable, key_ranges
from shopstrata.plans import summary

SIZE = 200_000


def read_for(table, batch):
    """Rows that leave the scan of the snapshot when the batch's old rows are looked up."""
    keyed = table._with_match(batch.select(*{*table.keys, *table.matched_by} - {"_match"}))
    old = table._old_rows(keyed, table.log.numbers(), 1000)
    found = old.collect()
    scans = scanned_rows(old._jdf.queryExecution().executedPlan())
    return len(found), sum(scans)


@pytest.fixture(scope="module")
def by_key(spark, tmp_path_factory):
    table = KeyedTable(spark, str(tmp_path_factory.mktemp("k")), ["a", "b"], ["v"])
    table.upsert(spark.range(SIZE).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"), F.rand(1).alias("v")))
    table.settle()
    return table


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    from shopstrata import Lake

    table = Lake(spark, str(tmp_path_factory.mktemp("g"))).gold_order_items()
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int"))
    table.upsert(spark.range(SIZE).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"), day.alias("transaction_date"),
        F.lit("USD").alias("unit_price_currency"), F.lit(1).alias("quantity"), F.lit(2.5).alias("gross_amount"),
        F.lit(0.1).alias("discount_amount"), F.lit(0.2).alias("tax_amount"), F.lit(2.6).alias("net_amount"),
        F.col("id").alias("transaction_id"), F.lit(1).alias("seq_no")))
    table.settle()
    return table


@pytest.mark.parametrize("keys", [[3], [3, SIZE - 10], [0, 1, 2, 3, 4, 100_000, 100_001]])
def test_a_batch_of_few_keys_reads_few_rows(spark, by_key, keys):
    found, read = read_for(by_key, spark.createDataFrame([(k, k % 3) for k in keys], "a bigint, b bigint"))
    assert found == len(keys) and read < SIZE / 10


def test_a_batch_of_many_keys_from_few_ranges_reads_few_rows(spark, by_key):
    near = [*range(500), *range(SIZE - 500, SIZE)]
    found, read = read_for(by_key, spark.createDataFrame([(k, k % 3) for k in near], "a bigint, b bigint"))
    assert found == 1000 and read < SIZE / 4


def test_one_key_reads_few_rows_of_a_table_laid_out_by_date_and_key(spark, gold):
    for key in (7, 123_456):
        found, read = read_for(gold, spark.createDataFrame([(key, 1)], "transaction_id bigint, seq_no int"))
        assert found == 1 and read < SIZE / 10


def test_the_window_reads_few_rows_of_the_same_table(spark, gold):
    totals = summary.daily_summary(summary.recent(gold.read(), newest=dt.date(2022, 9, 26)))
    assert len(totals.collect()) == 31
    assert sum(scanned_rows(totals._jdf.queryExecution().executedPlan())) < SIZE / 4


def test_the_newest_date_comes_from_footers(spark, gold):
    assert gold.newest("transaction_date") == dt.date(2022, 9, 26)
    plan = gold.greatest_in_files("transaction_date")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(transaction_date)]" in plan


@pytest.mark.parametrize("settle", [False, True])
def test_a_replaced_newest_date_does_not_count(spark, lake, settle):
    table, days = lake.gold_order_items(), [dt.date(2024, 1, 1), dt.date(2024, 1, 5), dt.date(2024, 3, 1)]
    table.upsert(spark.createDataFrame([sale(d, n=n) for n, d in enumerate(days)], GOLD))
    if settle:
        table.settle()
    assert table.newest("transaction_date") == days[2] and table.newest("quantity") == 1
    table.upsert(spark.createDataFrame([sale(days[0], n=2)], GOLD))
    assert table.newest("transaction_date") == days[1]
    assert table.newest("unit_price_currency") == "USD"
    table.upsert(spark.createDataFrame([(*sale(days[2], n=3), "x")], GOLD + ", note string"))
    assert table.newest("transaction_date") == days[2] and table.newest("note") == "x"


def test_ranges_hold_all_keys(spark):
    draw = random.Random(1)
    for values in ([draw.randrange(1 << 40) for _ in range(2000)], [*range(300), *range(10**9, 10**9 + 300)], [5] * 300 + [None]):
        found = key_ranges(spark.createDataFrame([(v,) for v in values], "k bigint"))
        assert len(found) <= 64
        assert all(any(low <= v <= high for low, high in found) for v in values if v is not None)
    assert sum(high - low for low, high in key_ranges(
        spark.createDataFrame([(v,) for v in [*range(300), *range(10**9, 10**9 + 300)]], "k bigint"))) < 10**6
    assert key_ranges(spark.createDataFrame([("b",), ("a",)], "k string")) == [("a", "b")]


def test_bits_are_interleaved(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (65535, 65535), (0b1010, 0b0110)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [r[0] for r in df.select(zorder.interleaved([F.col("a"), F.col("b")])).collect()]
    assert got == [0, 2, 1, (1 << 32) - 1, 0b10011100]
    with pytest.raises(ValueError):
        zorder.interleaved([F.lit(1)] * 4)


def test_layout_of_odd_columns(spark):
    df = spark.createDataFrame([(None, 1.5), (dt.date(9999, 1, 1), 2.5), (dt.date(2024, 1, 1), None)], "d date, x double")
    assert all(r[0] is not None for r in df.select(zorder.z_order([df], ["d", "x"])).collect())
    assert df.limit(0).select(zorder.z_order([df.limit(0)], ["d"])).collect() == []
    with pytest.raises(TypeError):
        zorder.z_order([spark.createDataFrame([("a",)], "s string")], ["s"])


def test_null_keys_are_matched_on_buckets(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "n"), ["a", "b"], ["v"], match_null_keys=True, settle_bytes=0)
    frame = lambda data: spark.createDataFrame(data, "a int, b string, v int")
    table.upsert(frame([(1, None, 1), (None, None, 2), (None, "null", 3), (2, "x", 4), (2, "", 5)]))
    table.upsert(frame([(1, None, 11), (None, "null", 33), (3, "y", 6)]))  # settles what was there
    table.settle()  # folds
    table.upsert(frame([(None, None, 22), (2, "", 55), (2, None, 7)]))
    want = [(None, None, 22), (None, "null", 33), (1, None, 11), (2, None, 7), (2, "", 55), (2, "x", 4), (3, "y", 6)]
    assert rows(table.read()) == want and len(table.snapshots()) == 2
    old = table._old_rows(table._with_match(frame([(None, None, 0)]).select("a", "b")), table.log.numbers(), 1000)
    assert rows(old) == [(None, None, 22)]
    scan = table._bucketed(table.snapshots()[-1])
    folded = table._folded(table.snapshots()[-1], [2])._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in folded and "_match" in scan.columns and table.read().columns == ["a", "b", "v"]
