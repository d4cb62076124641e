"""Streams give the same tables as batch jobs, however their input is cut."""

import random

import pytest
from conftest import rows

from shopstrata.operators.keyed_table import KeyedTable
from shopstrata.operators.latest import latest_per_key
from shopstrata.plans import gold, silver
from shopstrata.streaming.facts import bronze_to_silver, silver_to_gold
from shopstrata.streaming.ingest import bronze_log
from shopstrata.streaming.runner import append_stream, dedup_stream, drain, stream_table, without_near_repeats

SCHEMA = "order_id bigint, shipment_id int, order_dt string, carrier string"
KEYS = ["order_id", "shipment_id"]
COLUMNS = ["order_id", "shipment_id", "order_dt", "carrier"]


def shipments(n=200, seed=3):
    draw = random.Random(seed)
    carriers = [" bluedart ", "DHL", None, "Delhivery"]
    return [
        (draw.choice([1, 1, 1, 2, 3, 4]), draw.randrange(5), f"2024-01-{draw.randrange(1, 29):02d}", draw.choice(carriers))
        for _ in range(n)
    ]


def flow(spark, base, cuts, data, **options):
    bronze = bronze_log(spark, f"{base}/bronze")
    table = KeyedTable(spark, f"{base}/silver", KEYS, ["order_dt"], **options)
    target = KeyedTable(spark, f"{base}/gold", KEYS)
    for start, end in zip(cuts, cuts[1:]):
        bronze.append(spark.createDataFrame(data[start:end], SCHEMA))
        bronze_to_silver(bronze, table, silver.clean_order_shipments, f"{base}/c1")
        silver_to_gold(table, target, gold.order_shipments, f"{base}/c2")
    return bronze, table, target


@pytest.mark.parametrize("cuts", [(0, 200), (0, 20, 150, 200)])
def test_stream_equals_batch_for_any_cut(spark, tmp_path, cuts):
    data = shipments()
    cleaned = silver.clean_order_shipments(spark.createDataFrame(data, SCHEMA))
    want = latest_per_key(cleaned, KEYS, ["order_dt"])
    _, table, target = flow(spark, tmp_path, cuts, data, keep="greatest")
    assert rows(table.read(), *COLUMNS) == rows(want, *COLUMNS)
    enriched = [*COLUMNS, "carrier_group", "is_weekend_shipment"]
    assert rows(target.read(), *enriched) == rows(gold.order_shipments(want), *enriched)
    assert not {"_change_type", "_commit_version", "_commit_timestamp"} & set(target.read().columns)


def test_running_again_without_new_data_changes_nothing(spark, tmp_path):
    bronze, table, target = flow(spark, tmp_path, (0, 60), shipments(60))
    before = table.log.numbers(), target.log.numbers()
    bronze_to_silver(bronze, table, silver.clean_order_shipments, f"{tmp_path}/c1")
    silver_to_gold(table, target, gold.order_shipments, f"{tmp_path}/c2")
    assert (table.log.numbers(), target.log.numbers()) == before


def test_gold_takes_the_newest_of_several_commits(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/silver", KEYS)
    target = KeyedTable(spark, f"{tmp_path}/gold", KEYS)
    for carrier in ("DHL", "BLUEDART", "UPS"):
        table.upsert(spark.createDataFrame([(1, 1, "2024-01-06", carrier)], SCHEMA))
    silver_to_gold(table, target, gold.order_shipments, f"{tmp_path}/c")
    assert rows(target.read(), "carrier", "carrier_group") == [("UPS", "International")]


def test_a_failed_batch_is_delivered_again_without_double_effect(spark, tmp_path):
    bronze = bronze_log(spark, f"{tmp_path}/bronze")
    bronze.append(spark.createDataFrame(shipments(50), SCHEMA))
    table = KeyedTable(spark, f"{tmp_path}/silver", KEYS, ["order_dt"])

    def upsert_then_fail(df, source, batch):
        table.upsert(silver.clean_order_shipments(df.drop("_ingest_batch")), source, batch)
        raise RuntimeError("driver lost after the commit")

    with pytest.raises(Exception, match="driver lost"):
        drain(bronze.stream(), upsert_then_fail, f"{tmp_path}/c")
    held, changes = rows(table.read(), *COLUMNS), table.changes().count()
    bronze_to_silver(bronze, table, silver.clean_order_shipments, f"{tmp_path}/c")
    assert rows(table.read(), *COLUMNS) == held
    assert table.changes().count() == changes and table.log.numbers() == [0]


@pytest.mark.parametrize("thin", [False, True])
def test_dedup_remembers_keys_across_runs(spark, tmp_path, thin):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for value in (1, 2):
        spark.createDataFrame([(7, value), (8, value), (value + 100, value)], "k int, v int").repartition(3) \
            .write.mode("append").parquet(source)
        append_stream(dedup_stream(stream_table(spark, source), ["k"], thin=thin), out, f"{tmp_path}/c")
    assert rows(spark.read.parquet(out)) == [(7, 1), (8, 1), (101, 1), (102, 2)]


def test_dedup_with_bounded_memory(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.sql("SELECT 1 AS k, timestamp'2024-01-01 00:00:00' AS at UNION ALL SELECT 1, timestamp'2024-01-01 00:01:00'") \
        .write.parquet(source)
    stream = dedup_stream(stream_table(spark, source), ["k"], "at", "10 minutes")
    append_stream(stream, out, f"{tmp_path}/c")
    assert spark.read.parquet(out).count() == 1


def test_append_is_exactly_once_over_runs(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).write.mode("append").parquet(source)
        append_stream(stream_table(spark, source), out, f"{tmp_path}/c")
        append_stream(stream_table(spark, source), out, f"{tmp_path}/c")
    assert rows(spark.read.parquet(out)) == [(n,) for n in range(30)]


def test_thinning_keeps_a_row_of_every_key(spark):
    df = spark.range(50_000, numPartitions=3).selectExpr(
        "if(id % 3 = 0, 7, if(id % 5 = 0, null, id)) AS k", "cast(id AS string) AS l", "timestamp_seconds(id) AS at"
    )
    thin = without_near_repeats(df, ["k"])
    assert thin.schema == df.schema
    assert thin.select("k").distinct().count() == df.select("k").distinct().count()
    assert thin.filter("k = 7").count() < 20 and thin.join(df, ["l", "at"]).count() == thin.count()


def test_a_key_seen_late_and_timely_comes_out_once(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    runs = [
        [(1, "00:00:00", "first"), (2, "00:30:00", "first")],
        [(1, "00:05:00", "too late"), (3, "00:05:00", "too late"), (4, "00:25:00", "timely"), (2, "00:31:00", "repeat")],
        [(3, "00:40:00", "timely"), (3, "00:10:00", "too late"), (4, "00:26:00", "repeat")],
        [(2, "02:00:00", "still remembered"), (4, "01:59:00", "still remembered")],  # until a batch ends later
        [(2, "02:01:00", "forgotten"), (5, "00:10:00", "too late")],
    ]
    for run in runs:
        spark.createDataFrame(run, "k int, at string, note string").selectExpr(
            "k", "cast(concat('2024-01-01 ', at) as timestamp) as at", "note").coalesce(1).write.mode("append").parquet(source)
        append_stream(dedup_stream(stream_table(spark, source), ["k"], "at", "10 minutes"), out, f"{tmp_path}/c")
    assert rows(spark.read.parquet(out), "k", "note") == [
        (1, "first"), (2, "first"), (2, "forgotten"), (3, "timely"), (4, "timely")]


def test_deduplication_for_ever_runs_no_python_and_carries_all_columns(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.range(1000).selectExpr("7 AS k", "cast(null as string) AS l", "id AS v", "map('a', id) AS m", "1 AS _share").write.parquet(source)
    stream = dedup_stream(stream_table(spark, source), ["k", "l"])
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert plan.count("Deduplicate [") == 2 and not any(w in plan for w in ("Arrow", "Python", "Pandas"))
    append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/c")
    [row] = spark.read.parquet(f"{tmp_path}/out").collect()
    assert (row.k, row.l, row["_share"]) == (7, None, 1) and row.m == {"a": row.v}


def test_a_hot_key_meets_in_few_rows(spark, tmp_path):
    df = spark.range(100_000, numPartitions=64).selectExpr("if(id % 3 = 0, 0, id) AS k")
    thin = without_near_repeats(df, ["k"])
    assert thin.filter("k = 0").count() == 32 and thin.select("k").distinct().count() == df.select("k").distinct().count()
