"""Tables under lasting names, read from a second session."""

import datetime as dt

import pytest
from conftest import rows
from test_summary_and_jobs import GOLD, sale

from shopstrata.operators.keyed_table import KeyedTable


@pytest.fixture
def second(spark):
    session = spark.newSession()
    for schema in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
    yield session
    for schema in ("raw", "bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def selected(session, name):
    return sorted((tuple(r) for r in session.sql(f"SELECT * FROM {name}").collect()), key=str)


def same(session, name, table):
    read = table.read()
    assert session.table(name).columns == read.columns
    assert selected(session, name) == sorted((tuple(r) for r in read.collect()), key=str)


def test_a_second_session_reads_every_layer(spark, lake, second):
    day = dt.date(2024, 1, 1)
    gold, log = lake.gold_order_items(), lake.bronze_facts("order_items")
    gold.upsert(spark.createDataFrame([sale(day, n=1), sale(day, n=2)], GOLD))
    log.append(spark.createDataFrame([(1, "x")], "order_id int, channel string"))
    lake.snapshot("gold", "dim_date").overwrite(spark.createDataFrame([(day,)], "date date"))
    assert lake.register_all() == ["gold.gld_dim_date", "bronze.brz_order_items", "gold.gld_fact_order_items"]
    same(second, "gold.gld_fact_order_items", gold)
    same(second, "bronze.brz_order_items", log)
    assert selected(second, "gold.gld_dim_date") == [(day,)]
    # new commits, a new snapshot, a new version, new columns
    gold.settle()
    gold.upsert(spark.createDataFrame([(*sale(day, 9.0, n=2), "late"), (*sale(day, n=None), None)], GOLD + ", note string"))
    log.append(spark.createDataFrame([(2, "y", 1)], "order_id int, channel string, extra int"))
    lake.snapshot("gold", "dim_date").overwrite(spark.createDataFrame([(day, 1)], "date date, n int"))
    lake.register_all()
    same(second, "gold.gld_fact_order_items", gold)
    same(second, "bronze.brz_order_items", log)
    assert selected(second, "gold.gld_dim_date") == [(day, 1)]
    gold.settle()
    gold.settle()
    gold.vacuum(keep=1)
    lake.register_all()
    same(second, "gold.gld_fact_order_items", gold)
    helpers = [r.tableName for r in second.sql("SHOW TABLES IN gold LIKE '*__*'").collect()]
    assert len(helpers) == 4  # dim_date, and feed, rows and keyless rows of the fact table


@pytest.mark.parametrize("match_null_keys", [False, True])
def test_a_view_equals_the_table(spark, tmp_path, second, match_null_keys):
    spark.sql("CREATE SCHEMA gold")
    table = KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], ["v"], match_null_keys=match_null_keys)
    batches = [[(1, "x", 1), (None, "x", 2), (2, None, 3)], [(1, "x", 4), (None, "x", 5), (3, "y", 6)], [(2, None, 7), (3, "y", 8)]]
    for number, batch in enumerate(batches):
        table.upsert(spark.createDataFrame(batch, "a int, b string, v int"))
        assert table.register("gold", "some_table") == "gold.some_table"
        same(second, "gold.some_table", table)
        if number == 1:
            table.settle()
            table.register("gold", "some_table")
            same(second, "gold.some_table", table)
    assert len(rows(table.read())) == (4 if match_null_keys else 6)
