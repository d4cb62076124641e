"""What an upsert and its readers hold on disk besides the rows: shuffles that are done with, and rows moved at once."""

import re
import time
from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F

from shopstrata import session
from shopstrata.operators import keyed_table
from shopstrata.operators.commit_log import CommitLog
from shopstrata.operators.keyed_table import KeyedTable
from shopstrata.testbed import queries

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if re.search(r"/shuffle_\d+_[^/]*\.data$", f)}


def grouped(spark, n=200):
    wide = F.concat(*[F.sha2((F.col("id") + i).cast("string"), 512) for i in range(5)])
    return spark.range(n).groupBy((F.col("id") % 40).alias("k")).agg(F.max("id").cast("int").alias("v"), F.max(wide).alias("w"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], ["v"], keep="greatest")
    CommitLog(spark, f"{tmp_path}/log", "n").append(grouped(spark))
    queries.write_csv(grouped(spark), f"{tmp_path}/csv")
    table.upsert(grouped(spark))
    table.upsert(grouped(spark, 300))
    table.settle()
    time.sleep(1)  # for what is removed beside the job
    # what is left are the small sums that look at a batch's keys
    left = [Path(f) for f in shuffle_files(spark) - before]
    assert sum(f.stat().st_size for f in left if f.exists()) < 20_000
    assert spark.conf.get(FREED, None) in (None, "false")


def test_the_setting_is_put_back(spark):
    spark.conf.set(FREED, "true")
    with session.shuffles_freed(spark):
        assert spark.conf.get(FREED) == "true"
    assert spark.conf.get(FREED) == "true"
    spark.conf.unset(FREED)
    try:
        with session.shuffles_freed(spark):
            assert spark.conf.get(FREED) == "true"
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(FREED, None) in (None, "false")


def upserted(spark, path, **options):
    table = KeyedTable(spark, path, ["a", "b"], ["v"], keep="greatest", **options)
    first = spark.range(400).select(
        F.when(F.col("id") % 17 != 0, F.col("id") % 90).alias("a"), (F.col("id") % 3).cast("int").alias("b"), (F.col("id") % 11).alias("v"))
    table.upsert(first)
    table.upsert(first.filter("a >= 40 or a is null").withColumn("v", 20 - F.col("v")).unionByName(first.withColumn("a", F.col("a") + 90)))
    return table


def test_slices_make_the_same_changes_at_one_time(spark, tmp_path, monkeypatch):
    for match_null_keys in (False, True):
        whole = upserted(spark, f"{tmp_path}/whole{match_null_keys}", match_null_keys=match_null_keys)
        monkeypatch.setattr(keyed_table, "SLICE_BYTES", 1)
        cut, counted = [], KeyedTable._compare_slice
        monkeypatch.setattr(KeyedTable, "_compare_slice", lambda *given: cut.append(1) or counted(*given))
        sliced = upserted(spark, f"{tmp_path}/sliced{match_null_keys}", match_null_keys=match_null_keys)
        monkeypatch.undo()
        assert len(cut) == keyed_table.SLICES
        for read in (KeyedTable.read, lambda table: table.changes().drop(keyed_table.STAMP)):
            assert rows(read(sliced)) == rows(read(whole))
        stamps = sliced.changes().groupBy(keyed_table.VERSION).agg(F.countDistinct(keyed_table.STAMP)).collect()
        assert [n for _, n in stamps] == [1, 1]
        assert sliced.schema() == whole.schema()


def test_a_table_with_a_snapshot_is_compared_at_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "SLICE_BYTES", 1)
    table = upserted(spark, f"{tmp_path}/t")
    commits = table.log.numbers()
    assert table._slices(f"{tmp_path}/none", commits) == keyed_table.SLICES
    table.settle()
    assert table._slices(f"{tmp_path}/none", commits) == 1


def test_readers_of_two_commits_move_asked_columns_of_the_older_only(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], ["v"], keep="greatest")
    batch = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("wide").alias("w"))
    table.upsert(batch)
    table.upsert(batch.filter("k >= 20").withColumns({"k": F.col("k") + 10, "v": F.lit(2)}))
    with_w = rows(table.read())
    assert with_w == [(k, 2 if k >= 30 else 1, "wide") for k in range(60)]
    asked = plan(table.read().select("k", "v"))
    assert "w#" not in asked and "SortAggregate" not in asked and "HashAggregate" not in asked
    table.upsert(batch.filter("k < 5").withColumn("v", F.lit(3)))
    want = [(k, 3 if k < 5 else v, w) for k, v, w in with_w]
    assert rows(table.read()) == want
    table.settle()
    assert rows(table.read()) == want


def test_compressed_landing_files_are_taken_in_whole(spark, tmp_path):
    lake = queries.Lake(spark, f"{tmp_path}/lake")
    folder = lake.landing("order_items")
    items = queries.retail.order_items(spark, "/root/testdata/sf0.001")
    queries._land_items(items, folder, **queries.PACKED)
    queries._take_in_items(spark, lake, folder, pattern="*.csv.gz")
    assert list(Path(folder).glob("*.csv.gz")) and not list(Path(folder).glob("*.csv"))
    assert lake.bronze_facts("order_items").read().count() == items.count()
    plain = queries.Lake(spark, f"{tmp_path}/plain")
    queries._land_items(items, plain.landing("order_items"))
    queries._take_in_items(spark, plain, plain.landing("order_items"))
    assert rows(queries._silver_items(lake)) == rows(queries._silver_items(plain))
