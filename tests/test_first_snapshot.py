"""A lone commit is looked up as it is; the first snapshot is written when there are two."""

from conftest import rows
from pyspark.sql import functions as F

from shopstrata.operators.keyed_table import KeyedTable


def test_first_snapshot_waits_for_a_second_commit(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], ["v"], keep="greatest", settle_bytes=1)
    batch = spark.range(40).select(F.col("id").alias("k"), F.lit(5).alias("v"))
    table.upsert(batch)
    table.upsert(batch.filter("k < 20").withColumn("v", F.col("k").cast("int")))
    assert table.snapshots() == []
    want = [(k, max(k, 5) if k < 20 else 5) for k in range(40)]
    assert rows(table.read()) == want
    table.upsert(batch.filter("k >= 30").withColumn("v", F.lit(7)))
    assert [s.version for s in table.snapshots()] == [1]
    assert rows(table.read()) == [(k, 7 if k >= 30 else v) for k, v in want]
    assert rows(table.changes().groupBy("_change_type").count()) == [
        ("insert", 40), ("update_postimage", 24), ("update_preimage", 24)]
