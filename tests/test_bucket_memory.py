"""Buckets are sized by rows in memory, and key ranges are found by halving."""

from pyspark.sql import functions as F

from shopstrata.operators.keyed_table import HELD, KeyedTable, part_of, row_bytes


def test_rows_that_compress_well_get_buckets_enough(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], settle_bytes=0, bucket_bytes=1 << 20)
    rows = spark.range(100_000).select(F.col("id").alias("k"), F.lit("the same").alias("v"))
    table.upsert(rows, one_row_per_key=True)
    table.settle()
    assert table.snapshots()[-1].buckets >= HELD * 100_000 * row_bytes(rows.schema) / (1 << 20)
    table.upsert(rows.withColumn("v", F.lit("another")), one_row_per_key=True)
    table.settle()
    found = table.read().groupBy("v").agg(F.count("*"), F.countDistinct("k")).collect()
    assert [tuple(r) for r in found] == [("another", 100_000, 100_000)]


def test_parts_are_counts_of_smaller_cuts(spark):
    cuts = [-3.5, 0.0, 1.0, 2.0, 7.25, float("inf")]
    values = [-9.0, -3.5, -0.0, 0.0, 0.5, 1.0, 2.0, 2.5, 7.25, 8.0, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for some in (cuts, cuts[:1], []):
        counted = sum(((F.col("v") > F.lit(cut)).cast("int") for cut in some), F.lit(0))
        assert df.filter(part_of(F.col("v"), some) != counted).count() == 0
