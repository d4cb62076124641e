"""Reduction per key, reports and whole-table overwrite."""

import random

import pytest
from conftest import rows

from shopstrata import storage
from shopstrata.operators import quality
from shopstrata.operators.latest import latest_per_key


def sample(spark, n=500, seed=1):
    draw = random.Random(seed)
    data = [
        (draw.choice([1, 1, 1, 2, 3, None]), draw.choice(["a", "b", None]), draw.choice([None, 1, 2, 3]), draw.random())
        for _ in range(n)
    ]
    return data, spark.createDataFrame(data, "k int, l string, at int, v double")


def test_latest_per_key_equals_brute_force_for_any_split(spark):
    data, df = sample(spark)
    best = {}
    for k, l, at, v in data:
        order = (at is not None, at or 0, v)
        if (k, l) not in best or order > best[k, l][0]:
            best[k, l] = (order, (k, l, at, v))
    want = sorted((row for _, row in best.values()), key=lambda r: [(x is not None, x) for x in r])
    for parts in (1, 7):
        assert rows(latest_per_key(df.repartition(parts), ["k", "l"], ["at"])) == want


def test_latest_per_key_can_keep_every_row_without_a_key(spark):
    data, df = sample(spark)
    kept = rows(latest_per_key(df, ["k", "l"], ["at"], null_keys="each"))
    lone = [r for r in data if r[0] is None or r[1] is None]
    assert sorted((r for r in kept if r[0] is None or r[1] is None), key=str) == sorted(lone, key=str)
    assert len([r for r in kept if None not in r[:2]]) == len({r[:2] for r in data if None not in r[:2]})


def test_latest_per_key_reduces_before_the_shuffle(spark):
    """A key with most of the rows must not reach one task row by row."""
    df = spark.range(100_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    plan = latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "partial_max" in before_shuffle


def test_latest_per_key_with_keys_only(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    assert rows(latest_per_key(df, ["a", "b"])) == [(1, 2), (3, 4)]


def test_latest_per_key_with_awkward_names(spark):
    df = spark.createDataFrame([(1, 2), (1, 5)], "`k.x` int, `v y` int")
    assert rows(latest_per_key(df, ["k.x"])) == [(1, 5)]


def test_reports(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "b")], "k int, v string")
    assert rows(quality.duplicate_report(df)) == [(1, "a", 2)]
    assert rows(quality.duplicate_report(df, ["v"])) == [("a", 2), ("b", 2)]
    assert rows(quality.null_key_report(df, ["k"])) == [(None, "b")]
    assert rows(quality.distinct_values(df, "v")) == [("a",), ("b",)]
    assert rows(quality.distinct_within(df, "v", "k", ["b"])) == [("b", None), ("b", 2)]
    assert rows(quality.value_ranges(df, "k")) == [(4, 1, 2)]
    assert [tuple(r) for r in quality.top_rows(df, [df.k.desc(), df.v], 2).collect()] == [(2, "b"), (1, "a")]


def test_require_unique(spark):
    good = spark.createDataFrame([(1,), (2,)], "k int")
    assert quality.require_unique(good, ["k"], "t") is good
    with pytest.raises(ValueError, match="repeated"):
        quality.require_unique(good.union(good), ["k"], "t")
    with pytest.raises(ValueError, match="without k"):
        quality.require_unique(spark.createDataFrame([(None,)], "k int"), ["k"], "t")


def test_overwrite_keeps_old_columns_and_refuses_other_types(spark, lake):
    table = lake.snapshot("bronze", "t")
    assert not table.exists()
    table.overwrite(spark.createDataFrame([(1, "x")], "k int, old string"))
    table.overwrite(spark.createDataFrame([(2, 1.5)], "k int, new double"))
    assert rows(table.read(), "k", "new", "old") == [(2, 1.5, None)]
    assert dict(table.read().dtypes) == {"k": "int", "new": "double", "old": "string"}
    with pytest.raises(TypeError, match="column k"):
        table.overwrite(spark.createDataFrame([("2",)], "k string"))
    table.overwrite(spark.createDataFrame([("2",)], "k string"), keep_columns=False)
    assert table.read().dtypes == [("k", "string")]


def test_overwrite_may_read_the_table_it_replaces(spark, lake):
    table = lake.snapshot("silver", "t")
    table.overwrite(spark.range(5))
    table.overwrite(table.read().selectExpr("id + 1 AS id"))
    assert rows(table.read()) == [(1,), (2,), (3,), (4,), (5,)]


def test_unfinished_overwrite_is_not_seen(spark, lake):
    table = lake.snapshot("silver", "t")
    table.overwrite(spark.range(3))
    spark.range(9).write.parquet(f"{table.path}/_staging/half")  # a writer that died before its rename
    assert table.read().count() == 3


def test_clustered_overwrite_cuts_inside_a_hot_value(spark, lake):
    table = lake.snapshot("gold", "t")
    df = spark.range(8000).selectExpr("if(id % 3 = 0, 7, id % 50) AS day", "id AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data would be one file
    try:
        table.overwrite(df, cluster_by=["day"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in spark.read.parquet(table.location()).groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 8000 / 3
    assert table.read().count() == 8000


def test_vacuum_keeps_the_newest_versions(spark, lake):
    table = lake.snapshot("gold", "t")
    for n in range(4):
        table.overwrite(spark.range(n + 1))
    table.vacuum(keep=2)
    assert table.versions() == [2, 3] and table.read().count() == 4


def test_namespaces_and_names(spark, lake):
    lake.create_namespaces()
    lake.create_namespaces()
    found = {r.namespace for r in spark.sql("SHOW SCHEMAS").collect()}
    assert {"raw", "bronze", "silver", "gold"} <= found
    lake.publish("gold", "dim_date", spark.range(3))
    assert spark.sql("SELECT count(*) FROM gld_dim_date").first()[0] == 3


def test_storage_texts(spark, tmp_path):
    path = str(tmp_path / "a" / "note.txt")
    storage.write_text(spark, path, "grün\nzwei")
    assert storage.read_text(spark, path) == "grün\nzwei"
    assert storage.first_line(spark, path) == "grün"
    assert storage.exists(spark, path) and storage.size_bytes(spark, path) > 5
    assert storage.child_names(spark, str(tmp_path / "missing")) == []
