"""One exact row holds a third of all lines and one order a fifth: same results, and the join is split."""

from pathlib import Path

import check
import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '{SF}/orders.parquet') TO '{folder}/orders.parquet' (FORMAT parquet)")
    con.execute(f"""
        COPY (
            SELECT * EXCLUDE (n)
                   REPLACE (CASE WHEN n % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
                            CASE WHEN n % 3 = 0 THEN CAST(n AS INTEGER) ELSE l_linenumber END AS l_linenumber)
            FROM (SELECT *, row_number() OVER () AS n FROM '{SF}/lineitem.parquet')
            UNION ALL
            SELECT l.* FROM (SELECT * FROM '{SF}/lineitem.parquet' LIMIT 1) l, range(3000)
        ) TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    return folder


@pytest.mark.parametrize(
    "name",
    ["dedup_latest", "gold_order_items", "gold_returns", "upsert_settled", "change_feed_latest", "stream_dedup",
     "stream_upsert_latest", "duplicate_report"],
)
def test_hot_keys_equal_sql(spark, hot, name):
    assert check.compare(spark, hot, name) is None


def test_a_hot_order_is_split_in_the_join(spark, hot):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",  # small tables would not be joined by shuffles
    }
    before = {key: spark.conf.get(key) for key in small}
    # Splitting goes by map output, so the hot rows must come from several map tasks.
    spread = f"{hot}/spread"
    for table in ("lineitem", "orders"):
        spark.read.parquet(f"{hot}/{table}.parquet").repartition(6).write.mode("overwrite").parquet(
            f"{spread}/{table}.parquet"
        )
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        summary = entry.queries()["daily_summary_full"](spark, spread)
        rows = summary.collect()
        plan = summary._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "skew=true" in plan
    assert len(rows) == len(check.oracle_frame(hot, entry.oracle_sql()["daily_summary_full"]))
