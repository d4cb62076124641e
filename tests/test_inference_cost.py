"""What schema inference does to each value and line does not grow with columns, and no line is shuffled."""

from pyspark.sql import functions as F

from shopstrata.sources import landing


def plan(df, mode="simple"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_patterns_are_planned_once_for_all_columns(spark, tmp_path):
    spark.range(5).select(*[F.col("id").alias(f"c{n}") for n in range(13)]).write.option("header", True).csv(f"{tmp_path}/in")
    few, many = (plan(landing.value_kinds(spark, f"{tmp_path}/in", "*.csv", n)).upper().count("RLIKE") for n in (2, 13))
    assert few == many > 0


def test_lines_are_not_shuffled_to_find_headers(spark, tmp_path):
    spark.range(5).write.option("header", True).csv(f"{tmp_path}/in")
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if there were very many lines
    heads = landing.file_headers(session, f"{tmp_path}/in")
    assert "SortMergeJoin" not in plan(heads) and "BroadcastHashJoin" in plan(heads)
    assert {row.header for row in heads.collect()} == {"id"}


VALUES = {
    "": 0, "5": 1, "-2147483648": 1, "+0000000000000000000007": 1, "2147483648": 2, "-9223372036854775808": 2,
    "9223372036854775808": 4, "1" * 38: 4, "1" * 39: 8, ".5": 8, "5.": 8, "1e400": 8, "-.5e-3f": 8, "0x1.8p1": 8, "-inf": 8,
    "NaN": 8, "\t5.5": 8, "2001-02-03": 16, "2001-2-3": 16, "2001-02": 16, "2001-02-30": 128, "2001-02-03 12:30": 32,
    "2001-02-03T12:30:00Z": 32, "2001-02-03 12:00:00 America/New_York": 32, "T12:30": 32, "12:30:99": 128, "true": 64,
    "No": 64, "Yes": 64, "f": 64, "Two": 128, "INR": 128, "x1": 128, "5%": 128, "$5": 128, "5 ": 128, " 5": 128, "1_0": 128,
    "555-1234": 128, "é": 128, "now": 128, "٣": 128,
}


def test_kinds_of_single_values(spark):
    found = spark.createDataFrame([(v,) for v in VALUES], "v string").select("v", landing._kind(F.col("v")).alias("kind"))
    assert {r.v: r.kind for r in found.collect()} == VALUES


def test_kinds_of_text_columns_are_not_looked_for(spark, tmp_path):
    files = f"{tmp_path}/in"
    spark.sql("SELECT '1' AS a, '2' AS b").write.option("header", True).csv(f"{files}/x")
    spark.sql("SELECT '3' AS b, '4.5' AS a, '5' AS c").write.option("header", True).csv(f"{files}/y")
    found = landing.value_kinds(spark, files, "*.csv", 3, [1])
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(1, 0, 0), (1, 0, 1)]
    assert "c1" not in plan(found).lower().split("readschema")[1].split(">")[0]
    assert [tuple(r)[1:] for r in landing.value_kinds(spark, f"{files}/x", "*.csv", 2, [0, 1]).collect()] == [(0, 0)]
    # a place is left out only where every header has a text there
    kinds = {f.name: f.dataType.simpleString() for f in landing.kept_schema(spark, files, f"{tmp_path}/s.json", texts=["b"])}
    assert kinds == {"a": "double", "b": "string", "c": "int"}


def test_files_of_batch_cuts_are_written_once(spark, monkeypatch):
    from shopstrata.testbed import queries

    written = []
    monkeypatch.setattr(queries, "write_csv", lambda rows, folder: written.append(folder) or rows.write.csv(folder, header=True))
    taken = []
    monkeypatch.setattr(queries, "_take_in_items", lambda spark, lake, folder, most: taken.append((folder, most)))
    monkeypatch.setattr(queries, "_silver_items", lambda lake: spark.range(1))
    queries.silver_batch_cuts(spark, "/root/testdata/sf0.001")
    assert taken == [(written[0], 1000), (written[0], 3)] and len(written) == 1
