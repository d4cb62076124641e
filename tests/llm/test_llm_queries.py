"""Queries against their SQL, and the pipeline stage by stage against plain versions of each stage."""

import hashlib
import sys
from pathlib import Path

import check
import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from shopstrata.llm import bpe, mixing, toxicity  # noqa: E402
from shopstrata.llm.queries import ORACLES, QUERIES  # noqa: E402
from shopstrata.llm.scratch import Scratch  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [f"op{n}" for n in range(1, 14)] == [name.split("_")[0] for name in QUERIES]
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, name):
    assert check.compare(spark, SF, name) is None


@pytest.mark.parametrize("name", ["op5_chat_format", "op9_sharding", "op10_exact_dedup"])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


@pytest.fixture(scope="module")
def stages(spark):
    scratch, docs, out = Scratch(spark, "stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = scratch.table(stage(spark, docs, SF), f"{number}")
        out.append((docs, made))
        docs = made
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(made.columns == columns for _, made in stages[:-1])


def test_stages_keep_columns_of_any_name(spark):
    names = ["_mark", "_digest", "_copy", "_times", "_i", "_m", "_id", "_kept", "_toxicity", "id", "kept", "times", "score", "_gone_id"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumns({n: F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")) for n in names})
    docs = docs.unionByName(docs.limit(20)).unionByName(docs.limit(20).withColumn("_mark", F.lit("other")))
    for stage in (corpus_pipeline.reject_toxic, corpus_pipeline.exact, corpus_pipeline.near, corpus_pipeline.mix):
        made = stage(spark, docs, SF)
        rows = made.collect()
        assert made.columns == docs.columns and rows
        assert all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in names if n != "_mark")
        assert {r["_mark"] for r in rows} <= {"other", *(f"_mark:{r.doc_id}" for r in rows)}


def test_of_repeated_rows_the_least_stays(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "b"), (1, words, "a"), (1, words, None), (2, words, "c"), (3, "alone in here", "z"), (4, None, "x"), (4, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, note string")
    assert sorted(map(str, corpus_pipeline.exact(spark, docs, SF).select("doc_id", "note").collect())) == [
        "Row(doc_id=2, note='c')", "Row(doc_id=3, note='z')", "Row(doc_id=4, note='x')"]
    assert sorted(map(str, corpus_pipeline.near(spark, docs, SF).select("doc_id", "note").collect())) == [
        "Row(doc_id=1, note='a')", "Row(doc_id=1, note='b')", "Row(doc_id=1, note=None)", "Row(doc_id=3, note='z')",
        "Row(doc_id=4, note='x')", "Row(doc_id=4, note='y')"]


def test_toxic_documents_go(spark, stages):
    given, made = stages[0]
    model = toxicity.learned_model(spark, given, SF, Scratch(spark, "t"))
    scores = {r.doc_id: r.score for r in toxicity.score(given, model, keep=["doc_id"]).collect()}
    assert sorted(pairs(made)) == sorted(p for p in pairs(given) if scores[p[0]] < 0.3)
    assert len(pairs(made)) < len(pairs(given))


def test_copies_go(stages):
    given, made = stages[1]
    kept = {r[0] for r in brute.exact(pairs(given)) if r[3]}
    assert sorted(pairs(made)) == sorted(p for p in pairs(given) if p[0] in kept)


def test_near_copies_go(stages):
    given, made = stages[2]
    kept = {r[0] for r in brute.near(pairs(given), 80, 5) if r[3]}
    assert sorted(pairs(made)) == sorted(p for p in pairs(given) if p[0] in kept)


def test_the_mix_takes_what_sql_says(stages):
    given, made = stages[3]
    documents = given.toPandas()  # noqa: F841  read by name
    con = duckdb.connect()
    con.register("documents", documents)
    cursor = con.execute(mixing.SQL)
    names = [d[0] for d in cursor.description]
    want = {}
    for row in cursor.fetchall():
        r = dict(zip(names, row))
        want[r["doc_id"]] = r["taken"] // r["size"] if r["size"] else 0
    got = {}
    for i, _ in pairs(made):
        got[i] = got.get(i, 0) + 1
    assert got == {i: n for i, n in want.items() if n}


def test_tokens_are_the_librarys(stages):
    given, made = stages[4]
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    want = []
    for i, text in pairs(given):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), brute.sha(text or "")))
    assert sorted(tuple(r) for r in made.collect()) == sorted(want)
