"""Schemas inferred by jobs over the whole folder, and batches found without reading all notes."""

import pytest
from pyspark.sql import functions as F

from shopstrata.operators.commit_log import CommitLog
from shopstrata.sources import landing


def files(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_types_are_those_of_sparks_own_inference(spark, tmp_path):
    folder = files(tmp_path / "in", a=(
        "i,l,d,x,day,at,yes,t,none,mixed,e\n"
        "1,3000000000,123456789012345678901,1.5,2024-01-05,2024-01-05 10:00:00,true,abc,,1,1e5\n"
        "-2,4,5,2,2023-12-31,2024-01-05T10:00:00Z,FALSE,1,,2024-01-01,NaN\n"))
    ours = landing.kept_schema(spark, folder, f"{tmp_path}/s.json")
    theirs = spark.read.option("header", True).option("inferSchema", True).csv(folder).schema
    kinds = {f.name: f.dataType.simpleString() for f in ours}
    assert kinds["d"] == "decimal(38,0)"  # theirs is as wide as the longest number so far
    assert {k: v for k, v in kinds.items() if k != "d"} == {f.name: f.dataType.simpleString() for f in theirs if f.name != "d"}


def test_types_are_widened_over_files_of_several_headers(spark, tmp_path):
    folder = files(
        tmp_path / "in", a="k,v,w\n1,2,x\n", b="v,k\n2.5,3000000000\n", c="k,v,w,z\n5,,1,2024-01-01\n", d="\n\n", e="")
    files(tmp_path / "in" / "sub", f="﻿z,k\n2024-01-01 10:00:00,7\n\n", g="k,v,w\n")
    found = landing.kept_schema(spark, folder, f"{tmp_path}/s.json")
    assert {f.name: f.dataType.simpleString() for f in found} == {
        "k": "bigint", "v": "double", "w": "string", "z": "timestamp"}
    heads = {r.header: r["count"] for r in landing.file_headers(spark, folder).groupBy("header").count().collect()}
    assert heads == {"k,v,w": 2, "v,k": 1, "k,v,w,z": 1, "z,k": 1}


def test_a_folder_of_empty_files_has_no_schema(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.kept_schema(spark, files(tmp_path / "in", a="", b="\n \n"), f"{tmp_path}/s.json")


def test_only_distinct_headers_reach_the_driver(spark, tmp_path, monkeypatch):
    folder = files(tmp_path / "in", **{f"f{n}": f"a,b\n{n},{'x' if n % 2 else n}\n" for n in range(40)})
    monkeypatch.setattr(landing.storage, "first_line", None)  # no file is opened from the driver
    monkeypatch.setattr(landing, "files_by_header", None)
    frame, gathered = type(spark.range(1)), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: gathered.append(collect(self)) or gathered[-1])
    found = landing.kept_schema(spark, folder, f"{tmp_path}/s.json")
    assert {f.name: f.dataType.simpleString() for f in found} == {"a": "int", "b": "string"}
    assert [len(rows) for rows in gathered] == [1, 1]


def test_a_new_source_is_found_to_be_new_without_reading_old_notes(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path / "log"), "n")
    for batch in range(5):
        log.append(spark.range(1), "first", batch)
    reads, note = [], CommitLog.note
    monkeypatch.setattr(CommitLog, "note", lambda self, n: reads.append(n) or note(self, n))
    assert log.find("second", 0) is None and log.find("first", 7) is None
    assert [log.find("first", n) for n in range(5)] == [0, 1, 2, 3, 4]
    assert set(reads) == {4}


def test_an_append_whose_writer_was_lost_is_found(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path / "log"), "n")
    log.append(spark.range(1), "a", 0)
    with monkeypatch.context() as lost:
        lost.setattr(CommitLog, "_enter", lambda self, n: 1 / 0 if n else None)
        with pytest.raises(ZeroDivisionError):
            log.append(spark.range(2), "a", 1)
    assert log.numbers() == [0, 1] or log.numbers() == [0]
    log.append(spark.range(3), "b", 0)
    assert log.append(spark.range(2), "a", 1) == log.find("a", 1)
    assert log.read().groupBy("n").count().count() == len(log.numbers())
    assert log.read().agg(F.count("*")).first()[0] == 6


def test_a_log_without_an_index_gets_one(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), "n")
    for batch in range(3):
        log.append(spark.range(1), "a", batch)
    from shopstrata import storage

    storage.remove(spark, f"{log.path}/_batches")
    assert log.find("a", 1) == 1 and log.find("a", 9) is None and log.append(spark.range(1), "a", 2) == 2
