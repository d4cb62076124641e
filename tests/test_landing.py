"""Raw files: headers, inferred schemas and values that do not fit."""

import os
import time
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql.types import StructType

from shopstrata.sources import landing
from shopstrata.sources.csv import scan_by_header, scan_with_schema, with_lineage
from shopstrata.streaming.ingest import BATCH, bronze_log, ingest_landing

KV = StructType().add("k", "integer").add("v", "integer")


class Drop:
    def __init__(self, spark, base: Path):
        self.spark, self.base = spark, base
        self.folder = base / "landing"
        self.folder.mkdir()

    def file(self, name: str, text: str):
        (self.folder / name).write_text(text)

    def ingest(self, schema=KV, **options):
        ingest_landing(
            self.spark, str(self.folder), str(self.base / "bronze"), str(self.base / "checkpoint"), schema, **options
        )
        return bronze_log(self.spark, str(self.base / "bronze"))


@pytest.fixture
def drop(spark, tmp_path):
    return Drop(spark, tmp_path)


def test_scan_by_header_and_glob(spark, drop):
    drop.file("a.csv", "x,y\n1,a\n")
    drop.file("b.csv", "x,y\n2,\n")
    drop.file("c.txt", "x,y\n3,c\n")
    assert rows(scan_by_header(spark, f"{drop.folder}/*.csv")) == [("1", "a"), ("2", None)]


def test_scan_with_schema_refuses_another_header(spark, drop):
    drop.file("a.csv", "k,v\n1,2\n")
    assert rows(scan_with_schema(spark, f"{drop.folder}/*.csv", KV)) == [(1, 2)]
    drop.file("b.csv", "v,k\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        scan_with_schema(spark, f"{drop.folder}/b.csv", KV).collect()


def test_lineage(spark, drop):
    drop.file("a.csv", "k,v\n1,2\n")
    df = with_lineage(scan_with_schema(spark, f"{drop.folder}/*.csv", KV), "file_name", "ingested_at")
    [row] = df.collect()
    assert row.file_name.endswith("/landing/a.csv") and row.ingested_at is not None


def test_values_that_do_not_fit_are_rescued(drop):
    drop.file("a.csv", "k,v\nx,9\n1,2\n")
    assert rows(drop.ingest().read(), "k", "v", "_rescued_data") == [(None, 9, '{"k":"x"}'), (1, 2, None)]


def test_reordered_unknown_and_missing_columns(drop):
    drop.file("a.csv", "k,v\n1,2\n")
    drop.file("b.csv", "v,k,z\n5,6,7\n")
    drop.file("c.csv", "v\n8\n")
    assert rows(drop.ingest().read(), "k", "v", "_rescued_data") == [
        (None, 8, None), (1, 2, None), (6, 5, '{"z":"7"}'),
    ]


def test_ragged_rows_keep_their_text(drop):
    drop.file("a.csv", "k,v\n4,5,extra\n1,2\n")
    assert rows(drop.ingest().read(), "k", "v", "_rescued_data") == [
        (1, 2, None), (4, 5, '{"_corrupt_record":"4,5,extra"}'),
    ]


def test_quotes_repeated_names_and_empty_files(drop):
    drop.file("a.csv", '﻿"k",v,v\n1,2,3\n')
    drop.file("b.csv", "")
    drop.file("c.csv", '\n"k","v"\n"7","8"\n')
    assert rows(drop.ingest().read(), "k", "v", "_rescued_data") == [(1, 2, '{"v_":"3"}'), (7, 8, None)]


def test_each_file_is_read_once(drop):
    drop.file("a.csv", "k,v\n1,2\n")
    drop.ingest()
    log = drop.ingest()
    assert log.numbers() == [0]
    drop.file("b.csv", "k,v\n3,4\n")
    drop.file("b.txt", "k,v\n9,9\n")
    log = drop.ingest()
    assert rows(log.read(), "k", BATCH) == [(1, 0), (3, 1)]


def test_late_files_with_old_times_and_subfolders(drop):
    drop.file("a.csv", "k,v\n1,2\n")
    drop.ingest()
    (drop.folder / "2024" / "01").mkdir(parents=True)
    drop.file("2024/01/b.csv", "k,v\n3,4\n")
    month_ago = time.time() - 30 * 86400
    os.utime(drop.folder / "2024" / "01" / "b.csv", (month_ago, month_ago))
    assert rows(drop.ingest().read(), "k") == [(1,), (3,)]


def test_max_files_bounds_a_batch(drop):
    for n in range(3):
        drop.file(f"{n}.csv", f"k,v\n{n},0\n")
    log = drop.ingest(max_files=1)
    assert log.numbers() == [0, 1, 2] and rows(log.read(), "k") == [(0,), (1,), (2,)]


def test_schema_is_inferred_once_and_kept(spark, drop, tmp_path):
    drop.file("a.csv", "id,day,price,text\n1,2024-01-31,2.5,x1\n2,2024-02-01,3,y\n")
    drop.file("b.csv", "text,id\nhello,7\n")
    drop.file("c.csv", "id,day,price,text\n3,2024-02-01,3,y\n")
    kept = str(tmp_path / "kept" / "schema.json")
    first = landing.kept_schema(spark, str(drop.folder), kept)
    assert [f.dataType.simpleString() for f in first] == ["int", "date", "double", "string"]
    drop.file("d.csv", "id,day,price,text\nmany,never,none,z\n")
    assert landing.kept_schema(spark, str(drop.folder), kept) == first
    log = drop.ingest(schema=None)
    assert log.read().count() == 5


def test_inference_needs_a_file(spark, drop, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.kept_schema(spark, str(drop.folder), str(tmp_path / "s.json"))
