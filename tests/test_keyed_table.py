"""Upsert and change feed against a brute-force model."""

import random

import pytest
from conftest import rows

from shopstrata.operators.keyed_table import KeyedTable, newest_images

SCHEMA = "a int, b string, at int, v int"


def keyed(spark, tmp_path, **options):
    return KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], ["at"], **options)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def order(row):
    return [(x is not None, x if x is not None else 0) for x in row[2:]]


def merge(table, batch, keep):
    """The same upsert on a dict of keyed rows plus a list of rows without a key."""
    held, lone = table
    best = {}
    for row in batch:
        if None in row[:2]:
            lone.append(row)
        elif row[:2] not in best or order(row) > order(best[row[:2]]):
            best[row[:2]] = row
    for key, row in best.items():
        if key in held and (keep == "existing" or (keep == "greatest" and order(row) <= order(held[key]))):
            continue
        held[key] = row


def as_sorted(table):
    held, lone = table
    return sorted([*held.values(), *lone], key=lambda r: [(v is not None, v) for v in r])


def draw_batch(draw, n=60):
    return [
        (draw.choice([1, 2, 3, 4, None]), draw.choice(["x", "y", "z", None]), draw.choice([1, 2, 3, None]), draw.randrange(99))
        for _ in range(n)
    ]


@pytest.mark.parametrize("keep", ["incoming", "greatest", "existing"])
@pytest.mark.parametrize("settle_bytes", [0, 1 << 30])
def test_upserts_equal_brute_force(spark, tmp_path, keep, settle_bytes):
    draw = random.Random(f"{keep}{settle_bytes}")
    table, model = keyed(spark, tmp_path, keep=keep, settle_bytes=settle_bytes), ({}, [])
    for n in range(3):
        batch = draw_batch(draw, 25 + 20 * n)
        table.upsert(frame(spark, batch))
        merge(model, batch, keep)
    assert rows(table.read()) == as_sorted(model)
    assert bool(table.snapshots()) == (settle_bytes == 0)
    table.settle()
    assert rows(table.read()) == as_sorted(model)
    assert table.snapshots()[-1].version == 2


def test_replaying_a_feed_gives_the_table(spark, tmp_path):
    draw = random.Random(5)
    table, copy = keyed(spark, tmp_path / "s", settle_bytes=0), keyed(spark, tmp_path / "c")
    for _ in range(3):
        table.upsert(frame(spark, [r for r in draw_batch(draw) if None not in r[:2]]))
    copy.upsert(newest_images(table.changes(), ["a", "b"]), one_row_per_key=True)
    assert rows(copy.read()) == rows(table.read())


def test_change_feed_names_what_happened(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(frame(spark, [(1, "x", 1, 10), (2, "x", 1, 20)]))
    table.upsert(frame(spark, [(1, "x", 2, 11), (3, "x", 1, 30)]))
    assert rows(table.changes(), "_commit_version", "_change_type", "a", "v") == [
        (0, "insert", 1, 10), (0, "insert", 2, 20),
        (1, "insert", 3, 30), (1, "update_postimage", 1, 11), (1, "update_preimage", 1, 10),
    ]


def test_a_batch_handed_in_again_changes_nothing(spark, tmp_path):
    table = keyed(spark, tmp_path)
    first, second = [(1, "x", 1, 10)], [(1, "x", 2, 11), (2, "y", 1, 5)]
    assert table.upsert(frame(spark, first), "stream", 0) == 0
    assert table.upsert(frame(spark, second), "stream", 1) == 1
    for _ in range(2):
        assert table.upsert(frame(spark, second), "stream", 1) == 1
        assert table.upsert(frame(spark, first), "stream", 0) == 0
    assert table.changes().count() == 4
    assert rows(table.read(), "a", "v") == [(1, 11), (2, 5)]


def test_a_fresh_checkpoint_is_a_new_source(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(frame(spark, [(1, "x", 1, 10)]), "first", 0)
    table.upsert(frame(spark, [(1, "x", 1, 99)]), "second", 0)
    assert rows(table.read(), "v") == [(99,)]


def test_crash_before_the_commit_leaves_no_trace(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(frame(spark, [(1, "x", 1, 10)]), "s", 0)
    frame(spark, [(1, "x", 1, 66)]).write.parquet(f"{table.log.path}/_staging/half")
    assert rows(table.read(), "v") == [(10,)]
    table.upsert(frame(spark, [(1, "x", 2, 12)]), "s", 1)
    assert rows(table.read(), "v") == [(12,)]


@pytest.mark.parametrize("settle", [False, True])
def test_new_columns_are_null_in_old_rows_and_missing_ones_stay(spark, tmp_path, settle):
    table = keyed(spark, tmp_path, settle_bytes=0 if settle else 1 << 30)
    table.upsert(frame(spark, [(1, "x", 1, 10), (2, "x", 1, 20)]))
    wider = spark.createDataFrame([(2, "x", 2, 21, "n")], SCHEMA + ", note string")
    table.upsert(wider)
    assert rows(table.read(), "a", "v", "note") == [(1, 10, None), (2, 21, "n")]
    table.upsert(spark.createDataFrame([(3, "x", 1)], "a int, b string, at int"))
    assert rows(table.read(), "a", "v", "note") == [(1, 10, None), (2, 21, "n"), (3, None, None)]
    table.settle()
    assert rows(table.read(), "a", "v", "note") == [(1, 10, None), (2, 21, "n"), (3, None, None)]


def test_changed_type_is_refused(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(frame(spark, [(1, "x", 1, 10)]))
    with pytest.raises(TypeError, match="column v"):
        table.upsert(spark.createDataFrame([(1, "x", 1, "ten")], "a int, b string, at int, v string"))


@pytest.mark.parametrize("settle_bytes", [0, 1 << 30])
def test_null_keys_can_match(spark, tmp_path, settle_bytes):
    table = keyed(spark, tmp_path, match_null_keys=True, settle_bytes=settle_bytes)
    table.upsert(frame(spark, [(1, None, 1, 10), (None, None, 1, 20), (2, "x", 1, 5)]))
    table.upsert(frame(spark, [(1, None, 2, 11), (None, None, 2, 21), (None, "x", 1, 7)]))
    want = [(None, None, 21), (None, "x", 7), (1, None, 11), (2, "x", 5)]
    assert rows(table.read(), "a", "b", "v") == want
    table.settle()
    assert rows(table.read(), "a", "b", "v") == want


def test_growth_changes_the_bucket_count(spark, tmp_path):
    table = keyed(spark, tmp_path, settle_bytes=0, bucket_bytes=4096)
    model = ({}, [])
    for n in range(3):
        batch = [(i, "k", n, i * n) for i in range(400 * n, 400 * n + 2000 * (n + 1))]
        table.upsert(frame(spark, batch))
        merge(model, batch, "incoming")
    table.settle()
    counts = [s.buckets for s in table.snapshots()]
    assert len(set(counts)) > 1 and all(c & (c - 1) == 0 for c in counts)
    assert rows(table.read()) == as_sorted(model)


def test_merging_never_shuffles_or_sorts_the_snapshot(spark, tmp_path):
    table = keyed(spark, tmp_path, settle_bytes=0)
    table.upsert(frame(spark, [(i, "k", 1, i) for i in range(500)]))
    table.settle()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = frame(spark, [(i, "k", 2, i) for i in range(9)]).select("a", "b")
        old = table._old_rows(wanted, [0], 1000)
        fold = table._folded(table.snapshots()[-1], [0])
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (old, fold)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plans[0] and "Sort" not in plans[0]
    for plan in plans:
        assert "Bucketed: true" in plan
        scan = plan.splitlines()[next(i for i, l in enumerate(plan.splitlines()) if "Bucketed: true" in l) - 2:]
        assert not any("Exchange" in line for line in scan[:2])
        assert plan.count("Exchange") == 1  # the small side only


def test_a_new_session_finds_the_snapshot(spark, tmp_path):
    table = keyed(spark, tmp_path, settle_bytes=0)
    table.upsert(frame(spark, [(i, "k", 1, i) for i in range(50)]))
    table.settle()
    spark.sql(f"DROP TABLE IF EXISTS {table._catalog_name(table.snapshots()[-1])}")
    again = keyed(spark.newSession(), tmp_path)
    assert again.read().count() == 50


def test_vacuum_keeps_reading_correct(spark, tmp_path):
    table = keyed(spark, tmp_path, settle_bytes=0)
    for n in range(4):
        table.upsert(frame(spark, [(1, "x", n, n), (n, "y", n, n)]))
        table.settle()
    table.vacuum(keep=1)
    assert len(table.snapshots()) == 1
    assert rows(table.read(), "a", "b", "v") == [(0, "y", 0), (1, "x", 3), (1, "y", 1), (2, "y", 2), (3, "y", 3)]
    assert table.changes().count() == 4 * 2 + 3  # the feed is whole
