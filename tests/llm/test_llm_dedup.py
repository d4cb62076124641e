import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from shopstrata.llm import embedding_dedup, exact_dedup, near_dedup, substring  # noqa: E402
from shopstrata.llm.components import components  # noqa: E402
from shopstrata.llm.scratch import Scratch  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def table(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


# extra columns carry names that the operators use themselves
def clashing(df):
    return df.withColumns({c: F.lit("x") for c in ("id", "anchor", "cls", "_row", "spans", "digest", "n", "score")})


def odd_texts():
    rnd = random.Random(3)
    words = [rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(400)]
    cut = lambda a, b, by=" ": by.join(words[a:b])
    return [
        (1, None), (2, ""), (3, "x " * 100), (None, cut(0, 120)), (4, cut(10, 60) + "\n" + cut(200, 260)),
        (4, cut(30, 100)), (5, cut(0, 120)), (5, cut(0, 120)), (6, cut(50, 84, "\t")), (7, cut(50, 85)),
        (8, "é " * 50 + cut(300, 400)), (9, " \t\n"), (10, "漢字 " * 40), (11, "漢字 " * 40 + "x"), (12, "w " * 30_000),
    ]


def removed(df, scratch, **options):
    return brute.in_order(substring.remove_repeats(df, scratch, **options).select(
        "id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect())


def test_repeated_passages_equal_brute_force(spark, scratch):
    df = table(spark, odd_texts())
    assert removed(clashing(df), scratch) == brute.substring(odd_texts())
    assert removed(df, scratch, window=50) == brute.substring(odd_texts(), 50)


def test_repeated_passages_of_given_table(spark, scratch):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert removed(df, scratch) == brute.substring(rows)


def test_repeated_passages_of_empty_table(spark, scratch):
    assert removed(table(spark, []), scratch) == []


def near_rows():
    rnd = random.Random(5)
    rows = [(1, None), (2, ""), (3, "a"), (4, "A"), (5, "a b"), (6, "a b"), (None, "q r s"), (7, "q r s"), (7, "q r s"), (8, " \n")]
    base = [rnd.choice("abcdefghij") + str(rnd.randint(0, 99)) for _ in range(120)]
    number = 10
    for drift in (0, 1, 1):
        start = base[:]
        rnd.shuffle(start)
        now = start[:]
        for k in range(90):
            words = now[:]
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 999)}"
            if drift and k % 7 == 0:
                now = words
            rows.append((number, " ".join(words)))
            number += 1
    for _ in range(150):
        words = [f"w{rnd.randint(0, 9)}" for _ in range(rnd.randint(3, 14))]
        rows.append((number, " ".join(words)))
        rows.append((number + 1, " ".join([*words, "zz"] if rnd.random() < 0.5 else words[:-1])))
        number += 2
    return rows


def linked(df, scratch):
    return brute.in_order(near_dedup.near_duplicates(df, scratch).drop("mark").collect())


def test_near_duplicates_equal_brute_force(spark, scratch):
    assert linked(clashing(table(spark, near_rows())), scratch) == brute.near(near_rows())


def test_large_clusters_and_long_lists_give_the_same(spark, scratch, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "HEAD", 4)
    monkeypatch.setattr(near_dedup, "LIST", 40)
    assert linked(table(spark, near_rows()), scratch) == brute.near(near_rows())


def test_near_duplicates_of_empty_table(spark, scratch):
    assert linked(table(spark, []), scratch) == []
    assert linked(table(spark, [(1, None), (2, "")]), scratch) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_threshold_is_exact(spark, scratch):
    words = [f"t{i}" for i in range(22)]  # 20 shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[:-3])), (3, " ".join(words[:-4]) + " Z")]
    assert linked(table(spark, rows), scratch) == brute.near(rows)


def test_dropping_near_duplicates_keeps_columns(spark, scratch):
    df = clashing(table(spark, near_rows()))
    kept = near_dedup.drop_near_duplicates(df, scratch)
    assert kept.columns == df.columns
    stay = [r for r in brute.near(near_rows()) if r[3]]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in stay)


@pytest.mark.parametrize("percent", [80, 85])
def test_small_sets_at_the_threshold_share_a_key(percent):
    for common in range(1, 61):
        for other in range(1, common * (100 - percent) // percent + 1):
            gaps = [common * (i + 1) // (other + 1) - common * i // (other + 1) for i in range(other + 1)]
            union = [(i, 0) for i in np.cumsum(gaps)[:-1]] + [(i, 1) for i in range(common)]
            both = np.array([shared for _, shared in sorted(union)], bool)
            hashes = np.arange(1, len(both) + 1, dtype=np.uint32)
            for mine in (np.ones(other, bool), np.arange(other) % 2 == 0):
                one, two = both.copy(), both.copy()
                one[~both], two[~both] = mine, ~mine
                keys = [near_dedup.list_keys(hashes[x], x.sum(), percent) for x in (one, two)]
                assert len(np.intersect1d(*keys)), (common, other)


def test_five_words_at_four_fifths(spark, scratch):
    old = [f"w{i}" for i in range(400)]
    changed = [f"new{w}" if i % 40 == 20 else w for i, w in enumerate(old)]  # 3 words: 0.860, 5 words: 0.776
    longer = [f"v{i}" for i in range(1180)]  # the last 180 appended: 0.847 on either
    tiny = "a b c d e f g h".split()  # 4 shingles of 5
    rows = [(i, " ".join(x)) for i, x in enumerate([old, changed, longer[:1000], longer, tiny, [*tiny, "z"]])]
    kept = near_dedup.drop_near_duplicates(table(spark, rows), scratch, percent=80, width=5)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 4]


def test_components(spark, scratch):
    rnd = random.Random(1)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        brute.join(parent, a, b)
    want = sorted((x, brute.find(parent, x)) for x in {x for a, b in edges if a != b for x in (a, b)})
    got = components(table(spark, edges, "a bigint, b bigint"), scratch, "c")
    assert sorted(tuple(r) for r in got.collect()) == want
    assert components(table(spark, [], "a bigint, b bigint"), scratch, "d").collect() == []


def test_exact_copies(spark, scratch):
    rows = [(1, "Ab É"), (2, "aB É"), (3, "ab é"), (4, None), (5, ""), (None, "x"), (6, "x"), (7, "y"), (7, "y"), (None, "z"),
            *[(i, "Hot") for i in range(100, 160)], (8, "long " * 50_000)]
    df = clashing(table(spark, rows))
    for heavy in (1, 1024):
        got = exact_dedup.mark_copies(df, scratch, heavy=heavy, tracked=16384)
        assert brute.in_order(got.select("id", "keep_id", "group_size", "kept", "digest").collect()) == brute.exact(rows)
    kept = exact_dedup.drop_copies(df, scratch)
    assert kept.columns == df.columns
    want = {r[4]: r[0] for r in brute.exact(rows) if r[3]}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in want.values())
    assert exact_dedup.mark_copies(df.limit(0), scratch).collect() == []


def vector_rows():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 8))
    rows = []
    for k in range(500):
        v = centres[k % 12] + rng.normal(size=8) * rng.choice([0.02, 0.2, 0.5])
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(rng.choice([0, 0, 0, 1, 2]))))
    same = rows[5][1]
    return rows + [(600 + k, same, 0) for k in range(30)] + [
        (700, None, 0), (701, [0.0] * 8, 0), (702, [float("nan")] * 8, 0), (703, [None] * 8, 0), (704, same, None),
        (705, [], 0), (706, [1.0, 2.0], 0), (707, [2.0, 4.0], 0), (708, [float("inf")] + [1.0] * 7, 0), (709, same, 0), (709, same, 0)]


@pytest.mark.parametrize("leaf", [2048, 40])
def test_near_vectors_equal_brute_force(spark, scratch, monkeypatch, leaf):
    monkeypatch.setattr(embedding_dedup, "LEAF", leaf)
    monkeypatch.setattr(embedding_dedup, "SALT_ROWS", leaf)
    df = table(spark, vector_rows(), "vec_id bigint, embedding array<float>, label int")
    rows = [tuple(r) for r in df.collect()]
    assert brute.in_order(embedding_dedup.near_vectors(clashing(df), scratch).collect()) == brute.vectors(rows)
    assert embedding_dedup.near_vectors(df.limit(0), scratch).collect() == []


def test_covering_bounds_prune(monkeypatch):
    rng = np.random.default_rng(2)
    centres = np.eye(16)[:8]
    points = np.concatenate([c + 0.01 * rng.normal(size=(50, 16)) for c in centres])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    compared = []
    embedding_dedup.traverse(points, points, True, 0.93, lambda a, b, linked, twin: compared.append(linked.size))
    assert sum(compared) <= 8 * 50 * 50  # no pair of clusters is looked at


def test_repeated_rows_cost_no_more_than_one(spark, scratch):
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(1, text)] * 200 + [(2, text + " more"), (3, "x " + text)]
    got = substring.remove_repeats(table(spark, rows), scratch)
    assert brute.in_order(got.select("id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect()) == brute.substring(rows)
    listed = substring._with_spans(
        table(spark, rows, "_id bigint, _text string").withColumn("_mark", F.lit(1)),
        table(spark, [(1, 1, 5, 2)] * 200, "_id bigint, _mark int, pos int, n int"), "inner")
    assert {len(r.spans) for r in listed.collect()} == {1}
    near = Scratch(spark, "near")
    found = near_dedup.near_duplicates(table(spark, rows), near)
    assert brute.in_order(r[0:1] + r[2:] for r in found.collect()) == brute.near(rows)
