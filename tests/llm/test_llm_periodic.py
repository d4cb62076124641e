"""Runs on the grammar against a plain search of every period."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from shopstrata.llm import periodic  # noqa: E402


def patched(rnd):
    words = []
    for _ in range(rnd.randint(0, 6)):
        unit = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 25))]
        if rnd.random() < 0.3:
            unit = unit * rnd.randint(1, 4) + unit[:rnd.randint(0, len(unit))] + [rnd.randint(0, 9)]
        words += unit * rnd.randint(1, 8) + unit[:rnd.randint(0, len(unit))]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_a_batch_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = [patched(rnd) for _ in range(rnd.randint(1, 6))]
    docs = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    found = periodic.find_runs(np.array([w for t in texts for w in t], np.int64), docs)
    got = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in found)):
        got[text].append(tuple(run))
    assert got == [brute.periodic(t) for t in texts]


def test_levels_derive_every_word_once():
    numbers = np.array([1, 2, 3] * 40 + list(range(50)), np.int64)
    texts = np.repeat([0, 1], [100, 70])
    top = {}
    for level in periodic.grammar(numbers, texts, 1):
        for symbol, a, m, b in zip(*(x.tolist() for x in level)):
            assert a < m < b
            assert top.setdefault(symbol, numbers[a:b].tolist()) == numbers[a:b].tolist()
    assert {numbers[:100].tolist() == v or numbers[100:].tolist() == v for v in top.values() if len(v) in (70, 100)} == {True}
    assert {len(v) for v in top.values()} >= {70, 100}


def odd_rows():
    rnd = random.Random(5)
    prose = [rnd.choice(["sun", "moon", "tide", "é", "漢字"]) for _ in range(200)]
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "x"), (5, "la " * 24), (6, "la " * 23), (7, " ".join(prose)),
        (None, "a b " * 30), (7, "\tone two three  \n" * 40 + "end"), (8, "w " * 20_000), (9, "a b c " * 9 + "a b"),
        (9, "a b c " * 9 + "a b"), (10, "p q " * 14 + "r " + "p q " * 14), (21, " ".join(prose)), (30, "k " * 70),
    ]


def test_odd_rows_and_clashing_names(spark):
    df = spark.createDataFrame(odd_rows(), "doc_id bigint, text string").withColumns(
        {c: F.lit("x") for c in ("id", "runs", "kept", "n_words", "best")})
    got = [(r.id, r.n_words, tuple(tuple(x) for x in r.runs), r.kept) for r in periodic.collapse_runs(df).collect()]
    want = []
    for i, text in odd_rows():
        w = brute.WORD.findall(text or "")
        found = brute.periodic(w)
        gone = {p for s, n, q in found for p in range(s + q, s + n)}
        want.append((i, len(w), tuple(found), " ".join(x for p, x in enumerate(w) if p not in gone)))
    assert brute.in_order(got) == brute.in_order(want)


def test_empty_table(spark):
    assert periodic.collapse_runs(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_strongest_is_exact(spark):
    df = spark.sql("""select array(named_struct('start', 5L, 'length', 30L, 'period', 10L), named_struct('start', 9L,
        'length', 3000001L, 'period', 1000000L), named_struct('start', 10L, 'length', 3000001L, 'period', 1000000L)) as r""")
    assert df.select(periodic.strongest(F.col("r"))).first()[0] == (9, 3000001, 1000000)
    assert spark.sql("select array() as r").select(F.size("r")).first()[0] == 0
