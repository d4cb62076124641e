"""Near words by search schemes against a comparison of all pairs."""

import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from shopstrata.llm import spelling  # noqa: E402
from shopstrata.llm.scratch import Scratch  # noqa: E402


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "spelling")


def some_words(rnd, alphabet, most=60):
    words = sorted({"".join(rnd.choices(alphabet, k=rnd.randint(5, 9))) for _ in range(rnd.randint(1, most))})
    rnd.shuffle(words)
    return words


@pytest.mark.parametrize("seed", range(40))
def test_both_directions_find_each_pair_once(seed):
    rnd = random.Random(seed)
    words = some_words(rnd, rnd.choice(["ab", "abc", "abcdé÷"]))
    got = []
    for from_end in (False, True):
        rows = {"word": words, "n": range(len(words)), "from_end": [from_end] * len(words)}
        table = pa.table({**{k: list(v) for k, v in rows.items()}, "held": [True] * len(words), "sought": [True] * len(words)})
        got += [(w, o) for w, o, n in zip(*(c.to_pylist() for c in spelling.near_words(table).columns)) if words[n] == o]
    assert sorted(got) == sorted((a, b) for a in words for b in words if brute.one_edit(a, b))


def test_intervals_count_occurrences():
    words = ["banana", "bandana", "anna", "nab"]
    letters, _, lengths = spelling._letters(words, False)
    index = spelling.Index(letters, lengths)
    for part in ("an", "na", "ana", "b", "dan", "x"):
        low, high = np.array([0]), np.array([index.size])
        for c in part:
            low, high = index.append(np.array([ord(c)]), low, high)
        circles = ["$" + w for w in words]
        assert high[0] - low[0] == sum((c + c[:len(part) - 1]).startswith(part, i) for c in circles for i in range(len(c)))


def texts(rnd, rows=60):
    words = some_words(rnd, "abcdé", 80) + ["Hello", "hallo", "hell", "hellos", "ÀB×cd÷", "àb×cd÷", "x" * 3000, "x" * 2999]
    weights = [rnd.choice([1, 1, 3, 10, 40]) for _ in words]
    made = [(i % 50, rnd.choice(" .,1_\n漢").join(rnd.choices(words, weights, k=rnd.randint(0, 60)))) for i in range(rows)]
    return made + [(None, "hello hello hallo"), (7, None), (8, ""), (9, " 123 "), (9, "hello"), (9, "hello")]


@pytest.mark.parametrize("seed, block", [(1, 1 << 15), (2, 5), (3, 2)])
def test_variants_equal_brute_force(spark, scratch, seed, block):
    given = texts(random.Random(seed))
    df = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3).withColumns(
        {c: F.lit("x") for c in ("word", "n", "near", "shared", "parts", "id", "group", "root")})
    got = spelling.variants(df, scratch, block=block, altered=spelling.slips_by_id)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert brute.in_order(got.collect()) == brute.spelling(given, slip=97)
    plain = spelling.variants(df, Scratch(spark, "plain"), least_count=1, block=block)
    assert brute.in_order(plain.collect()) == brute.spelling(given, least_count=1)


def test_letters_shared_by_many_words_are_cut(spark, scratch):
    words = [("aa" + "".join(chr(97 + (i // 26**k) % 26) for k in range(3)) + "zzz", i) for i in range(300)]
    df = spark.createDataFrame(words, "word string, n bigint")
    found = spelling.near_pairs(df, scratch, block=40)
    assert scratch.spark.read.parquet(f"{scratch.folder}/large").agg(F.max("parts")).first()[0] == 8
    got = sorted((r.word, r.near) for r in found.collect())
    assert got == sorted((a, b) for a, _ in words for b, _ in words if brute.one_edit(a, b))


def test_forms_lead_to_one_root(spark, scratch):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(37)]
    got = spelling.roots(spark.createDataFrame(chain, "word string, form string"), scratch)
    assert sorted(map(tuple, got.collect())) == [(w, "w37") for w, _ in chain]


def test_empty_table(spark, scratch):
    assert spelling.variants(spark.createDataFrame([], "doc_id bigint, text string"), scratch).collect() == []
