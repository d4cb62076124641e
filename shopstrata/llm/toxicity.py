"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct buckets of its words, their stems (the first five bytes),
word pairs and pairs with one word left out, lower-cased, words being runs of letters and digits. Per-coordinate rates and an L1
term leave few weights other than zero, so the model is a small table that is broadcast.

The fit takes at most ``SAMPLE`` labelled rows, chosen by a hash of their id (a documented
bound; the labels are all that is sampled). Every text is scored in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.scratch import Scratch, documents, gives_back, short_batches
from shopstrata.llm.words import NO_LETTERS, hash_windows, hash_words, mix, text_slices, words_of

SAMPLE = 20_000  # most labelled rows in a fit
BITS = 20  # buckets: 2 ** BITS
STEM = 5
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 1.0
THRESHOLD = 0.3
FOLDS, HELD = 4, 2


def remainder(doc_id, folds: int):
    """crc32 of the id's text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def buckets(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every feature occurrence, in no useful order."""
    words = words_of(texts, lower=True, separators=NO_LETTERS)
    hashes, owner = hash_words(words), words.owner()
    found, owners = [hashes], [owner]
    long = words.ends - words.starts > STEM
    stems = words._replace(starts=words.starts[long], ends=words.starts[long] + STEM)
    found.append(~hash_words(stems))
    owners.append(owner[long])
    pairs = hash_windows(hashes, 2)
    inner = owner[1:] == owner[:-1]
    found.append(pairs[inner[:len(pairs)]])
    owners.append(owner[:-1][inner])
    if len(hashes) > 2:
        skips = mix(hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[2:])
        inner = owner[2:] == owner[:-2]
        found.append(skips[inner])
        owners.append(owner[:-2][inner])
    return np.concatenate(owners), (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def distinct(owner: np.ndarray, bucket: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(owner << bits | bucket)
    return both >> bits, both & ((1 << bits) - 1)


def train(examples: list[tuple[int, np.ndarray]], bits: int = BITS) -> tuple[float, np.ndarray]:
    """Bias and weights after ``EPOCHS`` passes over (label, distinct buckets)."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    l1 = np.full(len(z), L1)
    l1[-1] = 0.0

    def weights(at):
        near = np.abs(z[at]) <= l1[at]
        w = -(z[at] - np.sign(z[at]) * l1[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(near, 0.0, w)

    for _ in range(EPOCHS):
        for label, at in examples:
            at = np.append(at, len(z) - 1)
            w = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            was = n[at]
            n[at] = was + gradient * gradient
            z[at] += gradient - (np.sqrt(n[at]) - np.sqrt(was)) / ALPHA * w
    w = weights(np.arange(len(z)))
    return float(w[-1]), w[:-1]


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> tuple[float, list[tuple[int, float]]]:
    """Bias and the weights other than zero, (bucket, weight).

    ``labels`` has (id, toxic) rows to learn from; rows with a null label, or without a text, are left out.
    The sample's features are made in parallel; the online pass over them is one task by
    nature and sees ``sample`` rows at most: an id that several rows have counts once, with
    the smallest of their texts. Without rows every score is 0.
    """
    short_batches(docs.sparkSession)
    usable = labels.where(F.col("toxic").isNotNull() & F.col("id").isNotNull()).withColumn("_order", F.xxhash64("id"))
    # about twice the sample by hash, of which those that come first are taken
    drawn = usable.where(F.pmod("_order", F.lit(max(usable.count(), 1))) < 2 * sample)
    chosen = (
        drawn.groupBy("id", "_order").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy("_order", "id").limit(sample)
    )
    given = scratch.table(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).where("_text IS NOT NULL")
        .join(F.broadcast(chosen), "id").groupBy("id", "_order", "toxic").agg(F.min("_text").alias("_text"))
        .select("_order", "toxic", "_text"), "labelled")

    def features(batches):
        for batch in batches:
            texts = batch.column("_text")
            for low, high in text_slices(texts):
                owner, bucket = distinct(*buckets(texts.slice(low, high - low)))
                cuts = np.searchsorted(owner, np.arange(high - low + 1))
                made = [bucket[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                rest = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [rest.column("_order"), rest.column("toxic"), pa.array(made, pa.binary())],
                    ["_order", "toxic", "found"])

    def learn(batches):
        examples = [
            (label, np.frombuffer(found, "<i4"))
            for batch in batches
            for label, found in zip(batch.column("toxic").to_pylist(), batch.column("found").to_pylist())
        ]
        if examples:
            bias, w = train(examples)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))], ["bucket", "weight"])

    made = scratch.table(given.mapInArrow(gives_back(features), "_order bigint, toxic int, found binary"), "features")
    ordered = made.coalesce(1).sortWithinPartitions("_order", "toxic", "found")
    rows = [(r.bucket, r.weight) for r in ordered.mapInArrow(gives_back(learn), "bucket bigint, weight double").collect()]
    bias = next((w for b, w in rows if b < 0), 0.0)
    scratch.drop("labelled", "features")
    return (bias, [r for r in rows if r[0] >= 0]) if rows else (float("-inf"), [])


def score(docs: DataFrame, model: tuple[float, list[tuple[int, float]]], text_col: str = "text",
          made: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with a score from 0 to 1 in ``made``.

    Null and empty texts get that of the bias alone. Repeated rows stay.
    """
    short_batches(docs.sparkSession)
    bias, sparse = model
    weights = np.zeros(1 << BITS, np.float32)
    for at, weight in sparse:
        weights[at] = weight
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 4 MB at any size of the input
    keep = docs.columns if keep is None else keep

    def work(batches):
        w = shared.value
        for batch in batches:
            texts = batch.column(text_col)
            for low, high in text_slices(texts):
                owner, bucket = buckets(texts.slice(low, high - low))
                heavy = w[bucket] != 0
                owner, bucket = distinct(owner[heavy], bucket[heavy])
                sums = bias + np.bincount(owner, w[bucket].astype(float), high - low)
                part = batch.slice(low, high - low)
                with np.errstate(over="ignore"):
                    out = pa.array(1.0 / (1.0 + np.exp(-sums)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], out], [*keep, made])

    schema = docs.select(*keep, F.lit(0.0).alias(made)).schema
    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(gives_back(work), schema)


def learned_model(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch):
    """The model learned from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = labels.where(remainder(F.col("doc_id"), FOLDS) != HELD).select(F.col("doc_id").alias("id"), "toxic")
    return fit(docs, learned, scratch)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = learned_model(spark, docs, sf_dir, Scratch(spark, "toxicity"))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
