"""From raw documents to token ids: filter, deduplicate, mix, encode.

Every stage takes what its predecessor kept, reread from Parquet, and its decisions take
effect; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from shopstrata.llm.scratch import Scratch, documents, unused


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the model is learned from ``labels``."""
    model = toxicity.learned_model(spark, docs, sf_dir, Scratch(spark, "pipeline-toxicity"))
    (made,) = unused(docs, "_toxicity")
    return toxicity.score(docs, model, made=made).where(F.col(made) < toxicity.THRESHOLD).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text."""
    return exact_dedup.drop_copies(docs, Scratch(spark, "pipeline-exact"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity 0.8."""
    return near_dedup.drop_near_duplicates(docs, Scratch(spark, "pipeline-near"), percent=80, width=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.mixed(docs, Scratch(spark, "pipeline-mix"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, a row for each document of the mix."""
    return bpe.digest(docs, public_tokenizers.path(bpe.VOCABULARY))


STAGES = [
    ("toxicity", reject_toxic), ("exact dedup", exact), ("near dedup", near), ("mix", mix), ("tokens", tokens),
]

#: No SQL: training, clustering and encoding can't be expressed; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
