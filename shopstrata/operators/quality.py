"""Reports that check a table: distinct values, duplicates, missing keys, value ranges."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.functions.columns import named
from shopstrata.operators.latest import any_null


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*map(named, columns)).distinct()


def distinct_within(df: DataFrame, group: str, column: str, groups: Iterable[str]) -> DataFrame:
    """The distinct values of ``column`` in each listed group, all in one scan."""
    return distinct_values(df.filter(named(group).isin(list(groups))), group, column)


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Keys (or, by default, whole rows) that occur more than once, with their count."""
    return df.groupBy(*map(named, keys or df.columns)).count().filter(F.col("count") > 1)


def null_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(any_null(keys))


def value_ranges(df: DataFrame, *columns: str) -> DataFrame:
    """Row count with the least and greatest value of each column."""
    spans = [
        measure(named(c)).alias(f"{label}_{c}")
        for c in columns
        for label, measure in (("min", F.min), ("max", F.max))
    ]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *spans)


def top_rows(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps ``n`` rows of its own."""
    return df.orderBy(*order).limit(n)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Return ``df`` unchanged, or raise naming some keys that are missing or repeated."""
    if null_key_report(df, keys).take(1):
        raise ValueError(f"{what}: rows without {', '.join(keys)}")
    repeated = duplicate_report(df, keys).take(5)
    if repeated:
        raise ValueError(f"{what}: repeated {', '.join(keys)}: {[tuple(r)[:-1] for r in repeated]}")
    return df
