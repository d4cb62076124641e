"""Order of rows in which neighbours are close in several columns at once.

Sorted by one column, a file can skip row groups and pages for filters on that column only.
Sorted by the interleaved bits of several, it skips for each of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

from shopstrata.functions.columns import named

BITS = 16  # of each column
EDGES = (0.005, 0.995)  # quantiles that the codes run between; what lies outside is clamped


def _number(column: Column, kind: DataType) -> Column:
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, NumericType):
        return column.cast("double")
    raise TypeError(f"rows can be laid out by dates, times and numbers, not by {kind.simpleString()}")


def spread(code: Column, ways: int) -> Column:
    """Bit i of a code moved to place i * ways."""
    parts = [F.shiftleft(F.shiftright(code, i).bitwiseAND(F.lit(1)), i * ways) for i in range(BITS)]
    return reduce(lambda one, two: one.bitwiseOR(two), parts)


def interleaved(codes: Sequence[Column]) -> Column:
    """One number from the bits of several codes of ``BITS`` bits, highest bits first."""
    if not 1 <= len(codes) <= 63 // BITS:
        raise ValueError(f"one to {63 // BITS} columns can be interleaved")
    moved = [F.shiftleft(spread(code.cast("long"), len(codes)), len(codes) - 1 - n) for n, code in enumerate(codes)]
    return reduce(lambda one, two: one.bitwiseOR(two), moved)


def z_order(sample: Sequence[DataFrame], columns: Sequence[str]) -> Column:
    """The layout key of rows; its scale comes from quantiles of the columns in ``sample``.

    Quantiles are approximate aggregates over these columns alone, a few numbers for the
    driver. Nulls come first.
    """
    kinds = {f.name: f.dataType for f in sample[0].schema}
    both = reduce(DataFrame.unionByName, [df.select(*map(named, columns)) for df in sample])
    found = both.agg(*[
        F.percentile_approx(_number(named(c), kinds[c]), list(EDGES), 1000).alias(f"q{n}") for n, c in enumerate(columns)
    ]).first()
    codes = []
    for n, column in enumerate(columns):
        low, high = found[n] or (0.0, 1.0)
        share = (_number(named(column), kinds[column]) - F.lit(low)) / F.lit((high - low) or 1.0)
        code = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * F.lit(float((1 << BITS) - 1))
        codes.append(F.coalesce(code, F.lit(0.0)).cast("long"))
    return interleaved(codes)
