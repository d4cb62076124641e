"""Column expressions shared by the silver and gold plans.

All are built from Spark's own functions. Spark 4 casts raise on bad text, so
every text-to-number step uses ``try_cast`` and yields null instead.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def letters_and_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-zA-Z0-9]", "")


def tidy_lower(text: Column) -> Column:
    return F.lower(F.trim(text))


def tidy_upper(text: Column) -> Column:
    return F.upper(F.trim(text))


def before_dot(text: Column) -> Column:
    """``987.0`` gives ``987``; text without a dot is unchanged."""
    return F.split(text, "\\.").getItem(0)


def whole_number(text: Column) -> Column:
    return text.try_cast("int")


def spelled_quantity(text: Column) -> Column:
    """A count, where the feed writes the number two as the word ``Two``."""
    return F.when(text == "Two", F.lit(2)).otherwise(whole_number(text))


def without(text: Column, mark: str) -> Column:
    """Plain replacement: several times faster than a pattern or ``translate``."""
    return F.replace(text, F.lit(mark), F.lit(""))


def dollar_amount(text: Column) -> Column:
    return without(text, "$").try_cast("double")


def percentage(text: Column) -> Column:
    return without(text, "%").try_cast("double")


def without_unit(text: Column) -> Column:
    """``250g`` and ``250`` both give 250; a bare unit gives null."""
    return whole_number(F.regexp_replace(text, "[^0-9]+$", ""))


def decimal_comma(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("float")


def recoded(value: Column, names: dict[str, str]) -> Column:
    """Replace listed values exactly (case and blanks count); keep the rest."""
    branches = iter(names.items())
    old, new = next(branches)
    chain = F.when(value == old, F.lit(new))
    for old, new in branches:
        chain = chain.when(value == old, F.lit(new))
    return chain.otherwise(value)


def yes_no(condition: Column) -> Column:
    """1 or 0; a null condition counts as no."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def date_key(day: Column) -> Column:
    """20240131 as an int; built from the parts because formatting text per row is slower."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def year_label(prefix: str, part: Column, year: Column) -> Column:
    """``Q1-2024``; a missing part makes the whole label the empty string, not null."""
    return F.concat_ws("", F.concat(F.lit(prefix), part, F.lit("-"), year))


def exact_total(amount: Column) -> Column:
    """Sum of a double column, rounded once, that does not depend on row order or partitioning.

    An amount is cut, without rounding, into whole numbers of 2**43, 1, 2**-20, 2**-40 and
    2**-60. Sums of these fit long integers, which the engine adds in registers, for more rows
    than there are; put together as one decimal they make the exact total. NaN, infinite and
    astronomical amounts (from 2**103 on) and what lies below 2**-60 are added as doubles. Totals beyond
    38 digits are put together as doubles.
    """
    finite = F.abs(amount) < F.lit(2.0**103)
    large = (amount * F.lit(2.0**-43)).try_cast("bigint")
    rest = amount - large * F.lit(2.0**43)
    units = rest.try_cast("bigint")
    parts, rest = [], rest - units
    for _ in range(3):
        scaled = rest * F.lit(2.0**20)
        part = scaled.try_cast("bigint")
        parts.append(part)
        rest = scaled - part
    sums = [F.try_sum(F.when(finite, x)) for x in (large, units)] + [F.sum(F.when(finite, x)) for x in parts]
    scales = [103, 60, 40, 20, 0]
    whole = F.lit(Decimal(0)).cast("decimal(38,0)")
    for total, scale in zip(sums, scales):
        part = F.try_multiply(total.cast("decimal(38,0)"), F.lit(Decimal(1 << scale)).cast("decimal(38,0)"))
        whole = F.try_add(whole, F.when(total == 0, F.lit(Decimal(0)).cast("decimal(38,0)")).otherwise(part))
    in_digits = whole.cast("double") * F.lit(2.0**-60)
    in_doubles = sum((total * F.lit(2.0**(scale - 60)) for total, scale in zip(reversed(sums), reversed(scales))), F.lit(0.0))
    plain = F.sum(F.when(finite, F.lit(None).cast("double")).otherwise(amount))
    small = F.sum(F.when(finite, rest)) * F.lit(2.0**-60)
    exact = F.coalesce(in_digits, in_doubles, F.sum(F.when(finite, amount))) + F.coalesce(small, F.lit(0.0))
    return F.when(plain.isNull(), exact).otherwise(plain + F.coalesce(exact, F.lit(0.0)))
