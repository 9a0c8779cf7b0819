"""Rounded sums, shares and ratios used by several reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Line amounts are whole cents; raw amounts and unit prices may have more digits. Both leave
# room for sums of 38 digits.
CENTS = "decimal(28,2)"
FINE = "decimal(28,8)"


def exact_sum(amount: Column | str, kind: str = CENTS) -> Column:
    """Sum of amounts as a decimal: the same in any order of the rows and at any size.

    Sums stay decimals while they are ranked, compared and added up, and become doubles once,
    by ``money``, when a result is given out.
    """
    return F.sum((F.col(amount) if isinstance(amount, str) else amount).cast(kind))


def money(total: Column | str) -> Column:
    """An exact total in whole cents as a double, the nearest one there is."""
    return F.round(total, 2).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` in double; NULL when the whole is zero or NULL."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def ratio(value: Column, by: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(value.cast("double"), by.cast("double")), digits)


POWER_OF_TEN = "^(-?)([0-9])\\.([0-9]+)E(-?)([0-9]+)$"


def plain_text(value: Column, type_name: str) -> Column:
    """Text form of a result cell, with all its digits.

    A double is written by its shortest digits, with two decimals at least and never in powers
    of ten; NaN and infinities keep their names.
    """
    if type_name not in ("double", "float"):
        return value.cast("string")
    text = value.cast("string")
    sign, first, rest, minus, power = (F.regexp_extract(text, POWER_OF_TEN, i) for i in range(1, 6))
    places = F.coalesce(power.try_cast("int"), F.lit(0))
    digits = F.concat(first, F.when(rest == "0", "").otherwise(rest))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), places - 1), digits)
    long = F.rpad(digits, F.greatest(F.length(digits), places + 1), "0")
    large = F.concat(
        sign,
        F.substring(long, F.lit(1), places + 1),
        F.lit("."),
        F.rpad(F.substr(long, places + 2), F.greatest(F.length(long) - places - 1, F.lit(1)), "0"),
    )
    written = F.when(power == "", text).when(minus == "-", small).otherwise(large)
    return F.regexp_replace(written, "\\.([0-9])$", ".$10")
