"""Safe readings of raw text. An unreadable value becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_SPACE = " \t\n\r\f\v"
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
INTEGER_SHAPE = r"^[+-]?[0-9]+$"
NUMBER_SHAPE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Nearly all numbers look like this; they need no second look.
PLAIN_NUMBER = r"^[0-9]{1,9}(\.[0-9]{0,9})?$"
# A number from here on is no amount; sums of smaller ones fit their decimals.
TOO_LARGE = 1e15


def safe_integer(text: Column, type_name: str = "bigint") -> Column:
    """Whole number written with digits only; padded text is not a number."""
    return F.when(text.rlike(INTEGER_SHAPE), text.try_cast(type_name))


def safe_double(text: Column) -> Column:
    """Finite number written in digits, or NULL: the cast alone also reads NaN, infinities and
    the suffixes of number literals (5d). Numbers from ``TOO_LARGE`` on are unreadable too."""
    shown = F.btrim(text, F.lit(WHITE_SPACE))
    value = F.when(shown.rlike(NUMBER_SHAPE), shown.try_cast("double"))
    value = F.when(F.abs(value) < TOO_LARGE, value)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).otherwise(value)


def safe_timestamp(text: Column, formats: Sequence[str] = ()) -> Column:
    """Zone-free timestamp from ``yyyy-MM-dd HH:mm:ss``, then from any further format.

    The main form is independent of the session time zone. Further formats go through a
    zoned timestamp, so sessions that use them should run in UTC.
    """
    main = F.when(text.rlike(TIMESTAMP_SHAPE), text.try_cast("timestamp_ntz"))
    others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(main, *others) if others else main


def spelling_key(text: Column) -> Column:
    """Form under which spellings are compared: trimmed of all white space, lower case."""
    return F.lower(F.btrim(text, F.lit(WHITE_SPACE)))


def is_return(invoice: Column) -> Column:
    """Return invoices carry the prefix C."""
    return invoice.startswith("C")
