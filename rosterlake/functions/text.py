"""Column expressions over text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip(text: Column) -> Column:
    """Trim blanks, no-break spaces included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def prefix_code(code: Column, prefix: str) -> Column:
    """Put ``prefix`` before a code that does not contain it yet."""
    return F.when(F.contains(code, F.lit(prefix)), code).otherwise(F.concat(F.lit(prefix), code))


def first_integer(text: Column) -> Column:
    """First run of digits as a number; 0 when there is none."""
    return F.coalesce(F.regexp_extract(text, r"\d+", 0).try_cast("bigint"), F.lit(0).cast("bigint"))


# A decimal number as a report shows it, with or without an exponent.
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Beyond this a double no longer tells neighbouring whole numbers apart.
EXACT = 2**53


def coerce_numeric(text: Column, dtype: str = "double") -> Column:
    """Numeric value of a text, null when it is not a decimal number."""
    plain = F.trim(text)
    return F.when(plain.rlike(NUMBER), plain.try_cast(dtype))


def coerce_integer(text: Column) -> Column:
    """Whole number of a text: digits exactly, other numbers cut towards zero.

    Null when it is not a number, does not fit 64 bits, or is a fraction too large to be exact.
    """
    plain, number = F.trim(text), coerce_numeric(text)
    digits = plain.rlike(r"^[+-]?[0-9]+$")
    return F.when(digits, plain.try_cast("bigint")).otherwise(F.when(F.abs(number) < EXACT, number.try_cast("bigint")))
