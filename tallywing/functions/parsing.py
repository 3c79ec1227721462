"""Tolerant readings of text fields.

A blank or malformed number is NULL, never an error, so that each job can state its own rule for missing values. All
of these accept a column that is already numeric.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_or_null(c: str | Column) -> Column:
    return column(c).try_cast("int")


def long_or_null(c: str | Column) -> Column:
    return column(c).try_cast("bigint")


def double_or_null(c: str | Column) -> Column:
    return column(c).try_cast("double")


def whole_part(c: str | Column) -> Column:
    """``-12.00`` -> -12: what precedes the decimal point, as an int."""
    return F.substring_index(column(c), ".", 1).try_cast("int")


def is_on_time(delay_flag: str | Column) -> Column:
    """True where the "15 minutes late" flag is present and not positive; false where it is set, blank or malformed."""
    return F.coalesce(double_or_null(delay_flag) <= 0, F.lit(False))


def day_of(year: Column, month: Column, day: Column) -> Column:
    """A date from its three text parts, NULL where they make none."""
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def yyyymmdd(day: str | Column) -> Column:
    """A date as the int 20080131."""
    d = column(day)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
