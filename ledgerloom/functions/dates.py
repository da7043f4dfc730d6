"""Date expressions (all JVM-side Column expressions, no UDFs).

Dates are keyed by ``date_id`` = yyyymmdd as an int.  Year and month are
taken from the key arithmetically so that a ledger never needs a join to the
calendar just to group by period.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """yyyymmdd int of a date (``CAST(FORMAT(d,'yyyyMMdd') AS INT)``)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_to_date(date_id) -> Column:
    k = _c(date_id)
    return F.make_date((k / 10000).cast("int"), (k / 100).cast("int") % 100, k % 100)


def year_of(date_id="date_id") -> Column:
    return (_c(date_id) / 10000).cast("int")


def month_of(date_id="date_id") -> Column:
    return ((_c(date_id) / 100).cast("int") % 100).cast("int")


def quarter_of(date_id="date_id") -> Column:
    return (((month_of(date_id) - 1) / 3).cast("int") + 1).cast("int")


def month_index(date_id="date_id") -> Column:
    """Months since year 0: consecutive months differ by exactly 1."""
    return (year_of(date_id) * 12 + month_of(date_id) - 1).cast("int")


def month_end_key(year: Column, month: Column) -> Column:
    """date_id of the last day of (year, month)."""
    return date_key(F.last_day(F.make_date(year, month, F.lit(1))))


def shift_month_end(date_id, months: int) -> Column:
    """Month-end ``months`` later (negative = earlier): 2024-02-29 -> 2023-02-28."""
    return date_key(F.last_day(F.add_months(key_to_date(date_id), months)))


def quarter_name(d) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_c(d)).cast("string"))


def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def month_name_short(d) -> Column:
    return F.substring(F.date_format(_c(d), "MMMM"), 1, 3)


def is_month_end(d) -> Column:
    d = _c(d)
    return d == F.last_day(d)


def days_in_month(d) -> Column:
    return F.dayofmonth(F.last_day(_c(d))).cast("int")


def days_in_year(d) -> Column:
    y = F.year(_c(d))
    leap = (y % 400 == 0) | ((y % 4 == 0) & (y % 100 != 0))
    return F.when(leap, F.lit(366)).otherwise(F.lit(365)).cast("int")
