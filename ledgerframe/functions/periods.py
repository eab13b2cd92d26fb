"""Month-grain calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _col


def month_start(c: Column | str) -> Column:
    """First day of the month, as DATE (also for TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.trunc(_col(c).cast("date"), "month")


def add_months(day: date, n: int) -> date:
    """Shift a month start on the driver; only for literals such as a cutoff."""
    index = day.year * 12 + day.month - 1 + n
    return date(index // 12, index % 12 + 1, 1)


def fiscal_year(c: Column | str) -> Column:
    return F.year(_col(c))


def fiscal_quarter(c: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_col(c)).cast("string"))


def quarter_key(c: Column | str) -> Column:
    """``2024-Q3``."""
    return F.concat(F.year(_col(c)).cast("string"), F.lit("-"), fiscal_quarter(c))


def month_label(c: Column | str) -> Column:
    """``Mar-2024``."""
    return F.date_format(_col(c), "MMM-yyyy")


def month_index(c: Column | str) -> Column:
    """Months since year 0; consecutive months differ by one, so frames can use it."""
    return F.year(_col(c)) * 12 + F.month(_col(c))


def quarter_index(c: Column | str) -> Column:
    return F.year(_col(c)) * 4 + F.quarter(_col(c))


def is_actual(c: Column | str, as_of: date) -> Column:
    return _col(c) <= F.lit(as_of)
