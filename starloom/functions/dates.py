"""Month and date-key arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_floor(column: Column) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(column.cast("date"), "MM")


def months_before(month: Column, tenure: Column) -> Column:
    """Month in which a tenure counted up to ``month`` began; NULL if either is missing."""
    return F.add_months(month, F.lit(1) - tenure)


def date_key(column: Column) -> Column:
    """YYYYMMDD as an integer, by arithmetic (no text formatting per row)."""
    day = column.cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
