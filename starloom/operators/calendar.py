"""Calendar rows from a date range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, month_floor

# Fixed value: the source-system label of rows that no source delivered.
CALENDAR_SOURCE = "DBT"
DAY = "calendar_date"


# A calendar ends here, however wrong a stamp is; a fact outside has a date key without a day, which the checks report.
FIRST_DAY, LAST_DAY = "1900-01-01", "2199-12-31"


def days(bounds: DataFrame, start: str = "start", stop: str = "stop") -> DataFrame:
    """One row per day from ``start`` up to, not including, ``stop``, for a one-row ``bounds``; none before
    ``FIRST_DAY`` or after ``LAST_DAY``. Years come first and their days then, so no list is longer than a year."""
    # greatest and least pass over missing values, so these go first.
    ends = bounds.filter(F.col(start) < F.col(stop)).select(
        F.greatest(F.col(start).cast("date"), F.lit(FIRST_DAY).cast("date")).alias("first"),
        F.least(F.date_sub(F.col(stop), 1), F.lit(LAST_DAY).cast("date")).alias("last"),
    ).filter("first <= last")
    years = ends.select("first", "last", F.explode(F.sequence(F.year("first"), F.year("last"))).alias("year"))
    of_year = "sequence(greatest(first, make_date(year, 1, 1)), least(last, make_date(year, 12, 31)))"
    return years.select(F.explode(F.expr(of_year)).alias(DAY))


def fixed_bounds(spark, start: str, stop: str) -> DataFrame:
    row = spark.range(0, 1, 1, 1)
    return row.select(F.lit(start).cast("date").alias("start"), F.lit(stop).cast("date").alias("stop"))


def whole_years(*dated: tuple[DataFrame, str]) -> DataFrame:
    """Bounds covering every full year touched by the given date columns."""
    spans = [df.agg(F.min(c).cast("date").alias("lo"), F.max(c).cast("date").alias("hi")) for df, c in dated]
    lo_hi = spans[0]
    for span in spans[1:]:
        lo_hi = lo_hi.unionByName(span)
    return lo_hi.agg(
        F.trunc(F.min("lo"), "YEAR").alias("start"),
        F.add_months(F.trunc(F.max("hi"), "YEAR"), 12).alias("stop"),
    )


def calendar_attributes() -> list[Column]:
    """The attributes of a day; week numbers are ISO, day 1 of the week is Sunday."""
    day = F.col(DAY)
    quarter, year = F.quarter(day), F.year(day)
    q_label = F.concat(F.lit("Q"), quarter.cast("string"))
    month_end = F.last_day(day)
    named = {
        "date_key": date_key(day),
        "calendar_date": day,
        "day_of_month": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_week": F.dayofweek(day),
        "week_of_year": F.weekofyear(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter_number": quarter,
        "quarter_name": q_label,
        "year_number": year,
        "year_month": F.date_format(day, "yyyy-MM"),
        "year_quarter": F.concat_ws("-", year.cast("string"), q_label),
        "month_start_date": month_floor(day),
        "month_end_date": month_end,
        "is_month_start": F.dayofmonth(day) == 1,
        "is_month_end": day == month_end,
        "is_weekend": F.weekday(day) >= 5,
        "etl_source_system": F.lit(CALENDAR_SOURCE),
    }
    return [c.alias(n) for n, c in named.items()]
