"""Calendar expressions (X1-X13) as built-in Column expressions.

Every function returns a JVM-side expression, so the plan stays inside
whole-stage code generation.  Integer date parts are widened to ``bigint``
because the reference engine returns 64-bit integers for them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's parse formats, written in
# Spark's pattern language: trips use month/day/year hour:minute without
# zero padding, the holiday seed day/month/year, the restriction calendar
# "Mar, 2020".
TRIP_TIME_FORMAT = "M/d/yyyy H:mm"
HOLIDAY_DATE_FORMAT = "dd/MM/yyyy"
MONTH_YEAR_FORMAT = "MMM, yyyy"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_trip_time(c: Column | str) -> Column:
    """``'1/2/2024 3:04'`` -> timestamp without zone."""
    return F.to_timestamp_ntz(_c(c), F.lit(TRIP_TIME_FORMAT))


def parse_month_year(c: Column | str) -> Column:
    """``'Mar, 2020'`` -> first day of that month."""
    return F.to_date(_c(c), MONTH_YEAR_FORMAT)


def parse_day_month_year(c: Column | str) -> Column:
    """``'25/12/2022'`` -> date."""
    return F.to_date(_c(c), HOLIDAY_DATE_FORMAT)


def to_day(c: Column | str) -> Column:
    """Timestamp -> calendar day."""
    return F.to_date(_c(c))


def day_of_week(d: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday (the reference engine's numbering)."""
    return (F.dayofweek(_c(d)) - 1).cast("bigint")


def day_name(d: Column | str) -> Column:
    """Full English day name."""
    return F.date_format(_c(d), "EEEE")


def month_name(d: Column | str) -> Column:
    """Full English month name."""
    return F.date_format(_c(d), "MMMM")


def year(d: Column | str) -> Column:
    return F.year(_c(d)).cast("bigint")


def month(d: Column | str) -> Column:
    return F.month(_c(d)).cast("bigint")


def day_of_month(d: Column | str) -> Column:
    return F.dayofmonth(_c(d)).cast("bigint")


def iso_week(d: Column | str) -> Column:
    """X11: ISO-8601 week number."""
    return F.weekofyear(_c(d)).cast("bigint")


def quarter(d: Column | str) -> Column:
    return F.quarter(_c(d)).cast("bigint")


def period_start(d: Column | str, unit: str) -> Column:
    """Start of the week (Monday) or month as a zone-less timestamp."""
    spark_unit = {"week": "week", "month": "MM"}[unit]
    return F.trunc(_c(d), spark_unit).cast("timestamp_ntz")


def is_weekend(d: Column | str, rule: str = "reference") -> Column:
    """Weekend flag.

    ``reference`` reproduces the computed behaviour of the reference: with
    days numbered 0-6 from Sunday, the test ``in (6, 7)`` is true on
    Saturday only.  ``sat_sun`` gives the documented intent.
    """
    dow = day_of_week(d)
    if rule == "reference":
        return F.coalesce(dow.isin(6, 7), F.lit(False))
    if rule == "sat_sun":
        return F.coalesce(dow.isin(0, 6), F.lit(False))
    raise ValueError(f"unknown weekend rule {rule!r}")


def calendar_columns(d: Column | str, weekend: str = "reference") -> dict[str, Column]:
    """Non-leaky day attributes of the daily grain, in reference order."""
    return {
        "day_of_week": day_of_week(d),
        "day_name": day_name(d),
        "is_weekend": is_weekend(d, weekend),
        "month_num": month(d),
        "year": year(d),
        "day_of_month": day_of_month(d),
        "week_of_year": iso_week(d),
    }
