"""Elapsed time between zone-less timestamps, and calendar parts.

Subtracting zone-less timestamps never passes through the session time zone (``timestampdiff`` does).
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY = 86_400


def elapsed_seconds(start: Column, end: Column) -> Column:
    return (end - start).cast("interval second").cast("bigint")


def elapsed_days(start: Column, end: Column) -> Column:
    """Fractional days."""
    return elapsed_seconds(start, end).cast("double") / F.lit(float(DAY))


def whole_days_elapsed(start: Column, end: Column) -> Column:
    """Elapsed days rounded down, so one hour early is -1."""
    return F.floor(elapsed_days(start, end)).cast("int")


def date_key(d: Column) -> Column:
    return (F.year(d) * 10_000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> dict[str, Column]:
    """The descriptive columns of one calendar day."""
    year, month = F.year(d), F.month(d)
    quarter = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    weekday = F.weekday(d) + 1
    return {
        "date": d,
        "date_key": date_key(d),
        "year": year,
        "quarter": quarter,
        "year_quarter": F.concat_ws("-", year.cast("string"), quarter),
        "month_num": month,
        "month_name": F.date_format(d, "MMMM"),
        "month_short": F.date_format(d, "MMM"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_month_num": year * 100 + month,
        "month_start": F.trunc(d, "month"),
        "iso_week": F.weekofyear(d),
        "day_of_week_num": weekday,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": weekday >= 6,
    }
