"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(d: Column) -> Column:
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def iso_year(d: Column) -> Column:
    """Year of the ISO week, which differs from the calendar year around New Year."""
    return F.extract(F.lit("YEAROFWEEK"), d)


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def iso_weekday(d: Column) -> Column:
    """Monday 1 ... Sunday 7."""
    return F.weekday(d) + 1


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def is_weekend(d: Column) -> Column:
    return iso_weekday(d) > 5


def calendar_columns(d: Column) -> list[Column]:
    """Columns of the calendar dimension; `year` is the ISO year, the others calendar values."""
    return [
        date_id(d).alias("date_id"),
        d.alias("full_date"),
        iso_year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.day(d).alias("day"),
        iso_weekday(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        iso_week(d).alias("week_of_year_iso"),
        is_weekend(d).alias("is_weekend"),
    ]
