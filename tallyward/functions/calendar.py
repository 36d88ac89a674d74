"""Dates as columns. Group by the date value first, format it afterwards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(moment: Column) -> Column:
    return F.to_date(moment)


def day_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def month_start(moment: Column) -> Column:
    return F.trunc(moment, "MM")


def month_end(moment: Column) -> Column:
    return F.last_day(moment)


def month_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def add_days(moment: Column, days: int | Column) -> Column:
    return F.date_add(moment, days)


def week_monday(moment: Column) -> Column:
    return F.date_sub(moment, F.weekday(moment))


def week_sunday(moment: Column) -> Column:
    return F.date_add(moment, F.lit(6) - F.weekday(moment))


def grain_start(moment: Column, grain: str) -> Column:
    """First day of the period a row falls in: month for ``day`` and ``month``, else week or year."""
    unit = {"day": "MM", "month": "MM", "week": "week", "year": "year"}
    return F.trunc(moment, unit[grain])


def month_number_text(moment: Column) -> Column:
    return F.lpad(F.month(moment).cast("string"), 2, "0")


def strict_date(text: Column) -> Column:
    """The date, or null where the text is not ``YYYY-MM-DD`` or names no real day."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_date(text, "yyyy-MM-dd"))


def moment_from_text(text: Column) -> Column:
    """A text of at most ten characters is a date and gets midnight."""
    return F.when(
        F.length(text) <= 10, F.concat(text, F.lit(" 00:00:00"))
    ).otherwise(text).try_cast("timestamp_ntz")


def clock_text(moment: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if moment is None else moment, "HH:mm:ss")
