"""Report periods: typed parameters with explicit open or closed ends."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
_MOMENT = re.compile(r"\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?")
ENDS = ("[]", "()", "(]", "[)")
GRAINS = ("day", "week", "month", "year")


def check_date(text: str) -> date:
    """Accept exactly ``YYYY-MM-DD`` naming a real day; anything else is an error."""
    if not _DATE.fullmatch(text):
        raise ValueError(f"date must look like YYYY-MM-DD, got {text!r}")
    return date.fromisoformat(text)


def moment(value: str | date | datetime) -> datetime:
    """A date stands for its midnight, so a bare end date only reaches 00:00:00."""
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime.combine(value, time())
    if not _MOMENT.fullmatch(value):
        raise ValueError(f"expected YYYY-MM-DD or YYYY-MM-DD HH:MM:SS, got {value!r}")
    return datetime.fromisoformat(value)


@dataclass(frozen=True)
class Period:
    """``ends`` is None where each report is to apply its own usual ends.

    The two texts keep the bounds as the caller wrote them, for labels and stamps.
    """

    start: datetime
    end: datetime
    start_text: str
    end_text: str
    ends: str | None = None

    def __post_init__(self):
        if self.ends is not None and self.ends not in ENDS:
            raise ValueError(f"ends must be one of {ENDS}, got {self.ends!r}")

    @classmethod
    def of(cls, start, end, ends: str | None = None) -> Period:
        return cls(moment(start), moment(end), str(start), str(end), ends)

    def with_ends(self, ends: str) -> Period:
        return replace(self, ends=ends)

    def contains(self, column: str | Column, default_ends: str = "[]") -> Column:
        """Compare as timestamps, so that the bounds reach the Parquet or JDBC scan."""
        c = F.col(column) if isinstance(column, str) else column
        low, high = _bound(self.start), _bound(self.end)
        ends = self.ends or default_ends
        after = c >= low if ends[0] == "[" else c > low
        before = c <= high if ends[1] == "]" else c < high
        return after & before

    def restrict(self, df: DataFrame, column: str, default_ends: str = "[]") -> DataFrame:
        """Keep the period's rows.

        A table partitioned by month under the name ``<column>_month`` (text,
        ``yyyy-MM``) also gets the implied month bounds, which prune its folders.
        """
        kept = df.filter(self.contains(column, default_ends))
        month = f"{column}_month"
        if month in df.columns:
            kept = kept.filter(F.col(month).between(f"{self.start:%Y-%m}", f"{self.end:%Y-%m}"))
        return kept

    def label(self, default_ends: str = "[]", ends: str | None = None) -> str:
        """Interval text such as ``[2021-04-01→2021-05-01]``."""
        left, right = ends or self.ends or default_ends
        return f"{left}{self.start_text}→{self.end_text}{right}"

    def stamp(self, df: DataFrame, start_name="period_start", end_name="period_end") -> DataFrame:
        return df.withColumns({start_name: F.lit(self.start_text), end_name: F.lit(self.end_text)})


def _bound(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def month_bounds(day: date) -> tuple[date, date]:
    first = day.replace(day=1)
    next_first = (first + timedelta(days=31)).replace(day=1)
    return first, next_first - timedelta(days=1)


def week_bounds(day: date, to_day: bool = False) -> tuple[date, date]:
    """Monday and Sunday of the day's week, or Monday and the day itself."""
    monday = day - timedelta(days=day.weekday())
    return monday, day if to_day else monday + timedelta(days=6)


def period_for(grain: str, today: date) -> Period:
    """The running period up to the last second of ``today``.

    ``day`` and ``month`` start with the month, ``week`` with Monday, ``year`` with 1 January.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    if grain == "week":
        first = week_bounds(today)[0]
    elif grain == "year":
        first = today.replace(month=1, day=1)
    else:
        first = today.replace(day=1)
    return Period.of(moment(first), datetime.combine(today, time(23, 59, 59)))


def rolling_week(today: date) -> Period:
    """Six days back up to tomorrow, the span of the weekly activity report."""
    return Period.of(today - timedelta(days=6), today + timedelta(days=1))


def month_of_yesterday(today: date) -> Period:
    """First day of yesterday's month up to today, the span of the monthly order reports."""
    return Period.of((today - timedelta(days=1)).replace(day=1), today)
