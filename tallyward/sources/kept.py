"""Daily partial sums that are kept, so that overlapping periods need not be added up again."""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence
from datetime import date, datetime, time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.money import Measure
from tallyward.operators.partials import Partials
from tallyward.period import Period
from tallyward.sources.versions import Versions

_MONTH = "_month"


def whole_days(period: Period, default_ends: str = "[]") -> tuple[date, date]:
    """First and last day of a period that cuts no day; any other period is an error."""
    left, right = period.ends or default_ends
    at_last = period.end.time().replace(microsecond=0) == time(23, 59, 59)
    if period.start.time() != time() or left != "[" or not (at_last if right == "]" else period.end.time() == time()):
        raise ValueError(f"kept days answer for whole days only, not for {period.label(default_ends)}")
    last = period.end.date() if at_last else date.fromordinal(period.end.toordinal() - 1)
    return period.start.date(), last


class KeptSums:
    """Sums per day and group, stored by month.

    ``keys`` are the groups, ``day`` the date column. A batch brings all rows of the days it
    touches and replaces these days: late rows count once, and a batch that is run again
    changes nothing. Only the months of these days are rewritten, and all are shown at once.
    """

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], columns: Sequence[str], day: str = "pay_day"):
        self.spark = spark
        self.keys = list(keys)
        self.columns = list(columns)
        self.day = day
        self.versions = Versions(spark, base)

    def replace_days(self, rows: DataFrame, days: Collection[date] | None = None) -> int:
        """Put these rows in the place of what is kept of the days; returns the number of months rewritten.

        Without ``days`` the rows replace everything. Rows of other days and of none are left out.
        """
        listed = None if days is None else sorted(set(days))
        if listed == []:
            return 0
        dated = rows.filter(F.col(self.day).isNotNull() if listed is None else F.col(self.day).isin(listed))
        fresh = Partials.of(dated, [*self.keys, self.day], self.columns)
        frame = fresh.frame.withColumn(_MONTH, F.date_format(self.day, "yyyy-MM"))
        months = None if listed is None else sorted({f"{d:%Y-%m}" for d in listed})
        path = self.versions.new_folder("days")
        measures = [[m.column, m.scale] for m in fresh.wanted]

        def change(version: dict) -> dict:
            if version and (version["keys"] != [*self.keys, self.day] or version["measures"] != measures):
                raise ValueError(f"{self.versions.base} keeps other groups or sums")
            named = {} if months is None else version.get("months", {})
            # written here, as another writer may have replaced other days of these months meanwhile
            old = [self._of(folder, held, frame.schema).filter(~F.col(self.day).isin(listed)) for folder, held in _by_folder(named, months or [])]
            merged = reduce(DataFrame.unionByName, old, frame)
            merged.repartition(_MONTH).write.mode("overwrite").partitionBy(_MONTH).parquet(path)
            found = {r[0] for r in self._of(path, None, frame.schema).select(_MONTH).distinct().collect()}
            kept = {m: p for m, p in named.items() if m not in (months or [])}
            shown = kept | {m: path for m in found}
            return {"keys": [*self.keys, self.day], "measures": measures, "schema": frame.schema.json(), "months": shown}

        return len([p for p in self.versions.commit(change)["months"].values() if p == path])

    def _of(self, folder: str, months: Sequence[str] | None, schema: T.StructType) -> DataFrame:
        # with its schema given, a folder without rows can be read, and months are texts
        read = self.spark.read.schema(schema).parquet(folder)
        return read if months is None else read.filter(F.col(_MONTH).isin(list(months)))

    def read(self, period: Period, default_ends: str = "[]") -> Partials:
        """The kept sums of the period's days; only its months' files are read."""
        first, last = whole_days(period, default_ends)
        version = self.versions.current()
        if not version:
            raise ValueError(f"nothing is kept under {self.versions.base}")
        months = [m for m in version["months"] if f"{first:%Y-%m}" <= m <= f"{last:%Y-%m}"]
        schema = T.StructType.fromJson(json.loads(version["schema"]))
        frames = [self._of(folder, held, schema) for folder, held in _by_folder(version["months"], months)]
        frames = frames or [self.spark.createDataFrame([], schema)]
        frame = reduce(DataFrame.unionByName, frames).filter(F.col(self.day).between(first, last)).drop(_MONTH)
        return Partials(frame, tuple(Measure(column, scale) for column, scale in version["measures"]))


def _by_folder(named: dict[str, str], months: Collection[str]) -> list[tuple[str, list[str]]]:
    held: dict[str, list[str]] = {}
    for month in sorted(months):
        if month in named:
            held.setdefault(named[month], []).append(month)
    return sorted(held.items())


def days_of(rows: DataFrame, day: str) -> list[date]:
    """The days that occur: as many values as there are days."""
    found = rows.select(day).filter(F.col(day).isNotNull()).distinct().collect()
    return sorted(r[0].date() if isinstance(r[0], datetime) else r[0] for r in found)
