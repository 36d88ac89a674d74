"""Whole-frame operators: nulls, missing columns, unions, previews, bad rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.calendar import strict_date


def fill_nulls(df: DataFrame, text: str | None = None) -> DataFrame:
    """0 for every null number; null text stays unless a filler (such as ``"0"``) is given."""
    filled = df.fillna(0)
    return filled if text is None else filled.fillna(text)


def add_missing(df: DataFrame, names: Sequence[str], value: object = 0) -> DataFrame:
    """Add the named columns the frame lacks."""
    return df.withColumns({n: F.lit(value) for n in names if n not in df.columns})


def union_all(frames: Sequence[DataFrame], missing: bool = False) -> DataFrame:
    """Stack frames by column name; with ``missing`` absent columns become null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=missing)
    return first


def over_columns(df: DataFrame, names: Sequence[str], change) -> DataFrame:
    """Apply one column expression to each of the named columns."""
    return df.withColumns({n: change(F.col(n)) for n in names})


def first_row_as_pairs(df: DataFrame, order: Sequence[str | Column], columns: Sequence[str] | None = None) -> DataFrame:
    """The first row, turned into (field, value) pairs of text."""
    names = list(columns or df.columns)
    row = df.orderBy(*order).limit(1).select(*[F.col(c).cast("string").alias(c) for c in names])
    return row.unpivot([], names, "field", "value")


def with_date(df: DataFrame, column: str, parsed: str = "date") -> DataFrame:
    """The date of a text, null for a text that is not a ``YYYY-MM-DD`` date; one pass where both kinds stay together."""
    return df.withColumn(parsed, strict_date(F.col(column)))


def split_by_date(df: DataFrame, column: str, parsed: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows whose text is a ``YYYY-MM-DD`` date (with the date added), and all other rows."""
    checked = with_date(df, column, parsed)
    good = checked.filter(F.col(parsed).isNotNull())
    bad = checked.filter(F.col(parsed).isNull()).drop(parsed)
    return good, bad


def with_display_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename engine columns to display names."""
    return df.withColumnsRenamed(dict(names))
