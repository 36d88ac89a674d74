"""Column types of a sheet whose cells are texts.

Each cell is the least of its kinds; a column's kind is the least upper bound of its cells'

    blank < boolean, whole < decimal < double, date < moment, and text above all.

What is needed to find it are counts and greatest lengths per column, which add up over
tasks and over sheets in any order. One pass over the sheet gathers them for all columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.sql import name

_WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
_DECIMAL = r"^[+-]?(0|[1-9][0-9]*)(\\.[0-9]+)?$"
_DOUBLE = r"^[+-]?(0|[1-9][0-9]*)(\\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\\.[0-9]{1,6})?)?)?$"

#: Fact, and its SQL over a cell; ``{c}`` is null where the cell is blank. A count counts the cells that hold, a length is a maximum.
_COUNTS = {
    "cells": "{c} IS NOT NULL",
    "booleans": "lower({c}) IN ('true', 'false')",
    "wholes": f"{{c}} RLIKE '{_WHOLE}' AND try_cast({{c}} AS BIGINT) IS NOT NULL",
    "decimals": f"{{c}} RLIKE '{_DECIMAL}'",
    "doubles": f"{{c}} RLIKE '{_DOUBLE}'",
    "dates": f"{{c}} RLIKE '{_DATE}' AND try_cast({{c}} AS DATE) IS NOT NULL",
    "moments": f"{{c}} RLIKE '{_MOMENT}' AND try_cast({{c}} AS TIMESTAMP_NTZ) IS NOT NULL",
}
_LENGTHS = {
    "digits": f"CASE WHEN {{c}} RLIKE '{_DECIMAL}' THEN length(regexp_extract({{c}}, '{_DECIMAL}', 1)) END",
    "places": f"CASE WHEN {{c}} RLIKE '{_DECIMAL}' THEN greatest(length(regexp_extract({{c}}, '{_DECIMAL}', 2)) - 1, 0) END",
}


@dataclass(frozen=True)
class Facts:
    """What is known of a column; ``+`` joins what is known of two pieces of it."""

    cells: int = 0
    booleans: int = 0
    wholes: int = 0
    decimals: int = 0
    doubles: int = 0
    dates: int = 0
    moments: int = 0
    digits: int = 0
    places: int = 0

    def __add__(self, other: Facts) -> Facts:
        counts = {f: getattr(self, f) + getattr(other, f) for f in _COUNTS}
        return Facts(**counts, **{f: max(getattr(self, f), getattr(other, f)) for f in _LENGTHS})

    def kind(self) -> T.DataType:
        """The least type that holds every cell. A column of blanks is text."""
        if not self.cells:
            return T.StringType()
        if self.booleans == self.cells:
            return T.BooleanType()
        if self.wholes == self.cells:
            return T.LongType()
        if self.decimals == self.cells and self.digits + self.places <= 38:
            return T.DecimalType(self.digits + self.places, self.places)
        if self.doubles == self.cells:
            return T.DoubleType()
        if self.dates == self.cells:
            return T.DateType()
        if self.moments == self.cells:
            return T.TimestampNTZType()
        return T.StringType()


def _cell(column: str) -> str:
    return f"nullif(trim({name(column)}), '')"


def column_facts(sheet: DataFrame) -> dict[str, Facts]:
    """The facts of all columns of texts, in one pass; nine numbers per column come back."""
    asked: list[Column] = []
    for k, column in enumerate(sheet.columns):
        asked += [F.expr(f"count_if({test.replace("{c}", _cell(column))}) AS {f}_{k}") for f, test in _COUNTS.items()]
        asked += [F.expr(f"coalesce(max({value.replace("{c}", _cell(column))}), 0) AS {f}_{k}") for f, value in _LENGTHS.items()]
    if not asked:
        return {}
    row = sheet.agg(*asked).first()
    return {c: Facts(**{f: row[f"{f}_{k}"] for f in (*_COUNTS, *_LENGTHS)}) for k, c in enumerate(sheet.columns)}


def schema_of(facts: Mapping[str, Facts]) -> T.StructType:
    return T.StructType([T.StructField(c, known.kind()) for c, known in facts.items()])


def typed(sheet: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """A sheet of texts under its types, inferred if none are given.

    Blanks become null except in text columns, which stay as they are. Whole numbers with
    leading zeros are texts: they are codes and phone numbers. A cell that does not fit a
    given type is an error.
    """
    found = schema_of(column_facts(sheet)) if schema is None else schema
    return sheet.selectExpr(
        *[
            f"{name(f.name)}" if isinstance(f.dataType, T.StringType) else f"CAST({_cell(f.name)} AS {f.dataType.simpleString()}) AS {name(f.name)}"
            for f in found.fields
        ]
    )
