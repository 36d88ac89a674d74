"""Exact money: whole numbers or decimals in, decimals out, two rounding rules."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.sql import literal, name

# The units in which money is stored.
ONE = Decimal(1)
TEN_THOUSANDTH = Decimal("0.0001")
HUNDRED_THOUSANDTH = Decimal("0.00001")

# SQL ROUND goes half away from zero, Python's round on decimals half to even.
HALF_UP = "round"
HALF_EVEN = "bround"

AMOUNT = T.DecimalType(28, 2)

_LOW_BITS = 20
_WHOLE = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


@dataclass(frozen=True)
class Measure:
    """A money column and the way it is summed.

    Whole numbers are summed in two halves, the low 20 bits and the rest. Both are plain
    64-bit sums, several times faster than a decimal sum. Amounts below 2^43 in size can be
    summed over some 10^12 rows per group; larger ones over fewer, and what does not fit
    fails loudly. Decimals are summed as they are. Either way the sums are exact, can be
    summed again, and become one decimal only at the end.
    """

    column: str
    scale: int | None

    @property
    def parts(self) -> tuple[str, ...]:
        if self.scale is None:
            return f"{self.column}__high", f"{self.column}__low"
        return (f"{self.column}__sum",)

    def sums(self) -> list[Column]:
        """Aggregates over the rows, one per part."""
        c = name(self.column)
        if self.scale is None:
            values = [f"shiftright(CAST({c} AS BIGINT), {_LOW_BITS})", f"CAST({c} AS BIGINT) & {(1 << _LOW_BITS) - 1}"]
        else:
            values = [c]
        return [F.expr(f"sum({v}) AS {name(p)}") for v, p in zip(values, self.parts)]

    def sums_of_parts(self, where: str | None = None, label: str | None = None) -> list[Column]:
        """Aggregates over partial sums, over the rows of ``where`` if given."""
        renamed = Measure(label or self.column, self.scale)
        pick = "{}" if where is None else f"CASE WHEN {where} THEN {{}} ELSE 0 END"
        return [
            F.expr(f"sum({pick.format(name(p))}) AS {name(q)}") for p, q in zip(self.parts, renamed.parts)
        ]

    def value(self, unit: Decimal = ONE) -> str:
        """The exact total in currency, as SQL text over the parts.

        The casts leave room for the unit: Spark cuts the fraction of a product of more than 38 digits.
        """
        if self.scale is None:
            high, low = (f"CAST({name(p)} AS DECIMAL(20,0))" for p in self.parts)
            return f"({high} * {literal(unit * (1 << _LOW_BITS))} + {low} * {literal(unit)})"
        total = T.DecimalType(min(24 + self.scale, 32), self.scale).simpleString()
        return f"(CAST({name(self.parts[0])} AS {total}) * {literal(unit)})"


def measure(df: DataFrame, column: str) -> Measure:
    """How to sum a column; floating point is refused, since its sums depend on row order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return Measure(column, kind.scale)
    if isinstance(kind, _WHOLE):
        return Measure(column, None)
    raise TypeError(f"money column {column!r} must be a whole number or a decimal, not {kind.simpleString()}")


def measures(df: DataFrame, columns: Iterable[str]) -> list[Measure]:
    return [measure(df, c) for c in columns]


def currency(value: str, rounding: str = HALF_UP) -> str:
    """An amount as SQL text, rounded to two places; null becomes 0."""
    return f"CAST(coalesce({rounding}({value}, 2), 0) AS DECIMAL(28,2))"


def whole(value: str, rounding: str = HALF_UP) -> str:
    """An amount as SQL text, rounded to a whole number; null becomes 0. Cheap to sum again."""
    return f"CAST(coalesce({rounding}({value}, 0), 0) AS BIGINT)"


def scaled(df: DataFrame, column: str, unit: Decimal = TEN_THOUSANDTH, rounding: str = HALF_UP) -> Column:
    """One row's units as currency."""
    kind = "DECIMAL(20,0)" if measure(df, column).scale is None else None
    c = name(column) if kind is None else f"CAST({name(column)} AS {kind})"
    return F.expr(currency(f"{c} * {literal(unit)}", rounding))


def ratio(part: str, whole: str, places: int = 4) -> Column:
    """Count / count, half away from zero; 0 where there is nothing to divide by."""
    share = f"CAST({part} AS DECIMAL(19,0)) / CAST(nullif({whole}, 0) AS DECIMAL(19,0))"
    return F.expr(f"CAST(coalesce(round({share}, {places}), 0) AS DECIMAL(20,{places}))")


def ratio_even(part: str, whole: str, places: int = 2) -> Column:
    """Money / count, half to even; 0 where there is nothing to divide by."""
    share = f"CAST({part} AS DECIMAL(24,2)) / CAST(nullif({whole}, 0) AS DECIMAL(18,0))"
    return F.expr(f"CAST(coalesce(bround({share}, {places}), 0) AS DECIMAL(28,{places}))")


def ratio_float(part: str, whole: str) -> Column:
    """Money / count as floating point, rounded as Python rounds floats: to the cent nearest to the binary value.

    Twice a hundred times the quotient is taken in two parts that are exact together, the
    rounded product and what rounding lost, so that a value a hair off a half cent goes the
    way of the hair. Real halves go to even. 0 where there is nothing to divide by.
    """
    q = f"(CAST({part} AS DOUBLE) / nullif({whole}, 0))"
    top = f"({q} * 134217729D - ({q} * 134217729D - {q}))"
    lost = f"(({top} * 200D - {q} * 200D) + ({q} - {top}) * 200D)"
    cents = f"floor({q} * 200D / 2D)"
    over = f"(({q} * 200D - (2D * {cents} + 1D)) + {lost})"
    up = f"CASE WHEN {over} > 0 OR ({over} = 0 AND {cents} % 2 <> 0) THEN 1 ELSE 0 END"
    return F.expr(f"CAST(coalesce(CAST({cents} + {up} AS DECIMAL(28,0)) / 100, 0) AS DECIMAL(28,2))")


def percent_text(share: Column) -> Column:
    """0.4286 as ``42.86%``."""
    return F.concat((F.round(share, 4) * 100).cast("decimal(20,2)").cast("string"), F.lit("%"))
