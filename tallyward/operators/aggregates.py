"""Grouped sums: rounded in two stages, spread into columns, or split by rules.

All of them sum exactly and round late. Where an order is asked for, the rows are
sorted before the sums are turned into decimals, so that the sampling pass of the
sort does not pay for them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.money import HALF_UP, ONE, TEN_THOUSANDTH, Measure, currency, measures
from tallyward.functions.sql import all_equal, literal, name
from tallyward.operators.partials import Partials

Order = Sequence[str | Column]


def _sorted(df: DataFrame, order: Order) -> DataFrame:
    return df.orderBy(*order) if order else df


def _names(keys: Sequence[str]) -> list[str]:
    return [name(k) for k in keys]


def scaled_sums(
    df: DataFrame,
    keys: Sequence[str],
    columns: Iterable[str],
    unit: Decimal = TEN_THOUSANDTH,
    rounding: str = HALF_UP,
    order: Order = (),
) -> DataFrame:
    """Sum each column per group, then bring it to currency and round it."""
    return Partials.of(df, keys, columns).finished(keys, unit, rounding, order)


def spread(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    columns: Mapping,
    paid: str,
    totals: Sequence[str],
    unit: Decimal = ONE,
    order: Order = (),
) -> DataFrame:
    """Totals per group, and ``paid`` spread into one column per listed code.

    A listed code that never occurs still has its column, filled with 0; an unlisted
    code counts in the totals only. The rows shrink to one per group and code on the
    map side, before the first shuffle, so a group holding much of the table costs
    no more than a small one.
    """
    wanted = measures(df, totals)
    main = next(m for m in wanted if m.column == paid)
    small = df.groupBy(*keys, code).agg(*[part for m in wanted for part in m.sums()])
    wide = small.groupBy(*keys).agg(
        *[part for m in wanted for part in m.sums_of_parts()],
        *[
            part
            for value, label in columns.items()
            for part in main.sums_of_parts(f"{name(code)} = {literal(value)}", label)
        ],
    )
    shown = [*wanted, *[Measure(label, main.scale) for label in columns.values()]]
    values = [f"{currency(m.value(unit))} AS {name(m.column)}" for m in shown]
    return _sorted(wide, order).selectExpr(*_names(keys), *values)


def spread_rounded(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    columns: Mapping,
    paid: str,
    totals: Sequence[str],
    unit: Decimal = TEN_THOUSANDTH,
    order: Order = (),
) -> DataFrame:
    """``spread``, but of sums that are rounded per group and code before they are added up.

    The totals are then sums of rounded sums, which can differ by cents from the rounded
    sum. The rounded sums travel as whole cents.
    """
    return Partials.of(df, [*keys, code], totals).spread_rounded(keys, code, columns, paid, unit, order)


def disjoint(rules: Iterable[Mapping[str, object]]) -> bool:
    """True where any two rules ask for different values of some shared column."""
    return all(
        any(a[c] != b[c] for c in a.keys() & b.keys()) for a, b in combinations(list(rules), 2)
    )


def rule_sums(
    df: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Mapping[str, object]],
    suffixes: Mapping[str, str],
    unit: Decimal = ONE,
    rounding: str = HALF_UP,
    order: Order = (),
) -> DataFrame:
    """Total of each measure, and its sum over the rows of each rule, rounded to currency.

    ``rules`` maps a category to the code values its rows carry; ``suffixes`` maps a
    money column to the ending of its columns (``<category>_<suffix>``). Rows of no
    rule count in the totals only. As no row can meet two rules, every row is given
    its category first: each row is added once per measure instead of once per rule,
    and the wide conditional sums run over one row per group and category.
    """
    if not disjoint(rules.values()):
        raise ValueError("rules overlap: two of them can match one row")
    wanted = measures(df, suffixes)
    cases = " ".join(f"WHEN {all_equal(rule)} THEN {literal(label)}" for label, rule in rules.items())
    small = (
        df.withColumn("_category", F.expr(f"CASE {cases} END"))
        .groupBy(*keys, "_category")
        .agg(*[part for m in wanted for part in m.sums()])
    )
    columns = {
        f"{label}_{suffixes[m.column]}": (m, f"_category = {literal(label)}") for label in rules for m in wanted
    }
    wide = small.groupBy(*keys).agg(
        *[part for m in wanted for part in m.sums_of_parts()],
        *[part for label, (m, test) in columns.items() for part in m.sums_of_parts(test, label)],
    )
    shown = [*[Measure(label, m.scale) for label, (m, _) in columns.items()], *wanted]
    values = [f"{currency(m.value(unit), rounding)} AS {name(m.column)}" for m in shown]
    return _sorted(wide, order).selectExpr(*_names(keys), *values)
