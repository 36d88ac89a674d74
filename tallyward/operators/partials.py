"""Sums on their way: per group the parts of exact sums, which can be summed again.

A partial sum may be taken below a join, regrouped to any coarser level, kept in storage
and merged with others. Only ``finished`` turns it into currency, so however often it was
regrouped, it is rounded once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.money import HALF_UP, TEN_THOUSANDTH, Measure, currency, measures, whole
from tallyward.functions.sql import literal, name

#: Column that tells the grouping sets apart.
SET = "_set"


#: Sums up to here are kept in one long. A sixteenth of what it holds: rows may be joined to several, and beyond it fails loudly.
NARROW = 1 << 59
#: A sum's parts are about twice as long as a packed row, so sums must halve the rows to be worth it.
SHRINK = 2


def shrinks(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether sums per key, taken within each task, leave half of the rows at most; from one pass over the keys."""
    each = df.groupBy(F.spark_partition_id().alias("_task")).agg(
        F.count("*").alias("rows"), F.approx_count_distinct(F.struct(*keys)).alias("groups")
    )
    found = each.agg(F.sum("rows").alias("rows"), F.sum("groups").alias("groups")).first()
    return (found["rows"] or 0) >= SHRINK * (found["groups"] or 0)


@dataclass(frozen=True)
class Partials:
    """A frame of keys and of the parts of sums, and the measures that the parts belong to."""

    frame: DataFrame
    wanted: tuple[Measure, ...]

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], columns: Iterable[str], most: int | None = None) -> Partials:
        """Rows summed per group; combined on the map side, so a group costs one row per task at most.

        ``most`` is the size that no sum of whole numbers can exceed, where it is known: sums well
        within 64 bits need no halves.
        """
        wanted = tuple(measures(df, columns))
        if most is not None and most < NARROW:
            wanted = tuple(Measure(m.column, m.scale or 0) for m in wanted)
        return cls(df.groupBy(*keys).agg(*[part for m in wanted for part in m.sums()]), wanted)

    @property
    def parts(self) -> list[str]:
        return [p for m in self.wanted for p in m.parts]

    def _sums(self) -> list[Column]:
        return [part for m in self.wanted for part in m.sums_of_parts()]

    def joined(self, other: DataFrame, on: str | Sequence[str]) -> Partials:
        """Each sum once per match: as if its rows had been joined before they were summed."""
        return replace(self, frame=self.frame.join(other, on))

    def by(self, keys: Sequence[str]) -> Partials:
        return replace(self, frame=self.frame.groupBy(*keys).agg(*self._sums()))

    def over(self, sets: Mapping[str, Sequence[str]], always: Sequence[str] = ()) -> Partials:
        """All grouping sets in one pass: ``SET`` holds a set's name, keys outside the set are null.

        A null key inside a set stays a group of its own. ``always`` are keys of every set.
        """
        keys = list(dict.fromkeys(k for keys in sets.values() for k in keys))
        named: dict[int, str] = {}
        for label, members in sets.items():
            number = sum(1 << place for place, k in enumerate(reversed([*keys, *always])) if k not in members and k not in always)
            if number in named:
                raise ValueError(f"{label!r} and {named[number]!r} group by the same keys")
            named[number] = label
        grouped = self.frame.groupingSets([[*members, *always] for members in sets.values()], *keys, *always)
        cases = " ".join(f"WHEN {number} THEN {literal(label)}" for number, label in named.items())
        summed = grouped.agg(F.grouping_id().alias("_grouping"), *self._sums())
        label = F.expr(f"CASE _grouping {cases} END").alias(SET)
        return replace(self, frame=summed.select(label, *keys, *always, *self.parts))

    def finished(
        self, keys: Sequence[str], unit: Decimal = TEN_THOUSANDTH, rounding: str = HALF_UP, order: Sequence[str | Column] = ()
    ) -> DataFrame:
        """Currency, rounded; sorted before, while the rows are cheap."""
        values = [f"{currency(m.value(unit), rounding)} AS {name(m.column)}" for m in self.wanted]
        frame = self.frame.orderBy(*order) if order else self.frame
        return frame.selectExpr(*[name(k) for k in keys], *values)

    def spread_rounded(
        self,
        keys: Sequence[str],
        code: str,
        columns: Mapping,
        paid: str,
        unit: Decimal = TEN_THOUSANDTH,
        order: Sequence[str | Column] = (),
    ) -> DataFrame:
        """Totals per group and ``paid`` spread over one column per listed code.

        The rows are one per group and code. Their sums are rounded to cents first and then added up.
        """
        cents = [f"{whole(m.value(unit * 100))} AS {name(m.column)}" for m in self.wanted]
        per_code = self.frame.selectExpr(*[name(k) for k in keys], name(code), *cents)
        totals = [m.column for m in self.wanted]
        wide = per_code.groupBy(*keys).agg(
            *[F.expr(f"sum({name(c)}) AS {name(c)}") for c in totals],
            *[
                F.expr(f"sum(CASE WHEN {name(code)} = {literal(value)} THEN {name(paid)} ELSE 0 END) AS {name(label)}")
                for value, label in columns.items()
            ],
        )
        shown = [*totals, *columns.values()]
        values = [f"CAST(CAST({name(c)} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(28,2)) AS {name(c)}" for c in shown]
        wide = wide.orderBy(*order) if order else wide
        return wide.selectExpr(*[name(k) for k in keys], *values)
