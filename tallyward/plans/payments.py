"""Money per clinic, department or doctor: by payment method and by fee category."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.labels import PAY_METHOD_COLUMNS
from tallyward.functions.money import TEN_THOUSANDTH
from tallyward.operators.aggregates import spread, spread_rounded
from tallyward.operators.packed import Packing
from tallyward.operators.partials import SET, Partials, shrinks
from tallyward.period import GRAINS, Period
from tallyward.sources.kept import KeptSums
from tallyward.sources.schemas import CHARGE_MEASURES

LEVELS = {
    "clinic": ("hospital_name",),
    "department": ("hospital_name", "depart_name"),
    "doctor": ("hospital_name", "doctor_name"),
}
# Names under which the levels are also accepted.
LEVEL_ALIASES = {"门诊": "clinic", "科室": "department", "医生": "doctor"}

PAY_MEASURES = (
    "original_amount",
    "receivable_amount",
    "pay_amount",
    "deposit_amount",
    "medical_fund_payment",
)


def _level_keys(level: str) -> list[str]:
    level = LEVEL_ALIASES.get(level, level)
    if level not in LEVELS:
        raise ValueError(f"level must be one of {sorted(LEVELS)}, got {level!r}")
    return list(LEVELS[level])


def _by_day(grain: str) -> bool:
    """Only ``day`` splits the rows; the other grains differ in the period they are run for."""
    if grain not in (*GRAINS, "period"):
        raise ValueError(f"grain must be one of {(*GRAINS, 'period')}, got {grain!r}")
    return grain == "day"


def paid_visits(
    pay: DataFrame,
    visits: DataFrame,
    period: Period,
    keys: Sequence[str],
    states: Collection,
    buy_type: int,
    carry: Sequence[str],
) -> DataFrame:
    """Payments of the period with the names of their visit; only the columns asked for."""
    chosen = period.restrict(pay, "create_date").filter(
        (F.col("buy_type") == buy_type) & F.col("state").isin(*states)
    )
    left = chosen.select("order_id", F.to_date("create_date").alias("pay_day"), *carry)
    right = visits.select("registered_ord_id", *keys)
    return left.join(right, left["order_id"] == right["registered_ord_id"])


def payment_methods(
    pay: DataFrame,
    visits: DataFrame,
    period: Period,
    level: str = "clinic",
    grain: str = "day",
    *,
    states: Collection = (1, 5),
    buy_type: int = 1,
    methods: Mapping = PAY_METHOD_COLUMNS,
    unit: Decimal = TEN_THOUSANDTH,
    exact: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Five measures, and the paid amount spread over one column per payment method.

    The amounts are rounded per group and method and then added up; ``exact``
    rounds once. Unlisted methods count in the measures only.
    """
    names = _level_keys(level)
    keys = [*names, "pay_day"] if _by_day(grain) else names
    rows = paid_visits(pay, visits, period, names, states, buy_type, ["pay_type", *PAY_MEASURES])
    add_up = spread if exact else spread_rounded
    report = add_up(
        rows, keys, "pay_type", methods, "pay_amount", PAY_MEASURES, unit, order=keys if ordered else ()
    )
    return period.stamp(report)


def charge_categories(
    classify: DataFrame,
    pay: DataFrame,
    visits: DataFrame,
    period: Period,
    level: str = "clinic",
    grain: str = "day",
    *,
    states: Collection = (1, 5),
    buy_type: int = 1,
    measures: Sequence[str] = CHARGE_MEASURES,
    unit: Decimal = TEN_THOUSANDTH,
    ordered: bool = True,
) -> DataFrame:
    """Twenty fee measures per group; by day, each clinic's latest days come first.

    Payments meet their visits first, while the rows are narrow; see ``_fees`` for the wide
    classified rows.
    """
    names = _level_keys(level)
    by_day = _by_day(grain)
    keys = [*names, "pay_day"] if by_day else names
    paid = paid_visits(pay, visits, period, names, states, buy_type, ["pay_order_id"])
    sums = _fees(classify, paid.select("pay_order_id", *keys), keys, measures)
    order = [names[0], F.desc("pay_day"), *names[1:]] if by_day else names
    return period.stamp(sums.finished(keys, unit, order=order if ordered else ()))


def _fees(classify: DataFrame, paid: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> Partials:
    """The classified rows of the payments, summed by the keys; one shuffle carries the wide rows, by payment.

    Where a payment's rows stand together, they are summed before that shuffle: it carries one
    row per payment and task. Where they are scattered, such sums would fill the memory of the
    tasks and leave the rows as many as they were, so the rows travel themselves, packed, and
    are summed once they have met their payment. Both ways give the same sums.
    """
    rows = classify.filter(F.col("pay_order_id").isNotNull())
    if shrinks(rows, ["pay_order_id"]):
        return Partials.of(rows, ["pay_order_id"], measures).joined(paid, "pay_order_id").by(keys)
    packing = Packing.of(rows, measures)
    # the payments are the side to hold in memory: narrow, and one row each
    met = packing.pack(rows, ["pay_order_id"]).join(paid.hint("shuffle_hash"), "pay_order_id")
    return Partials.of(packing.unpack(met, keys), keys, measures, packing.most)


def _sets(levels: Sequence[str], grains: Sequence[str]) -> tuple[list[str], dict[str, list[str]]]:
    """All key columns, and per level and grain the keys of its groups under the name ``level/grain``."""
    sets = {}
    for level in dict.fromkeys(LEVEL_ALIASES.get(x, x) for x in levels):
        for grain in grains:
            by_day = _by_day(grain)
            sets[f"{level}/{'day' if by_day else 'period'}"] = _level_keys(level) + (["pay_day"] if by_day else [])
    return list(dict.fromkeys(k for keys in sets.values() for k in keys)), sets


def _labelled(report: DataFrame, keys: Sequence[str], period: Period, ordered: bool) -> DataFrame:
    label = F.split(SET, "/")
    named = report.select(label[0].alias("level"), label[1].alias("grain"), "*").drop(SET)
    return period.stamp(named.orderBy("level", "grain", *keys) if ordered else named)


def payment_rows(pay: DataFrame, visits: DataFrame, *, states: Collection = (1, 5), buy_type: int = 1) -> DataFrame:
    """All paid visits with the keys of every level, for ``kept_payments``."""
    names = list(dict.fromkeys(k for keys in LEVELS.values() for k in keys))
    chosen = pay.filter((F.col("buy_type") == buy_type) & F.col("state").isin(*states))
    left = chosen.select("order_id", F.to_date("create_date").alias("pay_day"), "pay_type", *PAY_MEASURES)
    right = visits.select("registered_ord_id", *names)
    return left.join(right, left["order_id"] == right["registered_ord_id"]).drop("order_id", "registered_ord_id")


def kept_payments(spark: SparkSession, base: str) -> KeptSums:
    """A store of daily payment sums: fill it with ``replace_days(payment_rows(...), days)``."""
    names = list(dict.fromkeys(k for keys in LEVELS.values() for k in keys))
    return KeptSums(spark, base, [*names, "pay_type"], PAY_MEASURES)


def payment_methods_kept(
    kept: KeptSums,
    period: Period,
    level: str = "clinic",
    grain: str = "day",
    *,
    methods: Mapping = PAY_METHOD_COLUMNS,
    unit: Decimal = TEN_THOUSANDTH,
    ordered: bool = True,
) -> DataFrame:
    """``payment_methods`` out of kept days, to the cent; the period must consist of whole days."""
    names = _level_keys(level)
    keys = [*names, "pay_day"] if _by_day(grain) else names
    sums = kept.read(period).by([*keys, "pay_type"])
    return period.stamp(sums.spread_rounded(keys, "pay_type", methods, "pay_amount", unit, keys if ordered else ()))


def payment_methods_at(
    pay: DataFrame,
    visits: DataFrame,
    period: Period,
    levels: Sequence[str] = tuple(LEVELS),
    grains: Sequence[str] = ("day", "period"),
    *,
    states: Collection = (1, 5),
    buy_type: int = 1,
    methods: Mapping = PAY_METHOD_COLUMNS,
    unit: Decimal = TEN_THOUSANDTH,
    ordered: bool = True,
) -> DataFrame:
    """``payment_methods`` at several levels and grains from one scan, told apart by ``level`` and ``grain``.

    The payments are summed to the finest groups once; all the levels are grouping sets over
    those sums, each rounded from its own exact sum. Keys that a level lacks are null.
    """
    keys, sets = _sets(levels, grains)
    names = [k for k in keys if k != "pay_day"]
    rows = paid_visits(pay, visits, period, names, states, buy_type, ["pay_type", *PAY_MEASURES])
    sums = Partials.of(rows, [*keys, "pay_type"], PAY_MEASURES).over(sets, ["pay_type"])
    report = sums.spread_rounded([SET, *keys], "pay_type", methods, "pay_amount", unit)
    return _labelled(report, keys, period, ordered)


def charge_categories_at(
    classify: DataFrame,
    pay: DataFrame,
    visits: DataFrame,
    period: Period,
    levels: Sequence[str] = tuple(LEVELS),
    grains: Sequence[str] = ("day", "period"),
    *,
    states: Collection = (1, 5),
    buy_type: int = 1,
    measures: Sequence[str] = CHARGE_MEASURES,
    unit: Decimal = TEN_THOUSANDTH,
    ordered: bool = True,
) -> DataFrame:
    """``charge_categories`` at several levels and grains from one scan of each table; see ``payment_methods_at``."""
    keys, sets = _sets(levels, grains)
    names = [k for k in keys if k != "pay_day"]
    paid = paid_visits(pay, visits, period, names, states, buy_type, ["pay_order_id"])
    sums = _fees(classify, paid.select("pay_order_id", *keys), keys, measures).over(sets)
    return _labelled(sums.finished([SET, *keys], unit), keys, period, ordered)


def sheet_by_method(
    sheet: DataFrame, columns: Mapping[str, str], clinic: str, method: str, paid: str
) -> DataFrame:
    """A sheet of payments pivoted to one row per clinic: the paid sum, and one column per method."""
    return spread(sheet, [clinic], method, columns, paid, [paid])
