"""Visits, income and cost per clinic, doctor and month, and their merged summary."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.calendar import month_start, month_text
from tallyward.functions.money import HALF_EVEN, HUNDRED_THOUSANDTH, percent_text, ratio, ratio_even, ratio_float
from tallyward.operators.aggregates import rule_sums
from tallyward.operators.distinct import distinct_over, id_sets
from tallyward.operators.frames import union_all
from tallyward.operators.joins import merge
from tallyward.operators.partials import SET
from tallyward.period import Period

_SOURCE = "_source"
_SUMMARY_TABLES = ("ord_registered", "ord_fee_detail", "ord_pay", "sec_hospital")
#: Of these the tables that a source's list of clinics restricts.
_OF_CLINICS = ("ord_registered", "ord_pay")

ROLES = {"doctor": "doctor_name", "consultant": "consultants_name"}

# The codes a fee line carries per category.
FEE_RULES = {
    "registered": {"subject_type": 1},
    "diagnosis": {"subject_type": 2},
    "check": {"subject_type": 3},
    "medical": {"subject_type": 5, "subject_id": 10},
    "material": {"subject_type": 5, "subject_id": 12, "item_type": 4},
    "instrument": {"subject_type": 5, "subject_id": 12, "item_type": 5},
    "other1": {"subject_type": 5, "subject_id": 12, "item_type": 6},
    "other2": {"subject_type": 5, "subject_id": 12, "item_type": 7},
    "other3": {"subject_type": 5, "subject_id": 12, "item_type": 8},
    "other4": {"subject_type": 5, "subject_id": 12, "item_type": 9},
    "exam_in_room": {"subject_type": 30, "subject_id": 41},
    "exam_check": {"subject_type": 30, "subject_id": 42},
    "exam_inspect": {"subject_type": 30, "subject_id": 43},
    "west_medicine": {"subject_type": 10, "subject_id": 15},
    "cp_medicine": {"subject_type": 10, "subject_id": 16},
    "trad_medicine": {"subject_type": 11, "subject_id": 20},
    "decoction": {"subject_type": 11, "subject_id": 25},
    "inspect_advice": {"subject_type": 6, "subject_id": 31},
    "other": {"subject_type": 15},
}
# The categories the finished report shows, in its order.
SHOWN_CATEGORIES = (
    "registered",
    "medical",
    "material",
    "instrument",
    "trad_medicine",
    "decoction",
    "west_medicine",
    "cp_medicine",
    "check",
    "inspect_advice",
    "other",
    "diagnosis",
)


def _role(role: str) -> str:
    if role not in ROLES:
        raise ValueError(f"role must be one of {sorted(ROLES)}, got {role!r}")
    return ROLES[role]


def _in_clinics(clinics: Collection | None) -> Column:
    return F.lit(True) if clinics is None else F.col("hospital_id").isin(*clinics)


def visit_indicators(
    visits: DataFrame,
    period: Period,
    role: str = "doctor",
    clinics: Collection | None = None,
    *,
    state: int = 5,
    types: Collection[int] = (1, 2),
    return_type: int = 2,
    ordered: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Visits, return visits and their rate, distinct patients, visits per patient. ``by`` names further keys.

    The distinct count is grouped by patient as well before it is grouped by
    clinic, so that a clinic holding much of the table is spread over all tasks.
    """
    person = _role(role)
    kept = period.restrict(visits, "create_date").filter(
        (F.col("state") == state) & F.col("registered_type").isin(*types) & _in_clinics(clinics)
    )
    kept = kept.withColumn("_month", month_start(F.col("create_date")))
    counted = kept.groupBy(*by, "hospital_name", "_month", person).agg(
        F.count("registered_ord_id").alias("visits"),
        F.count_if((F.col("registered_type") == return_type) & F.col("registered_ord_id").isNotNull()).alias(
            "return_visits"
        ),
        F.count_distinct("user_id").alias("patients"),
    )
    rate = ratio("return_visits", "visits")
    if ordered:
        counted = counted.orderBy("hospital_name", F.desc("_month"), F.desc(rate))
    return counted.select(
        *by,
        "hospital_name",
        month_text(F.col("_month")).alias("month"),
        person,
        "visits",
        "return_visits",
        percent_text(rate).alias("return_rate"),
        "patients",
        ratio("visits", "patients", 2).alias("visits_per_patient"),
    )


def income_cost(
    fees: DataFrame,
    pay: DataFrame,
    hospitals: DataFrame,
    period: Period,
    role: str = "doctor",
    clinics: Collection | None = None,
    *,
    pay_state: int = 2,
    state: int = 1,
    buy_type: int = 1,
    rules: Mapping[str, Mapping] = FEE_RULES,
    shown: Iterable[str] = SHOWN_CATEGORIES,
    unit: Decimal = HUNDRED_THOUSANDTH,
    parity: bool = False,
    ordered: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Price and cost per fee category, totals and gross profit. ``by`` names further keys, which all three tables have.

    The clinic's name follows the fee line, the clinic filter the payment. With
    ``parity`` the cost of category ``other`` repeats its price.
    """
    person = _role(role)
    shown = list(shown)
    paid = (
        period.restrict(pay, "registered_create_date", "()")
        .filter((F.col("state") == state) & (F.col("buy_type") == buy_type) & _in_clinics(clinics))
        .select(*by, "pay_order_id", person, month_start(F.col("registered_create_date")).alias("_month"))
    )
    codes = sorted({c for rule in rules.values() for c in rule})
    lines = fees.filter(F.col("pay_state") == pay_state).select(
        *by, "pay_order_id", "hospital_id", *codes, "total_price", "total_cost_price"
    )
    named = lines.join(hospitals.select(*by, "hospital_id", "hospital_name"), [*by, "hospital_id"])
    rows = named.join(paid, [*by, "pay_order_id"])
    keys = [*by, "hospital_name", person, "_month"]
    sums = rule_sums(
        rows,
        keys,
        {name: rules[name] for name in shown},
        {"total_price": "fee", "total_cost_price": "cost"},
        unit,
        HALF_EVEN,
        ["hospital_name", F.desc("_month")] if ordered else (),
    )
    if parity and "other" in shown:
        sums = sums.withColumn("other_cost", F.col("other_fee"))
    values = [f"{name}_{suffix}" for name in shown for suffix in ("fee", "cost")]
    return sums.select(
        *by,
        "hospital_name",
        person,
        month_text(F.col("_month")).alias("month"),
        *values,
        "total_price",
        "total_cost_price",
        F.expr("total_price - total_cost_price AS gross_profit"),
    )


def merge_indicators(
    indicators: DataFrame, money: DataFrame, role: str = "doctor", *, parity: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Both reports side by side where both have the group, with the average ticket.

    The ticket is rounded exactly, half cents to even. With ``parity`` it is the rounded
    quotient of floats, which sends some half cents the other way (5.35 / 2 to 2.67).
    """
    joined = merge(indicators, money, [*by, "hospital_name", _role(role), "month"])
    ticket = (ratio_float if parity else ratio_even)("total_price", "visits")
    return joined.withColumn("average_ticket", ticket).drop("total_cost_price")


def merged_summary(
    tables: Mapping[str, DataFrame],
    period: Period,
    role: str = "doctor",
    clinics: Collection | None = None,
    visit_options: Mapping | None = None,
    money_options: Mapping | None = None,
    *,
    parity: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """``merge_indicators`` built from the tables of one source, or of several told apart by the columns ``by``."""
    visits = visit_indicators(
        tables["ord_registered"], period, role, clinics, ordered=False, by=by, **(visit_options or {})
    )
    money = income_cost(
        tables["ord_fee_detail"],
        tables["ord_pay"],
        tables["sec_hospital"],
        period,
        role,
        clinics,
        ordered=False,
        by=by,
        **(money_options or {}),
    )
    return merge_indicators(visits, money, role, parity=parity, by=by)


def merged_sources(
    sources: Mapping[str, Mapping[str, DataFrame]],
    period: Period,
    role: str = "doctor",
    clinics: Mapping[str, Collection] | None = None,
    **options,
) -> DataFrame:
    """The merged summaries of several sources, each with its own clinics, in one frame.

    The sources' rows are tagged and put into one table each before anything is joined or
    summed: every step shuffles once, however many sources there are.
    """
    chosen = clinics or {}

    def tagged(table: str) -> DataFrame:
        parts = []
        for source, tables in sources.items():
            rows = tables[table].filter(_in_clinics(chosen.get(source))) if table in _OF_CLINICS else tables[table]
            parts.append(rows.withColumn(_SOURCE, F.lit(source)))
        return union_all(parts, missing=True)

    together = {table: tagged(table) for table in _SUMMARY_TABLES}
    return merged_summary(together, period, role, by=[_SOURCE], **options).drop(_SOURCE)


def patients_at(
    visits: DataFrame,
    period: Period,
    clinics: Collection | None = None,
    *,
    state: int = 5,
    types: Collection[int] = (1, 2),
    ordered: bool = True,
) -> DataFrame:
    """Distinct patients per clinic and month, per clinic, per month and overall, from one pass.

    A patient of several months or clinics counts once in each coarser group, which sums of
    finer counts cannot tell. Patients are numbered densely, see ``operators.distinct``.
    """
    kept = period.restrict(visits, "create_date").filter(
        (F.col("state") == state) & F.col("registered_type").isin(*types) & _in_clinics(clinics)
    )
    sets = id_sets(kept.withColumn("_month", month_start(F.col("create_date"))), ["hospital_name", "_month"], "user_id")
    levels = {"clinic month": ["hospital_name", "_month"], "clinic": ["hospital_name"], "month": ["_month"], "all": []}
    counted = distinct_over(sets, levels, "patients")
    shown = counted.select(F.col(SET).alias("level"), "hospital_name", month_text(F.col("_month")).alias("month"), "patients")
    return period.stamp(shown.orderBy("level", "hospital_name", "month") if ordered else shown)


def summary_sheets(
    sources: Mapping[str, Mapping[str, DataFrame]], period: Period, clinics: Mapping[str, Collection] | None = None, **options
) -> dict[str, DataFrame]:
    """One sheet per role, ready for ``write_report``."""
    return {role: merged_sources(sources, period, role, clinics, **options) for role in ROLES}
