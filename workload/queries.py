"""One query per report variant and operator, over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import Period
from tallyward.functions import calendar as cal
from tallyward.functions.labels import decode, two_way
from tallyward.functions.money import TEN_THOUSANDTH
from tallyward.functions.sql import name
from tallyward.functions.text import commonest_char
from tallyward.operators import frames, joins, windows
from tallyward.operators.aggregates import rule_sums
from tallyward.plans import activity, indicators, orders, payments, sheets, threshold
from tallyward.sources.buckets import Buckets, buckets_for, write_buckets
from tallyward.sources.inference import typed
from tallyward.sources.kept import days_of
from tallyward.sources.versions import shared_folder
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

ORDER_DAYS = Period.of("1995-01-01", "2001-08-01")
SHIP_DAYS = Period.of("1995-01-02", "2001-11-01")
EVENT_DAYS = Period.of("2024-01-01", "2024-01-31")
EVENT_WEEK = Period.of("2024-01-10", "2024-01-17")

INQUIRY_TYPE = (1, "text", "phone")
ABNORMAL = (0, "normal", "abnormal")


def present(df: DataFrame) -> DataFrame:
    """Plain output types: decimals as doubles, dates and times as text."""
    shown = []
    for field in df.schema.fields:
        c = name(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = f"CAST({c} AS DOUBLE)"
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        elif isinstance(field.dataType, T.DateType):
            c = f"CAST({c} AS STRING)"
        shown.append(f"{c} AS {name(field.name)}")
    return df.selectExpr(*shown)


# --- payments -----------------------------------------------------------------


def pay_method(level: str, grain: str, src: t.Sources, exact: bool = False) -> DataFrame:
    return payments.payment_methods(
        t.payments(src),
        t.clinic_visits(src),
        ORDER_DAYS,
        level,
        grain,
        states=t.PAID_STATES,
        methods=t.METHODS,
        exact=exact,
    )


def charge_category(level: str, grain: str, src: t.Sources) -> DataFrame:
    return payments.charge_categories(
        t.classified(src),
        t.payments(src),
        t.clinic_visits(src),
        ORDER_DAYS,
        level,
        grain,
        states=t.PAID_STATES,
    )


def pay_method_levels(src: t.Sources) -> DataFrame:
    return payments.payment_methods_at(
        t.payments(src), t.clinic_visits(src), ORDER_DAYS, states=t.PAID_STATES, methods=t.METHODS
    )


def charge_category_levels(src: t.Sources) -> DataFrame:
    return payments.charge_categories_at(
        t.classified(src), t.payments(src), t.clinic_visits(src), ORDER_DAYS, states=t.PAID_STATES
    )


#: The same days as ``ORDER_DAYS``, whole.
WHOLE_DAYS = Period.of("1995-01-01", "2001-08-01 23:59:59")


def pay_method_kept(level: str, grain: str, src: t.Sources) -> DataFrame:
    """A first batch without a fifth of the last months' payments, which come late; a second one replaces their days."""
    kept = payments.kept_payments(src.spark, f"{shared_folder(src.spark)}/kept-{uuid.uuid4().hex}")
    rows = partial(payments.payment_rows, visits=t.clinic_visits(src), states=t.PAID_STATES)
    pay = t.payments(src)
    late = (F.col("pay_order_id") % 5 == 0) & (F.col("create_date") >= "2001-05-10")
    kept.replace_days(rows(pay.filter(~late)))
    kept.replace_days(rows(pay), days_of(pay.filter(late).withColumn("day", F.to_date("create_date")), "day"))
    return payments.payment_methods_kept(kept, WHOLE_DAYS, level, grain, methods=t.METHODS)


def _bucketed(src: t.Sources, **tables: DataFrame) -> t.Sources:
    """The tables laid out by payment, read back as a source."""
    root = f"{shared_folder(src.spark)}/buckets-{uuid.uuid4().hex}"
    buckets = buckets_for(tables.values())
    for table, df in tables.items():
        write_buckets(df, root, table, ["pay_order_id"], buckets)
    return t.Sources(src.spark, {"main": Buckets(root)})


def charge_category_bucketed(src: t.Sources) -> DataFrame:
    laid = _bucketed(src, ord_pay_classify=t.classified(src), ord_pay=t.payments(src))
    return payments.charge_categories(
        laid.table("ord_pay_classify"), laid.table("ord_pay"), t.clinic_visits(src), ORDER_DAYS, "clinic", "day", states=t.PAID_STATES
    )


def income_cost_bucketed(src: t.Sources) -> DataFrame:
    laid = _bucketed(src, ord_fee_detail=t.fee_lines(src), ord_pay=t.fee_payments(src))
    return indicators.income_cost(
        laid.table("ord_fee_detail"), laid.table("ord_pay"), t.hospitals(src), ORDER_DAYS, "doctor", rules=t.RULES
    )


def distinct_patients(src: t.Sources) -> DataFrame:
    return indicators.patients_at(t.visits(src), ORDER_DAYS)


def inferred_orders(src: t.Sources) -> DataFrame:
    """Orders as a sheet of texts, some cells blank, under the types that the texts show."""
    placed = src.table("orders")
    sheet = placed.select(
        *[F.col(c).cast("string").alias(c) for c in placed.columns],
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") % 100).cast("string").alias("part_of_hundred"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.lpad((F.col("o_custkey") % 1000).cast("string"), 4, "0").alias("code"),
        (F.col("o_orderkey") % 2 == 0).cast("string").alias("even"),
    )
    rows = typed(sheet)
    kinds = ", ".join(f"{f.name} {f.dataType.typeName()}" for f in rows.schema.fields)
    return rows.withColumn("kinds", F.lit(kinds))


def pivot_from_file(src: t.Sources) -> DataFrame:
    visit, placed = t.clinic_visits(src), src.table("orders")
    sheet = placed.join(visit, placed["o_custkey"] == visit["registered_ord_id"]).select(
        "hospital_name", F.col("o_orderpriority").alias("pay_type"), F.col("o_totalprice").cast("decimal(18,2)").alias("pay_amount")
    )
    columns = {method: method for method in t.METHODS}
    wide = payments.sheet_by_method(sheet, columns, "hospital_name", "pay_type", "pay_amount")
    return wide.withColumnsRenamed(t.METHODS)


# --- visits, income and cost ----------------------------------------------------


def visit_indicators(role: str, src: t.Sources) -> DataFrame:
    return indicators.visit_indicators(t.visits(src), ORDER_DAYS, role)


def income_cost(role: str, src: t.Sources, parity: bool = False) -> DataFrame:
    return indicators.income_cost(
        t.fee_lines(src),
        t.fee_payments(src),
        t.hospitals(src),
        ORDER_DAYS,
        role,
        rules=t.RULES,
        parity=parity,
    )


def merged_summary(role: str, src: t.Sources, parity: bool = False) -> DataFrame:
    return indicators.merged_summary(
        t.summary_tables(src), ORDER_DAYS, role, money_options={"rules": t.RULES}, parity=parity
    )


def merged_two_sources(role: str, src: t.Sources) -> DataFrame:
    sources = {name: t.summary_tables(src, name) for name in t.CLINICS}
    return indicators.merged_sources(sources, ORDER_DAYS, role, t.CLINICS, money_options={"rules": t.RULES})


# --- order lists ------------------------------------------------------------------


def inquiry_orders(src: t.Sources, ordered: bool = True) -> DataFrame:
    return orders.inquiry_orders(
        t.order_lines(src),
        t.supplier_doctors(src),
        t.part_patients(src),
        SHIP_DAYS,
        "A",
        inquiry_type=INQUIRY_TYPE,
        states=t.ORDER_STATES,
        pay_states=t.ORDER_PAY_STATES,
        abnormal=ABNORMAL,
        ordered=ordered,
    )


def online_orders(src: t.Sources, ordered: bool = True) -> DataFrame:
    return orders.online_orders(
        t.order_lines(src),
        t.supplier_doctors(src),
        t.part_patients(src),
        SHIP_DAYS,
        "B",
        states=t.ORDER_STATES,
        pay_states=t.ORDER_PAY_STATES,
        ordered=ordered,
    )


def inquiry_orders_sum(src: t.Sources) -> DataFrame:
    return orders.order_sums(inquiry_orders(src, ordered=False), orders.INQUIRY_GROUP)


def online_orders_sum(src: t.Sources) -> DataFrame:
    return orders.order_sums(online_orders(src, ordered=False), orders.ONLINE_GROUP)


def in_list(src: t.Sources) -> DataFrame:
    """Line items of the customers with an urgent pending order, found through their orders: about half."""
    orders_, lines = src.table("orders"), src.table("lineitem")
    pending = orders_.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    placed = joins.keep_listed(orders_.select("o_orderkey", "o_custkey"), pending, "o_custkey")
    kept = joins.keep_listed(lines, placed, "l_orderkey", "o_orderkey", small=False)
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


def not_in_list(src: t.Sources) -> DataFrame:
    """Customers not among those with an urgent pending order."""
    pending = src.table("orders").filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    rest = joins.not_in(src.table("customer"), pending, "c_custkey", "o_custkey")
    return rest.select("c_custkey", "c_name")


# --- doctors -----------------------------------------------------------------------


def doctor_activity(src: t.Sources, parity: bool = False) -> DataFrame:
    return activity.doctor_activity(
        t.customer_doctors(src),
        t.followers(src),
        t.signups(src),
        t.clicks(src),
        t.purchases(src),
        t.referrers(src),
        EVENT_WEEK,
        "B",
        ("NATION",),
        parity=parity,
    )


# Near the median, so that about half of the doctors reach them.
MANY = threshold.Threshold(55, EVENT_DAYS, 1)
DAYS = threshold.Threshold(25, EVENT_DAYS, 1)


def registration_counts(src: t.Sources) -> DataFrame:
    return threshold.registration_counts(
        t.registrations(src), t.customer_doctors(src), MANY
    )


def nth_registration(src: t.Sources) -> DataFrame:
    return threshold.nth_registration(t.registrations(src), t.customer_doctors(src), MANY)


def registration_detail(src: t.Sources) -> DataFrame:
    rows, doctors = t.registrations(src), t.customer_doctors(src)
    reached = threshold.nth_registration(rows, doctors, MANY, ordered=False)
    return threshold.registration_detail(rows, t.part_patients(src), doctors, reached, MANY)


def dense_nth_registration(src: t.Sources) -> DataFrame:
    return threshold.dense_nth_registration(
        t.registrations(src, by_day=True), t.customer_doctors(src), DAYS
    )


def nth_event_large(src: t.Sources) -> DataFrame:
    """The 1500th event of each type."""
    return windows.nth_event(src.table("events"), ["event_type"], "ts", 1500)


def dense_nth_large(src: t.Sources) -> DataFrame:
    """The 1200th distinct minute of each event type, and its events."""
    minute = F.expr("CAST(date_format(ts, 'yyyy-MM-dd HH:mm:00') AS TIMESTAMP_NTZ)")
    counted = windows.time_counts(src.table("events").withColumn("ts", minute), ["event_type"], "ts")
    return windows.dense_nth(counted, ["event_type"], "ts", 1200)


# --- sheets and small operators ------------------------------------------------------


def exclude_by_words(src: t.Sources) -> DataFrame:
    part = src.table("part").select("p_partkey", "p_name", "p_type")
    return sheets.exclude_by_words(part, {"p_name": ("red", "bolt"), "p_type": ("ECONOMY", "SMALL")})


PROFILE_CATEGORIES = ("diagnosis", "check", "west", "trad", "medical", "lab", "material", "other")
PROFILE_RULES = {
    "diagnosis": {"l_returnflag": "A", "l_linestatus": "F"},
    "check": {"l_returnflag": "A", "l_linestatus": "O"},
    "west": {"l_returnflag": "N", "l_linestatus": "F"},
    "trad": {"l_returnflag": "N", "l_linestatus": "O"},
    "medical": {"l_returnflag": "R", "l_linestatus": "F", "l_linenumber": 1},
    "lab": {"l_returnflag": "R", "l_linestatus": "F", "l_linenumber": 2},
    "material": {"l_returnflag": "R", "l_linestatus": "O", "l_linenumber": 3},
    "other": {"l_returnflag": "R", "l_linestatus": "O", "l_linenumber": 4},
}
PROFILE_ORDER = (
    "year",
    "month",
    "clinic",
    *[f"{c}_fee" for c in PROFILE_CATEGORIES],
    "income",
    *[f"{c}_cost" for c in PROFILE_CATEGORIES],
    "cost",
    *[f"{c}_profit" for c in PROFILE_CATEGORIES],
    "profit",
)


def profile(src: t.Sources) -> DataFrame:
    """A profit table per year, month and supplier nation, its columns not yet in report order."""
    lines, supplier, nation = (src.table(n) for n in ("lineitem", "supplier", "nation"))
    places = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    rows = lines.join(places, lines["l_suppkey"] == places["s_suppkey"]).selectExpr(
        "year(l_shipdate) AS year",
        "month(l_shipdate) AS month",
        "n_name AS clinic",
        "l_returnflag",
        "l_linestatus",
        "l_linenumber",
        f"{t.PRICE} * 100 AS income",
        f"{t.COST} AS cost",
    )
    sums = rule_sums(
        rows, ["year", "month", "clinic"], PROFILE_RULES, {"income": "fee", "cost": "cost"}, TEN_THOUSANDTH
    )
    profits = [f"{c}_fee - {c}_cost AS {c}_profit" for c in PROFILE_CATEGORIES]
    return sums.selectExpr("*", *profits, "income - cost AS profit")


def profile_reorder(src: t.Sources) -> DataFrame:
    return sheets.reorder_profile(profile(src), PROFILE_ORDER)


def profile_row_unpivot(src: t.Sources) -> DataFrame:
    return sheets.profile_head(profile(src), ["year", "month", "clinic"], PROFILE_ORDER)


def char_mode_positions(src: t.Sources) -> DataFrame:
    best = src.table("documents").select("doc_id", commonest_char("text").alias("best"))
    return best.select(
        "doc_id",
        F.col("best.char").alias("char"),
        F.col("best.n").cast("bigint").alias("n"),
        F.array_join(F.col("best.positions").cast("array<string>"), ",").alias("positions"),
    )


def top_k_priority(src: t.Sources) -> DataFrame:
    placed = src.table("orders").select("o_orderkey", "o_totalprice")
    return windows.top_k(placed, "o_totalprice", "o_orderkey", 100)


def top_k_per_group(src: t.Sources) -> DataFrame:
    placed = src.table("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.top_k_per_group(placed, ["o_custkey"], "o_totalprice", "o_orderkey", 3)


def top_k_per_group_large(src: t.Sources) -> DataFrame:
    placed = src.table("orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return windows.top_k_per_group(placed, ["o_orderstatus"], "o_totalprice", "o_orderkey", 1500)


def calendar_bounds(src: t.Sources) -> DataFrame:
    d = F.col("o_orderdate")
    return src.table("orders").select(
        "o_orderkey",
        cal.day_text(d).alias("day"),
        cal.month_text(d).alias("month"),
        cal.month_number_text(d).alias("month_number"),
        cal.month_start(d).alias("month_first"),
        cal.month_end(d).alias("month_last"),
        cal.add_days(d, 7).alias("in_a_week"),
        cal.week_monday(d).alias("monday"),
        cal.week_sunday(d).alias("sunday"),
        cal.grain_start(d, "week").alias("week_first"),
        cal.grain_start(d, "year").alias("year_first"),
        cal.moment_from_text(cal.day_text(d)).alias("midnight"),
        cal.clock_text(d).alias("clock"),
    )


def label_decode(src: t.Sources) -> DataFrame:
    return src.table("orders").select(
        "o_orderkey",
        decode("o_orderpriority", t.METHODS).alias("method"),
        decode("o_orderstatus", {"F": "finished", "O": "open"}).alias("state"),
        two_way("o_orderstatus", ("F", "finished", "not finished")).alias("two_way"),
    )


def bad_date_rows(src: t.Sources) -> DataFrame:
    """Dates written without leading zeros: some of the texts are well formed, some are not."""
    d = F.col("o_orderdate")
    texts = src.table("orders").select(
        "o_orderkey", F.concat_ws("-", F.year(d), F.month(d), F.dayofmonth(d)).alias("date_text")
    )
    dated = frames.with_date(texts, "date_text")
    marked = dated.withColumn("verdict", F.when(F.col("date").isNotNull(), "good").otherwise("bad"))
    return marked.withColumn("date", F.coalesce(cal.day_text(F.col("date")), F.lit("-")))


def missing_column_union(src: t.Sources) -> DataFrame:
    customers = src.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = src.table("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
    )
    both = frames.union_all([customers, suppliers], missing=True)
    return frames.add_missing(frames.fill_nulls(both, text="0"), ["visits"])


def null_fill_drop(src: t.Sources) -> DataFrame:
    """Customers with their suppliers of the same number: most have none."""
    customers = src.table("customer").select("c_custkey", "c_mktsegment")
    suppliers = src.table("supplier").selectExpr(
        "s_suppkey AS c_custkey", "s_name", "CAST(s_acctbal AS DECIMAL(18,2)) AS balance", "s_nationkey"
    )
    wide = customers.join(suppliers, "c_custkey", "left")
    parts = {
        "numbers": frames.fill_nulls(wide).fillna("?", ["s_name"]),
        "one_column": wide.fillna({"s_nationkey": -1, "s_name": "none", "balance": 1}),
        "complete": wide.dropna(),
    }
    return frames.union_all([part.withColumn("rule", F.lit(rule)) for rule, part in parts.items()])


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for short, level in (("clinic", "clinic"), ("dept", "department"), ("doctor", "doctor")):
        for grain in ("day", "period"):
            found[f"pay_method_{short}_{grain}"] = partial(pay_method, level, grain)
            found[f"charge_category_{short}_{grain}"] = partial(charge_category, level, grain)
    found["pay_method_kept_clinic_period"] = partial(pay_method_kept, "clinic", "period")
    found["pay_method_kept_dept_day"] = partial(pay_method_kept, "department", "day")
    found["pay_method_clinic_period_exact"] = partial(pay_method, "clinic", "period", exact=True)
    for role in ("doctor", "consultant"):
        found[f"visit_indicators_{role}"] = partial(visit_indicators, role)
        found[f"income_cost_{role}"] = partial(income_cost, role)
        suffix = "" if role == "doctor" else f"_{role}"
        found[f"merged_summary{suffix}"] = partial(merged_summary, role)
        found[f"merged_two_sources{suffix}"] = partial(merged_two_sources, role)
    found["income_cost_parity"] = partial(income_cost, "doctor", parity=True)
    found["merged_summary_parity"] = partial(merged_summary, "doctor", parity=True)
    found["doctor_activity"] = doctor_activity
    found["doctor_activity_parity"] = partial(doctor_activity, parity=True)
    for query in (
        pay_method_levels,
        charge_category_bucketed,
        income_cost_bucketed,
        distinct_patients,
        inferred_orders,
        charge_category_levels,
        inquiry_orders,
        inquiry_orders_sum,
        online_orders,
        online_orders_sum,
        in_list,
        not_in_list,
        registration_counts,
        nth_registration,
        nth_event_large,
        dense_nth_large,
        registration_detail,
        dense_nth_registration,
        exclude_by_words,
        profile_reorder,
        profile_row_unpivot,
        pivot_from_file,
        char_mode_positions,
        top_k_priority,
        top_k_per_group,
        top_k_per_group_large,
        calendar_bounds,
        label_decode,
        bad_date_rows,
        missing_column_union,
        null_fill_drop,
    ):
        found[query.__name__] = query
    return {name: _presented(query) for name, query in found.items()}


def _presented(query: Callable[[t.Sources], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(query(t.given(spark, sf_dir)))
