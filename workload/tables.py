"""The given tables under the column names of the clinic tables.

Only renames, simple codes and amounts as whole numbers, the way the clinic tables
keep money: the reports themselves do the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyward.sources.catalog import Files, Sources
from tallyward.sources.schemas import CHARGE_MEASURES


def given(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(spark, {"main": Files(sf_dir)})


def hundredths(column: str) -> str:
    """The double as a whole number of hundredths."""
    return f"CAST(rint({column} * 100) AS BIGINT)"


PRICE = hundredths("l_extendedprice")
# Units of 1/10000: the price less its discount.
COST = f"{PRICE} * (100 - {hundredths('l_discount')})"

# --- payments -------------------------------------------------------------

METHODS = {
    "1-URGENT": "cash",
    "2-HIGH": "alipay",
    "3-MEDIUM": "wechat",
    "4-NOT SPECIFIED": "bank_card",
    "9-NEVER": "citizen_card",
}
PAID_STATES = ("F", "O")

# The five measures of a payment are the price times a whole factor.
PAY_FACTORS = {
    "original_amount": 5,
    "receivable_amount": 4,
    "pay_amount": 3,
    "deposit_amount": 1,
    "medical_fund_payment": 2,
}

# Each charge measure is one of four base amounts times a whole factor.
BASES = ("quantity", "price", "discount", "tax")
CHARGES = {name: (BASES[i % 4], i // 4 + 1) for i, name in enumerate(CHARGE_MEASURES)}


def payments(src: Sources) -> DataFrame:
    """Orders as payments; the customer stands for the visit."""
    price = hundredths("o_totalprice")
    return src.table("orders").selectExpr(
        "o_orderkey AS pay_order_id",
        "o_custkey AS order_id",
        "1 AS buy_type",
        "o_orderstatus AS state",
        "o_orderpriority AS pay_type",
        *[f"{price} * {factor} AS {name}" for name, factor in PAY_FACTORS.items()],
        "o_orderdate AS create_date",
    )


def clinic_visits(src: Sources) -> DataFrame:
    """Customers with their nation as clinic."""
    customer, nation = src.table("customer"), src.table("nation")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).selectExpr(
        "c_custkey AS registered_ord_id",
        "n_name AS hospital_name",
        "c_mktsegment AS depart_name",
        "c_name AS doctor_name",
    )


def classified(src: Sources) -> DataFrame:
    """Line items as classified payments."""
    bases = {
        "quantity": "CAST(l_quantity AS BIGINT)",
        "price": PRICE,
        "discount": f"{PRICE} * {hundredths('l_discount')}",
        "tax": f"{PRICE} * {hundredths('l_tax')}",
    }
    return src.table("lineitem").selectExpr(
        "l_orderkey AS pay_order_id",
        *[f"{bases[base]} * {factor} AS {name}" for name, (base, factor) in CHARGES.items()],
    )


# --- visits, income and cost ----------------------------------------------

CLINICS = {
    "main": (0, 1, 2, 4, 5, 6, 7, 9, 10, 11, 12, 14, 15, 16, 17, 19, 20, 21, 22, 24),
    "second": (3, 8, 13, 18, 23),
}
RULES = {
    "registered": {"subject_type": "A", "subject_id": "F", "item_type": 1},
    "medical": {"subject_type": "A", "subject_id": "F", "item_type": 2},
    "material": {"subject_type": "A", "subject_id": "F", "item_type": 3},
    "instrument": {"subject_type": "A", "subject_id": "O"},
    "trad_medicine": {"subject_type": "N", "subject_id": "F", "item_type": 1},
    "decoction": {"subject_type": "N", "subject_id": "F", "item_type": 2},
    "west_medicine": {"subject_type": "N", "subject_id": "O", "item_type": 4},
    "cp_medicine": {"subject_type": "N", "subject_id": "O", "item_type": 5},
    "check": {"subject_type": "R", "subject_id": "F"},
    "inspect_advice": {"subject_type": "R", "subject_id": "O", "item_type": 6},
    "other": {"subject_type": "R", "subject_id": "O", "item_type": 7},
    "diagnosis": {"subject_type": "A", "subject_id": "F", "item_type": 7},
}


def visits(src: Sources) -> DataFrame:
    """Orders as visits: open ones are return visits, pending ones neither first nor return."""
    orders, customer, nation = src.table("orders"), src.table("customer"), src.table("nation")
    placed = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    return orders.join(placed, orders["o_custkey"] == placed["c_custkey"]).selectExpr(
        "o_orderkey AS registered_ord_id",
        "o_custkey AS user_id",
        "c_nationkey AS hospital_id",
        "n_name AS hospital_name",
        "c_mktsegment AS doctor_name",
        "o_orderpriority AS consultants_name",
        "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS registered_type",
        "5 AS state",
        "o_orderdate AS create_date",
    )


def fee_lines(src: Sources) -> DataFrame:
    """Line items as fee lines; the supplier's nation is the clinic of the line."""
    lines, supplier = src.table("lineitem"), src.table("supplier")
    return lines.join(supplier, lines["l_suppkey"] == supplier["s_suppkey"]).selectExpr(
        "l_orderkey AS pay_order_id",
        "s_nationkey AS hospital_id",
        "l_returnflag AS subject_type",
        "l_linestatus AS subject_id",
        "l_linenumber AS item_type",
        "2 AS pay_state",
        f"{PRICE} * 100 AS total_price",
        f"{COST} AS total_cost_price",
    )


def fee_payments(src: Sources) -> DataFrame:
    """Orders as the payments behind the fee lines; pending ones are not paid."""
    orders, customer = src.table("orders"), src.table("customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).selectExpr(
        "o_orderkey AS pay_order_id",
        "c_nationkey AS hospital_id",
        "c_mktsegment AS doctor_name",
        "o_orderpriority AS consultants_name",
        "CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END AS state",
        "1 AS buy_type",
        "o_orderdate AS registered_create_date",
    )


def hospitals(src: Sources) -> DataFrame:
    return src.table("nation").selectExpr("n_nationkey AS hospital_id", "n_name AS hospital_name")


def summary_tables(src: Sources, source: str = "main") -> dict[str, DataFrame]:
    """The tables of one source. The second has other rows: no visits of urgent orders, and prices three times as high."""
    visited, lines = visits(src), fee_lines(src)
    if source == "second":
        visited = visited.filter("consultants_name <> '1-URGENT'")
        lines = lines.withColumn("total_price", lines["total_price"] * 3)
    return {
        "ord_registered": visited,
        "ord_fee_detail": lines,
        "ord_pay": fee_payments(src),
        "sec_hospital": hospitals(src),
    }


# --- order lists ------------------------------------------------------------

ORDER_STATES = {"A": "waiting", "N": "answered"}
ORDER_PAY_STATES = {"F": "paid"}


def order_lines(src: Sources) -> DataFrame:
    """Line items as inquiries and online orders: the supplier is the doctor, the part the patient."""
    return src.table("lineitem").selectExpr(
        "l_orderkey AS inquiry_ord_id",
        "l_linenumber AS medical_ord_id",
        "l_suppkey AS doctor_id",
        "l_partkey AS user_id",
        "concat('doctor ', l_suppkey) AS doctor_name",
        "concat('patient ', l_partkey) AS user_name",
        "l_linenumber AS buy_type",
        f"{PRICE} AS ord_amount",
        f"{PRICE} AS total_price",
        "l_returnflag AS ord_state",
        "l_linestatus AS pay_state",
        "CAST(l_discount > 0 AS INT) AS abnormal_state",
        "l_shipdate AS create_date",
        "l_shipdate AS pay_date",
    )


def supplier_doctors(src: Sources) -> DataFrame:
    return src.table("supplier").selectExpr(
        "s_suppkey AS id",
        "s_name AS phone",
        "CAST(s_nationkey AS STRING) AS department",
        "CASE WHEN s_acctbal < 0 THEN 'B' ELSE 'A' END AS binding_mechanism",
    )


def part_patients(src: Sources) -> DataFrame:
    return src.table("part").selectExpr(
        "p_partkey AS user_id",
        "p_name AS user_name",
        "CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS user_sex",
        "p_brand AS bill_id",
    )


# --- doctors and their events -----------------------------------------------


def customer_doctors(src: Sources) -> DataFrame:
    return src.table("customer").selectExpr(
        "c_custkey AS id",
        "c_name AS name",
        "c_mktsegment AS medical_institution",
        "CAST(c_nationkey AS STRING) AS department",
        "c_nationkey AS recommend_id",
        "CASE WHEN c_acctbal < 0 THEN 'B' ELSE 'A' END AS binding_mechanism",
    )


def referrers(src: Sources) -> DataFrame:
    return src.table("nation").selectExpr("n_nationkey AS recommend_id", "n_name AS name")


def _of_type(src: Sources, event_type: str, *columns: str) -> DataFrame:
    events = src.table("events").filter(f"event_type = '{event_type}'")
    return events.selectExpr("user_id AS doctor_id", "ts AS create_date", *columns)


def followers(src: Sources) -> DataFrame:
    """Views; those of value 100 and more are valid, so that some doctors have none."""
    return _of_type(
        src, "view", "floor(value) AS account_id", "CASE WHEN value >= 100 THEN 1 ELSE 0 END AS state"
    )


def signups(src: Sources) -> DataFrame:
    return _of_type(src, "signup", "floor(value) AS user_id", "CASE WHEN value >= 5 THEN 1 ELSE 0 END AS state")


def clicks(src: Sources) -> DataFrame:
    return _of_type(src, "click")


def purchases(src: Sources) -> DataFrame:
    return _of_type(
        src,
        "purchase",
        "1 AS state",
        "CASE WHEN value >= 10 THEN 1 ELSE 0 END AS pay_state",
        "CASE WHEN value < 60 THEN 1 ELSE 2 END AS pay_type",
    )


def registrations(src: Sources, by_day: bool = False) -> DataFrame:
    """Events as registrations; errors are void. By day, many share one time, and only clicks and signups are valid."""
    void = "event_type NOT IN ('click', 'signup')" if by_day else "event_type = 'error'"
    return src.table("events").selectExpr(
        "user_id AS doctor_id",
        "floor(value) AS user_id",
        "1 AS brand_id",
        f"CASE WHEN {void} THEN 0 ELSE 1 END AS state",
        f"{'CAST(to_date(ts) AS TIMESTAMP_NTZ)' if by_day else 'ts'} AS create_date",
    )
