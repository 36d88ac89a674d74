"""Decoded order lists and their sums: inquiries and online orders."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.labels import (
    ABNORMAL,
    INQUIRY_STATES,
    INQUIRY_TYPE,
    ONLINE_STATES,
    PAY_STATES,
    decode,
    two_way,
)
from tallyward.functions.money import AMOUNT, TEN_THOUSANDTH, scaled
from tallyward.period import Period

INQUIRY_GROUP = ("doctor_name", "user_name", "inquiry_type", "pay_state")
ONLINE_GROUP = ("doctor_name", "user_name", "pay_state")
# Newest first; the further columns settle ties, and let a much repeated id be sorted by several tasks.
LIST_ORDER = ("inquiry_ord_id", "create_date", "doctor_id", "user_id")


def bound_to(doctors: DataFrame, institution: str) -> DataFrame:
    """Doctors bound to the institution.

    The id is the doctor table's key, so being among the ids of the institution's doctors
    is the same as being one of them: a filter in place of a semi-join with the table itself.
    """
    return doctors.filter(F.col("binding_mechanism") == institution)


def not_bound_to(doctors: DataFrame, institution: str) -> DataFrame:
    """Doctors not bound to the institution, those without any included; see ``bound_to``."""
    return doctors.filter(~F.col("binding_mechanism").eqNullSafe(institution))


def inquiry_orders(
    inquiries: DataFrame,
    doctors: DataFrame,
    users: DataFrame,
    period: Period,
    institution: str,
    *,
    unit: Decimal = TEN_THOUSANDTH,
    inquiry_type: tuple = INQUIRY_TYPE,
    states: Mapping = INQUIRY_STATES,
    pay_states: Mapping = PAY_STATES,
    abnormal: tuple = ABNORMAL,
    ordered: bool = True,
) -> DataFrame:
    """Inquiries of one institution's doctors after the period's start and up to its end.

    Sorted before the codes are decoded: the sampling pass of the sort then skips that work.
    """
    own = bound_to(doctors, institution)
    rows = period.restrict(inquiries, "create_date", "(]").select(
        "inquiry_ord_id",
        "doctor_id",
        "user_id",
        "doctor_name",
        "buy_type",
        "ord_amount",
        "create_date",
        "ord_state",
        "pay_state",
        "abnormal_state",
    )
    joined = rows.join(
        own.select(F.col("id").alias("doctor_id"), F.col("phone").alias("doctor_phone"), "department"), "doctor_id"
    ).join(users.select("user_id", "user_name", "bill_id"), "user_id")
    if ordered:
        joined = joined.orderBy(*LIST_ORDER, ascending=[False, True, True, True])
    return joined.select(
        "inquiry_ord_id",
        two_way("buy_type", inquiry_type).alias("inquiry_type"),
        "user_name",
        "bill_id",
        "doctor_name",
        "doctor_phone",
        "department",
        scaled(inquiries, "ord_amount", unit).alias("amount"),
        "create_date",
        decode("ord_state", states).alias("ord_state"),
        decode("pay_state", pay_states).alias("pay_state"),
        two_way("abnormal_state", abnormal).alias("abnormal_state"),
    )


def online_orders(
    orders: DataFrame,
    doctors: DataFrame,
    users: DataFrame,
    period: Period,
    excluded_institution: str,
    *,
    unit: Decimal = TEN_THOUSANDTH,
    states: Mapping = ONLINE_STATES,
    pay_states: Mapping = PAY_STATES,
    ordered: bool = True,
) -> DataFrame:
    """Online orders strictly inside the period, without those of one institution's doctors."""
    others = not_bound_to(doctors, excluded_institution)
    rows = period.restrict(orders, "create_date", "()").select(
        "inquiry_ord_id",
        "medical_ord_id",
        "doctor_id",
        "user_id",
        "user_name",
        "doctor_name",
        "total_price",
        "create_date",
        "ord_state",
        "pay_state",
        "pay_date",
    )
    joined = rows.join(others.select(F.col("id").alias("doctor_id"), "department"), "doctor_id").join(
        users.select("user_id", "bill_id"), "user_id"
    )
    if ordered:
        joined = joined.orderBy(*LIST_ORDER, ascending=[False, True, True, True])
    return joined.select(
        "inquiry_ord_id",
        "create_date",
        "medical_ord_id",
        "user_name",
        "department",
        "bill_id",
        "doctor_name",
        scaled(orders, "total_price", unit).alias("amount"),
        decode("ord_state", states).alias("ord_state"),
        decode("pay_state", pay_states).alias("pay_state"),
        "pay_date",
    )


def order_sums(listed: DataFrame, group: tuple[str, ...], ordered: bool = True) -> DataFrame:
    """Sum of the listed amounts per group, largest first."""
    sums = listed.groupBy(*group).agg(F.sum("amount").cast(AMOUNT).alias("total_amount"))
    return sums.orderBy(F.desc("total_amount")) if ordered else sums


def order_sheets(
    listed: DataFrame, group: tuple[str, ...], names: tuple[str, str] = ("orders", "summary")
) -> dict[str, DataFrame | Callable]:
    """List and sums for ``write_report``; the sums are taken from the list as written."""
    return {names[0]: listed, names[1]: lambda written: order_sums(written[names[0]], group)}
