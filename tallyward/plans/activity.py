"""Activity of each doctor, gathered from four fact tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.text import contains_any
from tallyward.operators.frames import fill_nulls
from tallyward.operators.joins import attach
from tallyward.period import Period
from tallyward.plans.orders import not_bound_to

COUNTS = (
    "new_followers",
    "new_registrations",
    "new_inquiries",
    "new_prescriptions",
    "online_paid",
    "offline_paid",
)


def _totals(facts: DataFrame, valid: Column, person: str, inside: Column, total: str, new: str) -> DataFrame:
    return (
        facts.filter(valid)
        .groupBy("doctor_id")
        .agg(F.count_distinct(person).alias(total), F.count_if(inside).alias(new))
    )


def doctor_activity(
    doctors: DataFrame,
    followers: DataFrame,
    registrations: DataFrame,
    inquiries: DataFrame,
    prescriptions: DataFrame,
    referrers: DataFrame,
    period: Period,
    excluded_institution: str,
    referrer_words: Collection[str] | None = None,
    *,
    parity: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """All-time and in-period counts per doctor, for referrers whose name has one of the words.

    Each fact table is reduced to one row per doctor before it is joined. A doctor
    without followers keeps the other counts; with ``parity`` they are lost.
    Inquiries and prescriptions are read for the period only.
    """
    inside = period.contains("create_date")
    parts = [
        _totals(followers, F.col("state") == 1, "account_id", inside, "followers", "new_followers"),
        _totals(registrations, F.col("state") > 0, "user_id", inside, "registrations", "new_registrations"),
        period.restrict(inquiries, "create_date")
        .groupBy("doctor_id")
        .agg(F.count(F.lit(1)).alias("new_inquiries")),
        period.restrict(prescriptions, "create_date")
        .filter(F.col("state") == 1)
        .groupBy("doctor_id")
        .agg(
            F.count(F.lit(1)).alias("new_prescriptions"),
            F.count_if((F.col("pay_state") == 1) & (F.col("pay_type") == 2)).alias("online_paid"),
            F.count_if((F.col("pay_state") == 1) & (F.col("pay_type") == 1)).alias("offline_paid"),
        ),
    ]
    kept = not_bound_to(doctors, excluded_institution).select(
        F.col("id").alias("doctor_id"),
        F.col("name").alias("doctor_name"),
        "medical_institution",
        "department",
        "recommend_id",
    )
    named = kept.join(
        referrers.select("recommend_id", F.col("name").alias("referrer_name")), "recommend_id", "left"
    )
    if referrer_words is not None:
        named = named.filter(contains_any("referrer_name", referrer_words))
    joined = attach(named, parts, "doctor_id")
    if parity:
        followed = F.col("followers").isNotNull()
        lost = [c for c in ("registrations", *COUNTS) if c != "new_followers"]
        joined = joined.withColumns({c: F.when(followed, F.col(c)) for c in lost})
    report = fill_nulls(
        period.stamp(joined).select(
            "doctor_name",
            "referrer_name",
            "medical_institution",
            "department",
            "followers",
            "registrations",
            "period_start",
            "period_end",
            *COUNTS,
        )
    )
    return report.orderBy(*[F.desc(c) for c in COUNTS]) if ordered else report
