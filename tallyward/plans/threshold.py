"""When each doctor reached the n-th registered patient, and the patients behind it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.labels import SEX, two_way
from tallyward.operators.joins import keep_listed, relaid
from tallyward.operators.windows import dense_nth, nth_event, repeat_rows, time_counts
from tallyward.period import Period


@dataclass(frozen=True)
class Threshold:
    """``n`` registrations inside ``period`` with one brand."""

    n: int
    period: Period
    brand: object

    def __post_init__(self):
        if self.n < 1:
            raise ValueError(f"n must be at least 1, got {self.n}")


def _valid(registrations: DataFrame, wanted: Threshold) -> DataFrame:
    return wanted.period.restrict(registrations, "create_date").filter(
        (F.col("state") > 0) & (F.col("brand_id") == F.lit(wanted.brand))
    )


def _names(doctors: DataFrame) -> DataFrame:
    return doctors.select(F.col("id").alias("doctor_id"), F.col("name").alias("doctor_name"))


def registration_counts(
    registrations: DataFrame, doctors: DataFrame, wanted: Threshold, *, parity: bool = False, ordered: bool = True
) -> DataFrame:
    """Registrations per doctor.

    Counted per doctor id before the doctor table (one row per id) is joined. With
    ``parity`` the interval reads ``[a→b)`` whatever the real ends are.
    """
    counted = _valid(registrations, wanted).groupBy("doctor_id").agg(F.count(F.lit(1)).alias("registrations"))
    report = counted.join(_names(doctors), "doctor_id").select(
        "doctor_name", "doctor_id", "registrations", F.lit(_interval(wanted, parity)).alias("interval")
    )
    return report.orderBy("doctor_name", "doctor_id") if ordered else report


def _interval(wanted: Threshold, parity: bool) -> str:
    return wanted.period.label("[]", "[)" if parity else None)


def nth_registration(
    registrations: DataFrame, doctors: DataFrame, wanted: Threshold, *, parity: bool = False, ordered: bool = True
) -> DataFrame:
    """Doctors with at least n registrations, their count and the time of the n-th.

    The counts by which the n-th time is found give the total as well; the doctor table
    only meets one row per doctor.
    """
    valid = _valid(registrations, wanted)
    reached = nth_event(valid, ["doctor_id"], "create_date", wanted.n, total="registrations")
    report = (
        reached.join(_names(doctors), "doctor_id")
        .select(
            "doctor_name",
            "doctor_id",
            "registrations",
            F.col("create_date").alias("reached_at"),
            F.lit(wanted.n).alias("threshold"),
            F.lit(_interval(wanted, parity)).alias("interval"),
        )
    )
    return report.orderBy("doctor_name", "doctor_id") if ordered else report


def registration_detail(
    registrations: DataFrame,
    users: DataFrame,
    doctors: DataFrame,
    reached: DataFrame,
    wanted: Threshold,
    *,
    ordered: bool = True,
) -> DataFrame:
    """The patients registered with the doctors of ``reached``; no state is asked for here.

    The doctors get their names before they meet the registrations, which are then
    filtered and named by one join.
    """
    listed = relaid(reached.select("doctor_id").join(_names(doctors), "doctor_id", "left"))
    rows = wanted.period.restrict(registrations, "create_date").filter(F.col("brand_id") == F.lit(wanted.brand))
    found = (
        rows.select("doctor_id", "user_id", "create_date")
        .join(listed, "doctor_id")
        .join(users.select("user_id", "user_name", "user_sex", "bill_id"), "user_id")
    )
    if ordered:
        found = found.orderBy("doctor_name", F.desc("create_date"), "user_id")
    return found.select(
        "doctor_name",
        "user_name",
        two_way("user_sex", SEX).alias("sex"),
        "bill_id",
        F.col("create_date").alias("registered_at"),
    )


def threshold_sheets(
    tables: Mapping[str, DataFrame], wanted: Threshold, *, parity: bool = False
) -> dict[str, DataFrame | Callable]:
    """Sheets for ``write_report``: counts where n is 1, else the n-th times, and the detail.

    The sheet ``reached`` also holds the doctor ids. It is found once, and the other two
    sheets start from it as written.
    """
    registrations, doctors = tables["usr_doctor_user_rel"], tables["sec_app_doctor"]
    build = registration_counts if wanted.n == 1 else nth_registration
    return {
        "reached": build(registrations, doctors, wanted, parity=parity),
        "summary": lambda written: written["reached"].orderBy("doctor_name", "doctor_id").drop("doctor_id"),
        "detail": lambda written: registration_detail(
            registrations, tables["usr_user"], doctors, written["reached"], wanted
        ),
    }


def dense_nth_registration(
    registrations: DataFrame, doctors: DataFrame, wanted: Threshold, *, ordered: bool = True
) -> DataFrame:
    """The n-th distinct registration time per doctor name, tied rows kept.

    Doctors qualify by n valid registrations, but all registrations of the period
    are ranked, and by name. Rows are counted per doctor and time before they meet the
    names; the tied rows travel as counts and are written out at the end.
    """
    valid = _valid(registrations, wanted)
    enough = valid.groupBy("doctor_id").agg(F.count("user_id").alias("n")).filter(F.col("n") >= wanted.n)
    rows = wanted.period.restrict(registrations, "create_date").select("doctor_id", "create_date")
    named = keep_listed(time_counts(rows, ["doctor_id"], "create_date"), enough, "doctor_id").join(_names(doctors), "doctor_id")
    per_name = named.groupBy("doctor_name", "create_date").agg(F.sum("ties").alias("ties"))
    hits = dense_nth(per_name, ["doctor_name"], "create_date", wanted.n)
    report = repeat_rows(hits, "ties").select(
        "doctor_name",
        F.lit(wanted.n).alias("threshold"),
        F.col("create_date").alias("reached_at"),
        F.lit(f"{wanted.period.start_text}→{wanted.period.end_text}").alias("interval"),
    )
    return report.orderBy("doctor_name") if ordered else report
