"""Sheets as written: periods that stay, exact exports, display names, orders."""

import os
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyward.functions import labels
from tallyward.plans import finished, orders
from tallyward.sources import reports
from tallyward.sources.reports import read_export, write_report
from workload.oracle import oracles
from workload.queries import registry

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
given = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="the given tables are not here")

LISTED = (
    "inquiry_ord_id bigint, doctor_name string, user_name string, inquiry_type string, pay_state string, "
    "amount decimal(28,2), create_date timestamp_ntz"
)
AWKWARD = ["Ada", "Ada ", " Ada", "A\nda", "A\r\nda", 'A"d,a"', "", None, "A\\nda", "A\\\\", "0"]


def listed(spark):
    at = datetime(2021, 3, 1, 12, 30, 1, 123456)
    rows = [(k, name, "p", "text", "paid", Decimal(k + 1) / 4, at) for k, name in enumerate(AWKWARD * 2)]
    return spark.createDataFrame(rows, LISTED)


def month(spark, name, values):
    rows = [(v, f"2021-{name}-01", f"2021-{name}-28") for v in values]
    return {"s": spark.createDataFrame(rows, "v int, period_start string, period_end string")}


def test_other_periods_stay(spark, tmp_path):
    base, columns = str(tmp_path / "r"), ["period_start", "period_end"]

    def found():
        spark.catalog.refreshByPath(base)
        held = spark.read.parquet(f"{base}/sheet=s")
        return sorted((str(r.period_start)[5:7], r.v) for r in held.collect())

    write_report(month(spark, "03", [1, 2]), base, partition_by=columns)
    write_report(month(spark, "04", [3]), base, partition_by=columns)
    assert found() == [("03", 1), ("03", 2), ("04", 3)]
    write_report(month(spark, "03", [9]), base, partition_by=columns)
    assert found() == [("03", 9), ("04", 3)]
    march = {"period_start": "2021-03-01", "period_end": "2021-03-28"}
    assert write_report(month(spark, "03", []), base, partition_by=columns, replaces=march) == {"s": 0}
    assert found() == [("04", 3)]


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_sums_of_a_written_list(spark, tmp_path, kind):
    base = str(tmp_path / kind)
    frame = listed(spark)
    rows = write_report(orders.order_sheets(frame, orders.INQUIRY_GROUP), base, kind, single_file=["summary"])
    expected = orders.order_sums(frame, orders.INQUIRY_GROUP).collect()
    assert rows == {"orders": len(AWKWARD) * 2, "summary": len(expected)}
    schema = orders.order_sums(frame, orders.INQUIRY_GROUP).schema
    read = read_export(spark, f"{base}/sheet=summary", schema) if kind == "csv" else spark.read.parquet(f"{base}/sheet=summary")
    assert sorted(map(str, read.collect())) == sorted(map(str, expected))
    assert len(list(Path(f"{base}/sheet=summary").glob("part-*"))) == 1
    amounts = [r.total_amount for r in read.collect()]
    assert amounts == sorted(amounts, reverse=True)


def test_csv_texts_and_times_are_exact(spark, tmp_path):
    frame = listed(spark)
    write_report({"list": frame}, str(tmp_path), "csv")
    read = read_export(spark, f"{tmp_path}/sheet=list", frame.schema)
    assert sorted(map(str, read.collect())) == sorted(map(str, frame.collect()))


def test_a_single_file_is_computed_by_many_tasks(spark, tmp_path, monkeypatch):
    def tasks(rows):
        return rows.select(F.spark_partition_id().alias("t")).distinct().count()

    frame = spark.range(0, 1000, 1, 8).withColumn("t", F.spark_partition_id())
    write_report({"s": frame.orderBy(F.desc("id"))}, str(tmp_path), single_file=["s"])
    out = spark.read.parquet(f"{tmp_path}/sheet=s")
    assert out.select("t").distinct().count() == 8 and tasks(out) == 1
    assert [r.id for r in out.collect()] == list(range(999, -1, -1))
    monkeypatch.setattr(reports, "SINGLE_FILE_ROWS", 999)
    with pytest.raises(ValueError, match="too many"):
        write_report({"s": frame}, str(tmp_path), single_file=["s"])


def test_every_name_table_is_used():
    tables = {n for n in vars(labels) if n.endswith("_NAMES")}
    assert tables == {n for n in vars(finished) if n.endswith("_NAMES")}


def test_finished_order_sheets(spark, tmp_path):
    write_report(finished.inquiry_sheets(listed(spark), parity_nulls=True), str(tmp_path))
    shown = spark.read.parquet(f"{tmp_path}/sheet=orders")
    assert shown.columns[:2] == ["订单编号", "问诊医生"] and shown.filter("`问诊医生` IS NULL").isEmpty()
    sums = spark.read.parquet(f"{tmp_path}/sheet=summary")
    assert sums.columns == ["问诊医生", "患者姓名", "问诊类型", "付款状态", "总金额"]
    both = sum(Decimal(k + 1) / 4 for k, name in enumerate(AWKWARD * 2) if name in (None, "0"))
    assert sums.filter("`问诊医生` = '0'").first()["总金额"] == both.quantize(Decimal("0.01"))


@given
@pytest.mark.parametrize(
    ("query", "build", "names"),
    [
        ("pay_method_clinic_day", finished.payment_sheets, labels.PAYMENT_NAMES),
        ("charge_category_doctor_day", finished.charge_sheets, labels.CHARGE_NAMES),
        ("merged_summary", lambda f: finished.indicator_sheets({"doctor": f}), labels.INDICATOR_NAMES),
        ("online_orders", finished.online_sheets, labels.ONLINE_NAMES),
        ("doctor_activity", finished.activity_sheets, labels.ACTIVITY_NAMES),
        ("dense_nth_registration", finished.dense_sheets, labels.DENSE_THRESHOLD_NAMES),
        ("pivot_from_file", finished.payment_sheets, labels.PAYMENT_NAMES),
    ],
)
def test_reports_get_their_display_names(spark, query, build, names):
    report = registry()[query](spark, SF_DIR)
    sheet = next(iter(build(report).values()))
    assert sheet.columns == [names[c] for c in report.columns]


ORDERED = {
    **{f"charge_category_{level}_day": f"hospital_name, pay_day DESC{more}" for level, more in (("clinic", ""), ("dept", ", depart_name"), ("doctor", ", doctor_name"))},
    "pay_method_clinic_day": "hospital_name, pay_day",
    "charge_category_clinic_period": "hospital_name",
    "inquiry_orders": "inquiry_ord_id DESC, create_date",
    "online_orders": "inquiry_ord_id DESC, create_date",
    "inquiry_orders_sum": "total_amount DESC",
    "online_orders_sum": "total_amount DESC",
    "doctor_activity": "new_followers DESC, new_registrations DESC, new_inquiries DESC, new_prescriptions DESC, online_paid DESC, offline_paid DESC",
    "registration_counts": "doctor_name, doctor_id",
    "nth_registration": "doctor_name, doctor_id",
    "registration_detail": "doctor_name, registered_at DESC",
    "dense_nth_registration": "doctor_name",
    "top_k_priority": "o_totalprice DESC, o_orderkey",
}


@given
@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_their_order(spark, name):
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    keys = [part.split()[0] for part in ORDERED[name].split(", ")]
    expected = connection.execute(f"SELECT {', '.join(keys)} FROM ({oracles()[name]}) ORDER BY {ORDERED[name]}").fetchall()
    got = [tuple(r[k] for k in keys) for r in registry()[name](spark, SF_DIR).collect()]
    assert got and got == expected
