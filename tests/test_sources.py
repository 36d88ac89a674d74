from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyward import Period
from tallyward.functions.labels import INQUIRY_NAMES
from tallyward.operators.frames import with_display_names
from tallyward.plans import orders, sheets, threshold
from tallyward.sources.catalog import Database, Files, Sources, Split, read_sheet
from tallyward.sources.reports import preview, report_path, write_report
from tallyward.sources.schemas import SCHEMAS
from tests import clinic


def test_files_and_named_sources(spark, tmp_path):
    for source, name in (("main", "North"), ("second", "South")):
        hospital = clinic.frame(spark, "sec_hospital", [{"hospital_id": 1, "hospital_name": name}])
        hospital.write.parquet(f"{tmp_path}/{source}/sec_hospital.parquet")
    sources = Sources(spark, {s: Files(f"{tmp_path}/{s}") for s in ("main", "second")})
    assert sources.table("sec_hospital").first().hospital_name == "North"
    assert sources.table("sec_hospital", "second").first().hospital_name == "South"
    both = sources.across(
        ["sec_hospital"], lambda source, tables: tables["sec_hospital"].withColumn("source", F.lit(source))
    )
    assert sorted((r.source, r.hospital_name) for r in both.collect()) == [("main", "North"), ("second", "South")]
    with pytest.raises(KeyError):
        sources.table("sec_hospital", "third")


def test_csv_sheets(spark, tmp_path):
    (tmp_path / "places.csv").write_text("名称,地址\n甲齿科,北京\n乙诊所,上海\n", encoding="utf-8")
    places = Sources(spark, {"main": Files(str(tmp_path), "csv", "{table}.csv")}).table("places")
    assert [r["名称"] for r in sheets.filter_places(places).collect()] == ["乙诊所"]
    (tmp_path / "operations.csv").write_text("诊所名称,付款方式,实收\nN,现金,1.25\nN,现金,x\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_sheet(spark, str(tmp_path / "operations.csv"), SCHEMAS["operations"]).collect()


def test_database_options():
    database = Database(
        {"url": "jdbc:mysql://db.example/ord", "user": "reader"},
        schemas={"ord_pay": "ord"},
        splits={"ord_pay": Split("pay_order_id", 1, 1_000_000, 64)},
    )
    options = database.reader_options("ord_pay")
    assert options["dbtable"] == "ord.ord_pay"
    assert (options["partitionColumn"], options["numPartitions"]) == ("pay_order_id", "64")
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1000000")
    for unsplit in (lambda: database.reader_options("ord_fee"), lambda: database.reader_options("q", "SELECT 1")):
        with pytest.raises(ValueError, match="no split"):
            unsplit()
    database = replace(database, small=["recent"])
    query = database.reader_options("recent", "SELECT * FROM usr_account LIMIT 10")
    assert query["dbtable"] == "(SELECT * FROM usr_account LIMIT 10) recent"
    assert "query" not in query and "partitionColumn" not in query
    assert database.options == {"url": "jdbc:mysql://db.example/ord", "user": "reader"}


def test_order_sheets(spark, tmp_path):
    listed = spark.createDataFrame(
        [(1, "Ada", "p", "text", "paid", Decimal("1.50")), (2, "Ada", "p", "text", "paid", Decimal("2.00"))],
        "inquiry_ord_id bigint, doctor_name string, user_name string, inquiry_type string, pay_state string, "
        "amount decimal(28,2)",
    )
    base = report_path(str(tmp_path), "{kind}-{start}", kind="inquiries", start="2021-03-01")
    rows = write_report(orders.order_sheets(listed, orders.INQUIRY_GROUP), base, single_file=["summary"])
    assert rows == {"orders": 2, "summary": 1}
    assert spark.read.parquet(f"{base}/sheet=summary").first().total_amount == Decimal("3.50")
    shown = {"list": with_display_names(listed, INQUIRY_NAMES)}
    assert write_report(shown, f"{base}-csv", "csv") == {"list": 2}
    assert spark.read.option("header", True).csv(f"{base}-csv/sheet=list").columns[0] == "订单编号"
    assert preview(listed, 1).count() == 1


def test_empty_report_keeps_its_header(spark, tmp_path):
    empty = clinic.frame(spark, "usr_user", [])
    assert write_report({"users": empty}, str(tmp_path / "r")) == {"users": 0}
    assert spark.read.parquet(f"{tmp_path}/r/sheet=users").columns == empty.columns


def test_threshold_sheets_and_period_folders(spark, tmp_path):
    registered = [clinic.registration("a", n, f"2021-03-0{n}") for n in (1, 2, 3)]
    tables = {
        "usr_doctor_user_rel": clinic.frame(spark, "usr_doctor_user_rel", registered),
        "sec_app_doctor": clinic.frame(spark, "sec_app_doctor", [clinic.doctor("a", "Ada")]),
        "usr_user": clinic.frame(spark, "usr_user", [clinic.user(n) for n in (1, 2, 3)]),
    }
    period = Period.of("2021-03-01", "2021-03-31")
    base = str(tmp_path / "threshold")
    rows = write_report(threshold.threshold_sheets(tables, threshold.Threshold(2, period, 7)), base)
    assert rows == {"reached": 1, "summary": 1, "detail": 3}
    summary = spark.read.parquet(f"{base}/sheet=summary")
    assert "doctor_id" not in summary.columns
    assert summary.first().reached_at == datetime(2021, 3, 2)
    write_report({"summary": period.stamp(summary)}, f"{base}-p", partition_by=["period_start", "period_end"])
    assert (tmp_path / "threshold-p/sheet=summary/period_start=2021-03-01/period_end=2021-03-31").is_dir()
    assert write_report(threshold.threshold_sheets(tables, threshold.Threshold(1, period, 7)), base)["detail"] == 3


def test_report_names_are_folder_names():
    assert report_path("/r/", "{level}-{grain}-payments", level="clinic", grain="day") == "/r/clinic-day-payments"
    with pytest.raises(ValueError):
        report_path("/r", "{name}", name="a/b")
