"""Lists read back in the order they were written in."""

import pytest
from pyspark.sql import functions as F

from tallyward import Period
from tallyward.plans import orders
from tallyward.sources import ordered
from tallyward.sources.ordered import OrderedList, write_ordered
from tests.test_plans import plan

N = 20_000


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    rows = spark.range(N).selectExpr("id * 7919 % 20011 AS k", "CASE WHEN id % 5 > 0 THEN id % 7 END AS g", "concat('row ', id) AS `a b`")
    root = f"file://{tmp_path_factory.mktemp('lists')}/lists"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert write_ordered(rows, root, "list", [F.desc("g"), "k"]) == N
        assert write_ordered(rows.limit(0), root, "none", ["k"]) == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return root


def _wanted(spark):
    rows = [(i * 7919 % 20011, i % 7 if i % 5 else None, f"row {i}") for i in range(N)]
    return sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))


def test_order_over_several_files(spark, root):
    written = OrderedList(spark, root, "list")
    assert len(written.files) > 4 and written.rows == N
    frame = written.read()
    assert list(map(tuple, frame.collect())) == _wanted(spark)
    text = plan(frame, "simple")
    assert "Sort" not in text and "Exchange" not in text


def test_large_files_are_split_in_order(spark, root):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        frame = OrderedList(spark, root, "list").read()
        assert frame.rdd.getNumPartitions() > len(OrderedList(spark, root, "list").files)
        assert list(map(tuple, frame.collect())) == _wanted(spark)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize(("start", "stop"), [(0, 10), (2490, 2510), (19_990, 30_000), (0, N), (5, 5), (N, N + 1)])
def test_pages(spark, root, start, stop):
    written = OrderedList(spark, root, "list")
    page = written.page(start, stop)
    wanted = [(at, *row) for at, row in enumerate(_wanted(spark))][start:stop]
    assert list(map(tuple, page.collect())) == wanted
    assert plan(page, "simple").count("FileScan") == sum(b < stop and e > start for _, b, e in written.files if start < stop)


def test_positions(spark, root):
    frame = OrderedList(spark, root, "list").with_positions("at")
    got = {r["at"]: tuple(r)[1:] for r in frame.collect()}
    assert [got[k] for k in range(N)] == _wanted(spark)
    assert "Sort" not in plan(frame, "simple")


def test_empty_and_unknown_lists(spark, root, monkeypatch):
    none = OrderedList(spark, root, "none")
    assert none.read().collect() == [] and none.page(0, 5).collect() == [] and none.with_positions().collect() == []
    with pytest.raises(KeyError, match="no list"):
        OrderedList(spark, root, "other")
    monkeypatch.setattr(ordered, "MOST_FILES", 2)
    with pytest.raises(ValueError, match="too many"):
        OrderedList(spark, root, "list").read()


def test_report_keeps_its_order(spark, tmp_path):
    """The order list of a report, written and read back, row by row."""
    lines = spark.range(500).selectExpr(
        "id AS inquiry_ord_id", "CAST(id % 9 AS STRING) AS doctor_id", "id % 30 AS user_id", "concat('d', id % 9) AS doctor_name", "1 AS buy_type",
        "100 * id AS ord_amount", "2 AS ord_state", "1 AS pay_state", "0 AS abnormal_state",
        "timestamp_ntz '2021-03-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 20 AS INT)) AS create_date",
    )
    doctors = spark.range(9).selectExpr("CAST(id AS STRING) AS id", "'p' AS phone", "'x' AS department", "'100' AS binding_mechanism")
    users = spark.range(30).selectExpr("id AS user_id", "concat('u', id) AS user_name", "1 AS user_sex", "'b' AS bill_id")
    report = orders.inquiry_orders(lines, doctors, users, Period.of("2021-03-01", "2021-03-31"), "100")
    root = f"file://{tmp_path}/orders"
    numbered = report.withColumn("_n", F.monotonically_increasing_id())
    write_ordered(numbered, root, "orders", ["_n"])
    assert OrderedList(spark, root, "orders").read().drop("_n").collect() == report.collect()
