"""Partial sums: below joins, over grouping sets, merged again."""

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyward import Period
from tallyward.operators.packed import Packing
from tallyward.operators.partials import SET, Partials, shrinks
from tallyward.plans import payments
from tests import clinic
from tests.test_plans import plan
from workload.queries import registry

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="the given tables are not here")
MARCH = Period.of("2021-03-01", "2021-03-31 23:59:59")


@pytest.fixture(scope="module")
def tables(spark):
    """Payments with null names, null methods, several days and amounts whose sums round either way."""
    pay = [
        clinic.payment(k, k % 7, 50 + 33 * k, method=(k % 4) or None, day=f"2021-03-0{1 + k % 5} 10:00:00") for k in range(120)
    ]
    visits = [clinic.visit(k, clinic=[None, "North", "South"][k % 3], doctor=["Ada", None][k % 2], depart=["Eyes", None][k // 4]) for k in range(6)]
    classify = [clinic.charges(k % 100, 50 + 17 * k) for k in range(400)] + [clinic.charges(None, 5)]
    return tuple(
        clinic.frame(spark, name, rows) for name, rows in (("ord_pay_classify", classify), ("ord_pay", pay), ("ord_registered", visits))
    )


def _told(df, names):
    return sorted(map(repr, df.select(*names).collect()))


@pytest.mark.parametrize("level", ["clinic", "department", "doctor"])
@pytest.mark.parametrize("grain", ["day", "period"])
def test_levels_equal_the_single_reports(tables, level, grain):
    classify, pay, visits = tables
    for one, many in (
        (payments.payment_methods(pay, visits, MARCH, level, grain), payments.payment_methods_at(pay, visits, MARCH)),
        (payments.charge_categories(classify, pay, visits, MARCH, level, grain), payments.charge_categories_at(classify, pay, visits, MARCH)),
    ):
        of_level = many.filter((F.col("level") == level) & (F.col("grain") == grain))
        assert _told(of_level, one.columns) == _told(one, one.columns)
        absent = [c for c in ("depart_name", "doctor_name", "pay_day") if c not in one.columns]
        assert all(of_level.filter(F.col(c).isNotNull()).isEmpty() for c in absent)


def test_chosen_levels(tables):
    classify, pay, visits = tables
    some = payments.payment_methods_at(pay, visits, MARCH, ["门诊", "clinic"], ["week", "period"], ordered=False)
    assert {(r.level, r.grain) for r in some.collect()} == {("clinic", "period")}
    assert "doctor_name" not in some.columns
    with pytest.raises(ValueError):
        payments.payment_methods_at(pay, visits, MARCH, ["ward"])


def test_grouping_sets_keep_null_keys_apart(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, 5), (NULL, 1, 7), (NULL, NULL, 11) AS t(g, h, v)")
    sums = Partials.of(df, ["g", "h"], ["v"]).over({"both": ["g", "h"], "g": ["g"], "all": []}).finished([SET, "g", "h"], Decimal(1))
    assert sorted(map(tuple, sums.collect()), key=repr) == sorted(
        [
            ("both", "a", 1, 5), ("both", None, 1, 7), ("both", None, None, 11),
            ("g", "a", None, 5), ("g", None, None, 18), ("all", None, None, 23),
        ],
        key=repr,
    )
    with pytest.raises(ValueError, match="same keys"):
        Partials.of(df, ["g", "h"], ["v"]).over({"x": ["g", "h"], "y": ["h", "g"]})


def test_sums_of_sums_are_exact(spark):
    """Amounts near 2^43 and below zero, regrouped twice."""
    df = spark.range(1000).selectExpr("id % 10 AS a", "id % 5 AS b", "8796093022207 - id * 17592186044414 % 9007199254740881 AS v")
    total = sum(r.v for r in df.collect())
    (found,) = Partials.of(df, ["a", "b"], ["v"]).by(["b"]).by([]).finished([], Decimal(1)).collect()
    assert found.v == total


@given
@pytest.mark.parametrize("name", ["pay_method_levels", "charge_category_levels"])
def test_all_levels_from_one_scan(spark, name):
    text = plan(registry()[name](spark, SF_DIR))
    for table in ("orders", "customer", *(["lineitem"] if name.startswith("charge") else [])):
        assert text.count(f"/{table}.parquet]") == 1
    assert text.count("Expand") > 0


@given
def test_fees_are_summed_before_they_are_shuffled(spark):
    """Below the exchange of the wide side stands the partial sum per payment, and the join needs no other one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(registry()["charge_category_clinic_period"](spark, SF_DIR), "simple").splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    at = next(i for i, line in enumerate(text) if "l_orderkey" in line and "FileScan" in line)
    above = [line for line in text[:at] if "keys=[pay_order_id" in line or "hashpartitioning(pay_order_id" in line]
    kinds = ["Exchange" if "Exchange" in line else "partial" if "partial_sum" in line else "final" for line in above]
    assert kinds[-3:] == ["final", "Exchange", "partial"]


def _scattered(spark, payments_=50, copies=4):
    """Classified rows of which no two of one payment are read by the same task."""
    rows = [clinic.charges(k, 50 + 17 * k + i) for i in range(copies) for k in range(payments_)]
    return clinic.frame(spark, "ord_pay_classify", rows)


def test_scattered_payments_travel_packed(spark, tables):
    """Sums per payment would not shrink the rows of a task: none are held there, and the shuffle carries words."""
    _, pay, visits = tables
    classify = _scattered(spark)
    assert not shrinks(classify, ["pay_order_id"]) and shrinks(classify.coalesce(1), ["pay_order_id"])
    for scattered, together in (
        (payments.charge_categories(classify, pay, visits, MARCH), payments.charge_categories(classify.coalesce(1), pay, visits, MARCH)),
        (payments.charge_categories_at(classify, pay, visits, MARCH), payments.charge_categories_at(classify.coalesce(1), pay, visits, MARCH)),
    ):
        text = plan(scattered, "simple")
        assert "_word0" in text and "keys=[pay_order_id" not in text
        assert "keys=[pay_order_id" in plan(together, "simple")
        assert scattered.count() > 0 and scattered.schema == together.schema
        assert sorted(map(repr, scattered.collect())) == sorted(map(repr, together.collect()))


def test_packed_columns_come_back(spark):
    """Null as 0, values below zero, one value only, decimals, and ranges up to all of 64 bits."""
    top = 2**63 - 1
    rows = [
        (1, -5, None, 7, Decimal("1.25"), top, 3 * 2**40, None),
        (2, 250, 1, 7, None, -top - 1, -(2**40), None),
        (None, 0, None, 7, Decimal("-3.00"), None, 12345678901, None),
    ]
    kinds = "k INT, a INT, b SMALLINT, c BIGINT, d DECIMAL(9,2), e BIGINT, f BIGINT, g BIGINT"
    df = spark.createDataFrame(rows, kinds)
    packing = Packing.of(df, list("abcdefg"))
    assert packing.plain == ("d",) and len(packing.words) == 2
    back = packing.unpack(packing.pack(df, ["k"]), ["k"])
    told = {r.k: r.asDict() for r in back.collect()}
    assert told == {r[0]: {"k": r[0]} | {c: v if c == "d" else v or 0 for c, v in zip("abcdefg", r[1:])} for r in rows}
    none = Packing.of(df.limit(0), list("abcdefg"))
    assert none.words == [] and none.unpack(none.pack(df.limit(0), ["k"]), ["k"]).collect() == []


def test_small_sums_need_one_long(spark):
    df = spark.range(10).selectExpr("id % 2 AS a", "id AS v")
    narrow, wide = Partials.of(df, ["a"], ["v"], 90), Partials.of(df, ["a"], ["v"], 2**59)
    assert narrow.parts == ["v__sum"] and wide.parts == ["v__high", "v__low"]
    assert sorted(narrow.finished(["a"]).collect()) == sorted(wide.finished(["a"]).collect())
