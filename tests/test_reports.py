from datetime import datetime
from decimal import Decimal

import pytest

from tallyward import Period
from tallyward.plans import activity, indicators, orders, payments, sheets, threshold
from tests import clinic

MARCH = Period.of("2021-03-01", "2021-03-31 23:59:59")


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- payments ---------------------------------------------------------------


@pytest.fixture(scope="module")
def paid(spark):
    pay = [
        clinic.payment(1, 1, 50, method=1),  # 0.005
        clinic.payment(2, 1, 50, method=2),  # 0.005
        clinic.payment(3, 2, 10_000, method=99),
        clinic.payment(4, 2, 10_000, method=None),
        clinic.payment(5, 3, 20_000, method=10, day="2021-03-01 00:00:00"),
        clinic.payment(6, 3, 20_000, method=10, day="2021-03-31 23:59:59"),
        clinic.payment(7, 3, 70_000, day="2021-04-01 00:00:00"),
        clinic.payment(8, 1, 70_000, state=2),
        clinic.payment(9, 1, 70_000, buy_type=2),
        clinic.payment(10, 404, 70_000),
    ]
    visits = [clinic.visit(1), clinic.visit(2), clinic.visit(3, clinic="South", doctor="Bo", depart="Ears")]
    return clinic.frame(spark, "ord_pay", pay), clinic.frame(spark, "ord_registered", visits)


def test_payment_methods_adds_rounded_sums(paid):
    north, south = rows(payments.payment_methods(*paid, MARCH, "clinic", "period"))
    assert north["hospital_name"] == "North"
    assert north["pay_amount"] == Decimal("2.02")
    assert (north["cash"], north["alipay"]) == (Decimal("0.01"), Decimal("0.01"))
    assert north["citizen_card"] == 0
    assert (south["citizen_card"], south["pay_amount"]) == (Decimal("4.00"), Decimal("4.00"))
    assert south["period_start"] == "2021-03-01"
    assert south["period_end"] == "2021-03-31 23:59:59"


def test_payment_methods_exact_rounds_once(paid):
    north, _ = rows(payments.payment_methods(*paid, MARCH, "clinic", "period", exact=True))
    assert north["pay_amount"] == Decimal("2.01")
    assert north["cash"] == Decimal("0.01")


def test_payment_methods_by_day_and_level(paid):
    by_day = rows(payments.payment_methods(*paid, MARCH, "doctor", "day"))
    assert [(r["hospital_name"], r["doctor_name"], str(r["pay_day"])) for r in by_day] == [
        ("North", "Ada", "2021-03-05"),
        ("South", "Bo", "2021-03-01"),
        ("South", "Bo", "2021-03-31"),
    ]
    assert rows(payments.payment_methods(*paid, MARCH, "科室", "week"))[1]["depart_name"] == "Ears"


def test_exact_totals_of_finer_groups_add_up(paid):
    total = lambda level, grain: sum(
        r["pay_amount"] for r in rows(payments.payment_methods(*paid, MARCH, level, grain, exact=True))
    )
    assert total("clinic", "period") == total("doctor", "day")


def test_unknown_level_or_grain(paid):
    with pytest.raises(ValueError):
        payments.payment_methods(*paid, MARCH, "ward")
    with pytest.raises(ValueError):
        payments.payment_methods(*paid, MARCH, "clinic", "hour")


def test_charge_categories(spark, paid):
    classify = clinic.frame(spark, "ord_pay_classify", [clinic.charges(n, n * 10_000) for n in range(1, 8)])
    found = rows(payments.charge_categories(classify, *paid, MARCH, "clinic", "day"))
    assert [(r["hospital_name"], str(r["pay_day"])) for r in found] == [
        ("North", "2021-03-05"),
        ("South", "2021-03-31"),
        ("South", "2021-03-01"),
    ]
    assert found[0]["registered_fee"] == found[0]["diagnosis_fee"] == Decimal(10)
    assert len(found[0]) == 2 + 20 + 2


def test_money_sums_are_exact_and_refuse_floats(spark, paid):
    big = 2**62
    pay = [clinic.payment(n, 1, sign * big + 1) for n, sign in enumerate((1, 1, 1, -1), 1)]
    wide = rows(payments.payment_methods(clinic.frame(spark, "ord_pay", pay), paid[1], MARCH, "clinic", "period"))
    assert wide[0]["pay_amount"] == (Decimal(2 * big + 4) / 10_000).quantize(Decimal("0.01"))
    floats = paid[0].withColumn("pay_amount", paid[0]["pay_amount"].cast("double"))
    with pytest.raises(TypeError):
        payments.payment_methods(floats, paid[1], MARCH)


def test_sheet_by_method(spark):
    sheet = spark.createDataFrame(
        [("N", "cash", Decimal("1.50")), ("N", "odd", Decimal("2.00")), ("S", "cash", None)],
        "clinic string, method string, paid decimal(18,2)",
    )
    columns = {"cash": "cash", "card": "card"}
    found = {r["clinic"]: r for r in rows(payments.sheet_by_method(sheet, columns, "clinic", "method", "paid"))}
    assert (found["N"]["paid"], found["N"]["cash"], found["N"]["card"]) == (Decimal("3.50"), Decimal("1.50"), 0)
    assert found["S"]["cash"] == 0


# --- visits, income and cost ----------------------------------------------------


def test_visit_indicators(spark):
    visits = clinic.frame(
        spark,
        "ord_registered",
        [
            clinic.visit(1),
            clinic.visit(2, registered_type=2, user_id=1),
            clinic.visit(3, user_id=3),
            clinic.visit(4, state=4),
            clinic.visit(5, registered_type=3),
            clinic.visit(6, hospital_id=2),
            clinic.visit(7, create_date=clinic.at("2021-03-01 00:00:00"), doctor="Bo"),
            clinic.visit(8, create_date=clinic.at("2021-04-01 00:00:00"), doctor="Bo", registered_type=2),
        ],
    )
    closed = Period.of("2021-03-01", "2021-04-01")
    april, march_ada, march_bo = rows(indicators.visit_indicators(visits, closed, "doctor", [1]))
    assert april["month"] == "2021-04" and april["return_rate"] == "100.00%"
    assert march_ada["doctor_name"] == "Ada"
    assert (march_ada["visits"], march_ada["return_visits"], march_ada["patients"]) == (3, 1, 2)
    assert march_ada["return_rate"] == "33.33%"
    assert march_ada["visits_per_patient"] == Decimal("1.50")
    assert march_bo["return_rate"] == "0.00%"
    assert rows(indicators.visit_indicators(visits, closed, "consultant"))[0]["consultants_name"] == "Cy"


@pytest.fixture(scope="module")
def fee_tables(spark):
    lines = [
        clinic.fee(1, (1, None, None), 12_500, 37_500),  # 0.125 and 0.375
        clinic.fee(1, (5, 12, 4), 100_000, 50_000),
        clinic.fee(1, (15, None, None), 300_000, 100_000),
        clinic.fee(1, (77, 1, 1), 1_000_000, 200_000),  # no category
        clinic.fee(1, (5, 12, 6), 400_000, 100_000),  # a category that is not shown
        clinic.fee(1, (1, None, None), 9_900_000, 0, pay_state=1),
        clinic.fee(2, (1, None, None), 9_900_000, 0),
        clinic.fee(3, (1, None, None), 9_900_000, 0),
    ]
    pay = [
        clinic.payment(1, 1, 0),
        clinic.payment(2, 1, 0, day="2021-03-01 00:00:00"),  # on the open start
        clinic.payment(3, 1, 0, hospital_id=2),
    ]
    return (
        clinic.frame(spark, "ord_fee_detail", lines),
        clinic.frame(spark, "ord_pay", pay),
        clinic.frame(spark, "sec_hospital", [{"hospital_id": 1, "hospital_name": "North"}]),
    )


def test_income_cost(fee_tables):
    (found,) = rows(indicators.income_cost(*fee_tables, MARCH, clinics=[1]))
    assert (found["registered_fee"], found["registered_cost"]) == (Decimal("0.12"), Decimal("0.38"))
    assert (found["material_fee"], found["material_cost"]) == (Decimal("1.00"), Decimal("0.50"))
    assert (found["other_fee"], found["other_cost"]) == (Decimal("3.00"), Decimal("1.00"))
    assert found["total_price"] == Decimal("18.12")
    assert found["gross_profit"] == found["total_price"] - found["total_cost_price"]
    assert found["month"] == "2021-03"
    assert len(found) == 30


def test_income_cost_parity(fee_tables):
    (found,) = rows(indicators.income_cost(*fee_tables, MARCH, clinics=[1], parity=True))
    assert found["other_cost"] == found["other_fee"] == Decimal("3.00")


def test_merged_sources(spark, fee_tables):
    tables = {
        "ord_registered": clinic.frame(
            spark,
            "ord_registered",
            [clinic.visit(1), clinic.visit(2), clinic.visit(3, doctor="Bo"), clinic.visit(4, hospital_id=2)],
        ),
        "ord_fee_detail": fee_tables[0],
        "ord_pay": fee_tables[1],
        "sec_hospital": fee_tables[2],
    }
    found = rows(
        indicators.merged_sources({"main": tables, "second": tables}, MARCH, clinics={"main": [1], "second": [2]})
    )
    by_visits = {r["visits"]: r for r in found}
    assert by_visits.keys() == {2, 1}  # Bo has visits but no fees
    assert by_visits[2]["average_ticket"] == Decimal("9.06")
    assert "total_cost_price" not in by_visits[2]
    sheets_ = indicators.summary_sheets({"main": tables}, MARCH)
    assert list(sheets_) == ["doctor", "consultant"]


def test_merge_indicators_lets_null_meet_null(spark):
    visits = clinic.frame(spark, "ord_registered", [clinic.visit(1, doctor=None)])
    lines = clinic.frame(spark, "ord_fee_detail", [clinic.fee(1, (1, None, None), 100_000, 0)])
    pay = clinic.frame(spark, "ord_pay", [clinic.payment(1, 1, 0, doctor_name=None)])
    hospital = clinic.frame(spark, "sec_hospital", [{"hospital_id": 1, "hospital_name": "North"}])
    (found,) = rows(
        indicators.merge_indicators(
            indicators.visit_indicators(visits, MARCH), indicators.income_cost(lines, pay, hospital, MARCH)
        )
    )
    assert found["doctor_name"] is None and found["average_ticket"] == Decimal("1.00")


# --- order lists -------------------------------------------------------------------


def test_inquiry_orders(spark):
    base = {"doctor_id": "a", "user_id": 1, "doctor_name": "Ada", "ord_amount": 12_345}
    moments = ["2021-03-01 00:00:00", "2021-03-01 00:00:01", "2021-04-01 00:00:00", "2021-04-01 00:00:01"]
    listed = [
        {**base, "inquiry_ord_id": n, "buy_type": 10 + n % 2, "create_date": clinic.at(m)}
        for n, m in enumerate(moments, 1)
    ]
    listed[1] |= {"ord_state": 11, "pay_state": None, "abnormal_state": 0}
    listed[2] |= {"ord_state": 99, "pay_state": 5, "abnormal_state": 3}
    listed.append({**listed[1], "inquiry_ord_id": 9, "doctor_id": "b"})
    inquiries = clinic.frame(spark, "ord_inquiry", listed)
    doctors = clinic.frame(spark, "sec_app_doctor", [clinic.doctor("a", "Ada"), clinic.doctor("b", "Bo", "200")])
    users = clinic.frame(spark, "usr_user", [clinic.user(1)])
    spring = Period.of("2021-03-01", "2021-04-01")
    found = orders.inquiry_orders(inquiries, doctors, users, spring, "100")
    third, second = rows(found)
    assert (third["inquiry_ord_id"], second["inquiry_ord_id"]) == (3, 2)
    assert second["amount"] == Decimal("1.23")
    assert (second["inquiry_type"], third["inquiry_type"]) == ("图文问诊", "电话问诊")
    assert (second["ord_state"], third["ord_state"]) == ("待回复", "###")
    assert (second["pay_state"], third["pay_state"]) == ("待支付", "已退款")
    assert (second["abnormal_state"], third["abnormal_state"]) == ("正常", "异常")
    sums = rows(orders.order_sums(found, orders.INQUIRY_GROUP))
    assert [r["total_amount"] for r in sums] == [Decimal("1.23"), Decimal("1.23")]
    nothing = orders.inquiry_orders(inquiries, doctors, users, spring, "no such")
    assert rows(nothing) == [] and nothing.columns == found.columns


def test_online_orders(spark):
    base = {"doctor_id": "a", "user_id": 1, "user_name": "p", "doctor_name": "Ada", "total_price": 10_050}
    online = clinic.frame(
        spark,
        "ord_mobile_medical",
        [
            {**base, "inquiry_ord_id": 1, "create_date": clinic.at("2021-03-01 00:00:00")},
            {**base, "inquiry_ord_id": 2, "create_date": clinic.at("2021-03-02 00:00:00"), "ord_state": 4},
            {**base, "inquiry_ord_id": 3, "create_date": clinic.at("2021-03-03 00:00:00"), "pay_state": 1},
            {**base, "inquiry_ord_id": 4, "create_date": clinic.at("2021-04-01 00:00:00")},
            {**base, "inquiry_ord_id": 5, "create_date": clinic.at("2021-03-02 00:00:00"), "doctor_id": "b"},
            {**base, "inquiry_ord_id": 6, "create_date": clinic.at("2021-03-02 00:00:00"), "doctor_id": "c"},
        ],
    )
    doctors = clinic.frame(
        spark, "sec_app_doctor", [clinic.doctor("a", "Ada"), clinic.doctor("b", "Bo", "200"), clinic.doctor("c", "Cy", None)]
    )
    users = clinic.frame(spark, "usr_user", [clinic.user(1)])
    found = orders.online_orders(online, doctors, users, Period.of("2021-03-01", "2021-04-01"), "200")
    assert [r["inquiry_ord_id"] for r in rows(found)] == [6, 3, 2]
    sums = rows(orders.order_sums(found, orders.ONLINE_GROUP))
    assert [(r["pay_state"], r["total_amount"]) for r in sums] == [("待支付", Decimal("2.02")), ("支付完成", Decimal("1.01"))]


# --- doctors ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def activity_tables(spark):
    doctors = [
        clinic.doctor("a", "Ada"),
        clinic.doctor("b", "Bo"),
        clinic.doctor("c", "Cy", recommend_id=None),
        clinic.doctor("d", "Di", "999"),
    ]
    followers = [
        {"doctor_id": "a", "account_id": n, "state": s, "create_date": clinic.at(d)}
        for n, s, d in ((1, 1, "2021-03-01"), (1, 1, "2021-03-05"), (2, 1, "2021-02-01"), (3, 0, "2021-03-05"))
    ]
    registered = [clinic.registration(d, 1, "2021-03-05") for d in ("a", "b", "b")]
    inquiries = [{"inquiry_ord_id": 1, "doctor_id": "b", "create_date": clinic.at("2021-03-05")}]
    recipes = [
        {"doctor_id": "a", "pay_state": p, "pay_type": k, "state": s, "create_date": clinic.at("2021-03-05")}
        for p, k, s in ((1, 1, 1), (1, 2, 1), (0, 2, 1), (1, 2, 0))
    ]
    return [
        clinic.frame(spark, name, data)
        for name, data in (
            ("sec_app_doctor", doctors),
            ("usr_doctor_account_rel", followers),
            ("usr_doctor_user_rel", registered),
            ("ord_inquiry", inquiries),
            ("ord_mobile_prescription", recipes),
            ("sec_recommend", [{"recommend_id": 1, "name": "Eve Stone"}]),
        )
    ]


def test_doctor_activity(activity_tables):
    found = {r["doctor_name"]: r for r in rows(activity.doctor_activity(*activity_tables, MARCH, "999"))}
    assert found.keys() == {"Ada", "Bo", "Cy"}
    assert (found["Ada"]["followers"], found["Ada"]["new_followers"]) == (2, 2)
    assert (found["Ada"]["new_prescriptions"], found["Ada"]["online_paid"], found["Ada"]["offline_paid"]) == (3, 1, 1)
    assert (found["Bo"]["registrations"], found["Bo"]["new_registrations"], found["Bo"]["new_inquiries"]) == (1, 2, 1)
    assert found["Cy"]["referrer_name"] is None and found["Cy"]["new_inquiries"] == 0


def test_doctor_activity_by_referrer_and_parity(activity_tables):
    found = rows(activity.doctor_activity(*activity_tables, MARCH, "999", ["Stone", "Nobody"], parity=True))
    assert [r["doctor_name"] for r in found] == ["Ada", "Bo"]
    assert (found[1]["registrations"], found[1]["new_inquiries"]) == (0, 0)


@pytest.fixture(scope="module")
def threshold_tables(spark):
    days = {
        "a": ["2021-03-01", "2021-03-02", "2021-03-02", "2021-03-03"],
        "b": ["2021-03-05", "2021-03-06"],
        "c": ["2021-03-07"],
        "x": ["2021-03-08", "2021-03-09"],  # not in the doctor table
    }
    registered = [clinic.registration(d, n, day) for d, listed in days.items() for n, day in enumerate(listed, 1)]
    registered.append(clinic.registration("c", 5, "2021-03-08", state=0))
    registered.append(clinic.registration("c", 6, "2021-03-08", brand_id=8))
    return {
        "usr_doctor_user_rel": clinic.frame(spark, "usr_doctor_user_rel", registered),
        "sec_app_doctor": clinic.frame(
            spark, "sec_app_doctor", [clinic.doctor("a", "Ada"), clinic.doctor("b", "Bo"), clinic.doctor("c", "Bo")]
        ),
        "usr_user": clinic.frame(spark, "usr_user", [clinic.user(n, sex=n % 2) for n in range(1, 7)]),
    }


def test_nth_registration(threshold_tables):
    t = threshold_tables
    second = threshold.Threshold(2, MARCH, 7)
    found = rows(threshold.nth_registration(t["usr_doctor_user_rel"], t["sec_app_doctor"], second))
    assert [(r["doctor_id"], r["registrations"], r["reached_at"]) for r in found] == [
        ("a", 4, datetime(2021, 3, 2)),
        ("b", 2, datetime(2021, 3, 6)),
    ]
    assert found[0]["interval"] == "[2021-03-01→2021-03-31 23:59:59]"
    counts = rows(
        threshold.registration_counts(t["usr_doctor_user_rel"], t["sec_app_doctor"], threshold.Threshold(1, MARCH, 7), parity=True)
    )
    assert [(r["doctor_id"], r["registrations"]) for r in counts] == [("a", 4), ("b", 2), ("c", 1)]
    assert counts[0]["interval"].endswith(")")
    with pytest.raises(ValueError):
        threshold.Threshold(0, MARCH, 7)


def test_registration_detail(threshold_tables):
    t = threshold_tables
    wanted = threshold.Threshold(1, MARCH, 7)
    counts = threshold.registration_counts(t["usr_doctor_user_rel"], t["sec_app_doctor"], wanted)
    detail = lambda ids: threshold.registration_detail(
        t["usr_doctor_user_rel"], t["usr_user"], t["sec_app_doctor"], ids, wanted
    )
    found = rows(detail(counts))
    assert len(found) == 8  # the void registration of c counts here
    assert [r["doctor_name"] for r in found[:4]] == ["Ada"] * 4
    assert found[0]["registered_at"] == datetime(2021, 3, 3)
    assert {r["sex"] for r in found} == {"男", "女"}
    assert rows(detail(counts.limit(0))) == []


def test_dense_nth_registration(threshold_tables):
    t = threshold_tables
    find = lambda n: rows(
        threshold.dense_nth_registration(
            t["usr_doctor_user_rel"], t["sec_app_doctor"], threshold.Threshold(n, MARCH, 7)
        )
    )
    second = [(r["doctor_name"], r["reached_at"]) for r in find(2)]
    # both tied rows of Ada, and Bo's second time; the other Bo has too few registrations
    assert second == [("Ada", datetime(2021, 3, 2))] * 2 + [("Bo", datetime(2021, 3, 6))]
    # two doctors of one name are ranked together
    assert [(r["doctor_name"], r["reached_at"].day) for r in find(1)] == [("Ada", 1), ("Bo", 5)]
    # four registrations at three distinct times never reach a fourth time
    assert find(4) == []


# --- sheets -----------------------------------------------------------------------------


def test_filter_places(spark):
    places = spark.createDataFrame(
        [("甲齿科", "北京"), ("乙诊所", "昆山市"), ("丙诊所", None), (None, "北京")], "`名称` string, `地址` string"
    )
    assert [tuple(r) for r in sheets.filter_places(places).collect()] == [("丙诊所", None), (None, "北京")]


def test_profile(spark):
    columns = sheets.PROFILE_COLUMNS
    profile = spark.createDataFrame([tuple(range(30)), tuple(range(100, 130))], [*reversed(columns)])
    assert sheets.reorder_profile(profile.withColumn("extra", profile["`年`"])).columns == list(columns)
    pairs = [tuple(r) for r in sheets.profile_head(profile, ["年"]).collect()]
    assert pairs == [(c, str(29 - i)) for i, c in enumerate(columns)]
