"""Commits that are seen as a whole, and kept daily sums."""

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyward import Period
from tallyward.plans import payments
from tallyward.sources.commits import commit_report, read_report, report_parts
from tallyward.sources.kept import KeptSums, days_of, whole_days
from tallyward.sources.versions import Versions
from tests import clinic


def _frame(spark, *values):
    return spark.createDataFrame([(k, f"text\n{v}") for k, v in enumerate(values)], "k int, v string")


def _values(df):
    return sorted(r.v for r in df.collect())


@pytest.fixture
def base(tmp_path):
    return f"file://{tmp_path}/report"


def test_nothing_is_seen_of_a_report_that_fails(spark, base):
    commit_report(spark, {"one": _frame(spark, "a"), "two": _frame(spark, "b")}, base)

    def broken(_):
        return _frame(spark, "new").withColumn("v", F.raise_error(F.lit("no sheet")).cast("string"))

    with pytest.raises(Exception, match="no sheet"):
        commit_report(spark, {"one": _frame(spark, "new"), "two": broken}, base)
    assert _values(read_report(spark, base, "one")) == ["text\na"]
    assert _values(read_report(spark, base, "two")) == ["text\nb"]
    assert Versions(spark, base).expire() == 2
    assert _values(read_report(spark, base, "two")) == ["text\nb"]


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_sheets_appear_together(spark, base, kind):
    sheets = {"list": _frame(spark, "a", "", "b\\n"), "sum": lambda done: done["list"].groupBy().agg(F.count("*").alias("n"))}
    assert commit_report(spark, sheets, base, kind) == {"list": 3, "sum": 1}
    assert _values(read_report(spark, base, "list")) == sorted(["text\na", "text\n", "text\nb\\n"])
    assert read_report(spark, base, "sum").first().n == 3
    with pytest.raises(KeyError, match="no sheet"):
        read_report(spark, base, "other")


def test_a_reader_keeps_what_it_opened(spark, base):
    commit_report(spark, {"one": _frame(spark, "old")}, base)
    opened = read_report(spark, base, "one")
    commit_report(spark, {"one": _frame(spark, "new")}, base)
    assert _values(opened) == ["text\nold"] and _values(read_report(spark, base, "one")) == ["text\nnew"]


def test_parts_are_replaced_one_by_one(spark, base):
    for month, value in (("03", "a"), ("04", "b"), ("03", "c")):
        commit_report(spark, {"one": _frame(spark, value)}, base, part={"month": month})
    assert _values(read_report(spark, base, "one")) == ["text\nb", "text\nc"]
    assert report_parts(spark, base, "one") == {'{"month": "03"}': 1, '{"month": "04"}': 1}
    commit_report(spark, {"one": _frame(spark).limit(0)}, base, part={"month": "03"})
    assert _values(read_report(spark, base, "one")) == ["text\nb"]
    commit_report(spark, {"one": _frame(spark, "whole")}, base)
    assert _values(read_report(spark, base, "one")) == ["text\nwhole"]
    with pytest.raises(ValueError, match="without parts"):
        commit_report(spark, {"one": _frame(spark, "x")}, base, part={"month": "05"})


def test_writers_at_once_all_count(spark, base):
    def add(name):
        Versions(spark, base).commit(lambda version: version | {name: 1})

    writers = [threading.Thread(target=add, args=(f"w{k}",)) for k in range(6)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert Versions(spark, base).current() == {f"w{k}": 1 for k in range(6)}


# --- kept daily sums --------------------------------------------------------------


def _tables(spark, rows):
    visits = [clinic.visit(1), clinic.visit(2, clinic=None), clinic.visit(3, clinic="South", doctor="Bo", depart="Ears")]
    pay = [clinic.payment(k, 1 + k % 4, 50 + 37 * k, method=(k % 3) or None, day=day) for k, day in rows]
    return clinic.frame(spark, "ord_pay", pay), clinic.frame(spark, "ord_registered", visits)


FIRST = [(k, f"2021-0{2 + k % 3}-{1 + k % 28:02d} 11:00:00") for k in range(150)]
LATE = [(200 + k, f"2021-03-{1 + k % 9:02d} 23:59:59") for k in range(20)]
NEXT = [(300 + k, f"2021-05-{1 + k % 5:02d} 00:00:00") for k in range(20)]
MARCH = Period.of("2021-03-01", "2021-03-31 23:59:59")
SPRING = Period.of("2021-02-10", "2021-05-03 23:59:59")


@pytest.mark.parametrize(("level", "grain"), [("clinic", "period"), ("doctor", "day"), ("department", "week")])
def test_batches_with_late_rows_equal_one_run(spark, base, level, grain):
    kept = payments.kept_payments(spark, base)
    kept.replace_days(payments.payment_rows(*_tables(spark, FIRST)))
    for known, batch in ((FIRST + LATE, LATE), (FIRST + LATE + NEXT, NEXT), (FIRST + LATE + NEXT, NEXT)):
        pay, visits = _tables(spark, known)
        days = days_of(_tables(spark, batch)[0].withColumn("day", F.to_date("create_date")), "day")
        kept.replace_days(payments.payment_rows(pay, visits), days)
    for period in (MARCH, SPRING):
        one = payments.payment_methods(pay, visits, period, level, grain)
        assert payments.payment_methods_kept(kept, period, level, grain).collect() == one.collect()


def test_only_touched_months_are_rewritten(spark, base):
    kept = payments.kept_payments(spark, base)
    assert kept.replace_days(payments.payment_rows(*_tables(spark, FIRST))) == 3
    before = kept.versions.current()["months"]
    assert kept.replace_days(payments.payment_rows(*_tables(spark, FIRST + LATE)), [date(2021, 3, 5)]) == 1
    after = kept.versions.current()["months"]
    assert [m for m in after if after[m] != before[m]] == ["2021-03"]
    assert kept.replace_days(payments.payment_rows(*_tables(spark, FIRST)), []) == 0


def test_a_day_without_rows_is_emptied(spark, base):
    kept = KeptSums(spark, base, ["g"], ["v"], "d")
    rows = spark.sql("SELECT * FROM VALUES ('a', 5, DATE '2021-03-01'), ('a', 7, DATE '2021-03-02'), ('b', 1, NULL) AS t(g, v, d)")
    kept.replace_days(rows)
    kept.replace_days(rows.filter("v = 5"), [date(2021, 3, 2)])
    assert [r.v for r in kept.read(MARCH).by(["g"]).finished(["g"], 1).collect()] == [5]
    assert kept.read(Period.of("2022-01-01", "2022-01-31 23:59:59")).by(["g"]).frame.isEmpty()
    kept.replace_days(rows.limit(0), [date(2021, 3, 1)])
    assert kept.read(MARCH).by(["g"]).frame.isEmpty()


def test_other_groups_and_cut_days_are_errors(spark, base):
    rows = spark.sql("SELECT 'a' AS g, 5 AS v, DATE '2021-03-01' AS d")
    with pytest.raises(ValueError, match="nothing is kept"):
        KeptSums(spark, base, ["g"], ["v"], "d").read(MARCH)
    KeptSums(spark, base, ["g"], ["v"], "d").replace_days(rows)
    with pytest.raises(ValueError, match="other groups"):
        KeptSums(spark, base, [], ["v"], "d").replace_days(rows)
    assert whole_days(Period.of("2021-03-01", "2021-04-01", "[)")) == (date(2021, 3, 1), date(2021, 3, 31))
    for start, end, ends in (("2021-03-01", "2021-03-31", "[]"), ("2021-03-01 01:00", "2021-04-01", "[)"), ("2021-03-01", "2021-04-01", "()")):
        with pytest.raises(ValueError, match="whole days"):
            whole_days(Period.of(start, end, ends))
