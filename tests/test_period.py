from datetime import date, datetime

import pytest

from tallyward.period import (
    Period,
    check_date,
    month_bounds,
    month_of_yesterday,
    period_for,
    rolling_week,
    week_bounds,
)


def test_check_date():
    assert check_date("2021-03-01") == date(2021, 3, 1)
    for bad in ("2021-3-1", "2021-03-01 00:00:00", "2021-13-01", "", "2021-03-01\n"):
        with pytest.raises(ValueError):
            check_date(bad)


def test_bounds():
    assert month_bounds(date(2020, 2, 2)) == (date(2020, 2, 1), date(2020, 2, 29))
    assert month_bounds(date(2021, 12, 31)) == (date(2021, 12, 1), date(2021, 12, 31))
    sunday, monday = date(2021, 4, 18), date(2021, 4, 19)
    assert week_bounds(sunday) == (date(2021, 4, 12), sunday)
    assert week_bounds(monday) == (monday, date(2021, 4, 25))
    assert week_bounds(date(2021, 4, 21), to_day=True) == (monday, date(2021, 4, 21))


@pytest.mark.parametrize(
    "grain,first", [("day", "2021-04-01"), ("month", "2021-04-01"), ("week", "2021-04-19"), ("year", "2021-01-01")]
)
def test_period_for(grain, first):
    period = period_for(grain, date(2021, 4, 21))
    assert period.start == datetime.fromisoformat(first)
    assert period.end == datetime(2021, 4, 21, 23, 59, 59)
    assert period.start_text == f"{first} 00:00:00"


def test_period_for_rejects_unknown_grain():
    with pytest.raises(ValueError):
        period_for("decade", date(2021, 4, 21))


def test_rolling_periods():
    week = rolling_week(date(2021, 4, 21))
    assert (week.start_text, week.end_text) == ("2021-04-15", "2021-04-22")
    month = month_of_yesterday(date(2021, 4, 1))
    assert (month.start_text, month.end_text) == ("2021-03-01", "2021-04-01")


def test_labels_keep_the_texts_given():
    period = Period.of("2021-04-19 08:00:00", "2021-04-20")
    assert period.label() == "[2021-04-19 08:00:00→2021-04-20]"
    assert period.label(ends="[)") == "[2021-04-19 08:00:00→2021-04-20)"
    with pytest.raises(ValueError):
        Period.of("2021-04-19", "2021-04-20", "][")


@pytest.mark.parametrize("ends,kept", [("[]", [1, 2, 3]), ("()", [2]), ("(]", [2, 3]), ("[)", [1, 2])])
def test_ends(spark, ends, kept):
    rows = [(1, datetime(2021, 3, 1)), (2, datetime(2021, 3, 2)), (3, datetime(2021, 3, 3)), (4, None)]
    df = spark.createDataFrame(rows, "n int, t timestamp_ntz")
    found = Period.of("2021-03-01", "2021-03-03", ends).restrict(df, "t")
    assert sorted(r.n for r in found.collect()) == kept
