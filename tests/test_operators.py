import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyward.functions import calendar as cal
from tallyward.functions.labels import PAY_METHOD_LABELS, decode
from tallyward.functions.money import measure, ratio, ratio_even, scaled
from tallyward.functions.text import commonest_char, contains_any, matches
from tallyward.operators import aggregates, frames, joins, windows


def tuples(df):
    return [tuple(r) for r in df.collect()]


# --- windows --------------------------------------------------------------------


@pytest.fixture(scope="module")
def events(spark):
    draw = random.Random(7)
    start = datetime(2024, 3, 30, 22)
    rows = [(draw.choice("aaaabbc"), start + timedelta(seconds=draw.randrange(0, 200_000, 50))) for _ in range(3000)]
    rows += [("tied", start)] * 40 + [(None, start + timedelta(hours=h)) for h in range(60)]
    rows += [("a", None), ("late", start + timedelta(days=3))]
    return rows, spark.createDataFrame(rows, "who string, t timestamp_ntz").repartition(5)


def expected_nth(rows, n):
    times = {}
    for who, t in rows:
        if t is not None:
            times.setdefault(who, []).append(t)
    return {(who, sorted(ts)[n - 1]) for who, ts in times.items() if len(ts) >= n}


@pytest.mark.parametrize("n", [1, 2, 20, 41, 500])
def test_nth_event(events, n):
    assert set(tuples(windows.nth_event(events[1], ["who"], "t", n))) == expected_nth(events[0], n)


def test_nth_event_with_total(events):
    counts = Counter(who for who, t in events[0] if t is not None)
    found = windows.nth_event(events[1], ["who"], "t", 20, total="all").collect()
    assert {(r.who, r.t) for r in found} == expected_nth(events[0], 20)
    assert all(r["all"] == counts[r.who] for r in found)


def test_nth_event_equals_the_shift_form(events):
    import pandas as pd

    frame = pd.DataFrame(events[0], columns=["who", "t"]).dropna().sort_values("t", kind="stable")
    shifted = frame.groupby("who")["t"].shift(19)
    first = frame.loc[shifted.dropna().index].groupby("who")["t"].min()
    found = {who: t for who, t in tuples(windows.nth_event(events[1], ["who"], "t", 20)) if who is not None}
    assert found == {who: t.to_pydatetime() for who, t in first.items()}


@pytest.mark.parametrize("n", [1, 3, 30])
def test_dense_nth_keeps_ties(events, n):
    rows = [r for r in events[0] if r[1] is not None]
    counts = Counter(rows)
    distinct = {}
    for who, t in counts:
        distinct.setdefault(who, []).append(t)
    expected = Counter()
    for who, ts in distinct.items():
        if len(ts) >= n:
            hit = (who, sorted(ts)[n - 1])
            expected[hit] = counts[hit]
    counted = windows.time_counts(events[1].dropna(subset=["t"]), ["who"], "t")
    hits = windows.dense_nth(counted, ["who"], "t", n)
    assert Counter(tuples(windows.repeat_rows(hits, "ties"))) == expected


def test_n_must_be_positive(events):
    for find in (windows.nth_event, windows.dense_nth):
        with pytest.raises(ValueError):
            find(events[1], ["who"], "t", 0)


def test_repeat_rows_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(windows, "_REPEAT_CHUNK", 10)
    df = spark.createDataFrame([("a", 25), ("b", 10), ("c", 1), ("d", 0)], "k string, n bigint")
    assert Counter(r.k for r in windows.repeat_rows(df, "n").collect()) == {"a": 25, "b": 10, "c": 1}


def test_top_k(spark):
    df = spark.createDataFrame([("x", 5, 2), ("x", 5, 1), ("x", 9, 3), ("y", 1, 4)], "g string, p int, seq int")
    assert [r.seq for r in windows.top_k(df, "p", "seq", 3).collect()] == [3, 1, 2]
    ranked = windows.top_k_per_group(df, ["g"], "p", "seq", 2).collect()
    assert sorted((r.g, r["rank"], r.seq) for r in ranked) == [("x", 1, 3), ("x", 2, 1), ("y", 1, 4)]


@pytest.mark.parametrize("k", [3, 1500])
def test_top_k_of_a_hot_group(spark, k):
    df = spark.range(0, 9000, 1, 8).selectExpr("CASE WHEN id % 3 < 2 THEN 0 ELSE id % 50 END AS g", "id * 7919 % 1000 AS p", "id AS seq")
    by_group = {}
    for r in df.collect():
        by_group.setdefault(r.g, []).append((-r.p, r.seq))
    got = {}
    for r in windows.top_k_per_group(df, ["g"], "p", "seq", k).collect():
        got.setdefault(r.g, {})[r["rank"]] = r.seq
    for g, rows in by_group.items():
        assert got[g] == {n: seq for n, (_, seq) in enumerate(sorted(rows)[:k], start=1)}


# --- sums --------------------------------------------------------------------------


def test_rule_sums(spark):
    rows = [(1, 10, 4, 7, 5), (1, None, None, 1, 1), (2, 10, 4, 100, 50), (3, 1, 1, 1000, 0)]
    df = spark.createDataFrame([("g", *r) for r in rows], "k string, a int, b int, c int, fee bigint, cost bigint")
    rules = {"one": {"a": 1}, "two": {"a": 2, "b": 10, "c": 4}, "never": {"a": 9}}
    (found,) = aggregates.rule_sums(df, ["k"], rules, {"fee": "fee", "cost": "cost"}).collect()
    assert (found.one_fee, found.one_cost, found.two_fee, found.never_fee) == (8, 6, 100, 0)
    assert (found.fee, found.cost) == (1108, 56)
    with pytest.raises(ValueError):
        aggregates.rule_sums(df, ["k"], {"one": {"a": 1}, "both": {"a": 1, "b": 10}}, {"fee": "fee"})


def test_spread_equals_pivot(spark):
    draw = random.Random(3)
    rows = [(draw.choice("NS"), draw.choice(["cash", "card", "odd"]), Decimal(draw.randrange(10**6)) / 100) for _ in range(500)]
    df = spark.createDataFrame(rows, "clinic string, method string, paid decimal(18,2)")
    values = ["cash", "card", "never"]
    ours = aggregates.spread(df, ["clinic"], "method", {v: v for v in values}, "paid", ["paid"]).drop("paid")
    pivot = df.groupBy("clinic").pivot("method", values).agg(F.sum("paid")).fillna(0)
    assert sorted(tuples(ours)) == sorted(tuples(pivot))


def test_sums_of_extreme_whole_numbers(spark):
    draw = random.Random(5)
    values = [draw.randrange(-(2**63), 2**63) for _ in range(200)] + [2**63 - 1, -(2**63), -1, 0]
    df = spark.createDataFrame([("g", v) for v in values], "k string, v bigint")
    (found,) = aggregates.scaled_sums(df, ["k"], ["v"], unit=Decimal(1)).collect()
    assert found.v == sum(values)


def test_rounding_rules(spark):
    df = spark.createDataFrame([(12_500,), (37_500,), (-12_500,), (None,)], "v bigint")
    unit = Decimal("0.00001")
    up, even = (tuples(df.select(scaled(df, "v", unit, rule))) for rule in ("round", "bround"))
    assert [r[0] for r in up] == [Decimal("0.13"), Decimal("0.38"), Decimal("-0.13"), 0]
    assert [r[0] for r in even] == [Decimal("0.12"), Decimal("0.38"), Decimal("-0.12"), 0]
    with pytest.raises(TypeError):
        measure(df.selectExpr("CAST(v AS DOUBLE) AS v"), "v")


def test_ratios(spark):
    df = spark.createDataFrame([(2, 3), (1, 0), (201, 200)], "a bigint, b bigint")
    found = tuples(df.select(ratio("a", "b"), ratio("a", "b", 2), ratio_even("a", "b")))
    assert found[0] == (Decimal("0.6667"), Decimal("0.67"), Decimal("0.67"))
    assert found[1] == (0, 0, 0)
    assert found[2][1:] == (Decimal("1.01"), Decimal("1.00"))


# --- joins --------------------------------------------------------------------------


@pytest.mark.parametrize("listed", [[2, 2, 3], [2, None], []])
def test_not_in_follows_sql(spark, listed):
    spark.createDataFrame([(1,), (2,), (None,)], "k int").createOrReplaceTempView("left_rows")
    ids = spark.createDataFrame([(v,) for v in listed], "k int")
    ids.createOrReplaceTempView("listed_rows")
    expected = tuples(spark.sql("SELECT * FROM left_rows WHERE k NOT IN (SELECT k FROM listed_rows)"))
    found = tuples(joins.not_in(spark.table("left_rows"), ids, "k"))
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_listed_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "k int, v string")
    ids = spark.createDataFrame([(2,), (2,), (9,)], "id int")
    assert sorted(r.v for r in joins.keep_listed(df, ids, "k", "id").collect()) == ["b", "c"]
    assert sorted(r.v for r in joins.drop_listed(df, ids, "k", "id").collect()) == ["a", "d"]
    again = joins.keep_listed(df, df.filter("v = 'b'"), "k")
    assert sorted(r.v for r in again.collect()) == ["b", "c"]


def test_merge_null_meets_null(spark):
    left = spark.createDataFrame([("x", None, 1), ("y", "b", 2)], "k string, j string, l int")
    right = spark.createDataFrame([("x", None, 10), ("z", "b", 20)], "k string, j string, r int")
    assert tuples(joins.merge(left, right, ["k", "j"])) == [("x", None, 1, 10)]


# --- frames and functions ---------------------------------------------------------------


def test_nulls_missing_columns_and_unions(spark):
    df = spark.createDataFrame([(None, None), (1, "a")], "n int, s string")
    assert tuples(frames.fill_nulls(df)) == [(0, None), (1, "a")]
    assert tuples(frames.fill_nulls(df, text="0"))[0] == (0, "0")
    assert frames.add_missing(df, ["n", "new"]).columns == ["n", "s", "new"]
    other = spark.createDataFrame([("z", 5.0)], "s string, f double")
    assert tuples(frames.union_all([df, other], missing=True))[2] == (None, "z", 5.0)
    assert tuples(frames.over_columns(df, ["n"], lambda c: c + 1))[1] == (2, "a")
    assert frames.with_display_names(df, {"n": "数"}).columns == ["数", "s"]


def test_split_by_date(spark):
    texts = ["2021-03-01", "2021-3-1", "2021-02-30", "2021-03-01 ", "x", None, "2021-03-01\n"]
    good, bad = frames.split_by_date(spark.createDataFrame([(t,) for t in texts], "s string"), "s")
    assert tuples(good) == [("2021-03-01", date(2021, 3, 1))]
    assert Counter(r.s for r in bad.collect()) == Counter(texts[1:])


def test_calendar(spark):
    df = spark.createDataFrame([(datetime(2020, 2, 2, 5, 6, 7),)], "t timestamp_ntz")
    t = F.col("t")
    found = df.select(
        cal.month_start(t), cal.month_end(t), cal.week_monday(t), cal.week_sunday(t), cal.add_days(t, -2),
        cal.grain_start(t, "day"), cal.grain_start(t, "year"), cal.month_text(t), cal.day_text(t),
        cal.month_number_text(t), cal.clock_text(t), cal.day(t),
    ).first()
    d = date
    assert tuple(found) == (
        d(2020, 2, 1), d(2020, 2, 29), d(2020, 1, 27), d(2020, 2, 2), d(2020, 1, 31),
        d(2020, 2, 1), d(2020, 1, 1), "2020-02", "2020-02-02", "02", "05:06:07", d(2020, 2, 2),
    )
    texts = spark.createDataFrame([("2021-03-01",), ("2021-03-01 10:11:12",), ("x",)], "s string")
    assert [r[0] for r in texts.select(cal.moment_from_text(F.col("s"))).collect()] == [
        datetime(2021, 3, 1), datetime(2021, 3, 1, 10, 11, 12), None,
    ]


def test_decode(spark):
    df = spark.createDataFrame([(1,), (99,), (None,)], "c int")
    assert [r[0] for r in df.select(decode("c", PAY_METHOD_LABELS)).collect()] == ["现金", "###", "###"]
    assert [r[0] for r in df.select(decode("c", {0: "none", 1: "it's \\ one"})).collect()] == [
        "it's \\ one", "###", "none",
    ]


def test_words(spark):
    df = spark.createDataFrame([("a.b",), ("axb",), (None,)], "s string")
    assert [r[0] for r in df.select(contains_any("s", ["a.b"])).collect()] == [True, False, False]
    assert [r[0] for r in df.select(matches("s", "a.b|q")).collect()] == [True, True, False]
    assert [r[0] for r in df.select(contains_any("s", [])).collect()] == [False] * 3


def test_commonest_char(spark):
    draw = random.Random(11)
    texts = ["231abca", "", None, "ab", "ba", "😀é😀é", "é" * 5000 + "x" * 5000]
    texts += ["".join(draw.choices("abcdé😀 ", k=draw.randrange(1, 300))) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").repartition(3)
    found = {r.i: r.best for r in df.select("i", commonest_char("s").alias("best")).collect()}
    assert tuple(found[0]) == ("a", 2, [3, 6])
    for i, text in enumerate(texts):
        if not text:
            assert tuple(found[i]) == (None, 0, [])
            continue
        char, n = Counter(text).most_common(1)[0]
        assert tuple(found[i]) == (char, n, [p for p, c in enumerate(text) if c == char])
