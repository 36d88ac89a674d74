"""Bucketed tables, inferred sheets, cuts that follow the data, one plan for many sources, counts by bitmap."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import Period
from tallyward.operators.distinct import distinct_over, id_sets
from tallyward.operators.partials import SET
from tallyward.plans import indicators, payments
from tallyward.sources import buckets
from tallyward.sources.buckets import Buckets, write_buckets
from tallyward.sources.catalog import Cuts, Database, Files, Sources, Split, read_sheet
from tallyward.sources.inference import Facts, column_facts, schema_of, typed
from tests import clinic
from tests.test_plans import plan
from workload.queries import registry

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="the given tables are not here")
MARCH = Period.of("2021-03-01", "2021-03-31 23:59:59")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


# --- buckets ------------------------------------------------------------------------


def _fee_tables(spark):
    lines = [clinic.fee(k % 40 or None, (1, None, None), 100 * k, 50 * k) for k in range(300)]
    pay = [clinic.payment(k, 1, 100, hospital_id=1) for k in range(45)]
    hospitals = clinic.frame(spark, "sec_hospital", [{"hospital_id": 1, "hospital_name": "North"}])
    return clinic.frame(spark, "ord_fee_detail", lines), clinic.frame(spark, "ord_pay", pay), hospitals


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, no_broadcast):
    lines, pay, _ = _fee_tables(spark)
    root = f"file://{tmp_path}/laid"
    for table, df in (("ord_fee_detail", lines), ("ord_pay", pay)):
        write_buckets(df, root, table, ["pay_order_id"], 4)
    laid = Sources(spark, {"main": Buckets(root)})
    one, other = laid.table("ord_fee_detail"), laid.table("ord_pay")
    assert one.schema == lines.schema and sorted(map(repr, one.collect())) == sorted(map(repr, lines.collect()))
    joined = one.join(other.select("pay_order_id", "create_date"), "pay_order_id")
    summed = joined.groupBy("pay_order_id").agg(F.sum("total_price").alias("v"))
    assert "Exchange" not in plan(summed, "simple")
    plain = lines.join(pay.select("pay_order_id", "create_date"), "pay_order_id").groupBy("pay_order_id").agg(F.sum("total_price").alias("v"))
    assert plan(plain, "simple").count("Exchange") == 2
    assert sorted(summed.collect()) == sorted(plain.collect())


def test_reports_over_buckets_shuffle_no_wide_side(spark, tmp_path, no_broadcast):
    lines, pay, hospitals = _fee_tables(spark)
    root = f"file://{tmp_path}/laid"
    classify = clinic.frame(spark, "ord_pay_classify", [clinic.charges(k % 45, 1000 + k) for k in range(200)])
    visits = clinic.frame(spark, "ord_registered", [clinic.visit(1)])
    for table, df in (("ord_fee_detail", lines), ("ord_pay", pay), ("ord_pay_classify", classify)):
        write_buckets(df, root, table, ["pay_order_id"], 4)
    laid = Sources(spark, {"main": Buckets(root)})
    money = indicators.income_cost(laid.table("ord_fee_detail"), laid.table("ord_pay"), F.broadcast(hospitals), MARCH)
    assert "hashpartitioning(pay_order_id" not in plan(money, "simple")
    assert money.collect() == indicators.income_cost(lines, pay, hospitals, MARCH).collect()
    fees = payments.charge_categories(laid.table("ord_pay_classify"), laid.table("ord_pay"), visits, MARCH)
    exchanged = [line for line in plan(fees, "simple").splitlines() if "hashpartitioning(pay_order_id" in line]
    assert len(exchanged) == 1  # the payments, after they met their visits
    assert fees.collect() == payments.charge_categories(classify, pay, visits, MARCH).collect()


@given
@pytest.mark.parametrize("name", ["charge_category_bucketed", "income_cost_bucketed"])
def test_buckets_follow_the_rows(spark, monkeypatch, no_broadcast, name):
    """A bucket is one task's work: more rows make more buckets, not larger ones."""
    assert "out of 8" in plan(registry()[name](spark, SF_DIR))
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 300)
    text = plan(registry()[name](spark, SF_DIR))
    assert "out of 32" in text and "out of 8" not in text
    assert buckets.buckets_for([spark.range(9601), spark.range(5)]) == 64 and buckets.buckets_for([]) == 8


def test_bucketed_table_is_replaced(spark, tmp_path):
    root = f"file://{tmp_path}/laid"
    for n, buckets in ((5, 2), (9, 3)):
        write_buckets(spark.range(n), root, "ids", ["id"], buckets)
        assert Buckets(root).read(spark, "ids").count() == n
    with pytest.raises(KeyError, match="no bucketed table"):
        Buckets(root).read(spark, "other")
    with pytest.raises(ValueError):
        write_buckets(spark.range(1), root, "ids", [], 2)
    write_buckets(spark.range(0), root, "none", ["id"], 2)
    assert Buckets(root).read(spark, "none").isEmpty()


# --- inferred sheets ------------------------------------------------------------------

CELLS = {
    "whole": (["1", "-7", "+3", None, " ", "9223372036854775807"], T.LongType()),
    "big": (["1", "9223372036854775808"], T.DecimalType(19, 0)),
    "money": (["1.5", "20", "-0.125", ""], T.DecimalType(5, 3)),
    "wide": (["1" * 30, "0." + "1" * 20], T.DoubleType()),
    "float": (["1.5", "2e-3", "4"], T.DoubleType()),
    "yes": (["true", "FALSE", None], T.BooleanType()),
    "day": (["2021-03-01", "2020-02-29"], T.DateType()),
    "moment": (["2021-03-01", "2021-03-01 10:00", "2021-03-01T10:00:00.123456"], T.TimestampNTZType()),
    "code": (["007", "12"], T.StringType()),
    "no day": (["2021-02-30", "2021-02-01"], T.StringType()),
    "mixed": (["1", "true"], T.StringType()),
    "blank": ([None, "", "  "], T.StringType()),
    "none": ([], T.StringType()),
    "quote`d": (["1", "x\ny"], T.StringType()),
}


def _sheet(spark, column, cells):
    return spark.createDataFrame([(c,) for c in cells], T.StructType([T.StructField(column, T.StringType())]))


@pytest.mark.parametrize("column", list(CELLS))
def test_kinds(spark, column):
    cells, kind = CELLS[column]
    sheet = _sheet(spark, column, cells)
    rows = typed(sheet)
    assert rows.schema[0].dataType == kind
    values = [r[0] for r in rows.collect()]
    if kind == T.StringType():
        assert values == cells
    else:
        assert [v is None for v in values] == [not (c or "").strip() for c in cells]


def test_facts_add_up_in_any_order(spark):
    """The kind of a column is that of its pieces joined, however it is cut."""
    pieces = [["1"], ["2.50"], ["1e3"], ["x"], [None], ["2021-03-01"], ["2021-03-01 10:00"], ["true"]]
    known = [column_facts(_sheet(spark, "c", p))["c"] for p in pieces]
    whole = {}
    for i, j in product(range(len(pieces)), repeat=2):
        both = column_facts(_sheet(spark, "c", pieces[i] + pieces[j]))["c"] if i <= j else whole[j, i]
        whole[i, j] = both
        assert known[i] + known[j] == known[j] + known[i] == both
    assert sum(known, Facts()).kind() == T.StringType()


def test_sheet_without_a_schema(spark, tmp_path):
    (tmp_path / "list.csv").write_text('name,paid,day\n"a,b",1.25,2021-03-01\n,3,\n', encoding="utf-8")
    sheet = read_sheet(spark, str(tmp_path / "list.csv"))
    assert [f.dataType for f in sheet.schema.fields] == [T.StringType(), T.DecimalType(3, 2), T.DateType()]
    assert sorted(map(tuple, sheet.collect()), key=repr) == sorted(
        [("a,b", Decimal("1.25"), date(2021, 3, 1)), (None, Decimal("3.00"), None)], key=repr
    )
    assert Sources(spark, {"main": Files(str(tmp_path), "csv", "{table}.csv")}).table("list").schema == sheet.schema


def test_one_job_infers_all_columns(spark):
    sheet = spark.range(100).selectExpr(*[f"CAST(id AS STRING) AS c{k}" for k in range(12)])
    assert schema_of(column_facts(sheet)).simpleString() == "struct<" + ",".join(f"c{k}:bigint" for k in range(12)) + ">"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed(_sheet(spark, "c", ["x"]), T.StructType([T.StructField("c", T.LongType())])).collect()


# --- splits that follow the data ------------------------------------------------------


def _parts(df, cuts):
    """Rows per predicate; every row must meet exactly one."""
    tests = [f"CAST(coalesce({p}, false) AS INT)" for p in cuts.predicates()]
    assert df.filter(f"{' + '.join(tests)} <> 1").isEmpty()
    return [df.filter(p).count() for p in cuts.predicates()]


def test_cuts_of_a_skewed_column(spark):
    """A third of the rows on one key, half of the rest among small keys, some without."""
    keys = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 777 WHEN id % 3 = 1 THEN id % 1000 WHEN id % 50 = 2 THEN NULL ELSE id * 1000 END AS k"
    )
    cuts = Cuts.of(keys, "k", 8)
    assert cuts.hot == (777,) and cuts.nulls
    sizes = _parts(keys, cuts)
    assert max(s for s in sizes if s != keys.filter("k = 777").count()) <= 30_000 / 8 * 1.4
    even = Split("k", 0, 30_000_000, 8)
    assert even.options()["numPartitions"] == "8"
    width = 30_000_000 // 8
    assert keys.filter(f"k < {width}").count() > 20_000  # what equal widths give


@pytest.mark.parametrize("start", [date(2021, 1, 1), datetime(2021, 1, 1, 0, 0, 0, 5)])
def test_cuts_of_dates(spark, start):
    kind = "date" if type(start) is date else "timestamp_ntz"
    keys = spark.createDataFrame([(start + timedelta(days=k * k % 400),) for k in range(1000)], f"d {kind}")
    cuts = Cuts.of(keys, "d", 5)
    assert not cuts.nulls and 4 <= len(_parts(keys, cuts)) <= 5
    assert max(_parts(keys, cuts)) < 350


def test_cuts_of_little(spark):
    none = spark.createDataFrame([], "k bigint")
    assert Cuts.of(none, "k", 8).predicates() == ["k IS NOT NULL"]
    same = spark.range(50).selectExpr("5 AS k")
    assert _parts(same, Cuts.of(same, "k", 4)) == [0, 50]
    assert Cuts("name", ("b'",), ("a",), nulls=False).predicates() == ["name < 'b''' AND name NOT IN ('a')", "name >= 'b''' AND name NOT IN ('a')", "name = 'a'"]
    with pytest.raises(TypeError):
        Cuts("x", (1.5,)).predicates()
    with pytest.raises(TypeError):
        Cuts.of(spark.range(9).selectExpr("CAST(id AS DOUBLE) AS k"), "k", 2)
    database = Database({"url": "jdbc:x"}, splits={"ord_pay": Cuts("k", (5,))})
    assert "partitionColumn" not in database.reader_options("ord_pay")


# --- one plan for many sources ----------------------------------------------------------


def test_sources_share_their_shuffles(spark, no_broadcast):
    lines, pay, hospitals = _fee_tables(spark)
    visits = clinic.frame(spark, "ord_registered", [clinic.visit(k) for k in range(12)])
    tables = {"ord_registered": visits, "ord_fee_detail": lines, "ord_pay": pay, "sec_hospital": hospitals}

    def exchanges(df):
        return plan(df, "simple").count("Exchange hashpartitioning")

    alone = exchanges(indicators.merged_summary(tables, MARCH))
    for number in (2, 3):
        assert exchanges(indicators.merged_sources({f"s{k}": tables for k in range(number)}, MARCH)) == alone


def test_sources_with_equal_names_stay_apart(spark):
    lines, pay, hospitals = _fee_tables(spark)
    visits = clinic.frame(spark, "ord_registered", [clinic.visit(k, user_id=k % 3, hospital_id=1 + k % 2) for k in range(12)])
    one = {"ord_registered": visits, "ord_fee_detail": lines, "ord_pay": pay, "sec_hospital": hospitals}
    other = one | {"ord_registered": visits.filter("registered_ord_id < 5").withColumn("extra", F.lit(1))}
    clinics = {"a": [1], "b": [1, 2]}
    got = indicators.merged_sources({"a": one, "b": other}, MARCH, "doctor", clinics).collect()
    want = [r for name, tables in (("a", one), ("b", other)) for r in indicators.merged_summary(tables, MARCH, "doctor", clinics[name]).collect()]
    assert len(got) == 2 and sorted(map(repr, got)) == sorted(map(repr, want))


# --- distinct counts --------------------------------------------------------------------


def test_distinct_counts_add_up(spark):
    rows = spark.range(5000).selectExpr(
        "CASE WHEN id % 7 > 0 THEN id % 7 END AS g", "id % 3 AS h", "CASE WHEN id % 11 > 0 THEN id * 7919 % 200000 - 60000 END AS v"
    )
    levels = {"both": ["g", "h"], "g": ["g"], "all": []}
    got = {(r[SET], r.g, r.h): r.n for r in distinct_over(id_sets(rows, ["g", "h"], "v"), levels, "n").collect()}
    for label, keys in levels.items():
        counted = rows.filter("v IS NOT NULL").groupBy(*keys).agg(F.count_distinct("v").alias("n"))
        want = {(label, r["g"] if "g" in keys else None, r["h"] if "h" in keys else None): r.n for r in counted.collect()}
        assert want == {k: n for k, n in got.items() if k[0] == label}


@given
def test_patients_need_one_scan(spark):
    text = plan(registry()["distinct_patients"](spark, SF_DIR))
    assert text.count("/orders.parquet]") == 1
