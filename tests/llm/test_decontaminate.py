import random

from pyspark.sql import functions as F

from tallyward.llm import decontaminate as d
from tallyward.llm.decontaminate import contaminated
from tests.llm import brute
from tests.llm.conftest import documents

ITEM = "A train leaves the station with Anna at 40 km per hour and Anna meets Bob after 3 hours of travel on 40 km of track"


def _found(spark, texts, item=ITEM):
    items = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    rows = contaminated(documents(spark, list(enumerate(texts))), items).collect()
    return {r.doc_id: r.reworded for r in rows}


def test_verbatim_and_reworded(spark):
    other = ITEM.replace("Anna", "Maria").replace("Bob", "Peter").replace("40", "65").replace("km", "miles")
    broken = ITEM.replace("Anna meets", "Clara meets").replace("40 km of", "99 km of").replace("40", "65", 1)
    texts = [f"before it, {ITEM}. And after.", f"Some words. {other}", f"words {broken}", "nothing of the kind in this text at all", ITEM.upper()]
    found = _found(spark, texts)
    assert found.get(0) is False and found.get(1) is True
    assert 2 not in found and 3 not in found


def test_part_of_an_item(spark):
    words = ITEM.split()
    found = _found(spark, [" ".join(words[: len(words) * 3 // 4]), " ".join(words[:9])])
    assert 0 in found and 1 not in found


def test_short_items(spark):
    found = _found(spark, ["we ask: What is the capital? yes", "what is the", "What is\nthe, capital"], "What is the capital")
    assert set(found) == {0, 2}


def test_given_benchmark(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    plain = {(d.doc_id, i.item_id) for i in items.collect() for d in docs.collect() if i.text in d.text}
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    assert plain <= got


def test_items_of_numbers(spark):
    """Little but values: a copy is found by them, other values are another item."""
    for item in ("Calculate 12 + 7 * 3 - 4 / 2 + 9", "12 + 7 * 3 = 33", "What is 3 km, 5 km, 8 km, 9 km, 12 km and 40 km?"):
        other = item.replace("12", "15").replace("3", "6")
        assert _found(spark, [item, f"Before it. {item} And after.", f"Before it. {other} And after.", "12 words"], item) == {0: False, 1: False}


def test_one_value_that_becomes_two(spark):
    item = "There are 2 apples on the table in the kitchen and there are also 2 pears on the shelf that is near to the door of the old house by the lake"
    other = item.replace("2 apples", "3 apples").replace("2 pears", "5 pears")
    assert _found(spark, [item, f"Some words. {other}"], item) == {0: False, 1: True}


NAMES = "Anna Bert Clara Dave Emma Frank Greta Henry Irene Jacob Karin Louis Maria Nils Olga Peter".split()
FORMS = (
    "{a} buys {i} pens. {b} buys {j} pens. {c} buys {k} pens. How many pens did they buy?",
    "{a} has {i} red marbles and {j} blue ones. {b} takes {k} of them away. How many marbles are left with {a} at the end?",
    "A farmer sells {i} baskets of apples. {a} pays for {j} of them. What does each of the other baskets cost?",
    "{a} walks {i} km to the old mill. Then {b} drives {j} km further north. How far have both of them come by then?",
    "There are {i} children in a class. {a} counts {j} of them twice. How many names stand on the list of {b}?",
)


def _drawn(form, draw):
    a, b, c = draw.sample(NAMES, 3)
    i, j, k = draw.sample(range(2, 99), 3)
    return form.format(a=a, b=b, c=c, i=i, j=j, k=k)


def test_recall_of_reworded_items(spark):
    """Items with other names and numbers are found, at sentence starts as well; other texts hold none."""
    draw = random.Random(11)
    items = [_drawn(f, draw) for f in FORMS]
    texts = [f"{'Some words came before this. ' * (n % 3)}{_drawn(FORMS[n % 5], draw)} Nothing more is said here." for n in range(100)]
    clean = ["The shop sells pens. Many pens are blue, and they buy new ones each year. How many they buy is not known." for _ in range(3)]
    table = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(documents(spark, list(enumerate(texts + clean))), table).collect()}
    assert sum((n, n % 5) in got for n in range(100)) >= 95
    assert all(d < 100 and d % 5 == i for d, i in got)


def test_a_name_that_becomes_two(spark):
    item = "Anna buys 3 pens. Anna sells 4 pens. Anna keeps all of the other pens."
    torn = "Bert buys 3 pens. Clara sells 4 pens. Dave keeps some of those red pens."
    assert _found(spark, [item.replace("Anna", "Bert"), torn], item) == {0: True}


def test_items_without_id_or_of_one_id(spark):
    texts = ["What is the capital of the country", "Who wrote the long book about whales", "How tall is the highest hill of all"]
    items = spark.createDataFrame([(None, texts[0]), (5, texts[1]), (5, texts[2]), (5, texts[2])], "item_id bigint, text string")
    rows = contaminated(documents(spark, list(enumerate(texts))), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows if r.doc_id) == [(1, 5), (2, 5)]
    assert [r.item_id for r in rows if r.doc_id == 0] == [None]


def test_every_document_against_every_item(spark):
    """The same rows as a plain comparison of each document with each item."""
    draw = random.Random(5)
    items = [_drawn(f, draw) for f in FORMS] + [
        "Calculate 12 + 7 * 3 - 4 / 2 + 9", "Which city lies on the Rhine", "one", "3 km", "", None,
        "There are 2 apples on the table and there are also 2 pears on the shelf near the old door",
    ]
    texts = [f"{'Words come first. ' * (n % 3)}{_drawn(FORMS[n % 5], draw)} {'And more. ' * (n % 2)}" for n in range(30)]
    texts += [f"Before. {t} After." for t in items if t] + ["", None, "Calculate 12 + 7 * 3 - 4 / 2 + 8 now", items[-1].replace("2 a", "3 a")]
    texts += [" ".join(draw.sample(" ".join(items[:5]).split(), 30)) for _ in range(10)]
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    docs = list(enumerate(texts)) + [(10_000 + r.doc_id, r.text) for r in given]
    marks = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()
    marks = list(enumerate(items)) + [(1000 + r.item_id, r.text) for r in marks]
    table = spark.createDataFrame(marks, "item_id bigint, text string")
    got = contaminated(documents(spark, docs), table).collect()
    assert any(r.reworded for r in got) and any(r.doc_id >= 10_000 for r in got)
    assert {(r.doc_id, r.item_id, r.found, r.windows, r.reworded) for r in got} == brute.contaminated(docs, marks)
    assert all(r.coverage == r.found / r.windows for r in got)


def test_windows_side_by_side_are_those_of_each_place(spark):
    """Both readings, values where words are few, texts shorter than the window, and hashes in compiled code."""
    texts = [
        "", "One two three.", "So Ada paid 3 km, 4 kg, 5 lb and 6 oz to Bo and Cy. Then he left 12 of 13 for Di.",
        "plain words only and quite a few of them stand here", "He said no. She said yes. They all went home again, all of them did. Nobody stayed.",
        "1 2 3 4 5 6 7 8 9 10 11 12", None, "1,000.5 cost Ada. Bo 2:30 Cy 7 8 9 x y z and more, and more",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    template = d._template(F.col("text"))
    read = df.select("doc_id", d._as_words(template).alias("words"), d._as_names(template).alias("named"), d.literal_words(F.col("text")).alias("said"))
    read = read.withColumn("has_slots", d._slotted("words"))
    each = read.withColumns({"solid": d._literal("words"), "solid_named": d._literal("named")})
    for width, said in ((8, "said"), (8, None), (3, "said")):
        one = each.select("doc_id", F.posexplode(d._windows("words", width, 4, said)).alias("p", "h")).filter("h IS NOT NULL")
        other = each.select("doc_id", F.inline(d._other_windows("words", "named", width, 4)))
        found = d._side_by_side(read, width, 4, bool(said))
        assert one.count() > 0 and other.count() > 0
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, one.union(other).collect()))
