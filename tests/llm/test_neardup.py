import random

from tallyward.llm import neardup
from tallyward.llm.components import components
from tallyward.llm.store import Scratch
from tests.llm.brute import near_components
from tests.llm.conftest import documents


def _compared(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(documents(spark, rows)).collect()}
    assert got == near_components(rows)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    _compared(spark, rows)


def test_crowd_of_near_copies_and_a_common_passage(spark, monkeypatch):
    """Copies of one text, many too far from each other, and strangers that share half of it."""
    monkeypatch.setattr(neardup, "_BLOCK_ROWS", 64)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(draw.choice([1, 2, 3, 4, 5])):
            text[draw.randrange(120)] = f"x{draw.randrange(10**9)}"
        rows.append((i * 3, " ".join(text)))
    for i in range(150):
        own = [f"y{draw.randrange(10**9)}" for _ in range(draw.choice([5, 20, 60, 100]))]
        rows.append((5000 + i, " ".join(own + base[:60])))
    draw.shuffle(rows)
    _compared(spark, rows)


def test_chain_is_one_component(spark):
    store = Scratch(spark, "test")
    chain = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(chain, store, "chain").collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}
