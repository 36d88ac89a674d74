import random
import zlib

from tallyward.llm.sharding import balanced_shards, running_totals
from tallyward.llm.store import Scratch
from tests.llm.conftest import documents


def test_shards(spark):
    draw = random.Random(1)
    rows = [(k, "é" * draw.choice([0, 1, 5, 400])) for k in draw.sample(range(10**6), 500)]
    got = sorted(balanced_shards(documents(spark, rows)).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in got] == sorted(k for k, _ in rows)
    text = dict(rows)
    total = sum(len(t.encode()) + 1 for t in text.values())
    sizes, slots = [0] * 16, [0] * 16
    for r in got:
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert r.slot == slots[r.shard]
        slots[r.shard] += 1
        sizes[r.shard] += r.size
    assert max(abs(s - total / 16) for s in sizes) <= 801


def test_running_totals_of_equal_rows(spark):
    rows = spark.createDataFrame([(1, 5)] * 3000 + [(None, 2), (0, 1)], "k bigint, m bigint")
    got = sorted((r.row_before, r.m_before, r.m) for r in running_totals(rows, ["k"], ["m"], Scratch(spark, "test"), "t").collect())
    at = 0
    for number, (place, before, m) in enumerate(got):
        assert (place, before) == (number, at)
        at += m
