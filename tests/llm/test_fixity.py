from collections import Counter

from tallyward.llm import fixity
from tallyward.llm.store import Scratch
from tests.llm.conftest import CLASHING

SCHEMA = "page_id bigint, url string, html string"


def test_damage_is_found(spark):
    rows = [(k, f"http://h/{k}", f"<p>{k}</p>" * (k % 7)) for k in range(9000)] + [(None, None, None), (5, "http://h/5", "twice")]
    pages = spark.createDataFrame([r + ("x",) for r in rows], SCHEMA + ", hash string")
    hurt = {17, 4096, 8999}
    copies = [(k, u, "rot" if k in hurt else h) for k, u, h in rows if k != 300]
    got = fixity.audit(pages, spark.createDataFrame(copies, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert {r.page_id for r in got if not r.intact} == hurt | {300}
    assert {r.page_id for r in got if not r.intact and r.found_sha256 is None} == {300}
    ends = {}
    for r in sorted(got, key=lambda r: (r.file, r.offset)):
        assert r.offset == ends.get(r.file, 0)
        ends[r.file] = r.offset + r.length
    assert len(ends) == 3


def test_equal_replicas_stop_at_the_root(spark):
    pages = spark.createDataFrame([(k, "u", "h" * k) for k in range(50)], SCHEMA)
    store = Scratch(spark, "test")
    listed = fixity.manifest(pages, store)
    leaves = listed.select("file", "leaf", "start", "stop", "hash")
    copies = fixity.replica_leaves(listed, pages, store).select("file", "leaf", "start", "stop", "hash")
    one, two = fixity.tree(leaves, store, "one"), fixity.tree(copies, store, "two")
    assert one[-1].collect() == two[-1].collect() and one[-1].count() == 1
    assert fixity.differing(one, two).isEmpty()
    assert fixity.moved(copies, one, two).isEmpty()


def _findings(got):
    return Counter(r.finding for r in got)


def test_empty_tables(spark):
    pages = spark.createDataFrame([(k, "u", "h") for k in range(5)], SCHEMA)
    none = pages.limit(0)
    assert fixity.audit(none, none).collect() == []
    assert _findings(fixity.audit(none, pages).collect()) == {"surplus": 5}
    assert _findings(fixity.audit(pages, none).collect()) == {"missing": 5}


def test_a_replica_is_laid_out_by_its_own_records(spark):
    schema = SCHEMA + ", at int"
    rows = [(k, f"u{k}", "h" * (k % 5), k) for k in range(200)]
    pages = spark.createDataFrame(rows, schema)
    foreign = [(1000 + k, "u", "foreign", 500 + k) for k in range(50)]
    twice = [(7, "u7", "hh", 600), (8, "u8", "hhh", 601)]
    # turned around, with foreign records and doubled ones at its end
    copies = [(k, u, h, 199 - at) for k, u, h, at in rows] + foreign + twice
    got = fixity.audit(pages, spark.createDataFrame(copies, schema), "at").collect()
    assert _findings(got) == {"intact": 1, "moved": 199, "surplus": 52}
    assert {r.page_id for r in got if r.finding == "surplus"} == {7, 8} | {1000 + k for k in range(50)}
    offsets = sorted((r.found_offset, r.page_id) for r in got)
    assert [p for _, p in offsets[:200]] == list(range(199, -1, -1))

    # one lost, one longer, a foreign one between: the rest is in its place
    copies = [(k, u, h + "x" * (k == 40), at) for k, u, h, at in rows if k != 17] + [(1000, "u", "foreign", 90)]
    got = {r.page_id: r for r in fixity.audit(pages, spark.createDataFrame(copies, schema), "at").collect()}
    assert {p: r.finding for p, r in got.items() if r.finding != "intact"} == {17: "missing", 40: "altered", 1000: "surplus"}

    # two neighbours, and the first and last of all, have changed places
    swapped = {3: 4, 4: 3, 0: 199, 199: 0}
    copies = [(k, u, h, swapped.get(at, at)) for k, u, h, at in rows]
    got = fixity.audit(pages, spark.createDataFrame(copies, schema), "at").collect()
    assert {r.page_id for r in got if r.finding == "moved"} == {1, 4, 199}


def test_edge_cases(spark):
    long = "<p>long</p>" * 100_000
    rows = [(None, None, None), (None, "u", ""), (None, "u", ""), (1, "u", long), (2, None, "x"), (2, None, "x"), (2, None, "y")]
    extra = ", ".join(f"`{c}` string" for c in CLASHING + ["nth", "length", "offset", "sha256", "finding", "_first", "_order", "length_before"])
    width = extra.count(",") + 1
    pages = spark.createDataFrame([r + ("x",) * width for r in rows], f"{SCHEMA}, {extra}")
    assert _findings(fixity.audit(pages, pages).collect()) == {"intact": 7}
    fewer = spark.createDataFrame([r for r in rows if r[2] != "y"][1:], SCHEMA)
    got = fixity.audit(pages, fewer).collect()
    assert Counter(r.page_id for r in got) == {None: 3, 1: 1, 2: 3}
    assert _findings(got)["missing"] == 2
