import hashlib
import random
import re
from collections import defaultdict

from tallyward.llm.mixing import UNIT, mixed, systematic_copies
from tests.llm.conftest import EDGE_ROWS, documents

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, weights=(3, 1, 2), share=1.5, most=2):
    """The mix of rows (doc_id, source, text): the excess is shared out again until no source is above its cap."""
    held = defaultdict(list)
    for doc_id, source, text in rows:
        held[source].append((len(_WORD.findall(text or "")), doc_id, hashlib.md5((text or "").encode()).hexdigest()))
    sources = sorted(held, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(d[0] for d in held[s]) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    target = {}
    while True:
        rest = [s for s in sources if s not in target]
        left = share * sum(size.values()) - sum(target.values())
        level = left / sum(weight[s] for s in rest) if rest else 0
        full = [s for s in rest if weight[s] * level > most * size[s]]
        target |= {s: most * size[s] for s in full}
        if not full:
            target |= {s: weight[s] * level for s in rest}
            break
    out = []
    for s in sources:
        each = round(target[s] / size[s] * UNIT) if size[s] else 0
        at = int(hashlib.md5(("mix:" + ("-" if s is None else f"={s}")).encode()).hexdigest()[:6], 16)
        for n, doc_id, _ in sorted(held[s], key=lambda d: (d[0], d[1] is not None, d[1] or 0, d[2])):
            copies = (at + each) // UNIT - at // UNIT
            at += each
            out.append((doc_id, n, size[s], round(target[s], 6), copies * n, copies))
    return out


def _same(frame):
    got = systematic_copies(frame).collect()
    shown = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken, r.copies) for r in got]
    want = plain([(r.doc_id, r.source, r.text) for r in frame.collect()])
    assert sorted(map(repr, shown)) == sorted(map(repr, [(*w[:3], float(w[3]), *w[4:]) for w in want]))
    return got


def _drawn(seed, sizes):
    draw = random.Random(seed)
    return [(k, "w " * draw.choice([0, 1, 5, 30, 200]), s) for s, n in sizes.items() for k in draw.sample(range(10**6), n)]


def test_mix(spark):
    got = _same(documents(spark, _drawn(1, {"a": 900, "b": 40, "c": 300, "ä": 5, "": 60, None: 80})))
    by = defaultdict(list)
    for r in got:
        by[r.source_size].append(r)
    for size, rows in by.items():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r["size"] for r in rows) + 1
        assert all(r.taken <= 2 * r["size"] for r in rows)
    assert abs(sum(rows[0].target for rows in by.values()) - 1.5 * sum(by)) < 1e-6


def test_order_of_rows_does_not_matter(spark):
    rows = _drawn(2, {"a": 200, "b": 100})
    one = systematic_copies(documents(spark, rows)).collect()
    other = systematic_copies(documents(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(one) == sorted(other)


def test_one_source_has_nearly_all(spark):
    _same(documents(spark, _drawn(3, {"a": 2000, "b": 3, "c": 1})))


def test_edges(spark, edge_docs, no_docs):
    assert len(_same(edge_docs)) == len(EDGE_ROWS)
    assert systematic_copies(no_docs).collect() == []
    assert all(r.target == 0 and r.copies == 0 for r in systematic_copies(documents(spark, [(1, None), (2, " "), (None, "", None)])).collect())


def test_mixed_texts(spark, edge_docs):
    rows = documents(spark, _drawn(4, {"a": 50, "b": 9}), clashing=True)
    copies = {r.doc_id: r.copies for r in systematic_copies(rows).collect()}
    text = {r.doc_id: r.text for r in rows.collect()}
    got = mixed(rows).collect()
    assert sorted((r.doc_id, r["copy"]) for r in got) == sorted((k, c + 1) for k, n in copies.items() for c in range(n))
    assert all(r.text == text[r.doc_id] and r.node == "x" for r in got)
    assert mixed(edge_docs).columns == [*edge_docs.columns, "copy"]
