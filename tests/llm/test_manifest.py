import hashlib
import random
import zlib

from tallyward.llm.manifest import dataset_manifest
from tests.llm.conftest import EDGE_ROWS, documents


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_hash(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain(rows):
    """The manifest of rows (doc_id, source, lang, n_chars, text), one tree built after another."""
    leaf = lambda r: _hash(*[_told(v) for v in r])
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    kept = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: _levels([leaf(r) for r in kept[s]]) for s in sources}
    above = _levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(kept[s]):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            own = leaf((*r[:4], r[4].replace("\n", ""))) if even and r[4] is not None else leaf(r)
            beside = []
            for levels, at in ((trees[s], i), (above, k)):
                for level in levels[:-1]:
                    first = at // 3 * 3
                    left, right = level[first:at], level[at + 1 : first + 3]
                    beside += left + right
                    own, at = _hash(*left, own, *right), at // 3
            root = above[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, _hash(*beside), own, own == root))
    return out


def _rows(frame):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in frame.collect()]


def _same(frame):
    got = dataset_manifest(frame)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(_rows(frame))))


def test_manifest(spark):
    """Sources of 1, 2, 3, 4, 81, 82 and 400 documents, of heights from none to beyond a tier."""
    draw = random.Random(3)
    sizes = {"a": 1, "b": 2, "c": 3, "ä": 4, "z": 81, "": 82, None: 400}
    rows = [(s, draw.choice(["one", "two\nlines", "\n", ""])) for s, n in sizes.items() for _ in range(n)]
    ids = draw.sample(range(10**6), len(rows))
    _same(documents(spark, [(i, text, s) for i, (s, text) in zip(ids, rows)]))


def test_single_document(spark):
    _same(documents(spark, [(7, "alone\n", "s")]))


def test_edges(spark, edge_docs, no_docs):
    _same(edge_docs)
    assert len(dataset_manifest(edge_docs).collect()) == len(EDGE_ROWS)
    assert dataset_manifest(no_docs).collect() == []


def test_lost_line_ends_are_found(spark):
    rows = [(k, f"line {k}\nand more", "s") for k in range(60)]
    verified = {r.doc_id: r.verified for r in dataset_manifest(documents(spark, rows)).collect()}
    assert verified == {k: zlib.crc32(str(k).encode()) % 2 == 1 for k in range(60)}


def test_long_text(spark):
    _same(documents(spark, [(2, "é\n" * 1_000_000), (4, None), (4, "")]))
