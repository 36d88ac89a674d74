import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tallyward.llm import imatch
from tallyward.llm.imatch import edited_fingerprints
from tests.llm.conftest import documents


def test_edited_texts(spark):
    draw = random.Random(2)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(draw.choices(words, k=draw.choice([0, 1, 3, 40, 300])))) for k in draw.sample(range(-50, 10**6), 300)]
    rows += [(2_000_000, rows[0][1]), (2_000_001, "𝔘é " * 7)]
    got = {r.doc_id: r for r in edited_fingerprints(documents(spark, rows)).collect()}
    ordered = sorted(rows, reverse=True)
    prints = {}
    for place, (k, text) in enumerate(ordered):
        after = ordered[(place + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[k].n_chars == len(text)
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[k].near_next <= 1 and 0 <= got[k].near_edited <= 1
        assert prints.setdefault(text, got[k].fingerprint) == got[k].fingerprint
    assert len(set(prints.values())) >= 0.9 * len(prints)
    long = [r for r in got.values() if r.n_chars > 500]
    assert sum(r.near_edited for r in long) > 5 * sum(r.near_next for r in long)


def test_single_row(spark):
    (row,) = edited_fingerprints(documents(spark, [(1, "just one text")])).collect()
    assert row.near_next == 1.0
    assert row.edited_sha256 == hashlib.sha256(b"just one text"[:7] + b"just o").hexdigest()


def _hash(term):
    (found,) = imatch._terms(pa.array([term], pa.large_string()))
    return int(found[0])


def _mix(value):
    value ^= value >> 30
    value = value * 0xBF58476D1CE4E5B9 % 2**64
    value ^= value >> 27
    value = value * 0x94D049BB133111EB % 2**64
    return value ^ value >> 31


def _plain_print(text, band):
    """The fingerprint restated term by term."""
    terms = sorted({_hash(t) for t in re.findall(r"[^\x20\x09-\x0D]+", text)})
    terms = [t for t in terms if t in band] or terms
    out = []
    for group, bits in enumerate(imatch.PARTS):
        for turn in range(imatch.EACH):
            word, place = divmod(turn, 64 // bits)
            drawn = [t for t in terms if _mix((t + 64 * group + word + 1) % 2**64) >> place * bits & 2**bits - 1 == 0]
            total = sum(_mix((t + _mix(k)) % 2**64) for k, t in enumerate(drawn))
            out.append(_mix((total + len(drawn)) % 2**64) | 1 if drawn else 0)
    return out if any(out) else [_mix(sum(map(_mix, terms)) % 2**64) | 1] * len(out)


def test_fingerprints_and_likeness_restated(spark):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(draw.choices(words, weights=[1 / (1 + j) for j in range(120)], k=draw.choice([0, 2, 30, 90])))) for k in range(60)]
    held = Counter(t for _, text in rows for t in set(text.split()))
    band = {_hash(t) for t, n in held.items() if 2 <= n <= max(2, 0.1 * len(rows))}
    got = {r.doc_id: r for r in edited_fingerprints(documents(spark, rows)).collect()}
    for k, text in rows:
        after = rows[k - 1][1]
        half = len(text) // 2
        own, next_one, edited = (_plain_print(t, band) for t in (text, after, text[: len(text) - half] + after[:half]))
        assert got[k].fingerprint == "-".join(f"{h >> 32:08x}" if h else "" for h in own)
        assert got[k].edited_fingerprint == "-".join(f"{h >> 32:08x}" if h else "" for h in edited)
        for other, value in ((edited, got[k].near_edited), (next_one, got[k].near_next)):
            counted = [(a, b) for a, b in zip(own, other) if a or b]
            assert value == pytest.approx(sum(a == b for a, b in counted) / len(counted))


def test_terms_of_one_document_are_never_in_the_band(spark):
    """Three million of them, and a few that recur."""
    lone = spark.range(3000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 1000), k -> concat('t', id, 'x', k))) AS text")
    both = spark.createDataFrame([(-1, "here there"), (-2, "there here"), (-3, "here")], "doc_id bigint, text string")
    assert imatch.lexicon(lone.union(both)).tolist() == sorted(_hash(t) for t in ("here", "there"))


def test_the_band_is_no_larger_than_stated(spark):
    rows = [(k, f"a{k % 40} b{k % 7} c{k // 2}") for k in range(400)]
    band = imatch.lexicon(documents(spark, rows), most=1.0, terms=120)
    assert band.tolist() == sorted(_hash(f"{c}{k}") for c, n in (("a", 40), ("b", 7)) for k in range(n))


def test_rows_without_id_and_of_one_id_are_spread(spark):
    rows = [(None, f"text {k % 3}") for k in range(3000)] + [(7, "same") for _ in range(3000)] + [(k, "x y z") for k in range(100, 3100)]
    docs = documents(spark, rows).select("doc_id", "text")
    got = edited_fingerprints(docs)
    per_task = got.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(per_task) == len(rows) and max(per_task) < 0.5 * len(rows)
    count = Counter((r.doc_id, r.n_chars) for r in got.collect())
    assert count[None, 6] == 3000 and count[7, 4] == 3000 and sum(count.values()) == len(rows)
