import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallyward.llm.packing import pack
from tallyward.llm.tokens import Encoder
from tests.llm.conftest import EDGE_ROWS, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def _expected(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_words_give_the_same_ids():
    texts = [r[1] or "" for r in EDGE_ROWS] + ["x's Y'LL 'tis a.'b a,b,,c** **d é,è <b>a</b> <|startoftext|>a", "á, B̸ ≮", "1a2 ３ ²"]
    ids, counts = Encoder(open(PATH).read(), True).encode(pa.array(texts))
    edges = np.concatenate([[0], np.cumsum(counts)])
    for k, text in enumerate(texts):
        assert ids[edges[k] : edges[k + 1]].tolist() == _expected(text)[:-1]


@pytest.mark.parametrize("length", [16, 2048])
def test_round_trip(spark, length):
    rows = [(k, t[1], f"s{k % 5}") for k, t in enumerate(EDGE_ROWS)]
    got = pack(documents(spark, rows), PATH, wordwise=True, length=length, temperature=0.5).collect()
    for k, text, _ in rows:
        own = sorted((r for r in got if r.doc_id == k), key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in own), dtype="<u4").tolist()
        assert ids == _expected(text)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    filled = {}
    for number, parts in sequences.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        filled[number] = at
    assert sorted(filled) == list(range(len(filled)))
    assert all(filled[k] == length for k in range(len(filled) - 1)) and 0 < filled[len(filled) - 1] <= length


def _dealt(rows, mixture, length):
    """Plain dealing of ``(doc_id, source, tokens)``: credits grow until one covers its queue's next part."""
    queues = {}
    for doc_id, source, n in rows:
        queues.setdefault(source, []).extend((doc_id, at, min(length, n - at)) for at in range(0, n, length))
    credit, out = dict.fromkeys(queues, Fraction(0)), []
    while any(queues.values()):
        wait, source = min(((q[0][2] - credit[s]) / Fraction(mixture[s]), s) for s, q in queues.items() if q)
        for other in credit:
            credit[other] += wait * Fraction(mixture[other])
        part = queues[source].pop(0)
        credit[source] -= part[2]
        out.append(part)
    return out


def test_parts_go_out_as_plain_dealing_sends_them(spark):
    draw = random.Random(5)
    rows = [(k, "some words " * draw.choice([0, 1, 9, 30, 200]), f"s{draw.randrange(4)}") for k in range(200)]
    mixture = {"s0": 3, "s1": 1, "s2": 8, "s3": 5}
    got = pack(documents(spark, rows).coalesce(1), PATH, mixture=mixture, wordwise=True, length=64).collect()
    sized = [(k, s, len(_expected(t))) for k, t, s in rows]
    plain, at = [], 0
    for doc_id, start, n in _dealt(sized, mixture, 64):
        first = min(n, 64 - at % 64)
        plain += [(doc_id, start + skip, m, (at + skip) // 64, (at + skip) % 64) for skip, m in ((0, first), (first, n - first)) if m]
        at += n
    assert sorted((r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in got) == sorted(plain)


def test_windows_keep_the_mixture(spark):
    rows = [(k, "some words for this text " * 40, "big" if k % 4 else "small") for k in range(80)]
    got = pack(documents(spark, rows), PATH, mixture={"big": 3.0, "small": 1.0}, wordwise=True, length=256).collect()
    small, last = {}, max(r.sequence_id for r in got)
    for r in got:
        small[r.sequence_id] = small.get(r.sequence_id, 0) + (r.length if r.source == "small" else 0)
    # what a source lacks or has too much is never more than a part of each
    for number in range(last - 2):
        assert abs(sum(small.get(k, 0) for k in range(number + 1)) - 64 * (number + 1)) <= 256


def test_many_sources_have_a_queue_each(spark):
    """More than a thousand sources keep to a mixture by name; a small source's document stays whole."""
    rows = [(k, "one two three four " * 3, f"s{k % 1100}") for k in range(3300)]
    got = pack(documents(spark, rows), PATH, mixture={"s7": 1000.0}, wordwise=True).collect()
    assert all(r.sequence_id == 0 for r in got if r.source == "s7")
    assert len(got) <= len(rows) + max(r.sequence_id for r in got)


def test_few_documents_are_cut(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = pack(docs, PATH, wordwise=True, temperature=0.7).select("doc_id", "length", "doc_tokens", "sequence_id").collect()
    tokens = sum(r.length for r in got)
    parts = sum(-(-n // 2048) for n in {r.doc_id: r.doc_tokens for r in got}.values())
    assert len(got) <= parts + tokens // 2048


@pytest.mark.parametrize("mixture", [{"s": 0.0}, {"s": -1.0}])
def test_a_source_without_proportion_is_refused(spark, mixture):
    with pytest.raises(ValueError):
        pack(documents(spark, [(1, "x")]), PATH, mixture=mixture)
