"""Every operator over the table of edge cases and over an empty one."""

import pytest
import public_tokenizers

from tallyward.llm import decontaminate, imatch, licences, neardup, packing, quality, secrets, sharding
from tests.llm.conftest import EDGE_ROWS

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _operators(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (None, 1, 1), (8, None, 0), (9, 0, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, "a plain text that is long enough to count"), (2, None), (None, "x"), (3, ""), (4, "one")], "item_id bigint, text string")
    return {
        "packing": lambda d: packing.digest(packing.pack(d, TOKENIZER, wordwise=True)),
        "decontaminate": lambda d: decontaminate.contaminated(d, items),
        "secrets": lambda d: secrets.digest(secrets.find_secrets(d)[0]),
        "sharding": sharding.balanced_shards,
        "imatch": imatch.edited_fingerprints,
        "quality": lambda d: quality.select_by_importance(d, labels)[0],
        "licences": lambda d: licences.digest(licences.scan_licences(d)),
        "neardup": neardup.near_duplicates,
    }


PER_ROW = {"secrets", "sharding", "imatch", "quality", "licences", "neardup"}
NAMES = ["packing", "decontaminate", *sorted(PER_ROW)]


@pytest.mark.parametrize("name", NAMES)
def test_edge_rows(spark, edge_docs, name):
    rows = _operators(spark)[name](edge_docs).collect()
    if name in PER_ROW:
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in EDGE_ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(spark, no_docs, name):
    assert _operators(spark)[name](no_docs).collect() == []


def test_edge_results(spark, edge_docs):
    near = {r.doc_id: r for r in neardup.near_duplicates(edge_docs).collect() if r.doc_id is not None}
    assert near[2].component_id == 1 and not near[2].kept and near[1].kept
    assert [near[k].n_shingles for k in (3, 4, 5, 8)] == [0, 0, 0, 1]
    assert [near[k].component_id for k in (3, 4, 5)] == [3, 4, 5]
    assert near[7].n_shingles == 1

    found = decontaminate.contaminated(edge_docs, spark.createDataFrame([(1, "a plain text that is long enough to count"), (4, "one")], "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1), (2, 1), (8, 4)}
