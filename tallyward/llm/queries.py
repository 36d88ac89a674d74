"""The numbered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyward.llm.decontaminate import contaminated
from tallyward.llm.extraction import extract_pages
from tallyward.llm.imatch import edited_fingerprints
from tallyward.llm.neardup import near_duplicates
from tallyward.llm import fixity, licences, packing
from tallyward.llm.manifest import dataset_manifest
from tallyward.llm.mixing import systematic_copies
from tallyward.llm.quality import select_by_importance
from tallyward.llm.secrets import digest, earlier_version, find_secrets
from tallyward.llm.sharding import balanced_shards
from tallyward.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Small sources come earlier than in proportion.
TEMPERATURE = 0.7


def op1_deficit_round_robin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.digest(packing.pack(docs, WORD_TOKENIZER, temperature=TEMPERATURE, wordwise=True))


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' earlier version is scanned, then the present one against its ledger."""
    docs = _table(spark, sf_dir, "documents")
    _, ledger = find_secrets(earlier_version(docs))
    return digest(find_secrets(docs, ledger=ledger)[0])


def op4_byte_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(_table(spark, sf_dir, "documents"))


def op5_equivalence_class_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op6_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op7_merkle_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return fixity.audit(pages, fixity.decayed(pages))


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_by_importance(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), reject_toxic=True)[0]


def op9_positional_licence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.scan_licences(_table(spark, sf_dir, "documents")))


def op10_minhash_inverted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_merkle_slot_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_manifest(_table(spark, sf_dir, "documents"))


def op12_block_matrix_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return systematic_copies(_table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
            op1_deficit_round_robin_packing,
            op2_template_decontamination,
            op3_blob_ledger_secrets,
            op4_byte_prefix_shards,
            op5_equivalence_class_extraction,
            op6_imatch_fingerprints,
            op7_merkle_fixity_audit,
            op8_importance_resampling,
            op9_positional_licence_index,
            op10_minhash_inverted_join,
            op11_merkle_slot_pivot,
            op12_block_matrix_whitening,
            op13_systematic_mixing,
        )}

