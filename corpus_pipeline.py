"""The corpus pipeline: each stage takes documents and hands on documents, the last one packed windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward.llm import stages
from tallyward.llm.store import Scratch

STAGES = [
    ("quality", stages.keep_quality),
    ("near_dedup", stages.drop_near_duplicates),
    ("decontamination", stages.drop_contaminated),
    ("secrets", stages.mask_secrets),
    ("packing", stages.pack_windows),
]

#: Tokenising, component search and sampling are not expressible in SQL; tests/llm compares with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``, each written as Parquet and read again."""
    store = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def pipeline_oracles() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
