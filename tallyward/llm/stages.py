"""Pipeline stages: functions of documents, each applying one operator's decisions.

All but the last return the columns they were given, whatever these are.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.decontaminate import contaminated
from tallyward.llm.neardup import near_duplicates
from tallyward.llm.packing import pack
from tallyward.llm.quality import select_by_importance
from tallyward.llm.secrets import find_secrets, masked
from tallyward.llm.store import Scratch, sent_if_small

TOKENIZER = "word_bpe_49k.json"
TEMPERATURE = 0.7
#: Numbers of rows to drop (8 bytes each), and texts with secrets (some 200 bytes of hash and places), that are sent to all tasks.
SENT_IDS = 1_000_000
SENT_FINDINGS = 100_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws and that are not toxic. Both are worked out once more, which spares a join of texts.

    Rows are judged one by one, by id and text; a null text is empty, a null id an id of its own.
    """
    _, model, least = select_by_importance(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), reject_toxic=True)

    @F.arrow_udf("boolean")
    def drawn(ids: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array(model.drawn(ids, texts, least))

    return docs.filter(drawn(docs["doc_id"].cast("bigint"), docs["text"].cast("string")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: of the smallest id, and of these the first one.

    Rows are judged one by one: those without id, and those that share one, are rows like
    others, those without id coming last.
    """
    docs, row = _numbered(docs)
    store = Scratch(spark, "groups")
    near = near_duplicates(docs, id_col=row).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    named = docs.select(F.col(row).alias("row"), F.col("doc_id").cast("bigint").alias("id"))
    near = store.keep(near.join(named, "row"), "near")
    best = near.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("best"), F.count(F.lit(1)).alias("n"))
    best = store.keep(best.filter("n > 1").select("group", F.col("best.row").alias("row")), "best")
    others = near.filter("row <> group").select("row").union(best.select(F.col("group").alias("row")))
    return _without(docs, row, others.join(best.select("row"), "row", "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item, whatever their ids; null and empty texts stay."""
    docs, row = _numbered(docs)
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row)
    return _without(docs, row, found.select(F.col("doc_id").alias("row")))


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, in a column of a name not taken; a written table gives the same numbers each time it is read."""
    row, taken = "_row", {c.lower() for c in docs.columns}
    while row in taken:
        row = "_" + row
    return docs.withColumn(row, F.monotonically_increasing_id()), row


def _without(docs: DataFrame, row: str, found: DataFrame) -> DataFrame:
    gone = Scratch(docs.sparkSession, "gone").keep(found.select(F.col("row").alias("_gone")).distinct(), "rows")
    gone = sent_if_small(gone, SENT_IDS)
    return docs.join(gone, docs[row] == gone["_gone"], "left_anti").drop(row)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts; ``n_chars`` of a changed text is counted anew."""
    _, ledger = find_secrets(docs)
    spans = F.flatten(F.transform("scanned", lambda s: s["spans"]))
    found = ledger.select(F.col("blob").alias("_blob"), F.sort_array(spans).alias("_spans")).filter(F.size("_spans") > 0)
    found = sent_if_small(Scratch(spark, "masking").keep(found, "found"), SENT_FINDINGS)
    blob = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256)
    met = docs.join(found, blob == found["_blob"], "left")
    text = F.when(found["_spans"].isNull(), docs["text"]).otherwise(masked(docs["text"], found["_spans"]))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        length = F.char_length(masked(docs["text"], found["_spans"]))
        changed["n_chars"] = F.when(found["_spans"].isNull(), docs["n_chars"]).otherwise(length)
    return met.select(*[changed.get(c, docs[c]).alias(c) for c in docs.columns])


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training windows; a null text gives its end token alone, null is a source like others."""
    return pack(docs, public_tokenizers.path(TOKENIZER), temperature=TEMPERATURE, wordwise=True)
