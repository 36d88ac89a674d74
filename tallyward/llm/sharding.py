"""Contiguous shards of near equal size, by global prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.store import Scratch


def running_totals(
    rows: DataFrame, order: Sequence[str], measures: Sequence[str], store: Scratch, name: str
) -> DataFrame:
    """The rows with ``<measure>_before``, its exact sum over all rows that come earlier, and ``row_before``, their number.

    The rows are dealt out by ranges of the order and written; each range is summed up,
    the ranges' totals are summed along (one number per range), and every row adds what
    comes before it in its own range. No task sees more than a range or the totals. Equal
    rows are told apart by a number of their own, so that they too spread over ranges.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = rows.withColumn("_own", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(tasks, *order, "_own").withColumn("_range", F.spark_partition_id())
    ranged = store.keep(ranged, name)
    sums = [F.sum(m).alias(f"_{m}") for m in measures]
    totals = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), *sums)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(f"_{m}").over(earlier), F.lit(0)).alias(f"_base_{m}") for m in ("rows", *measures)],
    )
    inside = Window.partitionBy("_range").orderBy(*order, "_own").rowsBetween(Window.unboundedPreceding, -1)

    def before(total: Column) -> Column:
        return F.coalesce(total.over(inside), F.lit(0).cast("bigint"))

    within = ranged.select(
        "*", before(F.count(F.lit(1))).alias("_in_rows"), *[before(F.sum(m)).alias(f"_in_{m}") for m in measures]
    )
    # as many rows as there are ranges
    met = within.join(F.broadcast(bases), F.col("_range") == F.col("_of"))
    added = [(F.col(f"_in_{m}") + F.col(f"_base_{m}")).alias(f"{m}_before") for m in measures]
    return met.select(*rows.columns, *added, (F.col("_in_rows") + F.col("_base_rows")).alias("row_before"))


def balanced_shards(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Documents in the order of their ids are cut where the running sum of their sizes
    passes equal targets: a document belongs to the shard in whose range its middle lies.
    Size is the text's UTF-8 length plus 1. Shards are contiguous, their sizes differ by
    no more than a document; ``slot`` counts from 0 in each. The law is ``bytes``, so
    ``grown_shard`` is null.

    Defined cases: a null text has size 1 and the checksum of an empty one. Rows without
    id come first, equal ids in the order of their checksums and sizes. A shard may be
    empty if documents are fewer or larger than the targets. An empty table gives an empty
    result. Other columns are not read.
    """
    store = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = running_totals(sized, ["doc_id", "text_crc32", "size"], ["size"], store, "ranged")
    total = sized.agg(F.sum("size")).first()[0] or 0
    cut = placed.withColumn("_middle", 2 * F.col("size_before") + F.col("size"))
    shard = F.least(F.expr(f"_middle * {shards} div {max(1, 2 * total)}"), F.lit(shards - 1)).cast("int")
    cut = cut.withColumn("shard", shard).drop("_middle")
    cut = store.keep(cut, "cut")
    first = cut.groupBy(F.col("shard").alias("_shard")).agg(F.min("row_before").alias("_first"))
    # as many rows as there are shards
    met = cut.join(F.broadcast(first), F.col("shard") == F.col("_shard"))
    return met.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row_before") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
