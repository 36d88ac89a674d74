"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected in the mix equally often. These expectations are
summed along the source, shifted by one random offset, and a document is taken once per
whole number that its stretch crosses. The documents are sorted by size, so neighbours
are alike and the words taken differ from the target by little more than one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.sharding import running_totals
from tallyward.llm.store import Scratch

#: Weights of the sources in their order, repeating; words of the mix per word at hand; largest target per word of a source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Expected copies are whole multiples of one in so many: their sums are exact, and fit for 2^38 documents.
UNIT = 1 << 24
#: Rows of some 100 bytes that are sent to all tasks.
SENT_SOURCES = 100_000


def words(text: Column) -> Column:
    """Number of runs of characters other than space and the control characters 9 to 13."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, store: Scratch, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, rows, source_size, target`` for rows of these and ``_last``, by which a null source goes last.

    All sources rise with their weights until the mix is full; one that reaches ``most``
    times its size stays there. So a source's target is the smaller of its weight times one
    common level, and its cap. The sources are sorted by the level at which they are full;
    sums over the ones before tell the level that would fill the mix with the rest, and the
    first source that is not full at it gives the level. No source needs the driver.
    """
    placed = running_totals(sources, ["_last", "source"], [], store, "sources-named")
    turn = F.expr(f"row_before % {len(weights)}").cast("int") + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)
    weighed = placed.withColumn("weight", weight)
    weighed = store.keep(weighed.select("source", "rows", "source_size", "weight", (F.col("source_size") * most / F.col("weight")).alias("full_at")), "sources-weighed")
    size, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    ordered = running_totals(weighed, ["full_at", "source"], ["source_size", "weight"], store, "sources-ordered")
    left_over = share * F.lit(float(size or 0)) - most * F.col("source_size_before")
    ordered = ordered.withColumn("level", left_over / (F.lit(weight or 0.0) - F.col("weight_before")))
    level = ordered.filter(F.col("level") <= F.col("full_at")).agg(F.min_by("level", "row_before")).first()[0]
    risen = F.col("weight") * F.lit(level).cast("double")
    return weighed.select("source", "rows", "source_size", F.least(F.col("source_size") * float(most), risen).alias("target"))


def offset(source: Column, seed: str) -> Column:
    """The source's random offset: the first 24 bits of a hash of the seed and its name."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("-")))
    return F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("bigint")


def systematic_copies(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per document ``doc_id, size, source_size, target, taken, copies``.

    ``docs`` has ``doc_id, source, text``; size is the text's number of words. The sources,
    by code point, weigh ``weights`` in turn and share ``share`` times all sizes; none gets
    more than ``most`` times its size. ``copies`` says how often the mix takes a document, at
    most ``most`` times rounded up, ``taken`` how many words that makes. A source's taken words
    miss its target by little more than its largest document. ``carry`` names columns to keep,
    as fields of ``row``. The same table and seed give the same mix however it is laid out.

    Defined cases: a null text has size 0 and is taken as often as others of its source, at no
    cost; of a source of size 0 nothing is taken. A null source is a source of its own, the
    last; the empty name is the first. Null ids come first among documents of one size, equal
    ids follow the hashes of their texts. An empty table gives an empty result. Other columns
    are not read.
    """
    store = Scratch(docs.sparkSession, "mixing")
    source, text = F.col("source").cast("string"), F.col("text").cast("string")
    kept = [F.struct(*[docs[c] for c in carry]).alias("row")] if carry else []
    sized = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        source.alias("source"),
        words(text).alias("size"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("_sum"),
        *kept,
    )
    sized = store.keep(sized, "sized")
    counted = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goals = targets(store.keep(counted.withColumn("_last", F.col("source").isNull()), "sources"), store, weights, share, most)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)
    goals = goals.withColumn("expected", F.round(copies * UNIT).cast("bigint"))
    goals = goals.withColumn("all", F.col("rows") * F.col("expected"))
    goals = store.keep(running_totals(goals, ["source"], ["all"], store, "goals-ordered"), "goals")
    few = goals.count() <= SENT_SOURCES
    listed = goals.select(F.col("source").alias("_source"), "source_size", "target", "expected", F.col("all_before").alias("begins"))
    met = sized.join(F.broadcast(listed) if few else listed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = running_totals(met, ["source", "size", "doc_id", "_sum"], ["expected"], store, "placed")
    start = F.col("expected_before") - F.col("begins") + offset(F.col("source"), seed)
    placed = placed.withColumn("_start", start)
    crossed = F.expr(f"(_start + expected) div {UNIT} - _start div {UNIT}")
    shown = placed.withColumn("copies", crossed).withColumn("taken", F.col("copies") * F.col("size"))
    return shown.select("doc_id", "size", "source_size", "target", "taken", "copies", *["row" for _ in kept])


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with a ``copy`` number from 1.

    Options are those of ``systematic_copies``; its defined cases hold. A column named ``copy``
    gives way to the number.
    """
    taken = systematic_copies(docs, carry=docs.columns, **options)
    each = taken.filter(F.col("copies") > 0).select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy"))
    names = [c for c in docs.columns if c != "copy"]
    return each.select(*[F.col("row")[c].alias(c) for c in names], F.col("_copy").alias("copy"))
