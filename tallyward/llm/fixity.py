"""Fixity audits of WARC archives by Merkle trees.

Pages become WARC records, laid out in files one after another. The hash of each record
is a leaf; leaves and nodes are hashed upwards, FAN at a time, together with the range of
offsets that they cover, counted from the node's own beginning, so that a record that is
longer or gone changes the nodes above it and no others. A replica's tree is built from its
own bytes at its own offsets. An audit compares roots and goes down only where they differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.sharding import running_totals
from tallyward.llm.store import Scratch

FAN = 16
LEVELS = 3
#: Records per file: one root's worth.
RECORDS = FAN**LEVELS


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The record as text; its UTF-8 form is what the file holds. Nulls are empty."""
    body = F.coalesce(html.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def _laid_out(pages: DataFrame, store: Scratch, name: str, order_col: str | None) -> DataFrame:
    """``page_id, nth, length, hash, length_before, row_before`` per record, as they follow one another.

    ``nth`` tells records of one id apart, by their hashes. It is a difference of global
    numbers, so that rows of one id need not meet in a task.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    order = F.col(order_col) if order_col else F.lit(None).cast("bigint")
    read = pages.select(F.col("page_id").cast("bigint").alias("page_id"), record.alias("_record"), order.alias("_order"))
    read = read.select(
        "page_id", F.octet_length("_record").cast("bigint").alias("length"), F.sha2("_record", 256).alias("hash"), "_order"
    )
    placed = store.keep(running_totals(read, ["page_id", "hash"], ["length"], store, f"{name}-by-id"), f"{name}-numbered")
    first = placed.groupBy(F.col("page_id").alias("_id")).agg(F.min("row_before").alias("_first"))
    placed = placed.join(first, F.col("page_id").eqNullSafe(F.col("_id"))).withColumn("nth", F.col("row_before") - F.col("_first"))
    if order_col:
        placed = placed.drop("row_before", "length_before", "_id", "_first")
        placed = running_totals(placed, ["_order", "page_id", "hash"], ["length"], store, f"{name}-by-place")
    return placed.select("page_id", "nth", "length", "hash", "length_before", "row_before")


def manifest(pages: DataFrame, store: Scratch, order_col: str | None = None) -> DataFrame:
    """``page_id, nth, file, leaf, start, stop, hash``: where each record lies, in the order of the column, else of the ids."""
    placed = _laid_out(pages, store, "ours", order_col).select(
        "*",
        F.expr(f"row_before div {RECORDS}").alias("file"),
        (F.col("row_before") % RECORDS).alias("leaf"),
    )
    # a file has no more than RECORDS records
    begin = F.min("length_before").over(Window.partitionBy("file"))
    start = F.col("length_before") - begin
    placed = placed.select("page_id", "nth", "file", "leaf", start.alias("start"), (start + F.col("length")).alias("stop"), "hash")
    return store.keep(placed, "manifest")


def replica_leaves(listed: DataFrame, replica: DataFrame, store: Scratch, order_col: str | None = None) -> DataFrame:
    """``page_id, file, leaf, offset, length, sha256`` of the manifest, ``start, stop, hash`` of a replica's own records.

    The replica's offsets run through all it holds. What it lacks has no ``hash``, what
    only the replica has has no ``file``.
    """
    own = _laid_out(replica, store, "theirs", order_col).select(
        F.col("page_id").alias("_id"),
        F.col("nth").alias("_nth"),
        F.col("length_before").alias("_start"),
        (F.col("length_before") + F.col("length")).alias("_stop"),
        F.col("hash").alias("_hash"),
    )
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("nth") == F.col("_nth"))
    met = listed.join(own, same, "full").select(
        F.when(F.col("nth").isNotNull(), F.col("page_id")).otherwise(F.col("_id")).alias("page_id"),
        "file",
        "leaf",
        F.col("start").alias("offset"),
        (F.col("stop") - F.col("start")).alias("length"),
        F.col("hash").alias("sha256"),
        F.col("_start").alias("start"),
        F.col("_stop").alias("stop"),
        F.col("_hash").alias("hash"),
    )
    return store.keep(met, "replica")


def tree(leaves: DataFrame, store: Scratch, name: str) -> list[DataFrame]:
    """Levels of ``file, leaf, start, stop, hash`` from the leaves up to one root per file (``leaf``: the node's number)."""
    levels = [leaves]
    for level in range(LEVELS):
        child = F.struct("leaf", "start", "stop", F.coalesce("hash", F.lit("")).alias("hash"))
        # FAN children at most
        met = levels[-1].groupBy("file", F.expr(f"leaf div {FAN}").alias("leaf")).agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"), F.sort_array(F.collect_list(child)).alias("c")
        )
        from_here = (lambda x: F.concat_ws(":", x["start"] - F.col("start"), x["stop"] - F.col("start"), x["hash"]))
        told = F.array_join(F.transform("c", from_here), ",")
        nodes = met.select("file", "leaf", "start", "stop", F.sha2(told, 256).alias("hash"))
        levels.append(store.keep(nodes, f"{name}-{level}"))
    return levels


def differing(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """``file, leaf`` of the records whose hashes differ, found from the roots down."""
    suspects = None
    for one, two in zip(reversed(ours), reversed(theirs), strict=True):
        if suspects is not None:
            one, two = (
                level.withColumn("_up", F.expr(f"leaf div {FAN}")).join(suspects, ["file", "_up"], "left_semi") for level in (one, two)
            )
        other = two.select("file", "leaf", F.col("hash").alias("_hash"))
        apart = one.join(other, ["file", "leaf"]).filter(~F.col("hash").eqNullSafe(F.col("_hash")))
        suspects = apart.select("file", F.col("leaf").alias("_up"))
    return suspects.withColumnRenamed("_up", "leaf")


def moved(copies: DataFrame, ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """``file, leaf`` of the records that the replica holds before the one that they should follow.

    Only files whose roots differ are looked at.
    """
    roots = theirs[-1].select("file", F.col("hash").alias("_hash"))
    apart = ours[-1].join(roots, "file").filter(~F.col("hash").eqNullSafe(F.col("_hash"))).select("file")
    # a file has no more than RECORDS records
    earlier = Window.partitionBy("file").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    read = copies.join(apart, "file", "left_semi").withColumn("_last", F.last("stop", ignorenulls=True).over(earlier))
    return read.filter(F.col("start") < F.col("_last")).select("file", "leaf")


def audit(pages: DataFrame, replica: DataFrame, order_col: str | None = None) -> DataFrame:
    """Per record ``page_id, file, offset, length, sha256, intact, found_sha256, found_offset, finding``.

    ``pages`` and ``replica`` have ``page_id, url, html``. Each is laid out by its own
    records, in the order of ``order_col`` if named (where a record lies in its archive),
    else of the ids. The manifest is that of ``pages``. ``finding`` is ``intact``,
    ``altered``, ``missing``, ``moved`` (the replica holds it before the record of its file
    that it should follow; an altered one stays altered) or ``surplus``, a record that only
    the replica has: of these ``file, offset, length`` and ``sha256`` are null.
    ``found_sha256`` is what the replica holds of an altered or surplus record,
    ``found_offset`` where, counted through the whole replica. Files may stand in any order.

    Defined cases: nulls are empty texts, a null id is an id of its own. Records that share
    an id are matched in the order of their hashes, the last ones are missing or surplus.
    An empty replica lacks every record, without pages all it holds is surplus. Other
    columns are not read.
    """
    store = Scratch(pages.sparkSession, "fixity")
    listed = manifest(pages, store, order_col)
    ours = tree(listed.select("file", "leaf", "start", "stop", "hash"), store, "ours")
    copies = replica_leaves(listed, replica, store, order_col)
    held = copies.filter(F.col("file").isNotNull())
    theirs = tree(held.select("file", "leaf", "start", "stop", "hash"), store, "theirs")
    hurt = differing(ours, theirs).withColumn("_hurt", F.lit(True))
    shifted = moved(held, ours, theirs).withColumn("_moved", F.lit(True))
    told = copies.join(hurt, ["file", "leaf"], "left").join(shifted, ["file", "leaf"], "left")
    finding = (
        F.when(F.col("file").isNull(), "surplus")
        .when(F.col("_hurt") & F.col("hash").isNull(), "missing")
        .when(F.col("_hurt"), "altered")
        .when(F.col("_moved"), "moved")
        .otherwise("intact")
    )
    told = told.withColumn("finding", finding)
    return told.select(
        "page_id",
        "file",
        "offset",
        "length",
        "sha256",
        (F.col("finding") == "intact").alias("intact"),
        F.when(F.col("finding").isin("altered", "surplus"), F.col("hash")).alias("found_sha256"),
        F.col("start").alias("found_offset"),
        "finding",
    )


def decayed(pages: DataFrame, every: int = 97) -> DataFrame:
    """A replica to audit: of ``every`` pages one has a letter altered, one lacks its end, one is gone, one is there twice."""
    turn = F.pmod("page_id", F.lit(every))
    html, half = F.col("html"), F.expr("length(html) div 2")
    flipped = F.concat(F.substring(html, F.lit(1), half), F.lit("~"), F.substring(html, half + 2, F.length(html)))
    cut = F.substring(html, F.lit(1), F.length(html) - 1)
    changed = F.when(turn == 13, flipped).when(turn == 57, cut).otherwise(html)
    times = F.when(turn == 31, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = pages.filter(~F.coalesce(turn == 91, F.lit(False)))
    return kept.select("page_id", "url", changed.alias("html"), F.explode(times).alias("_time")).drop("_time")
