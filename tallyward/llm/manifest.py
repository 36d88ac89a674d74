"""Merkle manifests of a dataset, with a proof of membership per document.

A tree's nodes are numbered along; every ``FANOUT`` consecutive ones are a parent's
children. Conditional aggregates spread the children into one column per slot. All
columns concatenated are hashed into the parent; all but a child's own are its siblings.

Levels are worked off in tiers. The nodes below one node of the tier's top level are
shuffled to one place once, and all of the tier's levels are pivoted there, a child
with its own children nested in its slot. So a tree of n leaves takes one shuffle of
its leaves per ``TIER`` levels, of geometrically fewer rows each, and no task holds
more than ``FANOUT ** TIER`` nodes of one group, whatever the size of a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.sharding import running_totals
from tallyward.llm.store import Scratch, sent_if_small

#: Fixed value: children of a node.
FANOUT = 3
#: Levels per shuffle.
TIER = 4
#: Rows of some 150 bytes that are sent to all tasks.
SENT_SOURCES = 100_000
#: Rows of up to some 3 KB that are sent to all tasks.
SENT_PATHS = 10_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCK = FANOUT**TIER


def told(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[told(v) for v in values]), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """Without line ends, where the checksum of the id is even."""
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def _count_at(level: int) -> Column:
    """Nodes of a tree of ``n`` leaves, so many levels up."""
    size = FANOUT**level
    return F.expr(f"(n + {size - 1}) div {size}")


def _pivoted(nodes: DataFrame, tier: int) -> DataFrame:
    """One row per group of a tier, ``tree, block, n, hash, kids``, from rows ``tree, at, n, node``.

    ``node`` is a struct whose first field is ``hash``. ``kids`` holds a node's children in
    the order of their slots, each with its own. A tree's topmost node is passed on as it is.
    """
    rows = nodes.withColumn("block", F.expr(f"at div {_BLOCK}")).repartition("tree", "block")
    for step in range(TIER):
        level = tier * TIER + step
        slots = [F.max(F.when(F.col("at") % FANOUT == s, F.col("node"))).alias(f"slot{s}") for s in range(FANOUT)]
        # grouped within what the repartitioning has brought together: no further shuffle
        rows = rows.groupBy("tree", "block", "n", F.expr(f"at div {FANOUT}").alias("at")).agg(*slots)
        joined = F.concat(*[F.coalesce(F.col(f"slot{s}.hash"), F.lit("")) for s in range(FANOUT)])
        hashed = F.when(_count_at(level) > 1, F.sha2(joined, 256)).otherwise(F.col("slot0.hash"))
        kids = F.filter(F.array(*[F.col(f"slot{s}") for s in range(FANOUT)]), lambda k: k.isNotNull())
        rows = rows.select("tree", "block", "n", "at", F.struct(hashed.alias("hash"), kids.alias("kids")).alias("node"))
    return rows.select("tree", "block", "n", "node")


def climb(nodes: DataFrame, widest: int, store: Scratch, name: str) -> list[DataFrame]:
    """The tiers of a forest from its leaves ``tree, at, n, node`` up to one group per tree.

    ``n`` is the tree's number of leaves, ``at`` a leaf's place in it, ``node`` a struct that
    begins with ``hash``; ``widest`` is the largest ``n``.
    """
    tiers = []
    while not tiers or widest > 1:
        tiers.append(store.keep(_pivoted(nodes, len(tiers)), f"{name}-{len(tiers)}"))
        widest = -(-widest // _BLOCK)
        nodes = tiers[-1].select("tree", F.col("block").alias("at"), "n", F.struct("node.hash").alias("node"))
    return tiers


def tops(tiers: list[DataFrame]) -> DataFrame:
    """``tree, hash``: the root of every tree."""
    return tiers[-1].select("tree", F.col("node.hash").alias("hash"))


def _descended(blocks: DataFrame, tier: int) -> DataFrame:
    """``tree, at, node, path`` of the nodes below a tier's groups, from rows ``tree, block, n, node, path``.

    ``path`` lists, from the node up to the root, the siblings on the left and on the right
    of each level, which are the slots but the node's own. A level without a parent adds none.
    """
    rows = blocks.withColumn("at", F.col("block"))
    for step in reversed(range(TIER)):
        child, others = F.col("kids")[F.col("slot")], F.col("kids.hash")
        left = F.array_join(F.slice(others, F.lit(1), F.col("slot")), "")
        right = F.array_join(F.slice(others, F.col("slot") + 2, F.lit(FANOUT)), "")
        own = F.array(F.struct(left.alias("left"), right.alias("right")))
        path = F.when(_count_at(tier * TIER + step) > 1, F.concat(own, F.col("path"))).otherwise(F.col("path"))
        rows = rows.select("tree", "n", "at", "path", F.col("node.kids").alias("kids"))
        rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.size("kids") - 1)).alias("slot"))
        rows = rows.select("tree", "n", (F.col("at") * FANOUT + F.col("slot")).alias("at"), child.alias("node"), path.alias("path"))
    return rows


def descend(tiers: list[DataFrame], paths: DataFrame, store: Scratch, name: str) -> DataFrame:
    """``tree, node, path`` of every leaf; ``paths`` has ``tree, path`` from every tree's root upwards."""
    above = paths.select("tree", F.lit(0).cast("bigint").alias("block"), "path")
    for tier in reversed(range(len(tiers))):
        rows = _descended(tiers[tier].join(sent_if_small(above, SENT_PATHS), ["tree", "block"]), tier)
        if tier:
            above = store.keep(rows.select("tree", F.col("at").alias("block"), "path"), f"{name}-paths-{tier}")
    return rows.select("tree", "node", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings along its path."""
    return F.aggregate(path, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]), 256))


def proof(path: Column) -> Column:
    """One hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def dataset_manifest(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``docs`` has ``doc_id, source, lang, n_chars, text``. A document's leaf is the hash of
    these five. Leaves of a source make a tree, the roots of the sources another. The
    siblings of a document are folded with its leaf as read again, which differs where the
    text was tampered with (see ``tampered_text``), and the result is compared with the root.

    Defined cases: a null field is told as ``-``, unlike an empty one. A null source is a
    source of its own, the first. Within a source, null ids come first, and rows of one id
    follow their leaves; repeated rows are leaves each. A null id has no checksum, so its text
    is not tampered with. A single leaf is the root of its source, a single source's root is
    the root. An empty table gives an empty result. Other columns are not read.
    """
    store = Scratch(docs.sparkSession, "merkle")
    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.col("text").cast("string").alias("text"),
    )
    again = tampered_text(F.col("doc_id"), F.col("text"))
    differs = F.octet_length(again) < F.octet_length("text")
    changed = F.when(differs, leaf_hash([*[F.col(f) for f in FIELDS[:-1]], again]))
    # null where the leaf is as it was
    leaves = read.select("doc_id", "source", leaf_hash([F.col(f) for f in FIELDS]).alias("leaf"), changed.alias("changed"))
    leaves = store.keep(leaves, "leaves")
    placed = running_totals(leaves, ["source", "doc_id", "leaf"], [], store, "placed")

    counted = leaves.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    trees = store.keep(running_totals(counted, ["source"], ["n"], store, "sources"), "trees")
    widest, everything = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    few = everything <= SENT_SOURCES
    listed = trees.select(F.col("source").alias("_source"), F.col("row_before").alias("tree"), F.col("n_before").alias("first"), "n")
    nodes = placed.join(F.broadcast(listed) if few else listed, F.col("source").eqNullSafe(F.col("_source"))).select(
        "tree",
        (F.col("row_before") - F.col("first")).alias("at"),
        "n",
        F.struct(F.col("leaf").alias("hash"), "changed", "doc_id").alias("node"),
    )
    lower = climb(nodes, widest or 0, store, "lower")

    roots = tops(lower).select(
        F.lit(0).cast("bigint").alias("tree"),
        F.col("tree").alias("at"),
        F.lit(everything).cast("bigint").alias("n"),
        F.struct("hash", F.col("tree").alias("of")).alias("node"),
    )
    upper = climb(roots, everything, store, "upper")
    root = tops(upper).first()
    none = F.array().cast("array<struct<left:string,right:string>>")
    over = descend(upper, tops(upper).select("tree", none.alias("path")), store, "upper")
    over = store.keep(over.select(F.col("node.of").alias("tree"), "path", F.col("node.hash").alias("subroot")), "over")

    below = descend(lower, over.select("tree", "path"), store, "lower")
    small = over.select("tree", "subroot")
    small = F.broadcast(small) if few else small
    leaf, of_all = F.col("node.hash"), F.lit(root[1] if root else None).cast("string")
    again = folded(F.coalesce(F.col("node.changed"), leaf), F.col("path"))
    told_rows = below.join(small, "tree").select(
        F.col("node.doc_id").alias("doc_id"),
        leaf.alias("leaf"),
        "subroot",
        of_all.alias("root"),
        proof(F.col("path")).alias("proof_sha256"),
        again.alias("folded_root"),
    )
    return told_rows.withColumn("verified", F.col("folded_root") == F.col("root"))
