"""MinHash near-duplicates by an inverted join over signature coordinates.

Every document is posted under its (coordinate, value) pairs. Two documents are
candidates if enough of their coordinates agree; a candidate becomes a link if the
shingle sets themselves overlap enough. Linked documents form components.

Prefix merging: coordinates are ordered by how many documents share the pair, rarest
first. Of two signatures that agree in at least ``least`` of ``coordinates`` places, the
rarest ``coordinates - least + 1`` of each must share a pair, so only those are posted,
and a document that shares fewer than ``least`` of its pairs with anybody is posted
nowhere. Skip merging: the rest of the count is looked up in the signatures.

Long posting lists are never joined with themselves. Every member meets its list's
smallest one, and of all it meets so the few it meets most often are compared with it.
Lists whose members that leaves in several components are finished in blocks of bounded
size, inside tasks, which give back links only. Short lists (up to ``short`` documents)
are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.llm.hashing import Runs, blank_separated, blocks, give_back
from tallyward.llm.store import Scratch

COORDINATES = 64
#: Of a pair at similarity 0.75, fewer than this many of 64 coordinates agree once in 70,000 pairs.
LEAST = 34
WIDTH = 5
SIMILARITY = 0.75
SHORT = 16
#: Documents, bytes of text and shingles that a block comparison holds at a time.
_BLOCK_ROWS = 1024
_BLOCK_BYTES = 16 << 20
_BLOCK_COLUMNS = 8192

_SIGNED = "id bigint, first bigint, second bigint, n_shingles bigint, signature array<int>, sketch binary"


@lru_cache(maxsize=4)
def _functions(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240229)
    scale = draw.integers(1, 1 << 63, coordinates, dtype=np.uint64) | np.uint64(1)
    shift = draw.integers(0, 1 << 63, coordinates, dtype=np.uint64)
    return scale, shift


def _lowest(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The signature: each hash function's smallest value, its upper 32 bits."""
    scale, shift = _functions(coordinates)
    low = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(low, (shingles[at : at + 1024, None] * scale + shift).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def signed_batches(batches: Iterator[pa.RecordBatch], width: int, coordinates: int) -> Iterator[pa.RecordBatch]:
    classes = blank_separated()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for start, stop in blocks(texts):
            runs = Runs(texts.slice(start, stop - start), classes)
            first, second = runs.sequences()
            shingles, begins = runs.shingles(width)
            sizes, signatures = [], []
            for a, b in zip(begins[:-1], begins[1:], strict=True):
                distinct = np.unique(shingles[a:b])
                sizes.append(len(distinct))
                signatures.append(_lowest(distinct, coordinates) if len(distinct) else np.zeros(0, dtype=np.uint32))
            ends = np.concatenate([[0], np.cumsum([len(s) for s in signatures])]).astype(np.int32)
            flat = np.concatenate(signatures) if signatures else np.zeros(0, dtype=np.uint32)
            yield pa.record_batch(
                {
                    "id": ids.slice(start, stop - start).cast(pa.int64()),
                    "first": pa.array(first.view(np.int64)),
                    "second": pa.array(second.view(np.int64)),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "signature": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int32))),
                    "sketch": pa.array([s.astype(np.uint8).tobytes() for s in signatures], pa.binary()),
                }
            )
        give_back()


def agreeing_batches(batches: Iterator[pa.RecordBatch], coordinates: int, least: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches (the low byte of each coordinate) agree in enough places, with the count."""
    for batch in batches:
        one, two = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(-1, coordinates) for k in (2, 3)
        )
        agree = (one == two).sum(axis=1)
        held = pa.array(agree >= least)
        yield pa.record_batch(
            {
                "a": batch.column(0).filter(held),
                "b": batch.column(1).filter(held),
                "agree": pa.array(agree[agree >= least].astype(np.int32)),
            }
        )


def confirmed_batches(batches: Iterator[pa.RecordBatch], width: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole shingle sets overlap enough: 100 * common >= 100 * similarity * either."""
    percent, classes = round(100 * similarity), blank_separated()
    for batch in batches:
        held = np.zeros(len(batch), dtype=bool)
        last: tuple[object, np.ndarray] = (None, np.zeros(0, dtype=np.uint64))
        for row in range(len(batch)):
            key = batch.column(0)[row].as_py()
            if key != last[0]:
                last = (key, _distinct(batch.column(2)[row].as_py(), width, classes))
            left, right = last[1], _distinct(batch.column(3)[row].as_py(), width, classes)
            common = len(np.intersect1d(left, right, assume_unique=True))
            held[row] = 100 * common >= percent * (len(left) + len(right) - common)
        yield pa.record_batch({"a": batch.column(0).filter(pa.array(held)), "b": batch.column(1).filter(pa.array(held))})
        give_back()


def _distinct(text: str, width: int, classes: np.ndarray) -> np.ndarray:
    return np.unique(Runs(pa.array([text]), classes).shingles(width)[0])


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    width: int = WIDTH,
    coordinates: int = COORDINATES,
    least: int = LEAST,
    short: int = SHORT,
) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id, kept``.

    Documents whose sets of ``width``-word shingles have a Jaccard similarity of at least
    ``similarity`` are linked; ``component_id`` is the smallest id of all that can be
    reached, and ``kept`` marks the document that bears it. Equal word sequences are one
    node from the start. The links of a node are found with the error of MinHash alone:
    see ``LEAST``; what is found is exact.

    Defined cases: a text without words, empty or null, has 0 shingles and stands alone.
    A row without id stands alone too, with null ``component_id``, and is kept. Rows that
    share an id share their component. An empty table gives an empty result. Other
    columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    store = Scratch(spark, "neardup")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = store.keep(rows.mapInArrow(lambda it: signed_batches(it, width, coordinates), _SIGNED), "signed")

    sequences = signed.filter("n_shingles > 0 AND id IS NOT NULL")
    nodes = sequences.groupBy("first", "second").agg(F.min("id").alias("node"))
    nodes = store.keep(nodes, "nodes")
    ours = sequences.join(
        nodes.select(F.col("node").alias("id"), "first", "second"), ["id", "first", "second"], "left_semi"
    ).select(F.col("id").alias("node"), "signature", "sketch")
    ours = store.keep(ours, "signatures")
    lists = store.keep(_postings(ours, coordinates, least), "lists")

    texts = rows.join(lists.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    texts = store.keep(texts, "texts")
    links = _linked(store, lists, ours.select("node", "sketch"), texts, similarity, width, coordinates, least, short)

    links = store.keep(links, "links")
    store.keep_only("signed", "nodes", "links")
    labelled = nodes.join(links, "node", "left").select(
        "first", "second", F.coalesce("component", "node").alias("component_id")
    )
    alone = F.col("n_shingles") == 0
    found = signed.select("id", "n_shingles", "first", "second").join(labelled, ["first", "second"], "left")
    component = F.when(alone | F.col("id").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        (F.col("id").isNull() | (component == F.col("id"))).alias("kept"),
    )


def _postings(signatures: DataFrame, coordinates: int, least: int) -> DataFrame:
    """``coordinate, value, sharing, node``: the rarest shared pairs of each node that shares enough of them."""
    pairs = signatures.select("node", F.posexplode("signature").alias("coordinate", "value"))
    sharing = pairs.groupBy("coordinate", "value").agg(F.count(F.lit(1)).alias("sharing")).filter("sharing > 1")
    shared = pairs.join(sharing, ["coordinate", "value"])
    entry = F.struct("sharing", "coordinate", "value")
    merged = shared.groupBy("node").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    prefix = F.slice("entries", F.lit(1), F.size("entries") - F.lit(least - 1))
    return (
        merged.filter(F.size("entries") >= least)
        .select("node", F.explode(prefix).alias("e"))
        .select("e.coordinate", "e.value", "e.sharing", "node")
    )


_LIST = ["coordinate", "value"]


def _linked(store, lists, sketches, texts, similarity, width, coordinates, least, short) -> DataFrame:
    """``node, component`` of all nodes that have a link."""
    graph = _Graph(store, sketches, texts, similarity, width, coordinates, least)

    brief = lists.filter(F.col("sharing") <= short).groupBy(*_LIST).agg(F.sort_array(F.collect_set("node")).alias("m"))
    each = F.expr("flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> struct(x AS a, y AS b))))")
    whole = brief.filter(F.size("m") > 1).select(F.explode(each).alias("p")).select("p.a", "p.b")
    open_lists = lists.filter(F.col("sharing") > short).select(*_LIST, "node")
    stars = open_lists.groupBy(*_LIST).agg(F.min("node").alias("_star"))
    graph.try_pairs(_foremost(_rays(open_lists, stars)).union(whole))

    unsettled = _unsettled(store, graph, open_lists)
    if not unsettled.isEmpty():
        graph.add(_by_blocks(store, unsettled, texts, width, similarity), "blocks")
    return graph.labels


def _by_blocks(store, unsettled: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links among the members of unsettled lists that no star has connected.

    Lists that share members make a crowd. Whoever is outside the largest component of
    one of its lists is compared with its whole crowd, block by block: a task gets two
    blocks and gives back no more links than it takes to connect their components.
    """
    lowest = unsettled.groupBy(*_LIST).agg(F.min("node").alias("a"))
    crowds = components(unsettled.join(lowest, _LIST).select("a", F.col("node").alias("b")), store, "crowds")
    members = unsettled.groupBy("node").agg(
        F.first("component").alias("component"), F.max(F.col("component") != F.col("_main")).alias("outside")
    )
    members = members.join(crowds.withColumnRenamed("component", "crowd"), "node")
    members = members.join(texts.withColumnRenamed("id", "node"), "node").withColumn("_size", F.octet_length("text"))
    members = store.keep(members, "members")

    def parts(rows: str) -> Column:
        by_rows = F.count_if(F.expr(rows)) / F.lit(_BLOCK_ROWS)
        by_bytes = F.sum(F.when(F.expr(rows), F.col("_size")).otherwise(0)) / F.lit(_BLOCK_BYTES)
        return F.greatest(F.ceil(by_rows), F.ceil(by_bytes)).cast("int")

    sizes = members.groupBy("crowd").agg(parts("true").alias("_all"), parts("outside").alias("_few"))
    dealt = members.join(sizes, "crowd")
    one, other = F.pmod(F.xxhash64("node"), F.col("_few")), F.pmod(F.xxhash64("node"), F.col("_all"))
    columns = ["crowd", "node", "component", "text"]
    few = dealt.filter("outside").select(
        *columns, F.lit(True).alias("few"), one.alias("one"), F.explode(F.expr("sequence(0L, _all - 1)")).alias("other")
    )
    every = dealt.select(
        *columns, F.lit(False).alias("few"), F.explode(F.expr("sequence(0L, _few - 1)")).alias("one"), other.alias("other")
    )
    met = few.unionByName(every)
    return met.groupBy("crowd", "one", "other").applyInArrow(
        lambda table: block_links(table, width, similarity), "a bigint, b bigint"
    )


def block_links(table: pa.Table, width: int, similarity: float) -> pa.Table:
    """Links that connect the components of two blocks, from the exact sizes of all their intersections."""
    percent, classes = round(100 * similarity), blank_separated()
    table = table.combine_chunks()
    few = table.column("few").to_numpy().astype(bool)
    nodes, parts = table.column("node").to_numpy(), table.column("component").to_numpy()
    sets: list[np.ndarray] = []
    texts = pa.concat_arrays(table.column("text").chunks)
    for first, last in blocks(texts):
        shingles, begins = Runs(texts.slice(first, last - first), classes).shingles(width)
        sets += [np.unique(shingles[i:j]) for i, j in zip(begins[:-1], begins[1:], strict=True)]
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    left, right = np.flatnonzero(few), np.flatnonzero(~few)
    value, times = np.unique(np.concatenate(sets), return_counts=True)
    value = value[times > 1]
    columns = [np.searchsorted(value, x[np.isin(x, value, assume_unique=True)]) for x in sets]
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, len(value), _BLOCK_COLUMNS):
        wide = min(_BLOCK_COLUMNS, len(value) - start)
        held = np.zeros((len(sets), wide), dtype=np.float32)
        for row, places in enumerate(columns):
            held[row, places[(places >= start) & (places < start + wide)] - start] = 1
        common += held[left] @ held[right].T
    common = common.astype(np.int64)
    either = sizes[left][:, None] + sizes[right][None, :] - common
    linked = (100 * common >= percent * either) & (parts[left][:, None] != parts[right][None, :])
    rows, cols = np.nonzero(linked)
    a, b = left[rows], right[cols]
    _, some = np.unique(np.stack([parts[a], parts[b]]), axis=1, return_index=True)
    parent: dict[int, int] = {}

    def root(part: int) -> int:
        while parent.get(part, part) != part:
            part = parent[part]
        return part

    out: list[tuple[int, int]] = []
    for k in some:
        one, two = sorted((root(int(parts[a[k]])), root(int(parts[b[k]]))))
        if one != two:
            parent[two] = one
            out.append((int(nodes[a[k]]), int(nodes[b[k]])))
    ends = np.array(out, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": ends.min(axis=1), "b": ends.max(axis=1)})


def _unsettled(store, graph, open_lists: DataFrame) -> DataFrame:
    """The lists whose members are not all connected yet, with each member's component and the largest one's."""
    labelled = store.keep(graph.labelled(open_lists.select(*_LIST, "node")), "open")
    sizes = labelled.groupBy(*_LIST, "component").agg(F.count(F.lit(1)).alias("_size"))
    largest = sizes.groupBy(*_LIST).agg(
        F.max(F.struct("_size", "component")).alias("_largest"), F.count(F.lit(1)).alias("_components")
    )
    largest = largest.filter("_components > 1").select(*_LIST, F.col("_largest.component").alias("_main"))
    return store.keep(labelled.join(largest, _LIST), "still")


def _foremost(rays: DataFrame, few: int = 2) -> DataFrame:
    """Of each node's pairs the few that meet in the most lists. A node has no more pairs than prefix entries."""
    met = rays.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_lists"))
    order = Window.partitionBy("b").orderBy(F.desc("_lists"), "a")
    return met.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= few).select("a", "b")


def _rays(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Each list's star with its other members."""
    met = members.join(stars, _LIST).filter("node <> _star")
    return met.select(F.least("node", "_star").alias("a"), F.greatest("node", "_star").alias("b"))


class _Graph:
    """The links found so far, and the components they make."""

    def __init__(self, store, sketches, texts, similarity, width, coordinates, least):
        self.store, self.sketches, self.texts = store, sketches, texts
        self.similarity, self.width, self.coordinates, self.least = similarity, width, coordinates, least
        self.labels: DataFrame | None = None

    def labelled(self, rows: DataFrame, node: str = "node", name: str = "component") -> DataFrame:
        labels = self.labels.select(F.col("node").alias(node), F.col("component").alias("_c"))
        return rows.join(labels, node, "left").withColumn(name, F.coalesce("_c", node)).drop("_c")

    def try_pairs(self, pairs: DataFrame) -> None:
        """Add the links among the pairs.

        A node's most alike partner is confirmed first; pairs that this connects are not looked at again.
        """
        coordinates, least = self.coordinates, self.least
        two = self.sketches.select(F.col("node").alias("b"), F.col("sketch").alias("_b"))
        one = self.sketches.select(F.col("node").alias("a"), F.col("sketch").alias("_a"))
        met = pairs.distinct().join(two, "b").join(one, "a").select("a", "b", "_a", "_b")
        close = met.mapInArrow(lambda it: agreeing_batches(it, coordinates, least), "a bigint, b bigint, agree int")
        close = self.store.keep(close, "close")
        best = close.groupBy("b").agg(F.max(F.struct("agree", F.negative("a").alias("_a"))).alias("m"))
        self.add(self._confirmed(best.select(F.negative("m._a").alias("a"), "b")), "best")
        rest = self.labelled(self.labelled(close.select("a", "b"), "a", "_ca"), "b", "_cb")
        self.add(self._confirmed(rest.filter("_ca <> _cb").select("a", "b")), "rest")

    def add(self, links: DataFrame, name: str) -> None:
        """Take in links and draw the components anew, from those there are."""
        links = self.store.keep(links, f"links-{name}")
        if self.labels is None:
            self.labels = components(links, self.store, f"graph-{name}")
        elif not links.isEmpty():
            known = self.labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            self.labels = components(known.union(links), self.store, f"graph-{name}")

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        width, similarity = self.width, self.similarity
        two = self.texts.select(F.col("id").alias("b"), F.col("text").alias("_b"))
        one = self.texts.select(F.col("id").alias("a"), F.col("text").alias("_a"))
        read = pairs.join(two, "b").join(one, "a").select("a", "b", "_a", "_b")
        return read.mapInArrow(lambda it: confirmed_batches(it, width, similarity), "a bigint, b bigint")
