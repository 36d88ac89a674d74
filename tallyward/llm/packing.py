"""Packing into training windows, to target proportions of their sources.

Every source is a queue of documents, a document longer than a window several parts of at
most a window. Deficit round-robin deals the parts: a queue's credit grows by its weight
at each turn, its next part goes out as soon as the credit covers it, and what is left
over stays the queue's deficit, across windows and partitions alike. Queues that run dry
leave their share to the others. Windows are cut from what is dealt, end to end, so a
part is in two pieces only where a window ends in it, and what a source is owed is always
less than its next part, so less than a window.

Dealing turn by turn would be one sequential loop over the corpus. With turns as short as
one likes, a part goes out at the turn ``end / weight``, where ``end`` counts its queue's
tokens up to its own last one. So the parts are sorted by that turn, range by range, and
their places are running sums: of the queue's tokens first, of all tokens then.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm.hashing import blocks, give_back
from tallyward.llm.store import Scratch, sent_if_small
from tallyward.llm.tokens import encoder

LENGTH = 2048
END = 1
#: Bytes of text encoded at a time; a word that recurs in them is encoded once.
_TEXT_BYTES = 1 << 22
#: Sums of a source in a task (some 100 bytes each) up to which they are sent to all tasks.
SENT_SUMS = 200_000

_PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string, ids binary"
_TOKENS = "part int, source string, doc_id bigint, start bigint, n bigint, doc_tokens bigint, begin bigint, ids binary"


def tokenised_batches(
    batches: Iterator[pa.RecordBatch], content: str, wordwise: bool, end: int, length: int, width: int
) -> Iterator[pa.RecordBatch]:
    """Ids (``width`` bytes each) of each text in parts of at most ``length``, with where a part begins among this task's tokens of its source."""
    encode, task = encoder(content, wordwise), TaskContext.get()
    number = task.partitionId() if task else 0
    reached: dict[str | None, int] = {}
    for batch in batches:
        for first, last in blocks(batch.column(2), _TEXT_BYTES):
            some = batch.slice(first, last - first)
            ids, counts = encode.encode(some.column(2))
            sizes = counts.astype(np.int64) + 1
            edges = np.concatenate([[0], np.cumsum(sizes)])
            full = np.full(edges[-1], end, dtype=f"<u{width}")
            full[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
            raw, begins = full.tobytes(), []
            sources = some.column(1)
            for source, n in zip(sources.to_pylist(), sizes.tolist(), strict=True):
                begins.append(reached.get(source, 0))
                reached[source] = begins[-1] + n
            parts = -(-sizes // length)
            row = np.repeat(np.arange(len(sizes)), parts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            n = np.minimum(sizes[row] - start, length)
            cuts = width * (edges[:-1][row] + start)
            yield pa.record_batch(
                {
                    "part": pa.array([number] * len(row), pa.int32()),
                    "source": sources.take(pa.array(row)),
                    "doc_id": some.column(0).take(pa.array(row)),
                    "start": pa.array(start),
                    "n": pa.array(n),
                    "doc_tokens": pa.array(sizes[row]),
                    "begin": pa.array(np.array(begins, dtype=np.int64)[row] + start),
                    "ids": pa.array([raw[a : a + width * k] for a, k in zip(cuts.tolist(), n.tolist(), strict=True)], pa.binary()),
                }
            )
        give_back()


def placed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a range, in their order, with the tokens of the range before each."""
    before = 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        ends = before + np.cumsum(n)
        yield batch.append_column("before", pa.array(ends - n))
        before = int(ends[-1]) if len(ends) else before


def piece_batches(batches: Iterator[pa.RecordBatch], length: int, width: int) -> Iterator[pa.RecordBatch]:
    """Parts cut where a window ends, at most one in each, with ids of four bytes."""
    for batch in batches:
        n, at = batch.column("n").to_numpy(), batch.column("at").to_numpy()
        first = np.minimum(n, length - at % length)
        row = np.repeat(np.arange(len(n)), 1 + (first < n))
        second = np.concatenate([[False], row[1:] == row[:-1]])[: len(row)]
        skip = np.where(second, first[row], 0)
        size = np.where(second, n[row] - skip, first[row])
        ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype=f"<u{width}").astype("<u4")
        edges = np.concatenate([[0], 4 * np.cumsum(size)]).astype(np.int32)
        place = at[row] + skip
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "start": pa.array(batch.column("start").to_numpy()[row] + skip),
                "length": pa.array(size),
                "doc_tokens": batch.column("doc_tokens").take(pa.array(row)),
                "sequence_id": pa.array(place // length),
                "offset": pa.array(place % length),
                "source": batch.column("source").take(pa.array(row)),
                "ids": pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids)]),
            }
        )


def _weights(sums: DataFrame, mixture: Mapping[str, float] | None, temperature: float) -> DataFrame:
    """``_source, _part, base, weight``: the source's tokens in earlier tasks, and its credit per turn."""
    spark = sums.sparkSession
    whole = sums.agg(F.sum("tokens")).first()[0] or 1
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("tokens").over(Window.partitionBy("source"))
    based = sums.select(
        F.col("source").alias("_source"),
        F.col("part").alias("_part"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"),
        F.pow(total / F.lit(whole), F.lit(float(temperature))).alias("own"),
    )
    named = spark.createDataFrame([(k, float(v)) for k, v in (mixture or {}).items()], "_named string, given double")
    based = based.join(named, F.col("_source").eqNullSafe(F.col("_named")), "left")
    given = F.when(F.col("given").isNotNull(), F.col("given")).otherwise(F.col("own"))
    return based.select("_source", "_part", "base", given.alias("weight"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    mixture: Mapping[str, float] | None = None,
    temperature: float = 1.0,
    length: int = LENGTH,
    end: int = END,
    wordwise: bool = False,
) -> DataFrame:
    """Pieces of documents placed in sequences of ``length`` tokens.

    ``doc_id, start, length, doc_tokens, sequence_id, offset, source, ids``: the piece holds
    the document's tokens from ``start`` on (``ids``: little-endian 32-bit numbers, the
    document's last one being ``end``) and stands at ``offset`` of its sequence. Sequences
    are full, but for the last.

    ``tokenizer`` is the path of a tokenizer file. ``mixture`` gives the sources' target
    proportions; a source it does not name gets its own share of all tokens raised to
    ``temperature`` (1: proportions as they are; lower: small sources come earlier).

    Defined cases: a null text is empty and yields the end token alone. Null is a source
    like any other. Rows without id and repeated rows are packed like others. Any number
    of sources may occur, each is a queue. An empty table gives an empty result. Other
    columns are not read.
    """
    spark = docs.sparkSession
    store = Scratch(spark, "packing")
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    # ids wait for their places in as few bytes as the vocabulary needs
    width = 2 if max(end, *Tokenizer.from_str(content).get_vocab().values()) < 1 << 16 else 4
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    tokens = rows.mapInArrow(lambda it: tokenised_batches(it, content, wordwise, end, length, width), _TOKENS)
    tokens = store.keep(tokens, "tokens", "zstd")
    sums = store.keep(tokens.groupBy("source", "part").agg(F.sum("n").alias("tokens")), "sums")
    credits = store.keep(_weights(sums, mixture, temperature), "credits")
    if credits.filter("NOT weight > 0").limit(1).count():
        raise ValueError("every source needs a positive proportion")

    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    met = tokens.join(sent_if_small(credits, SENT_SUMS), same)
    begin = F.col("base") + F.col("begin")
    turned = met.select(
        ((begin + F.col("n")) / F.col("weight")).alias("turn"),
        "source",
        begin.alias("begin"),
        "doc_id",
        "start",
        "n",
        "doc_tokens",
        "ids",
    )
    # no two parts share a source and a beginning
    order = ["turn", "source", "begin"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = turned.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    dealt = dealt.select(F.spark_partition_id().alias("range"), "doc_id", "start", "n", "doc_tokens", "source", "ids")
    dealt = store.keep(
        dealt.mapInArrow(
            placed_batches,
            "range int, doc_id bigint, start bigint, n bigint, doc_tokens bigint, source string, ids binary, before bigint",
        ),
        "dealt",
        "zstd",
    )
    # as many rows as there are ranges
    ranges = dealt.groupBy("range").agg(F.sum("n").alias("held"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("range").alias("_range"), F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("ahead"))
    placed = dealt.join(F.broadcast(ranges), F.col("range") == F.col("_range")).withColumn("at", F.col("before") + F.col("ahead"))
    placed = placed.select("doc_id", "start", "n", "doc_tokens", "source", "ids", "at")
    return placed.mapInArrow(lambda it: piece_batches(it, length, width), _PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )
