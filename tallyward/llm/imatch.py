"""I-Match fingerprints over randomised lexicons.

Of a text's distinct terms only those count that stand in a band of inverse document
frequency: neither so common that they say nothing nor so rare that a typing error makes
one. The terms that remain are sorted and hashed, once for each of several random subsets
of the lexicon; two texts are alike in so far as these hashes agree. Subsets come in
several sizes: small ones survive heavy edits of long texts, large ones tell short texts
apart.

Document frequencies are counted exactly, per 64-bit hash of the term. The band's rare end
is a part of what the recurring terms add up to, as an inverse document frequency is: so
the band holds no more than ``TERMS`` terms, whatever the vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.hashing import Runs, blank_separated, blocks, give_back, mix
from tallyward.llm.store import Scratch

#: Terms that the band can hold (8 bytes each, sent to every task): of all recurrences of terms it takes one in TERMS to be in it.
TERMS = 1 << 23
#: The band: a term counts if at least LEAST documents have it, or more by TERMS, and at most this part of them.
LEAST = 2
MOST = 0.1
#: Random subsets hold one in 2^PARTS of the lexicon; each size is drawn EACH times.
PARTS = (2, 5, 8, 11)
EACH = 12
#: Terms of documents that a task adds up at a time.
_ADDED_UP = 1 << 22
#: Rows looked at per range of ids, to cut ranges of about equal numbers.
_PER_RANGE = 100

_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _terms(texts: pa.Array) -> list[np.ndarray]:
    """Each text's distinct terms, as sorted hashes. Terms are what stands between blanks, signs at the ends included."""
    out = []
    classes = blank_separated()
    for first, last in blocks(texts):
        runs = Runs(texts.slice(first, last - first), classes)
        out += [np.unique(runs.hashes[a:b]) for a, b in zip(runs.first[:-1], runs.first[1:], strict=True)]
    return out


def frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term, added up over as many rows as make ``_ADDED_UP`` terms."""

    def added(found: list[np.ndarray]) -> pa.RecordBatch:
        terms, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.record_batch({"term": pa.array(terms.view(np.int64)), "n": pa.array(n)})

    found, held = [], 0
    for batch in batches:
        for terms in _terms(batch.column(0)):
            found.append(terms)
            held += len(terms)
            if held >= _ADDED_UP:
                yield added(found)
                found, held = [], 0
    if found:
        yield added(found)
    give_back()


def lexicon(docs: DataFrame, text_col: str = "text", least: int = LEAST, most: float = MOST, terms: int = TERMS) -> np.ndarray:
    """The hashes of the terms in the band, sorted, by the frequencies of all documents.

    A term is in the band if at least ``least`` documents have it and at least one in
    ``terms`` of all recurring terms' documents is one of its: so there are at most
    ``terms`` of them.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(frequency_batches, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    recurring = Scratch(docs.sparkSession, "imatch").keep(counts.filter(F.col("n") >= least), "recurring")
    whole = recurring.agg(F.sum("n")).first()[0] or 0
    rare, frequent = max(least, -(-whole // terms)), max(least, most * docs.count())
    band = recurring.filter((F.col("n") >= rare) & (F.col("n") <= frequent)).select("term").toArrow()  # at most `terms` numbers
    return np.sort(band.column(0).to_numpy().view(np.uint64))


class Fingerprints:
    """Fingerprints by a fixed lexicon: a row of one hash per subset, 0 where the text has no term of the subset."""

    def __init__(self, band: np.ndarray, parts: tuple[int, ...] = PARTS, each: int = EACH):
        self.band, self.parts, self.each = band, parts, each

    def of(self, texts: pa.Array) -> np.ndarray:
        found = [self._block(texts.slice(first, last - first)) for first, last in blocks(texts)]
        return np.concatenate(found) if found else np.zeros((0, len(self.parts) * self.each), dtype=np.uint64)

    def _block(self, texts: pa.Array) -> np.ndarray:
        terms = _terms(texts)
        counts = np.array([len(t) for t in terms], dtype=np.int64)
        every = np.concatenate(terms)
        text = np.repeat(np.arange(len(terms)), counts)
        inside = self._in_band(every)
        # a text with nothing in the band speaks with all its terms
        mute = np.bincount(text[inside], minlength=len(terms)) == 0
        inside |= mute[text]
        every, text = every[inside], text[inside]
        out = np.zeros((len(terms), len(self.parts) * self.each), dtype=np.uint64)
        for group, bits in enumerate(self.parts):
            for turn in range(self.each):
                word, place = divmod(turn, 64 // bits)
                if place == 0:
                    draw = mix(every + np.uint64(64 * group + word + 1))
                drawn = (draw >> np.uint64(place * bits)) & np.uint64((1 << bits) - 1) == 0
                some, of = every[drawn], text[drawn]
                size = np.bincount(of, minlength=len(terms))
                begins = np.concatenate([[0], np.cumsum(size)])
                places = np.arange(len(some), dtype=np.uint64) - begins[of].astype(np.uint64)
                sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(some + mix(places)))])
                value = mix(sums[begins[1:]] - sums[begins[:-1]] + size.astype(np.uint64)) | np.uint64(1)
                out[:, group * self.each + turn] = np.where(size > 0, value, np.uint64(0))
        silent = ~out.any(axis=1)
        if silent.any():
            self._whole(out, silent, every, text)
        return out

    def _in_band(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.band):
            return np.zeros(len(terms), dtype=bool)
        return self.band[np.minimum(np.searchsorted(self.band, terms), len(self.band) - 1)] == terms

    @staticmethod
    def _whole(out: np.ndarray, silent: np.ndarray, every: np.ndarray, text: np.ndarray) -> None:
        """Texts whose terms all fell outside every subset get the hash of all their terms instead."""
        sums = np.zeros(len(out), dtype=np.uint64)
        np.add.at(sums, text, mix(every))
        out[silent] = (mix(sums) | np.uint64(1))[silent, None]


def text_of(fingerprint: np.ndarray) -> str:
    return "-".join(f"{h >> 32:08x}" if h else "" for h in fingerprint.tolist())


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """The part of agreeing hashes among the subsets of which either text has a term."""
    held = (one != 0) | (two != 0)
    return float((one[held] == two[held]).mean())


def _compared(ids: list, texts: list[str], prints: Fingerprints) -> pa.RecordBatch:
    """One result for each text but the last, which is only a neighbour."""
    edited = []
    for text, after in zip(texts[:-1], texts[1:], strict=True):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + after[:half])
    own, changed = prints.of(pa.array(texts, pa.large_string())), prints.of(pa.array(edited, pa.large_string()))
    return pa.record_batch(
        {
            "doc_id": pa.array(ids[: len(edited)], pa.int64()),
            "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": pa.array([sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            "fingerprint": pa.array([text_of(p) for p in own[:-1]], pa.string()),
            "edited_fingerprint": pa.array([text_of(p) for p in changed], pa.string()),
            "near_edited": pa.array([likeness(a, b) for a, b in zip(own, changed, strict=False)], pa.float64()),
            "near_next": pa.array([likeness(a, b) for a, b in zip(own[:-1], own[1:], strict=True)], pa.float64()),
        }
    )


def neighbour_batches(batches: Iterator[pa.RecordBatch], prints: Fingerprints, at_once: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows come by range and descending id; a range is closed by the next range's first row."""
    ids: list = []
    texts: list[str] = []
    held = 0
    for batch in batches:
        for closes, doc_id, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
            ids.append(doc_id)
            texts.append(text)
            held += len(text)
            if closes or held > at_once:
                if len(texts) > 1:
                    yield _compared(ids, texts, prints)
                ids, texts = ([], []) if closes else (ids[-1:], texts[-1:])
                held = sum(map(len, texts))


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, most: float = MOST
) -> DataFrame:
    """Each text's fingerprint, that of its edited form, and how alike they and the next document's are.

    The next document is the one of the next smaller id, after the smallest the largest;
    the edited form has the text's last half replaced by as many characters of the next.

    Rows are cut into ranges of about equal numbers, by id, checksum and a number of their
    own, so that rows without id and those of one id are spread as well; each range also
    gets the next range's first row, so that texts are shuffled once and ranges need not
    know each other. The table must read alike each time, as files do.

    Defined cases: a null text is empty; an empty text has no terms, and all texts without
    terms have one and the same fingerprint. Rows without id come last, before the wrap to
    the first row. Equal ids follow in the order of their texts' checksums. A single row is
    its own next. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    prints = Fingerprints(lexicon(docs, text_col, least=least, most=most))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text, F.monotonically_increasing_id().alias("own"))
    # rows without id are the least
    key = F.struct(
        F.col("doc_id").isNotNull().cast("int").alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("tie"), "own"
    )
    cuts = _cuts(rows, key, tasks)
    rows = rows.select("doc_id", "text", key.alias("key"))
    rows = rows.withColumn("range", _range_of(F.col("key"), cuts))

    # one row per range, from here on until the texts
    top = rows.groupBy("range").agg(F.max("key").alias("top"))
    turn = Window.orderBy("range")
    last = F.max("range").over(Window.partitionBy())
    heads = top.select(F.col("top").alias("_top"), F.coalesce(F.lag("range").over(turn), last).alias("_to"))
    closing = rows.join(F.broadcast(heads), F.col("key") == F.col("_top"))
    closing = closing.select("doc_id", "text", "key", F.col("_to").alias("range"), F.lit(True).alias("closes"))
    dealt = rows.withColumn("closes", F.lit(False)).unionByName(closing).repartitionById(len(cuts) + 1, F.col("range"))
    ordered = dealt.sortWithinPartitions("range", "closes", F.desc("key")).select("closes", "doc_id", "text")
    return ordered.mapInArrow(lambda it: neighbour_batches(it, prints), _RESULT)


def _cuts(rows: DataFrame, key: Column, ranges: int) -> list[tuple]:
    """Keys between ranges, descending, from about ``_PER_RANGE`` rows for each; where the cuts lie changes no result."""
    some = min(1.0, _PER_RANGE * ranges / max(1, rows.count()))
    seen = sorted((tuple(r.key) for r in rows.sample(some, seed=1).select(key.alias("key")).collect()), reverse=True)
    return sorted({seen[len(seen) * k // ranges] for k in range(1, ranges)}, reverse=True) if seen else []


def _range_of(key: Column, cuts: list[tuple]) -> Column:
    """How many of the descending cuts are above the key, found in two steps."""
    if not cuts:
        return F.lit(0)

    def told(some: list[tuple]) -> Column:
        types = ("int", "bigint", "bigint", "bigint")
        names = ("known", "id", "tie", "own")
        return F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(c, types, names, strict=True)]) for c in some])

    step = max(1, math.isqrt(len(cuts)))
    fine = [told(cuts[k : k + step]) for k in range(0, len(cuts), step)]
    block = F.size(F.filter(told(cuts[::step]), lambda c: c > key))
    within = F.size(F.filter(F.get(F.array(*fine), block - 1), lambda c: c > key))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + within).cast("int")
