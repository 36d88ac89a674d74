"""Quality selection by importance resampling.

Two bag-of-n-grams models over hashed buckets, one of the target (labelled good texts),
one of the raw table (every row), give each document the log ratio of its probabilities.
Documents are sampled without replacement in proportion to that ratio: Gumbel noise is
added and the k largest sums stay.

A handful of insults weighs nothing in a sum over a whole text. So a second ratio of the
same kind, of toxic against all labelled texts, is taken per token, and a text is judged
by its few strongest tokens; texts that it rejects do not stay.

N-grams are single tokens and neighbouring pairs; tokens are runs of letters and digits,
and runs of signs. Log ratios are whole 1/65536ths, so sums do not depend on the order
in which texts arrive.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.hashing import Runs, blocks, give_back, mix
from tallyward.llm.store import Scratch

#: Hash buckets of the models; what the driver gathers is bounded by it.
BUCKETS = 1 << 16
#: N-grams added to each bucket's count, seen and expected: a bucket seen less often says little.
PRIOR = 100
#: Labelled rows used for fitting, at most.
FIT_ROWS = 50_000
#: One in so many labelled documents is not fitted on: these tell how the weights of good documents lie.
HELD_OUT = 5
#: Part of the good documents held out whose weight the k-th document's must not exceed.
KEEP_GOOD = 0.998
#: Hash buckets of the toxicity model, which is of single tokens and must tell rare ones apart.
TOXIC_BUCKETS = 1 << 20
#: Labelled texts added to each bucket's count there, toxic and expected.
TOXIC_PRIOR = 2
#: A text's strongest tokens, by which its toxicity is judged.
STRONGEST = 3
_UNIT = 1 << 16
_BINS = 1024
_GATHER = 4096


def _token_classes() -> np.ndarray:
    table = np.ones(256, dtype=np.uint8)
    table[:33] = 0
    table[127] = 0
    table[[ord(c) for c in string.punctuation if c != "_"]] = 2
    return table


def _buckets(runs: Runs, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a block's tokens, and of the pairs that start at each token (-1 at a text's last)."""
    single = (runs.hashes % np.uint64(buckets)).astype(np.int64)
    after = np.concatenate([runs.hashes[1:], np.zeros(1, dtype=np.uint64)])[: len(runs.hashes)]
    pairs = mix(runs.hashes * np.uint64(3) + after) % np.uint64(buckets)
    pairs = pairs.astype(np.int64)
    last = runs.first[1:] - 1
    pairs[last[runs.counts > 0]] = -1
    return single, pairs


def counted_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """N-grams per bucket of a task's rows, all and target ones."""
    totals, classes = np.zeros((2, buckets), dtype=np.int64), _token_classes()
    for batch in batches:
        target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for start, stop in blocks(batch.column(0)):
            runs = Runs(batch.column(0).slice(start, stop - start), classes)
            single, pairs = _buckets(runs, buckets)
            chosen = np.repeat(target[start:stop], runs.counts)
            for grams, good in ((single, chosen), (pairs[pairs >= 0], chosen[pairs >= 0])):
                totals[0] += np.bincount(grams, minlength=buckets)
                totals[1] += np.bincount(grams[good], minlength=buckets)
    give_back()
    seen = np.flatnonzero(totals[0])
    yield pa.record_batch({"bucket": pa.array(seen), "raw": pa.array(totals[0][seen]), "target": pa.array(totals[1][seen])})


def log_weights(texts: pa.Array, ratios: np.ndarray) -> np.ndarray:
    """The log importance weight of each text, in units of 1/65536."""
    out, classes = np.zeros(len(texts), dtype=np.int64), _token_classes()
    for start, stop in blocks(texts):
        runs = Runs(texts.slice(start, stop - start), classes)
        single, pairs = _buckets(runs, len(ratios))
        value = ratios[single] + np.where(pairs >= 0, ratios[pairs], 0)
        sums = np.concatenate([[0], np.cumsum(value)])
        out[start:stop] = sums[runs.first[1:]] - sums[runs.first[:-1]]
    give_back()
    return out


def holder_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Texts per bucket of a task's rows, all and toxic ones; bucket -1 counts the texts themselves."""
    totals, texts, classes = np.zeros((2, buckets + 1), dtype=np.int64), np.zeros(2, dtype=np.int64), _token_classes()
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        texts += [len(toxic), toxic.sum()]
        for start, stop in blocks(batch.column(0)):
            runs = Runs(batch.column(0).slice(start, stop - start), classes)
            of, tokens = _distinct(runs, buckets)
            totals[0] += np.bincount(tokens, minlength=buckets + 1)
            totals[1] += np.bincount(tokens[toxic[start:stop][of]], minlength=buckets + 1)
    totals[:, buckets] = texts
    give_back()
    seen = np.flatnonzero(totals[0])
    yield pa.record_batch(
        {"bucket": pa.array(np.where(seen == buckets, -1, seen)), "every": pa.array(totals[0][seen]), "toxic": pa.array(totals[1][seen])}
    )


def _distinct(runs: Runs, buckets: int, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Texts and their distinct buckets, in order of the texts; only the ``chosen`` buckets if given."""
    single = (runs.hashes % np.uint64(buckets)).astype(np.int64)
    of = runs.text_of_words()
    if chosen is not None:
        inside = chosen[single]
        single, of = single[inside], of[inside]
    pairs = np.unique(of * buckets + single)
    return pairs // buckets, pairs % buckets


def toxic_weights(texts: pa.Array, ratios: np.ndarray, strongest: int = STRONGEST) -> np.ndarray:
    """The sum of the largest log ratios above 0 among each text's distinct tokens, in units of 1/65536."""
    out, classes, above = np.zeros(len(texts), dtype=np.int64), _token_classes(), ratios > 0
    for start, stop in blocks(texts):
        of, tokens = _distinct(Runs(texts.slice(start, stop - start), classes), len(ratios), above)
        value = ratios[tokens].astype(np.int64)
        order = np.lexsort((-value, of))
        of, value = of[order], value[order]
        begins = np.searchsorted(of, np.arange(stop - start))
        first = np.arange(len(of)) - begins[of] < strongest
        np.add.at(out, start + of[first], value[first])
    give_back()
    return out


def gumbel_keys(ids: pa.Array, weights: np.ndarray, seed: int) -> np.ndarray:
    """Weight plus noise; the noise depends on the id alone."""
    known = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    uniform = ((mix(known + np.uint64(seed)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return weights / _UNIT - np.log(-np.log(uniform))


class Resampler:
    """The fitted models: ``ratios`` holds each bucket's log ratio, ``toxic`` that of the toxicity model.

    Texts of a toxic weight above ``toxic_cut`` are rejected, none while it is not set.
    """

    def __init__(self, ratios: np.ndarray, seed: int = 1, toxic: np.ndarray | None = None):
        self.ratios, self.seed = ratios, seed
        self.toxic = np.zeros(1, dtype=np.int32) if toxic is None else toxic
        self.toxic_cut: float | None = None

    def key(self, ids: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        weights = log_weights(texts, self.ratios)
        return weights, gumbel_keys(ids, weights, self.seed)

    def toxicity(self, texts: pa.Array) -> np.ndarray:
        return toxic_weights(texts, self.toxic) / _UNIT

    def drawn(self, ids: pa.Array, texts: pa.Array, least: float) -> np.ndarray:
        """Which rows stay, given the smallest key that does."""
        stays = self.key(ids, texts)[1] >= least
        return stays if self.toxic_cut is None else stays & (self.toxicity(texts) <= self.toxic_cut)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    prior: float = PRIOR,
    fit_rows: int = FIT_ROWS,
    seed: int = 1,
    reject_toxic: bool = False,
) -> Resampler:
    """Target and raw model in one pass over all documents, the toxicity model, if asked for, in one over the labelled ones.

    The target are texts labelled ``quality = 1`` and not toxic, but for those held out:
    all of them, or the ``fit_rows`` whose ids come first in hash order. Without labels
    the ratios are 0.
    """
    target = _good(labels).filter(~_held_out())
    target = target.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    rows = docs.select(F.col(id_col).cast("bigint").alias("_doc"), F.col(text_col).cast("string").alias("text"))
    # at most fit_rows ids of 8 bytes
    marked = rows.join(F.broadcast(target), F.col("_doc") == F.col("_id"), "left").select(
        "text", F.col("_id").isNotNull().alias("target")
    )
    counts = marked.mapInArrow(lambda it: counted_batches(it, buckets), "bucket bigint, raw bigint, target bigint")
    totals = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, chosen = np.zeros(buckets), np.zeros(buckets)
    raw[totals["bucket"]], chosen[totals["bucket"]] = totals["raw"], totals["target"]
    ratios = np.zeros(buckets, dtype=np.int64)
    if chosen.sum():
        seen = raw > 0
        expected = raw[seen] * (chosen.sum() / raw.sum())
        ratios[seen] = np.rint(_UNIT * np.log((chosen[seen] + prior) / (expected + prior))).astype(np.int64)
    return Resampler(ratios, seed, _toxic_ratios(rows, labels, fit_rows) if reject_toxic else None)


def _toxic_ratios(rows: DataFrame, labels: DataFrame, fit_rows: int, buckets: int = TOXIC_BUCKETS, prior: float = TOXIC_PRIOR) -> np.ndarray:
    """Each bucket's log ratio of toxic texts that hold it to those expected, among the labelled texts not held out."""
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("_id"))
    marks = marks.agg((F.max("toxic") > 0).alias("toxic")).filter(~_held_out())
    marks = marks.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    marked = rows.join(F.broadcast(marks), F.col("_doc") == F.col("_id")).select("text", "toxic")
    counts = marked.mapInArrow(lambda it: holder_batches(it, buckets), "bucket bigint, every bigint, toxic bigint")
    totals = counts.groupBy("bucket").agg(F.sum("every").alias("every"), F.sum("toxic").alias("toxic"))
    # only what toxic texts hold can have a ratio above 0
    totals = totals.filter("toxic > 0").toPandas()
    ratios = np.zeros(buckets, dtype=np.int32)
    whole = totals[totals["bucket"] == -1]
    if len(whole):
        seen = totals[totals["bucket"] >= 0]
        expected = seen["every"] * (whole["toxic"].iloc[0] / whole["every"].iloc[0])
        ratios[seen["bucket"]] = np.rint(_UNIT * np.log((seen["toxic"] + prior) / (expected + prior)))
    return ratios


def _good(labels: DataFrame) -> DataFrame:
    """Ids labelled good and not toxic; contradicting labels count as bad."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    marks = known.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    return marks.filter("quality = 1 AND toxic = 0").select("_id")


def _held_out() -> Column:
    return F.pmod(F.xxhash64("_id"), F.lit(HELD_OUT)) == 0


def kth_largest(values: DataFrame, col: str, k: int) -> float:
    """The k-th largest value, by counting in ever narrower ranges; the driver sees counts and a last few values."""
    low, high = values.agg(F.min(col), F.max(col)).first()
    inside, left = values, k
    while True:
        width = (high - low) / _BINS
        if width <= 0 or low + width == low:
            return low
        at = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit(_BINS - 1)).alias("bin")
        counts = sorted(((r["bin"], r["count"]) for r in inside.groupBy(at).count().collect()), reverse=True)
        for number, size in counts:
            if size >= left:
                break
            left -= size
        inside = inside.filter(at == number)
        if size <= _GATHER:
            return sorted((r[0] for r in inside.select(col).collect()), reverse=True)[left - 1]
        low, high = inside.agg(F.min(col), F.max(col)).first()


def scored(docs: DataFrame, model: Resampler, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, log_weight, gumbel_key, toxicity`` per row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, keys = model.key(batch.column(0), batch.column(1))
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "log_weight": pa.array(weights / _UNIT),
                    "gumbel_key": pa.array(keys),
                    "toxicity": pa.array(model.toxicity(batch.column(1))),
                }
            )

    return rows.mapInArrow(score, "doc_id bigint, log_weight double, gumbel_key double, toxicity double")


def select_by_importance(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, reject_toxic: bool = False
) -> tuple[DataFrame, Resampler, float]:
    """Per row ``doc_id, log_weight, gumbel_key, kept``, the model, and the smallest key that is kept.

    With ``reject_toxic`` rows more toxic than all but ``1 - KEEP_GOOD`` of the good ones held
    out, and of all good ones where that is more (few held out tell little), are rejected.
    Of the others ``kept`` marks the k rows of the largest keys. k is the number of those
    at least as heavy as all but ``1 - KEEP_GOOD`` of the good ones held out. Without good
    ones held out all rows stay.

    Defined cases: an empty or null text has weight 1 (log 0). Rows without id share one
    noise value. Rows whose keys tie with the k-th all stay. An empty table gives an empty
    result. Other columns are not read.
    """
    store = Scratch(docs.sparkSession, "quality")
    model = fit(docs, labels, id_col, text_col, seed=seed, reject_toxic=reject_toxic)
    scores = store.keep(scored(docs, model, id_col, text_col), "scores")
    good = _good(labels).withColumn("_held", _held_out())
    labelled = scores.join(good, F.col("doc_id") == F.col("_id"))
    held = labelled.groupBy("_held").agg(
        F.percentile_approx("log_weight", 1 - KEEP_GOOD, 100_000).alias("cut"), F.percentile_approx("toxicity", KEEP_GOOD, 100_000).alias("toxic")
    )
    bounds = {r["_held"]: r for r in held.collect()}
    cut = bounds[True]["cut"] if True in bounds else None
    if reject_toxic and cut is not None:
        model.toxic_cut = max(r["toxic"] for r in bounds.values())
    mild = F.lit(True) if model.toxic_cut is None else F.col("toxicity") <= F.lit(model.toxic_cut)
    able = scores.filter(mild)
    k = able.filter(F.lit(True) if cut is None else F.col("log_weight") >= cut).count()
    least = kth_largest(able, "gumbel_key", k) if k else math.inf
    kept = mild & (F.col("gumbel_key") >= F.lit(least))
    return scores.select("doc_id", "log_weight", "gumbel_key", kept.alias("kept")), model, least
