"""Text predicates and per-text character statistics."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(column: str, words: Iterable[str]) -> Column:
    """True where any of the words occurs; false for null, so ``~`` keeps null rows.

    Plain substring tests: the words are literal and no regular expression is needed.
    """
    tests = [F.col(column).contains(word) for word in words]
    if not tests:
        return F.lit(False)
    return F.coalesce(reduce(or_, tests), F.lit(False))


def matches(column: str, pattern: str) -> Column:
    """Regular-expression search; false for null, so ``~`` keeps null rows."""
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def commonest_char(text: str | Column) -> Column:
    """Struct of the commonest character of a text, its count and its 0-based positions.

    The character seen first wins a tie. Every text is handled within its row, so no
    character is ever shuffled. Built-in functions would scan the text once per
    distinct character; counting code points as an array is some ten times faster.
    Memory follows the length of the text, whatever its characters. A batch is bounded by
    ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB); one whose positions would not
    fit 32-bit offsets is refused. The functions are local so that they travel to the
    executors with the query.
    """

    def find(value: str | None):
        if not value:
            return None, 0, np.empty(0, dtype="int32")
        codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        chars, counts = np.unique(codes, return_counts=True)
        most = counts.max()
        tied = chars[counts == most]
        code = codes[np.isin(codes, tied).argmax()] if len(tied) > 1 else tied[0]
        return chr(code), int(most), np.flatnonzero(codes == code).astype("int32")

    def per_batch(texts: pa.Array) -> pa.Array:
        found = [find(value) for value in texts.to_pylist()]
        ends = np.cumsum([0, *[len(places) for _, _, places in found]], dtype="int64")
        if ends[-1] >= 1 << 31:
            raise OverflowError("a batch of texts has too many positions; lower spark.sql.execution.arrow.maxBytesPerBatch")
        ends = ends.astype("int32")
        flat = np.concatenate([np.empty(0, dtype="int32"), *[places for _, _, places in found]])
        return pa.StructArray.from_arrays(
            [
                pa.array([char for char, _, _ in found], pa.string()),
                pa.array([n for _, n, _ in found], pa.int32()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ],
            names=["char", "n", "positions"],
        )

    return F.arrow_udf(per_batch, "struct<char:string,n:int,positions:array<int>>")(text)
