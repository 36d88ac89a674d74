"""Equi-joins of the reports.

No side is forced into a broadcast. Catalyst broadcasts a side whose size is known to
lie under ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution checks again
at run time; beyond that the joins are sort-merge joins, whose hot keys adaptive
execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relaid(df: DataFrame) -> DataFrame:
    """Distinct rows of a small list, laid out independently of its columns.

    A row much repeated in the list shrinks to one per task before any shuffle. As the
    result is laid out by its rows wrapped into a struct, a join with a large table has
    to shuffle both sides, whatever layout the list had: only then does adaptive
    execution look at their sizes, broadcast a small list and split a hot key of the
    large table.
    """
    return df.select(F.struct("*").alias("_row")).distinct().select("_row.*")


def keep_listed(
    df: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None, small: bool = True
) -> DataFrame:
    """Rows whose key is among the listed ones (``IN (SELECT ...)``); the list may repeat keys.

    A small list is laid out afresh (``relaid``), so that a hot key of ``df`` can be split.
    A list about as large as ``df`` is shuffled once, by key, which is all its join needs;
    each of its keys should then be rare in ``df``.
    """
    ids = listed.select(F.col(listed_key or key).alias("_listed"))
    ids = relaid(ids) if small else ids.distinct()
    return df.join(ids, df[key] == ids["_listed"], "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None) -> DataFrame:
    """Rows whose key is not among the listed ones, both keys being non-null; see ``not_in``."""
    ids = relaid(listed.select(F.col(listed_key or key).alias("_listed")))
    return df.join(ids, df[key] == ids["_listed"], "left_anti")


def not_in(df: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None) -> DataFrame:
    """SQL ``NOT IN`` with its null rules, without broadcasting the list.

    A null in the list rejects every row, a null key passes only an empty list. Both
    questions are answered by one-row subqueries; the rows go through an anti-join.
    """
    found = F.col(listed_key or key)
    size = listed.agg(F.count(F.lit(1))).scalar()
    nulls = listed.agg(F.count_if(found.isNull())).scalar()
    rest = drop_listed(df, listed, key, listed_key)
    return rest.filter((nulls == 0) & (F.col(key).isNotNull() | (size == 0)))


def merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on several keys in which null equals null, as in a merge of filled frames."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [left[k].eqNullSafe(other[f"_{k}"]) for k in keys])
    return left.join(other, same).drop(*[f"_{k}" for k in keys])


def attach(df: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join several frames that hold one row per key.

    All are hashed by the same key, so one shuffle of ``df`` serves every join.
    """
    for part in parts:
        df = df.join(part, key, "left")
    return df
