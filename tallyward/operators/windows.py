"""N-th event, dense rank and top-k. However many rows a group has, no task sorts or walks them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.joins import merge

_REPEAT_CHUNK = 1 << 16


def nth_event(events: DataFrame, keys: Sequence[str], time: str, n: int, total: str | None = None) -> DataFrame:
    """Per group the time of the n-th event; groups with fewer events are absent. ``total`` adds the group's count.

    The time is closed in on by counting, whatever n is: the day, the minute, the second,
    the millisecond, the time itself. Events are counted per minute in one scan, combined
    on the map side; a second scan counts those of the chosen minutes per time. Each step
    walks the few buckets of one group with a running sum: the days there are, 1440
    minutes, 60 seconds, 1000 milliseconds, 1000 times.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    rows = events.select(*keys, time).filter(F.col(time).isNotNull())
    rows = rows.withColumn("_day", F.to_date(time)).withColumn("_minute", F.hour(time) * 60 + F.minute(time))
    per_minute = rows.groupBy(*keys, "_day", "_minute").agg(F.count(F.lit(1)).alias("_n"))
    per_day = per_minute.groupBy(*keys, "_day").agg(F.sum("_n").alias("_n"))
    carry = []
    if total:
        per_day = per_day.withColumn(total, F.sum("_n").over(Window.partitionBy(*keys)))
        carry = [total]
    found = _reached(per_day.withColumn("_left", F.lit(n).cast("bigint")), keys, "_day", carry)
    found = _reached(merge(per_minute, found, [*keys, "_day"]), keys, "_minute", ["_day", *carry])
    chosen = merge(rows, found, [*keys, "_day", "_minute"])
    per_time = chosen.groupBy(*keys, time).agg(
        F.count(F.lit(1)).alias("_n"), F.first("_left").alias("_left"), *[F.first(c).alias(c) for c in carry]
    )
    # seconds with their fraction, in whole milliseconds
    per_time = per_time.withColumn("_milli", F.floor(F.expr(f"extract(SECOND FROM `{time}`)") * 1000).cast("int"))
    for bucket in (F.floor(F.col("_milli") / 1000), F.col("_milli")):
        step = per_time.withColumn("_bucket", bucket)
        sums = step.groupBy(*keys, "_bucket").agg(
            F.sum("_n").alias("_n"), F.first("_left").alias("_left"), *[F.first(c).alias(c) for c in carry]
        )
        found = _reached(sums, keys, "_bucket", carry)
        per_time = merge(step.drop("_left", *carry), found, [*keys, "_bucket"]).drop("_bucket")
    return _reached(per_time, keys, time, carry).drop("_left")


def _reached(counts: DataFrame, keys: Sequence[str], bucket: str, carry: Sequence[str]) -> DataFrame:
    """Per group the bucket in which the running count reaches ``_left``, and what is then left inside it."""
    upto = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    walked = counts.withColumn("_so_far", F.sum("_n").over(upto))
    hit = walked.filter((F.col("_so_far") >= F.col("_left")) & (F.col("_so_far") - F.col("_n") < F.col("_left")))
    left = (F.col("_left") - (F.col("_so_far") - F.col("_n"))).alias("_left")
    return hit.select(*keys, bucket, *carry, left)


def time_counts(events: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Events per group and distinct time, as column ``ties``."""
    return events.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("ties"))


def dense_nth(counted: DataFrame, keys: Sequence[str], time: str, n: int) -> DataFrame:
    """The row of the n-th distinct time per group, of a frame with one row per group and time."""
    return merge(counted, nth_event(counted, keys, time, n), [*keys, time])


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its count says.

    Large counts are cut into chunks that are dealt out to all tasks before they are
    written out, so that one heavily tied row does not become one long task.
    """
    columns = [c for c in df.columns if c != times]
    last = F.floor((F.col(times) - 1) / F.lit(_REPEAT_CHUNK))
    chunks = df.filter(F.col(times) > 0).select(
        *columns, times, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_chunk")
    )
    size = F.least(F.lit(_REPEAT_CHUNK).cast("bigint"), F.col(times) - F.col("_chunk") * _REPEAT_CHUNK)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(tasks, *columns, "_chunk").select(*columns, size.alias("_size"))
    return dealt.select(
        *columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size"))).alias("_copy")
    ).drop("_copy")


def top_k(df: DataFrame, priority: str, seq: str, k: int) -> DataFrame:
    """The k rows of highest priority; among equals the earlier ``seq`` comes first."""
    return df.orderBy(F.desc(priority), F.asc(seq)).limit(k)


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str | Column],
    priority: str,
    seq: str,
    k: int,
    rank_name: str = "rank",
    parts: int = 256,
) -> DataFrame:
    """The k rows of highest priority per group; among equals the earlier ``seq`` comes first.

    Cut twice: each group is dealt out by ``seq`` over so many parts, which are cut to k
    rows each, and what is left is cut again. A hot group is sorted in parts by many
    tasks; the last of them sees ``k * parts`` of its rows at most.
    """
    order = [F.desc(priority), F.asc(seq)]
    part = F.pmod(F.xxhash64(seq), F.lit(parts))
    first = F.row_number().over(Window.partitionBy(*keys, part).orderBy(*order))
    kept = df.withColumn(rank_name, first).filter(F.col(rank_name) <= k).drop(rank_name)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return kept.withColumn(rank_name, rank).filter(F.col(rank_name) <= k)
