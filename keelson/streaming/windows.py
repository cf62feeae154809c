"""Windowed aggregates over request logs.

Every function takes a batch or a streaming DataFrame, unless it says so.  Rows
are counted once per slide first; only those counts are spread over the
overlapping windows, so a 24-hour window sliding by the hour does not copy each
row 24 times.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the latency buckets in seconds, error alert line.
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
ERROR_SHARE_LINE = 0.01
NO_MODEL_STATUS = 503


def seconds(length: str) -> int:
    amount, unit = length.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def sliding_sums(df: DataFrame, at: str, size: str, slide: str, keys: Sequence[str],
                 sums: Mapping[str, Column]) -> DataFrame:
    """Sums per window and key: (window_start, window_end, *keys, *sums).

    ``sums`` are row expressions.  The window size must be a multiple of the
    slide; a row at the start of a window belongs to it, one at its end does not.
    """
    if seconds(size) % seconds(slide):
        raise ValueError("the window size must be a multiple of its slide")
    tumbling = df.groupBy(F.window(at, slide).alias("_slot"), *keys).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()])
    if df.isStreaming:
        slotted = tumbling.withColumn("_at", F.window_time("_slot"))
    else:
        slotted = tumbling.withColumn("_at", F.col("_slot.start"))
    windows = slotted.groupBy(F.window("_at", size, slide).alias("_window"), *keys).agg(
        *[F.sum(n).alias(n) for n in sums])
    return windows.select(F.col("_window.start").alias("window_start"),
                          F.col("_window.end").alias("window_end"), *keys, *sums)


def window_activity(df: DataFrame, at: str = "ts", value: str = "value", size: str = "24 hours",
                    slide: str = "1 hour", keys: Sequence[str] = ()) -> DataFrame:
    """Row count and value sum of every sliding window."""
    return sliding_sums(df, at, size, slide, keys,
                        {"n": F.lit(1), "total": F.coalesce(F.col(value), F.lit(0.0))})


def request_rates(df: DataFrame, at: str = "ts", status: str = "status", size: str = "5 minutes",
                  slide: str = "1 minute") -> DataFrame:
    """Requests per second by status."""
    sums = sliding_sums(df, at, size, slide, [status], {"requests": F.lit(1)})
    return sums.withColumn("per_second", F.col("requests") / float(seconds(size)))


def error_ratio(df: DataFrame, at: str = "ts", status: str = "status", size: str = "5 minutes",
                slide: str = "1 minute") -> DataFrame:
    """Share of 5xx answers other than 503 per window, and whether it is above 1%."""
    failed = F.col(status).between(500, 599) & (F.col(status) != NO_MODEL_STATUS)
    sums = sliding_sums(df, at, size, slide, [],
                        {"requests": F.lit(1), "errors": failed.cast("int")})
    ratio = F.col("errors") / F.col("requests")
    return sums.withColumns({"error_ratio": ratio, "above": ratio > ERROR_SHARE_LINE})


def held_alerts(ratios: DataFrame, slide: str = "1 minute", held: str = "5 minutes") -> DataFrame:
    """Windows that were above the line at every step of the ``held`` time (batch).

    Each window reports to the steps it counts for, so this is a group-by over
    the windows and not one ordered pass over all of them.
    """
    step, steps = seconds(slide), seconds(held) // seconds(slide)
    start = F.unix_seconds("window_start")
    votes = ratios.where("above").select(
        F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("later"), start.alias("start"))
    counted = votes.groupBy((F.col("start") + F.col("later") * step).alias("_start")).agg(
        F.count(F.lit(1)).alias("steps_above"), F.bool_or(F.col("later") == 0).alias("own"))
    return counted.where((F.col("steps_above") == steps + 1) & F.col("own")).select(
        F.timestamp_seconds("_start").alias("window_start"), "steps_above")


def latency_counts(df: DataFrame, at: str, latency: str, endpoint: str, size: str,
                   buckets: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Requests per tumbling window, endpoint and latency bucket (index of its bound)."""
    bucket = F.lit(len(buckets))
    for i in range(len(buckets) - 1, -1, -1):
        bucket = F.when(F.col(latency) <= buckets[i], i).otherwise(bucket)
    return df.where(F.col(latency).isNotNull()).groupBy(
        F.window(at, size).start.alias("window_start"), endpoint, bucket.alias("bucket")
    ).agg(F.count(F.lit(1)).alias("n"))


def latency_quantiles(counts: DataFrame, endpoint: str, shares: Sequence[float] = (0.5, 0.95, 0.99),
                      buckets: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Quantiles per window and endpoint, interpolated inside their bucket (batch).

    The bucket counts of a group are put in one short array, at most one entry
    per bucket.  A quantile in the open last bucket is its lower bound.
    """
    uppers = [float(b) for b in buckets]
    per_bucket = [F.coalesce(F.sum(F.when(F.col("bucket") == i, F.col("n"))), F.lit(0))
                  .alias(f"b{i}") for i in range(len(uppers) + 1)]
    wide = counts.groupBy("window_start", endpoint).agg(*per_bucket)
    total = sum((F.col(f"b{i}") for i in range(len(uppers) + 1)), F.lit(0))
    columns = []
    for share in shares:
        rank = total * F.lit(float(share))
        value = F.lit(uppers[-1])
        before = [sum((F.col(f"b{j}") for j in range(i)), F.lit(0)) for i in range(len(uppers))]
        for i in range(len(uppers) - 1, -1, -1):
            low = uppers[i - 1] if i else 0.0
            inside = low + (uppers[i] - low) * (rank - before[i]) / F.nullif(
                F.col(f"b{i}"), F.lit(0))
            value = F.when(before[i] + F.col(f"b{i}") >= rank,
                           F.coalesce(inside, F.lit(low))).otherwise(value)
        columns.append(value.alias(f"p{round(share * 100)}"))
    return wide.select("window_start", endpoint, total.cast("long").alias("n"), *columns)


def counter_increase(df: DataFrame, at: str, counter: str, size: str = "5 minutes",
                     keys: Sequence[str] = ()) -> DataFrame:
    """Last value less first value per window; windows without a rise are left out.

    A counter that starts again from zero shows no rise in that window.
    """
    spans = df.where(F.col(counter).isNotNull()).groupBy(
        F.window(at, size).start.alias("window_start"), *keys).agg(
        (F.max(F.struct(at, counter))[counter] - F.min(F.struct(at, counter))[counter]).alias("increase"))
    return spans.where(F.col("increase") > 0)
