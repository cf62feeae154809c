"""Exact order statistics, ranks and running totals without a single-task sort.

An unpartitioned window moves every row into one task.  The three jobs here
avoid that:

* ``order_statistics`` narrows a value range by repeated equal-width counting.
  Each pass shuffles only partial counts per bin, so neither row count nor
  repeated values matter.
* ``global_rank`` range-sorts the rows once, stores them with the partition
  they landed in, and adds the row counts of the partitions before.
* ``running_totals`` does the same with sums, on rows that are already
  aggregated per value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import materialize

BINS = 4096
#: Size of a quantile sketch, and how far its ranks may be off, as a share of the rows; a miss costs a fallback only.
SKETCH_K, SKETCH_MARGIN = 4096, 0.002


@dataclass
class _Range:
    """Values of one column between two values that occur in it."""

    column: str
    low: float
    high: float
    below: int
    rows: int
    ranks: list[int]


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Sequence[int]], bins: int = BINS
) -> dict[str, dict[int, float]]:
    """The values at the given 0-based ascending positions, per double column.

    Nulls and NaN are ignored.  The driver sees one row per asked rank and pass.
    """
    names = [c for c, wanted in ranks.items() if wanted]
    if not names:
        return {}
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in names])
    longs = numbers.unpivot([], names, "column", "value").where("value is not null")
    found: dict[str, dict[int, float]] = {c: {} for c in names}
    # Side by side, so that no row is copied for each column.
    ends = numbers.agg(*[p for i, c in enumerate(names) for p in (
        F.min(c).alias(f"low{i}"), F.max(c).alias(f"high{i}"), F.count(c).alias(f"rows{i}"))]).first()
    open_ranges = [
        _Range(c, ends[f"low{i}"], ends[f"high{i}"], 0, ends[f"rows{i}"],
               sorted({k for k in ranks[c] if 0 <= k < ends[f"rows{i}"]}))
        for i, c in enumerate(names) if ends[f"rows{i}"]
    ]
    while True:
        still = []
        for rng in open_ranges:
            if rng.low == rng.high:
                found[rng.column].update({k: rng.low for k in rng.ranks})
            elif rng.ranks:
                still.append(rng)
        if not still:
            return found
        open_ranges = _narrow(longs, still, bins)


def _way(rng: _Range, bins: int) -> str:
    """How a range is cut: infinite ends apart, no more rows than bins by value, else equal widths."""
    if math.isinf(rng.low) or math.isinf(rng.high):
        return "ends"
    if rng.rows <= bins or rng.high / 2 - rng.low / 2 == 0:
        return "values"
    return "bins"


def _narrow(longs: DataFrame, ranges: list[_Range], bins: int) -> list[_Range]:
    spark = longs.sparkSession
    table = spark.createDataFrame(
        [(i, r.column, r.low, r.high, _way(r, bins)) for i, r in enumerate(ranges)],
        "range_id int, column string, low double, high double, way string",
    )
    # Halved first, so that the widest finite range does not overflow.
    place = F.floor((F.col("value") / 2 - F.col("low") / 2)
                    / F.nullif(F.col("high") / 2 - F.col("low") / 2, F.lit(0.0)) * bins)
    ends = F.when(F.col("value") == float("inf"), 2).when(
        F.col("value") == float("-inf"), 0).otherwise(1)
    # One row per open range, at most one range per asked rank: always broadcast.
    inside = longs.join(F.broadcast(table), "column").where(
        (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high"))
    )
    counted = (
        inside.groupBy(
            "range_id",
            F.when(F.col("way") == "bins", F.least(place, F.lit(bins - 1)).cast("int"))
            .when(F.col("way") == "ends", ends).alias("bin"),
            F.when(F.col("way") == "values", F.col("value")).alias("exact"),
        )
        .agg(F.count("value").alias("rows"), F.min("value").alias("low"),
             F.max("value").alias("high"))
    )
    # A range has at most ``bins`` pieces; those that hold an asked rank are kept.
    asked = spark.createDataFrame([(i, r.below, k) for i, r in enumerate(ranges) for k in r.ranks],
                                  "range_id int, below long, rank long")
    earlier = Window.partitionBy("range_id").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    first = F.col("below") + F.col("before")
    hits = placed.join(F.broadcast(asked), "range_id").where(
        (F.col("rank") >= first) & (F.col("rank") < first + F.col("rows"))).select(
        "range_id", "low", "high", first.alias("first"), "rows", "rank").collect()
    narrowed: dict[tuple, _Range] = {}
    for r in sorted(hits, key=lambda r: (r["range_id"], r["rank"])):
        piece = narrowed.setdefault((r["range_id"], r["low"]), _Range(
            ranges[r["range_id"]].column, r["low"], r["high"], r["first"], r["rows"], []))
        piece.ranks.append(r["rank"])
    return list(narrowed.values())


def sketched_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]], k: int = SKETCH_K,
                        margin: float = SKETCH_MARGIN) -> dict[str, dict[int, float]]:
    """``order_statistics`` in two reads of the table, exact as well.

    The first read makes one mergeable sketch for each column, which brackets every
    asked rank between two values.  The second counts the rows below each bracket, and
    each value inside it.  Ranks inside a bracket come from running totals of its
    values, spread over tasks.  A rank that its bracket misses is found by narrowing.
    """
    names = [c for c, wanted in ranks.items() if wanted]
    if not names:
        return {}
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in names}
    numbers = df.select(*[value[c].alias(c) for c in names])
    sketches = numbers.agg(*[p for c in names for p in (
        F.kll_sketch_agg_double(c, k).alias(f"{c}:sketch"), F.count(c).alias(f"{c}:rows"))])
    # One row: a sketch has a fixed size, whatever the number of rows.
    made = sketches.first()
    rows = {c: made[f"{c}:rows"] for c in names}
    wanted = [(c, r) for c in names for r in sorted(set(ranks[c])) if 0 <= r < rows[c]]
    held = sketches.sparkSession.createDataFrame([made], sketches.schema)

    def end(column: str, rank: int, side: int) -> Column:
        share = min(max((rank + 0.5) / rows[column] + side * margin, 0.0), 1.0)
        return F.kll_sketch_get_quantile_double(F.col(f"`{column}:sketch`"), F.lit(share))

    # A bracket's ends are values that occur.
    ends = held.select(*[end(c, r, side).alias(f"{i}:{side}") for i, (c, r) in enumerate(wanted) for side in (-1, 1)]).first() \
        if wanted else {}
    asked = [(c, r, ends[f"{i}:-1"], ends[f"{i}:1"]) for i, (c, r) in enumerate(wanted)]
    found: dict[str, dict[int, float]] = {c: {} for c in names}
    if not asked:
        return found
    brackets = df.sparkSession.createDataFrame(
        [(i, *a) for i, a in enumerate(asked)], "bracket int, column string, rank long, low double, high double")
    # One row for each asked rank: always broadcast.
    inside = numbers.unpivot([], names, "column", "value").where("value is not null").join(
        F.broadcast(brackets), "column").where("value <= high")
    counts = materialize(inside.groupBy("bracket", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value")).agg(
        F.count(F.lit(1)).alias("n")), "brackets")
    below = counts.where("value is null").select("bracket", F.col("n").alias("below"))
    run = running_totals(counts.where("value is not null"), ["bracket"], "value", ["n"])
    target = brackets.join(below, "bracket", "left").select(
        "bracket", (F.col("rank") - F.coalesce("below", F.lit(0))).alias("target"))
    hits = run.join(F.broadcast(target), "bracket").where("target >= cum_n - n and target < cum_n")
    for row in hits.select("bracket", "value").collect():
        column, rank, _, _ = asked[row["bracket"]]
        found[column][rank] = row["value"]
    missed = {c: [r for a, r, _, _ in asked if a == c and r not in found[c]] for c in names}
    if any(missed.values()):
        for c, more in order_statistics(df, missed).items():
            found[c].update(more)
    return found


def kth_smallest(df: DataFrame, value: Column, k: int) -> float:
    """The value at 0-based position ``k`` of the ascending order."""
    hit = order_statistics(df.select(value.cast("double").alias("value")), {"value": [k]})
    if k not in hit["value"]:
        raise ValueError(f"position {k} is outside the data")
    return hit["value"][k]


def linear_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float],
    counts: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between the two neighbouring order statistics.

    The built-in ``percentile`` would keep the distinct values of a column in
    one task.
    """
    if counts is None:
        row = df.agg(*[F.count(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")))
                       .alias(c) for c in columns]).first()
        counts = row.asDict()
    spots = {c: [s * (counts[c] - 1) for s in shares] for c in columns if counts[c]}
    ranks = {c: sorted({int(p) for p in at} | {min(int(p) + 1, counts[c] - 1) for p in at})
             for c, at in spots.items()}
    values = order_statistics(df.select(*columns), ranks)
    result: dict[str, list[float | None]] = {}
    for c in columns:
        if not counts[c]:
            result[c] = [None] * len(shares)
            continue
        line = []
        for p in spots[c]:
            low = values[c][int(p)]
            high = values[c][min(int(p) + 1, counts[c] - 1)]
            line.append(low + (high - low) * (p - int(p)))
        result[c] = line
    return result


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Adds the 0-based position of each row in the given total order.

    Equal values are split over tasks like any others as long as ``order`` ends
    with something that tells rows apart, such as file and row number.
    """
    spread = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({
            "_part": F.spark_partition_id(),
            "_offset": F.monotonically_increasing_id() % F.lit(1 << 33),
        })
    )
    stored = materialize(spread, "rank")
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # One row per shuffle partition of the step above, so this window is tiny.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        stored.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_offset"))
        .drop("_part", "_offset", "_start")
    )


def running_totals(
    df: DataFrame, keys: Sequence[str], value: str, totals: Sequence[str]
) -> DataFrame:
    """Adds ``cum_<t>``, the sum of ``t`` up to and including this value, and
    ``next_value``, the following value of the same key.

    ``df`` holds one row per (keys, value).  Ranges are cut by sampling that
    data, so a key with very many values is spread over many tasks.
    """
    ranged = materialize(
        df.repartitionByRange(*[F.col(k) for k in keys], F.col(value))
        .withColumn("_part", F.spark_partition_id()),
        "totals",
    )
    # At most one row per key and range: keys plus partitions rows in all.
    per_part = ranged.groupBy(*keys, "_part").agg(
        F.min(value).alias("_first"), *[F.sum(t).alias(t) for t in totals])
    parts = Window.partitionBy(*keys).orderBy("_part")
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(
        *keys, "_part", F.lead("_first").over(parts).alias("_after"),
        *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_before_{t}") for t in totals],
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(value)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(starts, [*keys, "_part"])
        .withColumns({
            **{f"cum_{t}": F.sum(t).over(upto) + F.col(f"_before_{t}") for t in totals},
            "next_value": F.coalesce(F.lead(value).over(inside), F.col("_after")),
        })
        .drop("_part", "_after", *[f"_before_{t}" for t in totals])
    )
