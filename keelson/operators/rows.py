"""Row-wise steps: deduplication, label filter, sampling and the set plan.

These drop rows, so they belong to preparing data and never to a model.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators import clean, ranking, splits
from keelson.session import materialize
from keelson.spec import TableSpec

FILE_ORDER = ("_file", "_row")
#: Bits of a key filter: at least so many for each key, at most so many in all; and of one of its rows, which has 4 KB.
KEY_BITS, MOST_BITS, ROW_BITS = 16, 1 << 30, 1 << 15


def with_file_order(df: DataFrame) -> DataFrame:
    """Adds where each row of a file scan was stored, the meaning of "first"."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.row_index").alias("_row"))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keeps the first row per key in the given order; null keys are one key.

    ``row_number() = 1`` is planned with a group limit on both sides of the
    shuffle: every task sends on at most one row per key, however often the key
    occurs.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def dedup_latest(df: DataFrame, keys: Sequence[str], moment: Column,
                 ties: Sequence[Column]) -> DataFrame:
    """Keeps the latest row per key; among equal moments the last one in file order."""
    return dedup_first(df, keys, [moment.desc_nulls_last(), *[t.desc() for t in ties]])


def drop_null_label(df: DataFrame, label: str) -> DataFrame:
    if label not in df.columns:
        raise KeyError(f"label column {label!r} is absent")
    return df.where(F.col(label).isNotNull())


def sample_key(seed: int, key: Column) -> Column:
    """A fixed draw per key: 52 bits of a hash, which a double holds exactly."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")


def _draw_digest(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def sample_cut(keys: DataFrame, n: int, seed: int, key: Column) -> tuple[float, str]:
    """The draw, and the digest among equal draws, of the last row of a sample of ``n``.

    ``keys`` only needs the columns of ``key``, which must tell rows apart.  The
    cut is an order statistic, so rows are never sorted or sent through one task.
    """
    draw = sample_key(seed, key)
    cut = ranking.kth_smallest(keys, draw, n - 1)
    below = keys.where(draw < cut).count()
    # Rows that share 52 hash bits: one row, or a few at very large sizes.
    ties = keys.where(draw == cut).groupBy(_draw_digest(seed, key).alias("digest")).count()
    last = ties.orderBy("digest").limit(n - below).agg(
        F.max("digest").alias("last"), F.max("count").alias("repeats")).first()
    if last["repeats"] > 1:
        raise ValueError("the sample key repeats, give one that tells rows apart")
    return cut, last["last"]


def drawn_within(seed: int, key: Column, cut: float, last: str) -> Column:
    draw = sample_key(seed, key)
    return (draw < cut) | ((draw == cut) & (_draw_digest(seed, key) <= F.lit(last)))


def sample_exact(df: DataFrame, n: int | None, seed: int, key: Column,
                 available: int | None = None) -> DataFrame:
    """Exactly ``n`` rows without replacement, the same ones on every run.

    ``n`` of None, or at least the number of rows, keeps all.
    """
    if n is None:
        return df
    if n < 1:
        raise ValueError(f"sample size must be positive, got {n}")
    if n >= (df.count() if available is None else available):
        return df
    return df.where(drawn_within(seed, key, *sample_cut(df, n, seed, key)))


def sample_with_replacement(df: DataFrame, n: int, seed: int, order: Sequence[Column]) -> DataFrame:
    """``n`` draws from a pool, repeats allowed; ``draw`` numbers them.

    Draw number i takes the row at a hashed position, so this is an equi join
    between draws and row positions.
    """
    ranked = ranking.global_rank(df, order, "_position")
    size = ranked.count()
    if size == 0:
        return df.withColumn("draw", F.lit(None).cast("long")).limit(0)
    spark = df.sparkSession
    draws = spark.range(n).select(
        F.col("id").alias("draw"),
        (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string"))), 1, 13),
                16, 10).cast("long") % size).alias("_position"),
    )
    return draws.join(ranked, "_position").drop("_position")


def may_hold(df: DataFrame, keys: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The rows of ``df`` that may have a partner among ``n`` rows of ``keys``; none that has one is lost.

    Each key sets one bit by its hash.  A row whose bit is not set has no partner, so a
    join that follows need not shuffle it; of rows without one, at most one in 16 stays.
    The bits are broadcast, 2 to 4 bytes for each key and 128 MB at most; beyond that many
    keys more rows stay.
    """
    bits = min(MOST_BITS, max(ROW_BITS, 1 << math.ceil(math.log2(max(n, 1) * KEY_BITS))))
    mark = F.xxhash64(*columns).bitwiseAND(F.lit(bits - 1))
    places = {"_held_in": F.floor(mark / ROW_BITS), "_held_at": mark % ROW_BITS}
    # Dealt out first, so that a row of bits is made once and not by every task that has a key of it.
    held = keys.select(*[c.alias(name) for name, c in places.items()]).repartition("_held_in").groupBy("_held_in").agg(
        F.bitmap_construct_agg("_held_at").alias("_held"))
    byte = F.conv(F.hex(F.substr("_held", (F.floor(F.col("_held_at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return df.withColumns(places).join(F.broadcast(held), "_held_in").where(
        F.bit_get(byte, (F.col("_held_at") % 8).cast("int")) == 1).select(*df.columns)


@dataclass
class SetPlan:
    """Train and test rows plus the counts a preparation run reports."""

    train: DataFrame
    test: DataFrame
    counts: dict[str, int]


def flag_rows(df: DataFrame, spec: TableSpec, task: str, rules: dict,
              order: Sequence[Column]) -> DataFrame:
    """Deduplicates, labels and places every row; adds ``set_name``.

    Deduplication comes first, so one id can never sit in both train and test.
    Rows without a label stay, with ``set_name`` null, so they can be counted.
    """
    first = dedup_first(df, [spec.id_column], order)
    labelled = first.withColumn(spec.target(task), clean.task_label(first, spec, task))
    placed = splits.split_name(labelled, spec, rules)
    return labelled.withColumn(
        "set_name", F.when(F.col(spec.target(task)).isNotNull(), placed)
    )


def plan_counts(flagged: DataFrame, total: Column | int) -> DataFrame:
    """The report row of a flagged table, in one aggregate."""
    n = F.count(F.lit(1))
    total = F.lit(total) if isinstance(total, int) else total
    return flagged.agg(
        (total - n).cast("long").alias("dropped_duplicates"),
        F.count_if(F.col("set_name").isNull()).alias("dropped_missing_target"),
        F.count_if(F.col("set_name") == splits.TRAIN).alias("train_available"),
        F.count_if(F.col("set_name") == splits.TEST).alias("test_rows"),
        F.count_if(F.col("set_name") == splits.SIMULATION).alias("simulation_rows"),
    )


def plan_rows(df: DataFrame, spec: TableSpec, task: str, rules: dict, sample_rows: int | None,
              seed: int, order: Sequence[str] = FILE_ORDER) -> SetPlan:
    """Train and test rows of a run; ``order`` names the columns that say which row is first.

    They must tell rows apart.  Rows are deduplicated, labelled, placed and drawn
    once, on the planning and order columns only; the whole rows are then joined
    once to their places and stored by set.  Whole rows without a place are mostly
    left out before that join.  The test set is never sampled, so it is the same
    for every sample size.
    """
    if sample_rows is not None and sample_rows < 1:
        raise ValueError(f"sample size must be positive, got {sample_rows}")
    target = spec.target(task)
    light = df.select(*dict.fromkeys([*spec.planning_columns(task, df.columns), *order]))
    total = df.count()
    # A row without an id is still one row after deduplication.
    key = F.coalesce(F.col(spec.id_column).cast("string"), F.lit(""))
    placed = materialize(
        flag_rows(light, spec, task, rules, [F.col(c) for c in order]).select(
            *order, key.alias("_key"), F.col(target).alias("_label"), "set_name"), "plan")
    counts = plan_counts(placed, total).first().asDict()
    in_train, in_test = (F.col("set_name") == name for name in (splits.TRAIN, splits.TEST))
    if sample_rows is not None and sample_rows < counts["train_available"]:
        draw, digest = sample_cut(placed.where(in_train), sample_rows, seed, F.col("_key"))
        in_train = in_train & drawn_within(seed, F.col("_key"), draw, digest)
    wanted = placed.where(in_train | in_test).select(*order, "_label", "set_name")
    names = list(dict.fromkeys([*df.columns, target]))
    whole = df.drop(target)
    n = min(counts["train_available"], math.inf if sample_rows is None else sample_rows) + counts["test_rows"]
    if 4 * n <= 3 * total:
        whole = may_hold(whole, wanted, order, n)
    rows = materialize(whole.join(wanted, list(order)).withColumnRenamed("_label", target)
                       .select(*names, "set_name"), "sets")
    return SetPlan(
        rows.where(F.col("set_name") == splits.TRAIN).drop("set_name"),
        rows.where(F.col("set_name") == splits.TEST).drop("set_name"),
        counts,
    )
