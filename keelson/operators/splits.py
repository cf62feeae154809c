"""Cutting a dataset version by time: test data is always later than train data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions import parse
from keelson.operators import clean, ranking
from keelson.spec import FEEDBACK, MOMENT_COLUMN, ORIGINAL, TableSpec

TRAIN, TEST, SIMULATION = "train", "test", "simulation"

# Sizes and shares of the sets.
SIMULATION_SHARE = 0.10
TEST_SHARE = 0.20
UNDATED_TEST_SHARE = 0.20
FEEDBACK_TEST_SHARE = 0.20


def split_points(days: DataFrame, day: str = "day", most_held: int | None = None) -> DataFrame:
    """One row ``t1, t2`` for a column of event days.

    From t2 on lie about 10% of the dated rows, at most ``most_held`` if that is
    given; from t1 to t2 about 20% of the rest.  Rows of a boundary day all go to the later side.

    The rows are only counted per day, with partial counts before the shuffle.
    The windows run over that table, which the calendar bounds to a few
    thousand rows.
    """
    per_day = days.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    held = F.floor(F.col("total") * F.lit(SIMULATION_SHARE))
    if most_held is not None:
        held = F.least(held, F.lit(most_held))
    counted = per_day.select(
        "day", "n", F.sum("n").over(upto).alias("cum"),
        F.sum("n").over(everything).alias("total"),
    ).withColumn("held", held)
    with_t2 = counted.withColumn(
        "t2",
        F.when(F.col("held") > 0,
               F.min(F.when(F.col("cum") > F.col("total") - F.col("held"), F.col("day")))
               .over(everything))
        .otherwise(F.date_add(F.max("day").over(everything), 1)),
    )
    with_before = with_t2.withColumn(
        "before", F.sum(F.when(F.col("day") < F.col("t2"), F.col("n"))).over(everything))
    cut = F.floor(F.col("before") * F.lit(1 - TEST_SHARE))
    return with_before.agg(
        F.coalesce(
            F.min(F.when((F.col("day") < F.col("t2")) & (F.col("cum") > cut), F.col("day"))),
            F.max("t2"),
        ).alias("t1"),
        F.max("t2").alias("t2"),
        F.max("total").alias("dated_rows"),
    )


def split_rule(df: DataFrame, spec: TableSpec) -> dict:
    """The split points of a table as a manifest rule."""
    days = df.select(clean.event_day(df, spec).alias("day"))
    row = split_points(days).first()
    if row["t2"] is None:
        raise ValueError("no row has a readable date, split points cannot be placed")
    return {"t1": row["t1"].isoformat(), "t2": row["t2"].isoformat(),
            "undated_test_share": UNDATED_TEST_SHARE}


def split_name(df: DataFrame, spec: TableSpec, rules: Mapping[str, Mapping]) -> Column:
    """train / test / simulation per row, by the rule of the row's source.

    Undated rows go to test by a fixed hash of the id, the rest to train.  A
    source without a rule is an error.
    """
    source = clean.record_source(df)
    when_ = clean.event_moment(df, spec)
    share = parse.hash_share(F.coalesce(F.col(spec.id_column).cast("string"), F.lit("None")))
    chosen = None
    for name, rule in rules.items():
        t1 = _literal_moment(rule["t1"])
        t2 = _literal_moment(rule.get("t2"))
        undated = float(rule.get("undated_test_share", UNDATED_TEST_SHARE))
        steps = (when_ >= t1).cast("int")
        if t2 is not None:
            steps = steps + (when_ >= t2).cast("int")
        # No moment gives no step count, and so falls through to the hash rule.  The
        # strict element_at is declared never null and would hide that.
        place = F.coalesce(
            F.try_element_at(F.array(F.lit(TRAIN), F.lit(TEST), F.lit(SIMULATION)), steps + 1),
            F.when(share < undated, TEST).otherwise(TRAIN),
        )
        chosen = (F if chosen is None else chosen).when(source == name, place)
    unknown = F.raise_error(F.concat(F.lit("no split rule for record source "), source))
    return unknown.cast("string") if chosen is None else chosen.otherwise(unknown.cast("string"))


def _literal_moment(value: str | None) -> Column | None:
    return None if value is None else F.lit(value).cast("timestamp")


def assign_split(df: DataFrame, spec: TableSpec, rules: Mapping[str, Mapping]) -> DataFrame:
    return df.withColumn("set_name", split_name(df, spec, rules))


def feedback_rules(source_rules: Mapping[str, Mapping], records: DataFrame,
                   rows: int | None = None) -> dict:
    """Rules of a version that adds feedback to a source version.

    Original rows are train up to the source's t2 and simulation after it.  Of
    the feedback rows the latest 20% by prediction time are test.
    """
    moment = parse.moment(F.col(MOMENT_COLUMN).cast("string"))
    micros = F.unix_micros(moment).cast("double")
    rows = records.count() if rows is None else rows
    cut = ranking.kth_smallest(records, micros, int(rows * (1 - FEEDBACK_TEST_SHARE)))
    t1 = datetime.fromtimestamp(int(cut) // 1_000_000, UTC).replace(
        microsecond=int(cut) % 1_000_000, tzinfo=None)
    t2 = source_rules[ORIGINAL]["t2"]
    return {
        ORIGINAL: {"t1": t2, "t2": t2, "undated_test_share": 0.0},
        FEEDBACK: {"t1": t1.isoformat(), "t2": None, "undated_test_share": 0.0},
    }


def training_order(df: DataFrame, spec: TableSpec, ties: Sequence[Column]) -> DataFrame:
    """Adds ``position``: undated rows first, then by moment, ties in file order."""
    timed = df.withColumn("_moment", clean.event_moment(df, spec))
    return ranking.global_rank(timed, [F.col("_moment").asc_nulls_first(), *ties])


def fold_bounds(rows: int, undated: int, folds: int) -> list[tuple[int, int]]:
    """(start, end) position of each scored block.

    Fold i learns from every position before ``start`` and is scored on
    ``[start, end)``; undated rows lead and are only ever learned from.
    """
    dated = rows - min(undated, rows)
    size = dated // (folds + 1)
    if size == 0:
        raise ValueError(f"{dated} dated rows are too few for {folds} folds")
    starts = [rows - (folds - i) * size for i in range(folds)]
    return [(s, s + size) for s in starts]


def time_folds(ordered: DataFrame, folds: int, rows: int, undated: int) -> DataFrame:
    """Adds ``scored_in``: the fold a row is scored in, null if it only ever teaches."""
    bounds = fold_bounds(rows, undated, folds)
    first, size = bounds[0][0], bounds[0][1] - bounds[0][0]
    fold = F.floor((F.col("position") - first) / size).cast("int")
    return ordered.withColumn("scored_in", F.when(F.col("position") >= first, fold))
