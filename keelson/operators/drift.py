"""Comparing two samples column by column, and grading what was found."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions import parse
from keelson.operators import ranking
from keelson.operators.profile import value_counts
from keelson.session import materialize

OK, WARNING, HIGH, INSUFFICIENT = "ok", "warning", "high", "insufficient_data"

# Detection thresholds and the lines between levels.
DISTANCE_THRESHOLD = 0.1
P_VALUE_THRESHOLD = 0.05
FEW_DISTINCT = 5
SMALLEST_STD = 0.001
SHARE_WARNING, SHARE_HIGH = 0.3, 0.5
MARGIN_WARNING = 0.0
RMSE_RATIO_WARNING, RMSE_RATIO_HIGH = 1.2, 1.5
AUC_DROP_WARNING, AUC_DROP_HIGH = 0.05, 0.10
MIN_GROUND_TRUTH = 50
MIN_PREDICTIONS = 50
MISSING_POINTS_WARNING, MISSING_POINTS_HIGH = 5.0, 20.0
UNSEEN_WARNING, UNSEEN_HIGH = 0.05, 0.20
PARTS = ("feature", "prediction", "performance", "input_quality")


def severity_rank(level: Column) -> Column:
    """0, 1, 2 for measured levels, null for anything unmeasured."""
    return F.when(level == OK, 0).when(level == WARNING, 1).when(level == HIGH, 2)


def rank_name(rank: Column) -> Column:
    return (F.when(rank == 0, OK).when(rank == 1, WARNING).when(rank == 2, HIGH)
            .otherwise(INSUFFICIENT))


def worst(*levels: Column) -> Column:
    """The worst measured level; insufficient_data if none was measured."""
    ranks = [severity_rank(level) for level in levels]
    return rank_name(F.greatest(*ranks) if len(ranks) > 1 else ranks[0])


def aligned_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n_ref, n_cur) of the present values of both sides.

    Both sides are counted in one aggregate over tagged rows, which does what a
    full outer join of two frequency tables would, with one shuffle.
    """
    def tagged(df: DataFrame, side: int) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
            [], list(columns), "column", "value"
        ).where(F.col("value").isNotNull()).withColumn("_side", F.lit(side))

    both = tagged(reference, 0).unionByName(tagged(current, 1))
    return both.groupBy("column", "value").agg(
        F.count_if(F.col("_side") == 0).alias("n_ref"),
        F.count_if(F.col("_side") == 1).alias("n_cur"),
    )


def aligned_numbers(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for numeric columns, with the value kept as a double."""
    def tagged(df: DataFrame, side: int) -> DataFrame:
        return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
            [], list(columns), "column", "value"
        ).where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("_side", F.lit(side))

    both = tagged(reference, 0).unionByName(tagged(current, 1))
    return both.groupBy("column", "value").agg(
        F.count_if(F.col("_side") == 0).alias("n_ref"),
        F.count_if(F.col("_side") == 1).alias("n_cur"),
    )


def js_distance(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon distance (natural log) per column of an aligned count table.

    Null for a column that has no value on one of the sides.
    """
    totals = counts.groupBy("column").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    p = F.col("n_ref") / F.nullif("t_ref", F.lit(0))
    q = F.col("n_cur") / F.nullif("t_cur", F.lit(0))
    m = (F.col("p") + F.col("q")) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / m)).otherwise(0.0)

    # Totals hold one row per column.
    shares = counts.join(F.broadcast(totals), "column").select(
        "column", "t_ref", "t_cur", p.alias("p"), q.alias("q"))
    return shares.groupBy("column").agg(F.when(
        (F.max("t_ref") > 0) & (F.max("t_cur") > 0),
        F.sqrt(F.greatest(F.sum((part(F.col("p")) + part(F.col("q"))) / 2), F.lit(0.0))))
        .alias("value"))


def reference_std(counts: DataFrame) -> DataFrame:
    """Population deviation of the reference side, from counts; never below 0.001."""
    first = counts.groupBy("column").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"),
        (F.sum(F.col("value") * F.col("n_ref")) / F.nullif(F.sum("n_ref"), F.lit(0))).alias("mean"),
    )
    gap = F.col("value") - F.col("mean")
    return counts.join(F.broadcast(first), "column").groupBy("column").agg(
        F.max("t_ref").alias("t_ref"), F.max("t_cur").alias("t_cur"),
        F.greatest(F.sqrt(F.sum(gap * gap * F.col("n_ref")) / F.nullif(F.sum("n_ref"), F.lit(0))),
                   F.lit(SMALLEST_STD)).alias("std"),
    )


def wasserstein(counts: DataFrame) -> DataFrame:
    """Wasserstein-1 distance per column over the reference's deviation.

    The distance is the area between the two cumulative distributions.  Both
    are running counts over distinct values, spread over tasks by value range.
    Null for a column that has no value on one of the sides.
    """
    run = ranking.running_totals(counts, ["column"], "value", ["n_ref", "n_cur"])
    scales = reference_std(counts)
    gap = F.abs(F.col("cum_n_ref") / F.nullif("t_ref", F.lit(0))
                - F.col("cum_n_cur") / F.nullif("t_cur", F.lit(0)))
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    # Scales hold one row per column.
    return run.join(F.broadcast(scales), "column").groupBy("column").agg(
        F.when((F.max("t_ref") > 0) & (F.max("t_cur") > 0), F.sum(gap * step) / F.max("std"))
        .alias("value"))


def chi_square(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Test per column that both samples follow one distribution: statistic, degrees, p-value.

    One aggregate of the aligned counts for all columns, whatever the number of
    categories; the p-value is taken of one row per column.  Without values on
    both sides statistic and p-value are null.
    """
    counts = aligned_counts(reference, current, columns)
    totals = counts.groupBy("column").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    both = F.col("n_ref") + F.col("n_cur")
    expected = both * F.col("t_ref") / (F.col("t_ref") + F.col("t_cur"))
    # With two rows a value's terms differ from expectation by the same amount.
    gap = F.col("n_ref") - expected
    term = gap * gap / F.nullif(expected, F.lit(0.0)) + gap * gap / F.nullif(both - expected, F.lit(0.0))
    tested = counts.join(F.broadcast(totals), "column").groupBy("column").agg(
        F.when((F.max("t_ref") > 0) & (F.max("t_cur") > 0), F.sum(term)).alias("statistic"),
        (F.count(F.lit(1)) - 1).alias("degrees"))
    spark = reference.sparkSession
    rows = _listed(spark, [(c, "") for c in columns]).select("column").join(
        tested, "column", "left").collect()
    graded = [(r["column"], r["statistic"], r["degrees"] or 0, None if r["statistic"] is None
               else chi_square_tail(r["statistic"], r["degrees"])) for r in rows]
    out = spark.createDataFrame(graded, "column string, statistic double, degrees long, value double")
    return out.select("column", F.lit("chi-square p-value").alias("method"), "statistic", "degrees",
                      F.lit(P_VALUE_THRESHOLD).alias("threshold"), "value",
                      (F.col("value") < P_VALUE_THRESHOLD).alias("drifted"))


def chi_square_tail(statistic: float, degrees: int) -> float:
    """Probability of a larger statistic: the upper incomplete gamma function.

    By its series below the mean, by its continued fraction (modified Lentz) above.
    """
    a, x = degrees / 2, statistic / 2
    if degrees == 0 or x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - front * total)
    b, c, d = x + 1 - a, 1e300, 1 / (x + 1 - a)
    h, i, step = d, 0, 0.0
    while abs(step - 1) > 1e-15 and i < 100_000:
        i += 1
        an = i * (a - i)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        step = c * d
        h *= step
    return front * h


def _listed(spark, methods: Sequence[tuple[str, str]]) -> DataFrame:
    """(column, method), one row for each compared column."""
    return spark.createDataFrame(list(methods), "column string, method string")


def drift_table(reference: DataFrame, current: DataFrame, numeric: Sequence[str],
                categorical: Sequence[str]) -> DataFrame:
    """(column, method, threshold, value, drifted), a row for every compared column.

    Categories, and numbers with at most five distinct values, are compared by
    Jensen-Shannon distance, other numbers by normed Wasserstein distance.  A
    column without values on one side was not measured: value and drifted are null.
    """
    return drift_of_counts(
        reference.sparkSession, aligned_numbers(reference, current, numeric) if numeric else None,
        aligned_counts(reference, current, categorical) if categorical else None, numeric, categorical)


def drift_of_counts(spark: SparkSession, numbers: DataFrame | None, categories: DataFrame | None,
                    numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """The drift table of aligned counts ``column, value, n_ref, n_cur`` of both kinds of columns."""
    if not numeric and not categorical:
        raise ValueError("no column to compare")
    pieces, methods = [], {c: "jensen-shannon" for c in categorical}
    if categories is not None:
        pieces.append(js_distance(categories))
    if numbers is not None:
        counts = materialize(numbers, "drift")
        distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
        # One row per column at most.
        many = {r["column"] for r in distinct.where(F.col("n_distinct") > FEW_DISTINCT).collect()}
        methods |= {c: "wasserstein" if c in many else "jensen-shannon" for c in numeric}
        if len(many) < len(numeric):
            pieces.append(js_distance(counts.where(~F.col("column").isin(*many)) if many else counts))
        if many:
            pieces.append(wasserstein(counts.where(F.col("column").isin(*many))))
    table = pieces[0]
    for piece in pieces[1:]:
        table = table.unionByName(piece)
    listed = _listed(spark, sorted(methods.items()))
    return listed.join(table, "column", "left").select(
        "column", "method", F.lit(DISTANCE_THRESHOLD).alias("threshold"), "value",
        (F.col("value") >= DISTANCE_THRESHOLD).alias("drifted"))


def drift_totals(table: DataFrame) -> DataFrame:
    """Drifted and unmeasured columns, the drifted share, and the sum of margins.

    The share is that of all compared columns.  Only distances have margins: a
    p-value falls as drift grows.  No measured column at all is an error, not a
    clean result.
    """
    usable = F.col("value").isNotNull() & F.col("threshold").isNotNull()
    distance = usable & ~F.col("method").endswith("p-value")
    n = F.count_if(usable)
    return table.agg(
        F.when(n == 0, F.raise_error("no column could be compared").cast("long"))
        .otherwise(F.count_if(F.col("drifted"))).alias("n_drifted"),
        F.count_if(~usable).alias("n_unmeasured"),
        (F.count_if(F.col("drifted")) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("drifted_share"),
        F.sum(F.when(distance, F.col("value") - F.col("threshold"))).alias("margin_sum"),
    )


def share_level(share: Column) -> Column:
    return parse.level(share, SHARE_WARNING, SHARE_HIGH)


def margin_level(margin_sum: Column) -> Column:
    """Warning from zero up; there is no high tier.  Null means nothing was summed."""
    return F.when(margin_sum >= MARGIN_WARNING, WARNING).otherwise(OK)


def feature_level(share: Column, margin_sum: Column, unmeasured: Column) -> Column:
    """Worst of share and margins; never ok while a compared column was not measured."""
    measured = worst(share_level(share), margin_level(margin_sum))
    return F.when((measured == OK) & (unmeasured > 0), INSUFFICIENT).otherwise(measured)


def prediction_level(drifted: Column) -> Column:
    return F.when(drifted, HIGH).when(~drifted, OK).otherwise(INSUFFICIENT)


def performance_level(task: str, current: Column, reference: Column, n_joined: Column) -> Column:
    """Grades live scores against test scores: rmse ratio, or auc drop.

    Too little ground truth is insufficient data; a missing score is an error.
    """
    unmeasured = F.raise_error("a score needed for the performance level is missing").cast("double")
    current, reference = F.coalesce(current, unmeasured), F.coalesce(reference, unmeasured)
    if task == "regression":
        graded = parse.level(current / reference, RMSE_RATIO_WARNING, RMSE_RATIO_HIGH)
    else:
        drop = reference - current
        graded = (F.when(drop >= AUC_DROP_HIGH, HIGH).when(drop >= AUC_DROP_WARNING, WARNING)
                  .otherwise(OK))
    return F.when(n_joined < MIN_GROUND_TRUTH, INSUFFICIENT).otherwise(graded)


def known_categories(train: DataFrame, columns: Sequence[str], clean) -> DataFrame:
    """(column, value) pairs of a train set after cleaning.

    Raw values are made distinct first, so each is cleaned once.
    ``clean`` maps (column name, raw value Column) to the cleaned Column.
    """
    raw = train.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "raw").distinct()
    value = None
    for c in columns:
        value = (F if value is None else value).when(F.col("column") == c, clean(c, F.col("raw")))
    return raw.select("column", value.alias("value")).where(
        F.col("value").isNotNull()).distinct()


def quality_numbers(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    known: DataFrame) -> DataFrame:
    """(column, missing_share, unseen_share) of a cleaned table.

    ``unseen_share`` is the share of present values outside ``known``, null for
    numeric columns.  Values are counted before the lookup join, so it handles
    distinct values only.
    """
    columns = [*numeric, *categorical]
    missing = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]) \
        .unpivot([], columns, "column", "missing_share")
    if not categorical:
        return missing.withColumn("unseen_share", F.lit(None).cast("double"))
    present = value_counts(df, categorical).where(F.col("value").isNotNull())
    looked_up = present.join(known.withColumn("_known", F.lit(True)), ["column", "value"], "left")
    unseen = looked_up.groupBy("column").agg(
        (F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)) / F.sum("n"))
        .alias("unseen_share"))
    return missing.join(F.broadcast(unseen), "column", "left")


def input_quality(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Grades every column's rise in missing values and share of unseen categories.

    Both inputs come from ``quality_numbers``; one row per column each.
    """
    base = reference.select("column", F.col("missing_share").alias("base"))
    rise = F.round((F.col("missing_share") - F.coalesce("base", F.lit(0.0))) * 100, 4)
    graded = current.join(F.broadcast(base), "column", "left").select(
        "column", rise.alias("missing_increase_points"), "unseen_share")
    return graded.withColumn("level", worst(
        parse.level(F.col("missing_increase_points"), MISSING_POINTS_WARNING, MISSING_POINTS_HIGH),
        F.when(F.col("unseen_share").isNotNull(),
               parse.level(F.col("unseen_share"), UNSEEN_WARNING, UNSEEN_HIGH)),
    ))


def flagged_columns(graded: DataFrame) -> DataFrame:
    """Columns at warning or worse, worst first, then by name."""
    return graded.where(F.col("level") != OK).orderBy(
        severity_rank(F.col("level")).desc(), "column")


def quality_level(graded: DataFrame, n_predictions: int) -> DataFrame:
    """The worst column's level; insufficient_data for too few predictions."""
    level = rank_name(F.max(severity_rank(F.col("level"))))
    enough = F.lit(n_predictions >= MIN_PREDICTIONS)
    return graded.agg(F.when(enough, level).otherwise(INSUFFICIENT).alias("level"))


