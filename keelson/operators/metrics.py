"""Scores of predictions, per table and per group, and the promotion gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions import parse
from keelson.operators import ranking

# Rows a group needs before its scores are reported.
EVALUATION_GROUP_ROWS = 200
MONITORING_GROUP_ROWS = 50


def regression_scores(truth: Column, prediction: Column) -> dict[str, Column]:
    """rmse, mae and r2 as aggregate expressions.

    r2 is one minus residual over total sum of squares, not the squared
    correlation.
    """
    error = truth - prediction
    squares = F.sum(error * error)
    spread = F.var_pop(truth) * F.count(truth)
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": F.when(spread > 0, 1 - squares / F.when(spread > 0, spread))
        .when(squares == 0, 1.0).otherwise(0.0),
    }


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / F.when(bottom > 0, bottom)).otherwise(0.0)


def classification_scores(truth: Column, answer: Column) -> dict[str, Column]:
    """f1, precision, recall, accuracy; zero where nothing was there to divide by."""
    hit = F.count_if(truth & answer)
    false_alarm = F.count_if(~truth & answer)
    miss = F.count_if(truth & ~answer)
    right = F.count_if(truth == answer)
    return {
        "f1": _ratio(2 * hit, 2 * hit + false_alarm + miss),
        "precision": _ratio(hit, hit + false_alarm),
        "recall": _ratio(hit, hit + miss),
        "accuracy": _ratio(right, F.count(truth)),
    }


def regression(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    scores = regression_scores(F.col(truth), F.col(prediction))
    return df.agg(*[c.alias(n) for n, c in scores.items()])


def classification(df: DataFrame, truth: str, answer: str) -> DataFrame:
    scores = classification_scores(F.col(truth), F.col(answer))
    return df.agg(*[c.alias(n) for n, c in scores.items()])


def auc(df: DataFrame, truth: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per key, ties counted half; null for one class only.

    Rows are first counted per distinct score, so repeated scores cost nothing,
    and the running count of negatives is spread over tasks by score range.
    """
    label = F.col(truth).cast("boolean")
    counts = (
        df.where(F.col(score).isNotNull() & label.isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(label).alias("pos"), F.count_if(~label).alias("neg"))
    )
    run = ranking.running_totals(counts, list(keys), "score", ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    area = F.sum(F.col("pos") * (below + F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    value = F.when(pairs > 0, area / F.when(pairs > 0, pairs)).alias("auc")
    return run.groupBy(*keys).agg(value) if keys else run.agg(value)


def long_groups(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per input row and grouping column: (group_column, group_name, *keep).

    Names are normalized like any categorical; rows without a name are left out.
    """
    present = [c for c in columns if c in df.columns]
    read = df.select(*keep, *[parse.words(F.col(c).cast("string")).alias(c) for c in present])
    return read.unpivot(list(keep), present, "group_column", "group_name").where(
        F.col("group_name").isNotNull())


def by_group(df: DataFrame, task: str, columns: Sequence[str], truth: str, answer: str,
             probability: str | None = None, min_rows: int = EVALUATION_GROUP_ROWS) -> DataFrame:
    """Scores per group of every grouping column, in one aggregate.

    A group below ``min_rows`` keeps its count only; a group with one class has
    no auc.
    """
    keep = [c for c in (truth, answer, probability) if c]
    groups = long_groups(df, columns, keep)
    names = ["group_column", "group_name"]
    scores = (regression_scores if task == "regression" else classification_scores)(
        F.col(truth), F.col(answer))
    n = F.count(F.lit(1))
    scored = groups.groupBy(*names).agg(
        n.alias("n"), (n < min_rows).alias("insufficient_data"),
        *[F.when(n >= min_rows, c).alias(s) for s, c in scores.items()],
    )
    if task == "classification" and probability:
        areas = auc(groups, truth, probability, names)
        scored = scored.join(areas, names, "left").withColumn(
            "auc", F.when(~F.col("insufficient_data"), F.col("auc")))
    return scored


# Floors, compared metrics and margins of the promotion gates.
FLOORS = {"regression": ("r2", 0.75), "classification": ("auc", 0.55)}
COMPARED = {"regression": "rmse", "classification": "auc"}
RELATIVE_RMSE_MARGIN = 0.01
ABSOLUTE_AUC_MARGIN = 0.005
SLACK = 1e-9


def gate(rows: DataFrame, task: str, candidate: str = "candidate_",
         champion: str = "champion_") -> DataFrame:
    """Adds passed, floor_passed, beats_champion and reason to candidate/champion rows.

    A candidate must clear the floor, and beat the champion (null columns: there
    is none yet) by the margin.  A missing candidate metric is an error.
    """
    floor_metric, floor = FLOORS[task]
    compared = COMPARED[task]

    def needed(column: str) -> Column:
        return F.coalesce(F.col(column), F.raise_error(f"{column} was not measured").cast("double"))

    own_floor = needed(candidate + floor_metric)
    rival = F.col(champion + compared)
    own = needed(candidate + compared)
    if task == "regression":
        bound = rival - F.abs(rival) * RELATIVE_RMSE_MARGIN
        better, sign = own <= bound + SLACK, "<="
    else:
        bound = rival + ABSOLUTE_AUC_MARGIN
        better, sign = own >= bound - SLACK, ">="
    floor_passed = own_floor >= floor
    beats = F.when(floor_passed & rival.isNotNull(), better)
    shown = F.format_string
    reason = (
        F.when(~floor_passed, shown(f"{floor_metric} %.4f is below the floor of {floor}", own_floor))
        .when(rival.isNull(), shown(f"{floor_metric} %.4f clears the floor, no champion yet", own_floor))
        .when(beats, shown(f"{compared} %.4f beats the champion's %.4f", own, rival))
        .otherwise(shown(f"{compared} %.4f against the champion's %.4f, needs {sign} %.4f",
                         own, rival, bound))
    )
    return rows.select(
        "*", (floor_passed & F.coalesce(beats, F.lit(True))).alias("passed"),
        floor_passed.alias("floor_passed"), beats.alias("beats_champion"), reason.alias("reason"),
    )
