"""One monitoring run of one model: four graded parts in one summary row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import clean, daycounts, drift, feedback, metrics, train
from keelson.operators.profile import side_by_side
from keelson.session import materialize
from keelson.spec import TableSpec


def live_scores(joined: DataFrame, task: str, threshold: float) -> DataFrame:
    """Scores of matched predictions; classes are cut at the model's threshold."""
    if task == "regression":
        return metrics.regression(joined, "actual", "prediction")
    flat = joined.select(
        F.col("actual").cast("boolean").alias("t"), F.col("probability").alias("p"),
        (F.col("probability") >= threshold).alias("a"))
    return side_by_side(metrics.classification(flat, "t", "a"), metrics.auc(flat, "t", "p"))


#: The model's answers among the counted columns.
PREDICTION = "_prediction"


def count_reference(train_set: DataFrame, model: train.TrainedModel, spec: TableSpec) -> DataFrame:
    """Counts of the train set's cleaned features and of the model's answers to it.

    Train set and model of a version do not change, so neither do these counts:
    keep them by ``daycounts.stored_once``.
    """
    numeric, categorical = spec.encoded_features(model.task)
    cleaned = clean.clean_table(train_set, spec, numeric_booleans=True)
    answers = model.score(train_set).select(F.col("prediction").cast("double").alias(PREDICTION))
    here = [[c for c in group if c in cleaned.columns] for group in (numeric, categorical)]
    answered = [[PREDICTION], []] if model.task == "regression" else [[], [PREDICTION]]
    return daycounts.count_values(cleaned, *here).unionByName(daycounts.count_values(answers, *answered))


def clean_category(spec: TableSpec):
    def read(name: str, raw: Column) -> Column:
        return clean.read_as(spec[name].kind, raw, T.StringType())
    return read


def summarize(predictions: DataFrame, outcomes: DataFrame, train_set: DataFrame,
              model: train.TrainedModel, spec: TableSpec, *, model_name: str,
              model_version: str, reference_scores: dict[str, float], run_id: str,
              now: datetime, window_hours: float = 24.0, reference_source: str = "train",
              reference_groups: DataFrame | None = None, previous: DataFrame | None = None,
              reference_counts: DataFrame | None = None) -> DataFrame:
    """The summary row of a run, against the whole train set.

    ``predictions`` are the window's log rows, stored once, since every part
    reads them.  ``reference_groups`` are group scores of the model's test set,
    ``previous`` the summary of the run before, from which streaks go on.  With
    ``reference_counts`` (see ``count_reference``), stored once for a model
    version, the train set is neither read nor scored.
    """
    task = model.task
    spark = predictions.sparkSession
    window = materialize(predictions, "window")
    n = window.count()
    joined = materialize(feedback.join_outcomes(window, outcomes), "joined")
    n_joined = joined.count()
    levels = dict.fromkeys(drift.PARTS, drift.INSUFFICIENT)
    numbers: dict[str, float | None] = {}
    flagged: list = []
    grades = groups = None
    if n >= drift.MIN_PREDICTIONS:
        seen = _sent_columns(window, spec, task)
        current_raw = clean.decode_json(window.select("raw_input", "prediction"), "raw_input", seen)
        held = spec.encoded_features(task)
        reference = reference_counts if reference_counts is not None else materialize(
            count_reference(train_set, model, spec), "reference")
        current = clean.clean_table(current_raw, spec, numeric_booleans=True)
        # One row for each column of the catalog at most.
        counted = {r["column"] for r in reference.select("column").distinct().collect()}
        numeric, categorical = ([c for c in group if c in current.columns and c in counted] for group in held)
        served = [[PREDICTION], []] if task == "regression" else [[], [PREDICTION]]
        current = current.withColumn(PREDICTION, F.col("prediction").cast("double"))
        current = materialize(daycounts.count_values(
            current, [*numeric, *served[0]], [*categorical, *served[1]]), "current")
        table = daycounts.drift_table(reference, current, numeric, categorical)
        totals = drift.drift_totals(table).withColumn(
            "level", drift.feature_level(
                F.col("drifted_share"), F.col("margin_sum"), F.col("n_unmeasured"))).first()
        levels["feature"] = totals["level"]
        numbers |= {k: totals[k] for k in ("drifted_share", "margin_sum", "n_unmeasured")}

        moved = daycounts.drift_table(reference, current, *served)
        levels["prediction"] = moved.agg(
            drift.prediction_level(F.bool_or("drifted")).alias("level")).first()["level"]

        known = daycounts.known_categories(reference, categorical)
        graded = materialize(drift.input_quality(
            daycounts.quality_numbers(reference, numeric, categorical, known),
            daycounts.quality_numbers(current, numeric, categorical, known)), "quality")
        levels["input_quality"] = drift.quality_level(graded, n).first()["level"]
        # One entry per feature column at most.
        flagged = [r["column"] for r in drift.flagged_columns(graded).collect()]
        grades = graded.agg(F.sort_array(F.collect_list(F.struct(
            "column", "missing_increase_points", "unseen_share", "level"))).alias("column_grades"))
        if reference_scores and n_joined >= drift.MIN_GROUND_TRUTH:
            live = live_scores(joined, task, model.threshold or 0.5)
            name = metrics.COMPARED[task]
            graded_live = live.withColumn("level", drift.performance_level(
                task, F.col(name), F.lit(reference_scores.get(name)).cast("double"),
                F.lit(n_joined))).first().asDict()
            levels["performance"] = graded_live.pop("level")
            groups = _side_by_side(group_scores(joined, spec, task, model.threshold or 0.5),
                                   reference_groups, name)
            numbers |= {f"current_{k}": v for k, v in graded_live.items()}
    streaks = _streaks(levels, model_version, previous)
    row = spark.range(1).select(
        F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
        F.lit(task).alias("task_type"), F.lit(run_id).alias("run_id"),
        F.lit(now.isoformat()).alias("computed_at"), F.lit(n).alias("n_predictions"),
        F.lit(n_joined).alias("n_ground_truth"),
        F.lit(float(window_hours)).alias("window_hours"), F.lit(reference_source).alias("reference_source"),
        F.struct(*[F.lit(v).alias(k) for k, v in levels.items()]).alias("parts"),
        F.struct(*[F.lit(v).cast("long").alias(k) for k, v in streaks.items()]).alias("consecutive_warnings"),
        F.lit(model.threshold).cast("double").alias("decision_threshold"),
        F.array(*[F.lit(c) for c in flagged]).cast("array<string>").alias("flagged_columns"),
        *[F.lit(v).cast("double").alias(k) for k, v in numbers.items()],
        *[F.lit(v).cast("double").alias(f"reference_{k}") for k, v in reference_scores.items()],
    )
    # Both hold one row: an entry per feature column, and per value of a group column.
    row = row.crossJoin(grades) if grades is not None else row.withColumn(
        "column_grades", F.lit(None).cast(_GRADES))
    row = row.crossJoin(groups) if groups is not None else row.withColumn("groups", F.lit(None).cast(_GROUPS))
    return row.withColumn("severity", drift.worst(*[F.col(f"parts.{p}") for p in drift.PARTS]))


_GRADES = "array<struct<column: string, missing_increase_points: double, unseen_share: double, level: string>>"
_GROUPS = ("array<struct<group_column: string, group_name: string, n: bigint, insufficient_data: boolean, "
           "score: double, reference_score: double>>")


def _side_by_side(live: DataFrame, reference: DataFrame | None, score: str) -> DataFrame:
    """Live group scores in one array, beside the reference's where it has the group."""
    names = ["group_column", "group_name"]
    rows = live.select(*names, "n", "insufficient_data", F.col(score).alias("score"))
    if reference is None:
        rows = rows.withColumn("reference_score", F.lit(None).cast("double"))
    else:
        rows = rows.join(reference.select(*names, F.col(score).alias("reference_score")), names, "left")
    return rows.agg(F.sort_array(F.collect_list(F.struct(
        *names, "n", "insufficient_data", "score", "reference_score"))).cast(_GROUPS).alias("groups"))


def _streaks(levels: dict[str, str], version: str, previous: DataFrame | None) -> dict[str, int]:
    """Runs in a row at warning per part; another model version starts over."""
    last = previous.select("model_version", "consecutive_warnings").first() if previous is not None else None
    before = last["consecutive_warnings"].asDict() if last and last["model_version"] == version else {}
    return {p: (before.get(p) or 0) + 1 if level == drift.WARNING else 0 for p, level in levels.items()}


def group_scores(joined: DataFrame, spec: TableSpec, task: str, threshold: float) -> DataFrame:
    """Live scores per group of the served raw rows."""
    keep = [c for c in joined.columns if c != "raw_input"]
    flat = clean.decode_json(joined.select(*keep, "raw_input"), "raw_input", spec.group_columns)
    if task == "regression":
        return metrics.by_group(flat, task, spec.group_columns, "actual", "prediction",
                                min_rows=metrics.MONITORING_GROUP_ROWS)
    flat = flat.withColumns({"actual": F.col("actual").cast("boolean"),
                             "answer": F.col("probability") >= threshold})
    return metrics.by_group(flat, task, spec.group_columns, "actual", "answer", "probability",
                            metrics.MONITORING_GROUP_ROWS)


def _sent_columns(window: DataFrame, spec: TableSpec, task: str) -> Sequence[str]:
    """Catalog columns the window's records carry at all."""
    features = set(spec.features(task))
    found = clean.json_keys(window.select("raw_input"), "raw_input").where(
        F.col("key").isin(*features)).select("key").collect()
    names = {r["key"] for r in found}
    return [c for c in spec.names if c in names]
