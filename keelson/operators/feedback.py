"""Predictions, their late outcomes, and the rows both turn into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import parse
from keelson.operators import clean, rows, splits
from keelson.session import materialize
from keelson.spec import FEEDBACK, MOMENT_COLUMN, SOURCE_COLUMN, TableSpec

# Smallest feedback set and default period.
MIN_FEEDBACK = 500
PERIOD_DAYS = 30


class NotEnoughFeedbackError(ValueError):
    """Too few predictions have an outcome to build a version from."""


def join_outcomes(predictions: DataFrame, outcomes: DataFrame,
                  *, dedupe_outcomes: bool = False) -> DataFrame:
    """Predictions that have an outcome, with ``actual`` added.

    An outcome reported twice gives two rows unless ``dedupe_outcomes`` is set.
    """
    reported = outcomes.select("request_id", "actual")
    if dedupe_outcomes:
        reported = reported.groupBy("request_id").agg(F.max("actual").alias("actual"))
    return predictions.join(reported, "request_id")


def reconcile_outcomes(predictions: DataFrame, outcomes: DataFrame, streamed: DataFrame) -> DataFrame:
    """``join_outcomes`` of the stored logs, from what a stream has joined already.

    A request is complete if the stream holds a row for each of its outcomes.  Requests
    that lack some, because an outcome came after the stream's bound or a row came too
    late for it, are joined again, wholly, and those only; the streamed rows of all others
    are taken as they are.  ``streamed`` may hold unmatched predictions, with a null
    ``reported_at``.
    """
    columns = [*predictions.columns, "actual"]
    matched = streamed.where("reported_at is not null")
    counts = predictions.select("request_id", F.lit(1).alias("p"), F.lit(0).alias("o"), F.lit(0).alias("m")) \
        .unionByName(outcomes.select("request_id", F.lit(0).alias("p"), F.lit(1).alias("o"), F.lit(0).alias("m"))) \
        .unionByName(matched.select("request_id", F.lit(0).alias("p"), F.lit(0).alias("o"), F.lit(1).alias("m")))
    lacking = materialize(counts.groupBy("request_id").agg(*[F.sum(c).alias(c) for c in "pom"]).where(
        "request_id is not null and p * o <> m").select("request_id"), "lacking")
    again = join_outcomes(predictions.join(lacking, "request_id", "left_semi"),
                          outcomes.join(lacking, "request_id", "left_semi"))
    whole = matched.join(lacking, "request_id", "left_anti")
    return whole.select(columns).unionByName(again.select(columns))


def records(matched: DataFrame, spec: TableSpec, task: str, columns: Sequence[str],
            order: Sequence[Column]) -> DataFrame:
    """One raw text row per id from matched predictions, the latest one.

    ``columns`` are the keys read from ``raw_input``; ``order`` breaks ties
    between equal moments, last one wins.
    """
    label = spec.target(task)
    actual, dtype = F.col("actual"), matched.schema["actual"].dataType
    if task == "classification":
        actual, dtype = actual.cast("boolean"), T.BooleanType()
    stamp = matched.schema["timestamp"].dataType
    moment = (parse.moment(F.col("timestamp")) if isinstance(stamp, T.StringType)
              else F.col("timestamp").cast("timestamp"))
    inputs = [c for c in columns if c != label]
    decoded = F.from_json("raw_input", "map<string,string>")
    flat = matched.select(
        *[F.element_at(decoded, F.lit(c)).alias(c) for c in inputs],
        parse.as_text(actual, dtype).alias(label),
        F.lit(FEEDBACK).alias(SOURCE_COLUMN),
        (F.col("timestamp") if isinstance(stamp, T.StringType)
         else F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias(MOMENT_COLUMN),
        moment.alias("_moment"),
        *[o.alias(f"_tie{i}") for i, o in enumerate(order)],
    )
    ties = [F.col(f"_tie{i}") for i in range(len(order))]
    latest = rows.dedup_latest(flat, [spec.id_column], F.col("_moment"), ties)
    return latest.drop("_moment", *[f"_tie{i}" for i in range(len(order))])


def merge(source: DataFrame, fresh: DataFrame, id_column: str) -> DataFrame:
    """Source rows whose id has no feedback, followed by the feedback rows.

    Ids are compared as text and a missing id equals a missing id.  Columns of
    either side that the other lacks become null.  Rows without an id take no
    part in the join: whether feedback has one is a single yes or no.
    """
    key = F.col(id_column).cast("string")
    missing = _has_missing_id(fresh, id_column)
    kept = source.where(key.isNotNull()).join(_present_ids(fresh, id_column), key == F.col("_id"), "left_anti")
    if not missing:
        kept = kept.unionByName(source.where(key.isNull()))
    return as_texts(kept).unionByName(as_texts(fresh), allowMissingColumns=True)


def replaced_count(source: DataFrame, fresh: DataFrame, id_column: str) -> DataFrame:
    key = F.col(id_column).cast("string")
    hit = source.select(key.alias("_key")).where("_key is not null").join(
        _present_ids(fresh, id_column), F.col("_key") == F.col("_id"), "left_semi")
    if _has_missing_id(fresh, id_column):
        hit = hit.unionByName(source.select(key.alias("_key")).where("_key is null"))
    return hit.agg(F.count(F.lit(1)).alias("replaced_records"))


def _present_ids(fresh: DataFrame, id_column: str) -> DataFrame:
    return fresh.select(F.col(id_column).cast("string").alias("_id")).where("_id is not null").distinct()


def _has_missing_id(fresh: DataFrame, id_column: str) -> bool:
    return not fresh.where(F.col(id_column).isNull()).isEmpty()


def as_texts(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f.name) if isinstance(f.dataType, T.StringType)
        else parse.as_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields
    ])


def holdout_pool(raw: DataFrame, spec: TableSpec, rules: dict, trained_ids: DataFrame) -> DataFrame:
    """Simulation rows the current model never learned from, without bookkeeping columns."""
    ids = trained_ids.select(F.col(spec.id_column).cast("string").alias("_id")).where(
        "_id is not null").distinct()
    in_simulation = raw.where(splits.split_name(raw, spec, rules) == splits.SIMULATION)
    unseen = in_simulation.join(
        ids, F.col(spec.id_column).cast("string") == F.col("_id"), "left_anti")
    return clean.drop_bookkeeping(unseen)


def overlap(test: DataFrame, trained: DataFrame | None, id_column: str) -> DataFrame:
    """How many test rows carry an id the current model learned from; 0 without a model."""
    if trained is None:
        return test.sparkSession.createDataFrame([(0,)], "overlap bigint")
    ids = trained.select(id_column).where(F.col(id_column).isNotNull()).distinct()
    return test.select(id_column).join(ids, id_column, "left_semi").agg(
        F.count(F.lit(1)).alias("overlap"))


def feedback_preview(matched: DataFrame, id_column: str) -> DataFrame:
    """Matched rows, distinct houses among them, and whether they are enough."""
    key = F.element_at(F.from_json("raw_input", "map<string,string>"), F.lit(id_column))
    ids = matched.select(key.alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("matched"),
        F.count("id").alias("houses"),
        (F.count("id") >= MIN_FEEDBACK).alias("enough"),
    )
