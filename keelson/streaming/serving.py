"""Scoring a stream of requests by the champion of the moment."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from keelson.operators import clean
from keelson.operators.train import TrainedModel
from keelson.sources.logs import PREDICTIONS
from keelson.sources.tables import exists

CHAMPIONS = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("promoted_at", T.TimestampType()),
])


def promote(spark: SparkSession, path: str, model_name: str, model_version: str, at: datetime) -> None:
    """Appends to the champion history; the latest row of a model is its champion."""
    spark.createDataFrame([(model_name, model_version, at)], CHAMPIONS).coalesce(1).write.mode("append").parquet(path)


def champion(spark: SparkSession, path: str, model_name: str) -> str | None:
    """The version that serves now; the history is read anew, so promotions show at the next trigger."""
    if not exists(spark, path):
        return None
    # The schema comes from this module, so one row and one column are all that is read.
    latest = F.max(F.struct("promoted_at", "model_version"))
    row = spark.read.schema(CHAMPIONS).parquet(path).where(F.col("model_name") == model_name).agg(latest.alias("x")).first()
    return row["x"]["model_version"] if row["x"] is not None else None


def score_stream(requests: DataFrame, model_name: str, champions: str, load: Callable[[str], TrainedModel],
                 columns: Sequence[str], log: str, checkpoint: str, *, available_now: bool = False,
                 interval: str = "30 seconds") -> StreamingQuery:
    """Scores ``request_id, timestamp, raw_input`` and writes the log, each request once.

    Every trigger looks up the champion and scores all its rows by that version;
    ``load`` gives the fitted chain of a version and is asked once for each.  The
    rows of a trigger go to a partition of their own number, so a trigger that is
    tried again replaces what its first try had written.  A trigger without any
    champion fails, and its requests wait for the next.
    """
    loaded: dict[str, TrainedModel] = {}

    def serve(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version = champion(spark, champions, model_name)
        if version is None:
            raise LookupError(f"no champion of {model_name}")
        if version not in loaded:
            loaded.clear()  # a version that was replaced does not come back often
            loaded[version] = load(version)
        answers(batch, loaded[version], model_name, version, columns).withColumn("trigger", F.lit(number)).write.option(
            "partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("model_name", "dt", "trigger").parquet(log)

    writer = requests.writeStream.foreachBatch(serve).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def answers(requests: DataFrame, model: TrainedModel, model_name: str, version: str, columns: Sequence[str]) -> DataFrame:
    """Log rows of requests scored by one model, in a batch or a trigger."""
    raw = clean.decode_json(requests.select("request_id", "timestamp", "raw_input", F.col("raw_input").alias("_sent")),
                            "_sent", columns)
    scored = model.score(raw)
    probability = F.col("probability") if "probability" in scored.columns else F.lit(None).cast("double")
    out = scored.select(
        "request_id", "timestamp", "raw_input", F.col("prediction").cast("double").alias("prediction"),
        probability.alias("probability"), F.lit(version).alias("model_version"), F.lit(model_name).alias("model_name"),
        F.to_date("timestamp").alias("dt"))
    return out.select(*PREDICTIONS.names)
