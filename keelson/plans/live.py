"""Streams with a model, with outcomes of any age, and with alerts that are held."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from keelson.operators import feedback, gram, train
from keelson.operators.encode import FillAndScale
from keelson.plans import standins as S
from keelson.plans.rates import _as_stream, _delay, _log, _RATIO_SQL, _ratios, _setting, _stream_partitions
from keelson.plans.registry import query, table
from keelson.session import scratch_path
from keelson.sources import logs
from keelson.streaming import jobs, serving

ROCKS = ("spark.sql.streaming.stateStore.providerClass",
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

_LINES = {"1": (50.0, 3.0), "2": (-20.0, 8.0)}


def _version(name: str) -> train.TrainedModel:
    """A line of the number of bedrooms; a missing number counts as 2."""
    intercept, weight = _LINES[name]
    fill = FillAndScale('{"medians": {"rooms": 2.0}, "means": {"rooms": 0.0}, "deviations": {"rooms": 1.0}, '
                        '"modes": {}, "kept": {}, "has_rare": {}}')
    chain = PipelineModel([_Rooms(), fill, VectorAssembler(inputCols=["n_rooms"], outputCol="features"),
                           train.LinearScore.of(gram.Line(intercept, [weight]))])
    return train.TrainedModel("regression", chain)


class _Rooms(train.encode._JsonStage):
    def _transform(self, df):
        return df.withColumn("rooms", F.col("bedrooms").cast("double"))


@query("M9 R1 S8", f"""
SELECT request_id, dt, CASE WHEN ts < TIMESTAMP '{S.CHANGE} 00:00:00' THEN '1' ELSE '2' END AS model_version,
  CASE WHEN ts < TIMESTAMP '{S.CHANGE} 00:00:00' THEN 50.0E0 + 3.0E0 * rooms ELSE -20.0E0 + 8.0E0 * rooms END AS prediction
FROM (SELECT request_id, dt, "timestamp" AS ts,
  coalesce(CAST(json_extract_string(raw_input, '$.bedrooms') AS DOUBLE), 2) AS rooms FROM ({S.PREDICTIONS_SQL})
  WHERE model_name = '{S.REGRESSOR}')""")
def streamed_scores(spark, folder):
    """Requests scored as they come, by the version that is champion then, read back from the log."""
    requests = _log(spark, folder).where(F.col("model_name") == S.REGRESSOR).select("request_id", "timestamp", "raw_input")
    incoming, champions, log, state = (scratch_path(spark, n) for n in ("requests", "champions", "scored", "scored-state"))
    change = F.lit(f"{S.CHANGE} 00:00:00").cast("timestamp")
    for version, some in (("1", F.col("timestamp") < change), ("2", F.col("timestamp") >= change)):
        requests.where(some).repartition(4).write.mode("append").parquet(incoming)
        serving.promote(spark, champions, S.REGRESSOR, version, datetime(2024, 1, int(version)))
        stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 2).parquet(incoming)
        serving.score_stream(stream, S.REGRESSOR, champions, _version, ["bedrooms"], log, state,
                             available_now=True).awaitTermination()
    return logs._read(spark, log, logs.PREDICTIONS).select("request_id", "dt", "model_version", "prediction")


_DELAYED = "ts + CAST(event_id % 96 AS INT) * INTERVAL '1' HOUR"


def _reported(spark, folder):
    """Outcomes up to four days late, some of them reported twice, the second time a day later."""
    events = table(spark, folder, "events").where("event_id % 3 <> 0").select(
        "event_id", F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id"),
        F.expr(_DELAYED).cast("timestamp").alias("reported_at"), F.expr(S.OUTCOME_RULES["actual"]).alias("actual"))
    again = events.where("event_id % 15 = 1").withColumn("reported_at", F.expr("reported_at + INTERVAL 1 DAY"))
    return events.unionByName(again).drop("event_id")


@query("R4 S9 J1", f"""
SELECT p.request_id, p.prediction, o.actual FROM ({S.PREDICTIONS_SQL}) p
JOIN ({S.OUTCOMES_SQL}) o ON p.request_id = o.request_id""")
def reconciled_outcomes(spark, folder):
    """Two days' outcomes joined as streams, later ones by a batch over what lacks them."""
    predictions, outcomes = _log(spark, folder), _reported(spark, folder)
    joined = jobs.join_late_outcomes(
        _as_stream(spark, predictions, "p-in", "timestamp"), _as_stream(spark, outcomes, "o-in", "reported_at"),
        latest="2 days", delay=_delay(outcomes, "reported_at"), keep_unmatched=True)
    path = scratch_path(spark, "joined")
    with _stream_partitions(spark):
        jobs.log_sink(joined, path, scratch_path(spark, "joined-state"), available_now=True).awaitTermination()
    streamed = spark.read.parquet(path).drop("dt")
    return feedback.reconcile_outcomes(predictions, outcomes, streamed).select("request_id", "prediction", "actual")


HELD = 4 * 60 * 1000


@query("R6 R9", f"""
WITH r AS (SELECT *, lag(above) OVER (ORDER BY window_start) AS before FROM ({_RATIO_SQL})),
runs AS (SELECT *, sum(CASE WHEN above AND NOT coalesce(before, FALSE) THEN 1 ELSE 0 END) OVER (ORDER BY window_start) AS run,
  lead(window_start) OVER (ORDER BY window_start) AS next_at FROM r),
held AS (SELECT run, min(window_start) FILTER (WHERE above) AS since, min(window_start) FILTER (WHERE NOT above) AS fell
  FROM runs WHERE run > 0 GROUP BY 1)
SELECT since, since + INTERVAL 4 MINUTE AS "at", 'firing' AS state FROM held
WHERE coalesce(fell, TIMESTAMP '2100-01-01') > since + INTERVAL 4 MINUTE
UNION ALL SELECT since, fell, 'cleared' FROM held WHERE fell > since + INTERVAL 4 MINUTE""")
def streamed_alerts(spark, folder):
    """Alerts on the error ratio, held four minutes, kept by timers of a stream."""
    ratios = _ratios(spark, folder).select(F.lit("errors").alias("name"), F.col("window_start").alias("at"), "above")
    last = ratios.agg(F.max("at").alias("at")).first()["at"]
    closing = spark.createDataFrame([("errors", last, True)], ratios.schema).where(F.lit(last is not None)).select(
        F.lit("").alias("name"), (F.col("at") + F.expr("INTERVAL 3650 DAYS")).alias("at"), F.lit(False).alias("above"))
    path_in, path = scratch_path(spark, "ratios-in"), scratch_path(spark, "alerts")
    stream = _as_stream(spark, ratios, "ratios-in", "at", path_in)
    # A row of another name moves the watermark, so that what is held to the end fires.
    closing.write.mode("append").parquet(path_in)

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    with _stream_partitions(spark), _setting(spark, *ROCKS):
        jobs.live_alerts(stream, HELD, _delay(ratios, "at")).writeStream.outputMode("append").foreachBatch(keep).option(
            "checkpointLocation", scratch_path(spark, "alerts-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(jobs.ALERT_ROWS).parquet(path).where("name = 'errors'").select("since", "at", "state")
