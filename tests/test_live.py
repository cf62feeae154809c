"""Streams with a champion, outcomes of any age, and held alerts, over restarts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from keelson.operators import encode, feedback, gram, train
from keelson.sources import logs
from keelson.streaming import jobs, serving

START = datetime(2024, 3, 1, 12)


class Number(encode._JsonStage):
    def _transform(self, df):
        return df.withColumn("x", F.col("bedrooms").cast("double"))


def model(weight):
    chain = [Number(), VectorAssembler(inputCols=["x"], outputCol="features"), train.LinearScore.of(gram.Line(1.0, [weight]))]
    return train.TrainedModel("regression", PipelineModel(chain))


def requests(spark, ids):
    rows = [(f"r{k}", START + timedelta(hours=5 * k), f'{{"bedrooms": {k}}}') for k in ids]
    return spark.createDataFrame(rows, "request_id string, timestamp timestamp, raw_input string")


def test_champion_changes_between_triggers(spark, tmp_path):
    incoming, champions, log, state = (str(tmp_path / n) for n in ("in", "champions", "log", "state"))
    weights, asked = {"1": 2.0, "2": 10.0}, []

    def load(version):
        asked.append(version)
        return model(weights[version])

    def run():
        stream = spark.readStream.schema(requests(spark, [0]).schema).option("maxFilesPerTrigger", 1).parquet(incoming)
        serving.score_stream(stream, "m", champions, load, ["bedrooms"], log, state, available_now=True).awaitTermination()

    requests(spark, range(6)).repartition(2).write.parquet(incoming)
    with pytest.raises(Exception, match="no champion"):
        run()
    serving.promote(spark, champions, "m", "1", START)
    serving.promote(spark, champions, "other", "9", START + timedelta(days=9))
    run()
    serving.promote(spark, champions, "m", "2", START + timedelta(days=1))
    requests(spark, range(6, 10)).coalesce(1).write.mode("append").parquet(incoming)
    run()
    run()
    rows = logs._read(spark, log, logs.PREDICTIONS).orderBy("timestamp").collect()
    assert [(r["request_id"], r["prediction"], r["model_version"]) for r in rows] == [
        (f"r{k}", 1 + k * (2.0 if k < 6 else 10.0), "1" if k < 6 else "2") for k in range(10)]
    assert asked == ["1", "2"]
    batch = serving.answers(requests(spark, range(6)), model(2.0), "m", "1", ["bedrooms"])
    assert sorted(r["prediction"] for r in batch.collect()) == [1 + 2.0 * k for k in range(6)]
    assert [r["dt"] for r in rows] == [r["timestamp"].date() for r in rows]


def test_a_trigger_tried_again_replaces_its_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    for weight in (2.0, 10.0):  # the first try is lost after it had written
        serving.answers(requests(spark, range(6)), model(weight), "m", "1", ["bedrooms"]).withColumn(
            "trigger", F.lit(0)).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(
            "model_name", "dt", "trigger").parquet(log)
    assert sorted(r["prediction"] for r in spark.read.parquet(log).collect()) == [1 + 10.0 * k for k in range(6)]


def plain(df):
    return sorted((r["request_id"], r["prediction"], r["actual"]) for r in df.collect())


def test_reconciled_is_what_the_stored_logs_give(spark):
    predictions = spark.createDataFrame(
        [(f"r{k}", float(k), START) for k in range(12)] + [("r5", 5.5, START), (None, 0.0, START)],
        "request_id string, prediction double, timestamp timestamp")
    outcomes = spark.createDataFrame(
        [(f"r{k}", 10.0 * k) for k in range(9)] + [("r3", 31.0), ("r4", 41.0), ("r5", 51.0), ("stranger", 1.0), (None, 2.0)],
        "request_id string, actual double")
    whole = feedback.join_outcomes(predictions, outcomes)
    for kept in (0, 1, 2, 3, 5):
        # Of each request the stream has some rows; the rest came too late for it.
        matched = whole.where(F.pmod(F.hash("request_id", "actual"), F.lit(5)) < kept).withColumn("reported_at", F.current_timestamp())
        unmatched = predictions.join(matched, "request_id", "left_anti").withColumns(
            {"actual": F.lit(None).cast("double"), "reported_at": F.lit(None).cast("timestamp")})
        got = feedback.reconcile_outcomes(predictions, outcomes, matched.unionByName(unmatched))
        assert plain(got) == plain(whole)
    empty = matched.limit(0)
    assert plain(feedback.reconcile_outcomes(predictions, outcomes, empty)) == plain(whole)
    assert feedback.reconcile_outcomes(predictions, outcomes.limit(0), empty).count() == 0


def alerts_by_hand(rows, held):
    """Firing and cleared events of (name, minute, above) rows, taken in order."""
    out, merged = [], {}
    for name, at, above in rows:
        merged[name, at] = merged.get((name, at), False) or above
    since, firing = {}, set()
    for (name, at), above in sorted(merged.items()):
        begun = since.get(name)
        if begun is not None and name not in firing and (begun + held <= at if above else begun + held < at):
            firing.add(name)
            out.append((name, begun, begun + held, "firing"))
        if above:
            since.setdefault(name, at)
        elif begun is not None:
            if name in firing:
                out.append((name, begun, at, "cleared"))
                firing.discard(name)
            del since[name]
    out += [(n, b, b + held, "firing") for n, b in since.items() if n not in firing]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_alerts_fire_clear_and_survive_a_restart(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for name in ("a", "b", "c"):
        above = False
        for minute in range(120):
            above = above if rng.random() < 0.8 else not above
            if rng.random() < 0.9:
                rows.append((name, minute, above))
    rows += [("b", 60, True), ("b", 60, False)]
    slices = [[r for r in rows if lo <= r[1] < lo + 30] for lo in range(0, 120, 30)]
    for one in slices:
        rng.shuffle(one)
    incoming, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    schema = "name string, at timestamp, above boolean"

    def write(some):
        spark.createDataFrame([(n, START + timedelta(minutes=m), a) for n, m, a in some], schema).coalesce(1).write.mode(
            "append").parquet(incoming)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(incoming)
        jobs.live_alerts(stream, 5 * 60_000, "35 minutes").writeStream.outputMode("append").foreachBatch(
            lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")).option(
            "checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()

    for one in slices[:2]:
        write(one)
    run()
    early = spark.read.schema(jobs.ALERT_ROWS).parquet(out).count()
    for one in slices[2:]:
        write(one)
    write([("", 10_000, False)])
    run()
    minute = lambda t: (t - START) // timedelta(minutes=1)
    got = sorted((r["name"], minute(r["since"]), minute(r["at"]), r["state"])
                 for r in spark.read.schema(jobs.ALERT_ROWS).parquet(out).where("name <> ''").collect())
    assert got == alerts_by_hand(rows, 5)
    assert 0 < early < len(got)
