"""Windowed request aggregates, and streams checked against their batch twins."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from keelson.plans import standins as S
from keelson.plans.drifting import STREAKS_SQL, part_levels
from keelson.plans.registry import query, table
from keelson.session import scratch_path
from keelson.streaming import jobs, windows

_STATUS = ("CASE WHEN event_type = 'error' THEN CASE WHEN user_id % 4 = 0 THEN 503 ELSE 500 END "
           "ELSE 200 END")


def _spread(size: int, slide: int) -> str:
    """Each event under every window that holds it (epoch seconds)."""
    return (f"SELECT e.*, to_timestamp(CAST(floor(epoch_us(ts) / 1000000 / {slide}) AS BIGINT) "
            f"* {slide} - k * {slide})::TIMESTAMP AS window_start FROM events e, "
            f"range({size // slide}) r(k)")


def _requests(spark, folder):
    return table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type", "value",
        F.expr(_STATUS).alias("status"))


@query("R3", f"""
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS n,
  round(sum(coalesce(value, 0)), 6) AS total FROM ({_spread(86400, 3600)}) GROUP BY 1""")
def sliding_activity(spark, folder):
    return windows.window_activity(_requests(spark, folder)).withColumn(
        "total", F.round("total", 6))


@query("R5", f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, {_STATUS} AS status,
  count(*) AS requests, count(*) / 300 AS per_second FROM ({_spread(300, 60)}) GROUP BY 1, 2, 3""")
def request_rates(spark, folder):
    return windows.request_rates(_requests(spark, folder))


_RATIO_SQL = f"""
SELECT window_start, count(*) AS requests, CAST(count(*) FILTER (WHERE s = 500) AS BIGINT) AS errors,
  count(*) FILTER (WHERE s = 500) / count(*) AS error_ratio,
  count(*) FILTER (WHERE s = 500) / count(*) > 0.01 AS above
FROM (SELECT *, {_STATUS} AS s FROM ({_spread(300, 60)})) GROUP BY 1"""


def _ratios(spark, folder):
    return windows.error_ratio(_requests(spark, folder), size="5 minutes", slide="1 minute")


@query("R6", _RATIO_SQL)
def error_ratios(spark, folder):
    return _ratios(spark, folder).drop("window_end")


@query("R6", f"""
SELECT window_start, 5 AS steps_above FROM (SELECT window_start, above,
  count(*) FILTER (WHERE above) OVER (ORDER BY window_start RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING
    AND CURRENT ROW) AS steps FROM ({_RATIO_SQL})) WHERE above AND steps = 5""")
def held_error_alerts(spark, folder):
    held = windows.held_alerts(_ratios(spark, folder), "1 minute", "4 minutes")
    return held.withColumn("steps_above", F.col("steps_above").cast("int"))


_BOUNDS = list(windows.LATENCY_BUCKETS)


def _latency_sql() -> str:
    seconds = "value / 100"
    bucket = "CASE " + " ".join(f"WHEN {seconds} <= {b} THEN {i}" for i, b in enumerate(_BOUNDS)) \
        + f" ELSE {len(_BOUNDS)} END"
    edges = ", ".join(f"({i}, {_BOUNDS[i - 1] if i else 0.0}, {b})" for i, b in enumerate(_BOUNDS))
    shares = ", ".join(f"('p{p}', {p / 100})" for p in (50, 95, 99))
    return f"""
WITH c AS (SELECT date_trunc('day', ts) AS window_start, event_type, {bucket} AS b, count(*) AS n
  FROM events WHERE value IS NOT NULL GROUP BY 1, 2, 3),
edges(b, low, high) AS (VALUES {edges}), shares(name, share) AS (VALUES {shares}),
total AS (SELECT window_start, event_type, sum(n) AS n FROM c GROUP BY 1, 2),
grid AS (SELECT t.window_start, t.event_type, t.n AS total, e.*, coalesce(c.n, 0) AS n,
  sum(coalesce(c.n, 0)) OVER (PARTITION BY t.window_start, t.event_type ORDER BY e.b) AS upto
  FROM total t CROSS JOIN edges e LEFT JOIN c ON c.window_start = t.window_start
  AND c.event_type = t.event_type AND c.b = e.b),
hit AS (SELECT window_start, event_type, total, name, share, min(b) FILTER (WHERE upto >= total * share)
  AS b FROM grid, shares GROUP BY 1, 2, 3, 4, 5),
q AS (SELECT h.window_start, h.event_type, h.total, h.name, CASE WHEN h.b IS NULL THEN {_BOUNDS[-1]}
  WHEN g.n = 0 THEN g.low ELSE g.low + (g.high - g.low) * (h.total * h.share - (g.upto - g.n)) / g.n
  END AS v FROM hit h LEFT JOIN grid g ON g.window_start = h.window_start
  AND g.event_type = h.event_type AND g.b = h.b)
SELECT CAST(window_start AS TIMESTAMP) AS window_start, event_type, CAST(total AS BIGINT) AS n,
  round(max(v) FILTER (WHERE name = 'p50'), 9) AS p50, round(max(v) FILTER (WHERE name = 'p95'), 9)
  AS p95, round(max(v) FILTER (WHERE name = 'p99'), 9) AS p99 FROM q GROUP BY 1, 2, 3"""


@query("R7", _latency_sql())
def latency_quantiles(spark, folder):
    timed = _requests(spark, folder).withColumn("seconds", F.col("value") / 100)
    counts = windows.latency_counts(timed, "ts", "seconds", "event_type", "1 day")
    found = windows.latency_quantiles(counts, "event_type")
    return found.select("window_start", "event_type", "n",
                        *[F.round(c, 9).alias(c) for c in ("p50", "p95", "p99")])


@query("R8", """
SELECT to_timestamp(CAST(floor(epoch_us(ts) / 1000000 / 300) AS BIGINT) * 300)::TIMESTAMP
  AS window_start, max_by(counter, (ts, counter)) - min_by(counter, (ts, counter)) AS increase
FROM (SELECT ts, event_id % 50 AS counter FROM events) GROUP BY 1
HAVING max_by(counter, (ts, counter)) > min_by(counter, (ts, counter))""")
def counter_increases(spark, folder):
    """A counter that starts again from zero after fifty requests."""
    counted = _requests(spark, folder).withColumn("counter", F.col("event_id") % 50)
    return windows.counter_increase(counted, "ts", "counter")


@contextmanager
def _setting(spark, key, value):
    """Holds a setting for as long as a stream is started, and puts the old one back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def _stream_partitions(spark):
    """State is cut into as many pieces as there are cores while a stream is started.

    The number is fixed in a stream's checkpoint and adaptive execution does not
    change it, so the batch default would leave most pieces empty.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


SLICES, FILES_PER_SLICE = 8, 2


def _as_stream(spark, df, label, at=None, path=None):
    """Stores a table and reads it back as a stream of its files, some at a time.

    With ``at``, slices of equal length in time are stored one after the other, as a log
    grows, each in ``FILES_PER_SLICE`` files, and a trigger reads one slice.
    """
    path = path or scratch_path(spark, label)
    if at is None:
        df.repartition(SLICES * FILES_PER_SLICE).write.parquet(path)
    else:
        start, width = _slices(df, at)
        number = F.least(F.floor((F.col(at).cast("timestamp").cast("double") - start) / width), F.lit(SLICES - 1))
        for k in range(SLICES):
            df.where(number == k).repartition(FILES_PER_SLICE).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES_PER_SLICE).parquet(path)


def _slices(df, at):
    ends = df.agg(F.min(F.col(at).cast("timestamp").cast("double")), F.max(F.col(at).cast("timestamp").cast("double"))).first()
    return ends[0] or 0.0, max(((ends[1] or 0.0) - (ends[0] or 0.0)) / SLICES, 1.0)


def _delay(df, at):
    """Twice the time a trigger spans: files of neighbouring slices may share a trigger."""
    return f"{int(2 * _slices(df, at)[1]) + 60} seconds"


def _log(spark, folder):
    return S.predictions(spark, folder).drop("dt").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))


@query("R1 S8", f"SELECT model_name, dt, count(*) AS n, count(DISTINCT request_id) AS requests "
                f"FROM ({S.PREDICTIONS_SQL}) GROUP BY 1, 2")
def streamed_log(spark, folder):
    """The log as written by the stream, read back as a table."""
    stream = _as_stream(spark, _log(spark, folder), "log-in")
    path = scratch_path(spark, "log")
    jobs.log_sink(stream, path, scratch_path(spark, "log-state"), available_now=True) \
        .awaitTermination()
    return spark.read.parquet(path).groupBy("model_name", "dt").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("request_id").alias("requests"))


@query("R2", f"SELECT model_name, count(*) AS n FROM ({S.PREDICTIONS_SQL}) GROUP BY 1")
def streamed_without_repeats(spark, folder):
    """A log in which every fourth request was written twice."""
    log = _log(spark, folder)
    again = log.where(F.pmod(F.xxhash64("request_id"), F.lit(4)) == 0)
    stream = _as_stream(spark, log.unionByName(again), "repeats-in", "timestamp")
    path = scratch_path(spark, "once")
    once = jobs.drop_repeats(stream, _delay(log, "timestamp"))
    with _stream_partitions(spark):
        jobs.log_sink(once, path, scratch_path(spark, "once-state"), available_now=True) \
            .awaitTermination()
    return spark.read.parquet(path).groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))


_REPORTED = "ts + CAST(event_id % 48 AS INT) * INTERVAL '1' HOUR"


@query("R4 S9", f"""
SELECT p.request_id, p.prediction, o.actual FROM ({S.PREDICTIONS_SQL}) p JOIN
  (SELECT request_id, max(actual) AS actual FROM ({S.OUTCOMES_SQL}) GROUP BY 1) o
  ON p.request_id = o.request_id""")
def streamed_late_outcomes(spark, folder):
    """Outcomes up to two days late, joined by two streams."""
    predictions = _log(spark, folder)
    late = table(spark, folder, "events").where("event_id % 3 <> 0").select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id"),
        F.expr(_REPORTED).cast("timestamp").alias("reported_at"),
        F.expr(S.OUTCOME_RULES["actual"]).alias("actual"))
    joined = jobs.join_late_outcomes(
        _as_stream(spark, predictions, "p-in", "timestamp"), _as_stream(spark, late, "o-in", "reported_at"),
        latest="3 days", delay=_delay(late, "reported_at"))
    path = scratch_path(spark, "late")
    with _stream_partitions(spark):
        jobs.log_sink(joined, path, scratch_path(spark, "late-state"), available_now=True) \
            .awaitTermination()
    return spark.read.parquet(path).select("request_id", "prediction", "actual")


@query("R3", f"""
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS n,
  round(sum(coalesce(value, 0)), 6) AS total FROM ({_spread(86400, 21600)})
GROUP BY 1""")
def streamed_activity(spark, folder):
    """The sliding window as a stream, closed by one last row far behind the others."""
    requests = _requests(spark, folder)
    delay = _delay(requests, "ts")
    end = requests.agg(F.max("ts").alias("ts")).first()["ts"]
    last = requests.where(F.col("ts") == F.lit(end)).limit(1).withColumn(
        "ts", F.col("ts") + F.expr("INTERVAL 3650 DAYS"))
    path_in = scratch_path(spark, "activity-in")
    stream = _as_stream(spark, requests, "activity-in", "ts", path_in)
    last.write.mode("append").parquet(path_in)
    activity = windows.window_activity(stream.withWatermark("ts", delay), slide="6 hours")
    path = scratch_path(spark, "activity")
    writer = activity.writeStream.format("parquet").outputMode("append").option("path", path) \
        .option("checkpointLocation", scratch_path(spark, "activity-state"))
    with _stream_partitions(spark):
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).where(F.col("window_start") <= F.lit(end)).withColumn(
        "total", F.round("total", 6))


@query("R10 T10", STREAKS_SQL)
def streamed_streaks(spark, folder):
    """Warning streaks kept in streaming state, run by run."""
    levels = part_levels(spark, folder).withColumn("run_at", F.col("dt").cast("timestamp"))
    stream = _as_stream(spark, levels, "levels-in", "run_at")
    path = scratch_path(spark, "streaks")

    def keep(batch, number):
        # A batch that is tried again replaces what its first try wrote.
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    store = ("spark.sql.streaming.stateStore.providerClass",
             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    with _stream_partitions(spark), _setting(spark, *store):
        jobs.live_streaks(stream).writeStream.outputMode("update").foreachBatch(keep).option(
            "checkpointLocation", scratch_path(spark, "streaks-state")
        ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).select(
        "model_name", "part", F.to_date("run_at").alias("dt"), "level", "streak")
