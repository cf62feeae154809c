"""Log writing, late outcomes and live warning streaks as streams."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

FLUSH_INTERVAL = "30 seconds"


def _start(writer, available_now: bool, interval: str) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def log_sink(predictions: DataFrame, path: str, checkpoint: str, *, available_now: bool = False,
             interval: str = FLUSH_INTERVAL) -> StreamingQuery:
    """Appends served predictions to the day-partitioned log.

    One trigger writes at most one file per task, model and day.  The file
    sink's own record of finished batches makes a retried batch appear once.
    """
    return _sink(predictions, F.to_date("timestamp"), path, checkpoint, available_now, interval)


def _sink(rows: DataFrame, day: Column, path: str, checkpoint: str, available_now: bool,
          interval: str) -> StreamingQuery:
    writer = (
        rows.withColumn("dt", day).writeStream
        .format("parquet").outputMode("append").partitionBy("model_name", "dt")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _start(writer, available_now, interval)


def outcome_sink(outcomes: DataFrame, path: str, checkpoint: str, *, available_now: bool = False,
                 interval: str = FLUSH_INTERVAL) -> StreamingQuery:
    """Appends outcomes under the day of the prediction they belong to."""
    return _sink(outcomes, F.col("predicted_on"), path, checkpoint, available_now, interval)


def drop_repeats(log: DataFrame, delay: str) -> DataFrame:
    """Drops requests written twice by an at-least-once writer.

    ``delay`` must cover how far rows of one trigger lie apart, and a repeat from
    its request.  Rows that come later still are left out, and counted by Spark as
    ``numRowsDroppedByWatermark`` of the query's progress.
    """
    return log.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["request_id"])


def join_late_outcomes(predictions: DataFrame, outcomes: DataFrame, latest: str, delay: str,
                       *, keep_unmatched: bool = False) -> DataFrame:
    """Predictions with the outcomes reported up to ``latest`` after them.

    The time bound lets Spark forget old predictions.  It leaves out outcomes that
    come later; with ``keep_unmatched`` a prediction that had none in time comes out
    too, once, with null ``actual`` and ``reported_at``, and
    ``feedback.reconcile_outcomes`` goes over what is missing.  ``outcomes`` needs
    ``reported_at``.
    """
    p = predictions.withWatermark("timestamp", delay).alias("p")
    o = outcomes.select("request_id", "actual", "reported_at").withWatermark(
        "reported_at", delay).alias("o")
    on = F.expr(
        "p.request_id = o.request_id AND o.reported_at >= p.timestamp "
        f"AND o.reported_at <= p.timestamp + INTERVAL {latest}")
    return p.join(o, on, "left" if keep_unmatched else "inner").select("p.*", "o.actual", "o.reported_at")


STREAK_ROWS = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("part", T.StringType()),
    T.StructField("run_at", T.TimestampType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("streak", T.LongType()),
])
_STREAK_STATE = T.StructType([
    T.StructField("model_version", T.StringType()),
    T.StructField("streak", T.LongType()),
])


class WarningStreak(StatefulProcessor):
    """Keeps, per model and part, the version and length of the current streak."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("streak", _STREAK_STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        version, streak = (
            (self._state.get()[0], self._state.get()[1]) if self._state.exists() else (None, 0)
        )
        for row in sorted(rows, key=lambda r: r["run_at"]):
            if row["model_version"] != version:
                streak = 0
            streak = streak + 1 if row["level"] == "warning" else 0
            version = row["model_version"]
            yield Row(model_name=row["model_name"], part=row["part"], run_at=row["run_at"],
                      model_version=version, level=row["level"], streak=streak)
        self._state.update((version, streak))

    def close(self) -> None:
        pass


def live_streaks(levels: DataFrame) -> DataFrame:
    """Warning streaks of a stream of (model_name, part, run_at, model_version, level).

    A trigger holds a few monitoring runs per key, never a key's history.
    Needs the RocksDB state store.
    """
    return levels.groupBy("model_name", "part").transformWithState(
        statefulProcessor=WarningStreak(), outputStructType=STREAK_ROWS,
        outputMode="Update", timeMode="None")


ALERT_ROWS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("since", T.TimestampType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("state", T.StringType()),
])
_WAITING = T.StructType([T.StructField("micros", T.LongType()), T.StructField("above", T.BooleanType())])
_ALERT = T.StructType([T.StructField("since", T.LongType()), T.StructField("firing", T.BooleanType())])


class HeldAlert(StatefulProcessor):
    """Fires for a name that stays above its line for ``held_ms``, and clears when it falls.

    Rows wait until the watermark has passed them and are then taken in order of event
    time, so the outcome does not depend on how rows are dealt to triggers.  A timer
    stands at the earliest row that waits, and one at the end of the held time, which
    fires without another row.  State goes when a name falls below its line.
    """

    def __init__(self, held_ms: int):
        self._held = held_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", _WAITING)
        self._alert = handle.getValueState("alert", _ALERT)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        fresh = [(_micros(row["at"]), bool(row["above"])) for row in rows]
        self._waiting.appendList(fresh)
        self._handle.registerTimer(_timer(min(fresh)[0]))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        # The watermark: no row up to it is still to come, so all that wait before it are taken at once.
        now = timerValues.getCurrentWatermarkInMs() * 1000
        due: dict[int, bool] = {}
        later = []
        for micros, above in self._waiting.get():
            if micros > now:
                later.append((micros, above))
            else:  # of rows of one moment, one above the line is enough
                due[micros] = due.get(micros, False) or above
        if due and later:
            self._waiting.put(later)
            self._handle.registerTimer(_timer(min(later)[0]))
        elif due:
            self._waiting.clear()
        out = []
        for micros in sorted(due):
            out += self._step(key[0], micros, due[micros])
        out += self._fire(key[0], now - 1)
        if self._alert.exists():
            since, firing = self._alert.get()
            if not firing:
                self._handle.registerTimer(_timer(since + self._held) + 1)
        yield from out

    def _step(self, name: str, micros: int, above: bool) -> list[Row]:
        # What was held long enough before this row fires first.
        out = self._fire(name, micros if above else micros - 1)
        if above and not self._alert.exists():
            self._alert.update((micros, False))
        elif not above and self._alert.exists():
            since, firing = self._alert.get()
            if firing:
                out.append(_alert_row(name, since, micros, "cleared"))
            self._alert.clear()
        return out

    def _fire(self, name: str, upto: int) -> list[Row]:
        if not self._alert.exists():
            return []
        since, firing = self._alert.get()
        if firing or since + self._held > upto:
            return []
        self._alert.update((since, True))
        return [_alert_row(name, since, since + self._held, "firing")]

    def close(self) -> None:
        pass


def _micros(moment: datetime) -> int:
    return round(moment.timestamp() * 1_000_000)


def _timer(micros: int) -> int:
    """The first millisecond at which a moment has passed."""
    return -(-micros // 1000)


def _alert_row(name: str, since: int, at: int, state: str) -> Row:
    return Row(name=name, since=datetime.fromtimestamp(since / 1_000_000), at=datetime.fromtimestamp(at / 1_000_000), state=state)


def live_alerts(ratios: DataFrame, held_ms: int, delay: str) -> DataFrame:
    """``name, since, at, state`` (firing or cleared) of a stream of ``name, at, above``.

    ``at`` may be out of order by ``delay``.  Needs the RocksDB state store.
    """
    return ratios.select("name", "at", "above").withWatermark("at", delay).groupBy("name").transformWithState(
        statefulProcessor=HeldAlert(held_ms), outputStructType=ALERT_ROWS, outputMode="Append", timeMode="EventTime")
