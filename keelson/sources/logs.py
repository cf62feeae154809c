"""The prediction log and the late outcomes, stored by model and day."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.sources.tables import path_exists

WINDOW_HOURS = 24.0

PREDICTIONS = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("raw_input", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("probability", T.DoubleType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("dt", T.DateType()),
])
OUTCOMES = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("predicted_on", T.DateType()),
    T.StructField("actual", T.DoubleType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("dt", T.DateType()),
])


def days_in_window(end: datetime, hours: float) -> list:
    first, last = (end - timedelta(hours=hours)).date(), end.date()
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def write_predictions(df: DataFrame, path: str) -> None:
    """Appends to the log; the partition day is the day of the record itself."""
    df.withColumn("dt", F.to_date("timestamp")).write.mode("append").partitionBy(
        "model_name", "dt").parquet(path)


def write_outcomes(df: DataFrame, path: str) -> None:
    """Appends outcomes under the day of the prediction they describe."""
    df.withColumn("dt", F.col("predicted_on")).write.mode("append").partitionBy(
        "model_name", "dt").parquet(path)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def in_window(log: DataFrame, end: datetime, hours: float, at: str = "timestamp",
              day: str | None = "dt") -> DataFrame:
    """Rows with ``end - hours <= at <= end``.

    The day predicate beside it prunes partitions, which the timestamp
    predicate alone cannot.
    """
    start = end - timedelta(hours=hours)
    rows = log.where(F.col(at).between(F.lit(start), F.lit(end)))
    return rows if day is None else rows.where(F.col(day).between(start.date(), end.date()))


def read_predictions(spark: SparkSession, path: str, model: str, end: datetime,
                     hours: float = WINDOW_HOURS) -> DataFrame:
    log = _read(spark, path, PREDICTIONS).where(F.col("model_name") == model)
    return in_window(log, end, hours)


def read_outcomes(spark: SparkSession, path: str, model: str, end: datetime,
                  hours: float = WINDOW_HOURS) -> DataFrame:
    """Outcomes by day only: the join with windowed predictions bounds them."""
    days = days_in_window(end, hours)
    return _read(spark, path, OUTCOMES).where(
        (F.col("model_name") == model) & F.col("dt").between(days[0], days[-1]))
