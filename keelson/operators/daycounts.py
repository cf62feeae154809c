"""Monitoring from stored counts of values.

Drift distances, missing shares and shares of unseen categories depend on a table only
through how often each value occurs in each column.  Such counts add up over rows, so they
are written once for each hour of the log, and a window of any length is the sum of its
hours.  The train side of a model version is counted once.  A monitoring run then reads
count tables, and of the raw log only the two hours that a window cuts.

A count table has the columns ``column, value, number, n``: the value as text and, for
numeric columns, as a double; both are null for a missing value.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import drift
from keelson.sources.tables import exists, path_exists

#: The rows of a day, beside its values; no column has an empty name.
ROWS = ""
COUNTS = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("number", T.DoubleType()), T.StructField("n", T.LongType()),
])
STORED = T.StructType([*COUNTS.fields, T.StructField("hour", T.IntegerType()), T.StructField("dt", T.DateType())])


def count_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 keys: Sequence[str] = ()) -> DataFrame:
    """The count table of a table, for each combination of ``keys``; one shuffle of partial counts."""
    if not numeric and not categorical:
        raise ValueError("no column to count")
    entries = [F.struct(F.lit(c).alias("column"), F.lit(None).cast("string").alias("value"),
                        F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("number")) for c in numeric]
    entries += [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                         F.lit(None).cast("double").alias("number")) for c in categorical]
    flat = df.select(*keys, F.inline(F.array(*entries)))
    return flat.groupBy(*keys, "column", "value", "number").agg(F.count(F.lit(1)).alias("n"))


def merged(*tables: DataFrame) -> DataFrame:
    """Counts of all rows of several count tables."""
    both = tables[0].select(*COUNTS.names)
    for one in tables[1:]:
        both = both.unionByName(one.select(*COUNTS.names))
    return both.groupBy("column", "value", "number").agg(F.sum("n").alias("n"))


def _aligned(reference: DataFrame, current: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """(column, value, n_ref, n_cur) of present values, as ``drift.aligned_counts`` has them."""
    def side(df: DataFrame, name: str, other: str) -> DataFrame:
        return df.where(F.col("column").isin(*columns) & F.col(value).isNotNull()).select(
            "column", F.col(value).alias("value"), F.col("n").alias(name), F.lit(0).cast("long").alias(other))
    both = side(reference, "n_ref", "n_cur").unionByName(side(current, "n_cur", "n_ref"))
    return both.groupBy("column", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def drift_table(reference: DataFrame, current: DataFrame, numeric: Sequence[str],
                categorical: Sequence[str]) -> DataFrame:
    """``drift.drift_table`` of two count tables."""
    return drift.drift_of_counts(
        reference.sparkSession,
        _aligned(reference, current, numeric, "number") if numeric else None,
        _aligned(reference, current, categorical, "value") if categorical else None, numeric, categorical)


def known_categories(reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    return reference.where(F.col("column").isin(*columns) & F.col("value").isNotNull()).select(
        "column", "value").distinct()


def quality_numbers(counts: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    known: DataFrame) -> DataFrame:
    """``drift.quality_numbers`` of a count table."""
    rows = counts.where(F.col("column").isin(*numeric, *categorical))
    looked_up = rows.join(known.withColumn("_known", F.lit(True)), ["column", "value"], "left")
    missing = F.col("value").isNull() & F.col("number").isNull()
    unseen = F.sum(F.when(~missing & F.col("_known").isNull(), F.col("n")).otherwise(0))
    return looked_up.groupBy("column").agg(
        (F.sum(F.when(missing, F.col("n")).otherwise(0)) / F.sum("n")).alias("missing_share"),
        F.when(F.col("column").isin(*categorical) if categorical else F.lit(False),
               unseen / F.nullif(F.sum(F.when(~missing, F.col("n")).otherwise(0)), F.lit(0))).alias("unseen_share"))


def refresh(log: DataFrame, path: str, numeric: Sequence[str], categorical: Sequence[str],
            at: str = "timestamp", day: str = "dt") -> list[date]:
    """Counts the days of an append-only log that are new or have grown, and returns them.

    Rows of a day are counted first, which reads no column of a Parquet log.  A day
    whose stored number of rows differs (rows came late) is counted again and
    replaces its own counts only; all other days are left alone.
    """
    spark = log.sparkSession
    rows = log.groupBy(F.col(day).alias("dt")).agg(F.count(F.lit(1)).alias("rows"))
    known = read(spark, path).where(F.col("column") == ROWS).groupBy("dt").agg(F.sum("n").alias("counted"))
    # One row for each day of the log.
    stale = sorted(r["dt"] for r in rows.join(known, "dt", "left").where(
        "counted is null or counted <> rows").select("dt").collect() if r["dt"] is not None)
    if not stale:
        return []
    fresh = log.where(F.col(day).isin(*stale)).withColumns({"hour": F.hour(at), "_day": F.col(day)})
    counts = count_values(fresh, numeric, categorical, ["_day", "hour"])
    totals = fresh.groupBy("_day", "hour").agg(F.count(F.lit(1)).alias("n")).select(
        "_day", "hour", F.lit(ROWS).alias("column"), F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("double").alias("number"), "n")
    out = counts.unionByName(totals).withColumn("hour", F.col("hour").cast("int")).withColumnRenamed("_day", "dt")
    # A day's counts lie in few files; adaptive execution splits a large day's and joins small ones.
    out.select(*COUNTS.names, "hour", "dt").hint("rebalance", "dt").write.option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("dt").parquet(path)
    return stale


def read(spark: SparkSession, path: str) -> DataFrame:
    # Replacing partitions leaves no mark of success beside them.
    if not path_exists(spark, path):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(path)


def window(log: DataFrame, path: str, start: datetime, end: datetime, numeric: Sequence[str],
           categorical: Sequence[str], at: str = "timestamp", day: str = "dt") -> DataFrame:
    """Counts of the log's rows with ``start <= at <= end``, and of ``ROWS``.

    Whole hours come from the stored counts; hours that the window cuts are read
    from the log, pruned to their days.  ``refresh`` must have run before.
    """
    spark = log.sparkSession
    first = start.replace(minute=0, second=0, microsecond=0)
    first = first if first == start else first + timedelta(hours=1)
    last = end.replace(minute=0, second=0, microsecond=0)  # the hour that holds the end is always cut
    moment = F.make_timestamp_ntz(F.year("dt"), F.month("dt"), F.dayofmonth("dt"), F.col("hour"), F.lit(0), F.lit(0))
    inside = F.lit(False) if first >= last else (moment >= _ntz(first)) & (moment < _ntz(last)) \
        & F.col("dt").between(first.date(), last.date())
    whole = read(spark, path).where(inside)
    cuts = [(start, end)] if first >= last else [(start, first), (last, end)]
    rows = log.where(F.lit(False))
    for k, (a, b) in enumerate(cuts):
        upto = F.col(at) <= F.lit(b) if b == end and k == len(cuts) - 1 else F.col(at) < F.lit(b)
        if a < b or a == end:
            rows = rows.unionByName(log.where((F.col(at) >= F.lit(a)) & upto & F.col(day).between(a.date(), b.date())))
    edge = count_values(rows, numeric, categorical)
    total = rows.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(ROWS).alias("column"), F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("double").alias("number"), "n")
    return merged(whole, edge, total)


def _ntz(moment: datetime):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def stored_once(path: str, spark: SparkSession, build) -> DataFrame:
    """The count table at ``path``, built and written if it is not there yet."""
    if not exists(spark, path):
        build().select(*COUNTS.names).write.mode("overwrite").parquet(path)
    return spark.read.schema(COUNTS).parquet(path)
