"""Monitoring from counts stored for each hour of the log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from keelson.operators import daycounts
from keelson.plans import standins as S
from keelson.plans.drifting import CATEGORIES, CURRENT_SQL, DRIFT_SQL, NUMBERS, REFERENCE_SQL, SIDES
from keelson.plans.registry import query, table
from keelson.session import scratch_path

_START, _END = datetime(2024, 1, 9, 3, 17, 30), datetime(2024, 1, 20, 12, 40)


def _log(spark, folder):
    pick = [f"{e} AS {n}" for n, e in SIDES.items() if n in (*NUMBERS, *CATEGORIES)]
    return table(spark, folder, "events").selectExpr("event_id", "ts AS timestamp", "CAST(ts AS DATE) AS dt", *pick)


def _stored(spark, folder):
    """Counts of the whole log, a seventh of whose rows came when their days had been counted already."""
    log, path = _log(spark, folder), scratch_path(spark, "counts")
    daycounts.refresh(log.where("event_id % 7 <> 0"), path, NUMBERS, CATEGORIES)
    daycounts.refresh(log, path, NUMBERS, CATEGORIES)
    return log, path


def _sides(spark, folder):
    _, path = _stored(spark, folder)
    counts = daycounts.read(spark, path)
    return tuple(daycounts.merged(counts.where(f"dt {op} DATE '{S.CHANGE}'")) for op in ("<", ">="))


@query("D12 D1 D2 D3", DRIFT_SQL)
def drift_of_day_counts(spark, folder):
    """The drift table from stored counts alone."""
    return daycounts.drift_table(*_sides(spark, folder), NUMBERS, CATEGORIES).withColumn("value", F.round("value", 9))


def _quality_sql() -> str:
    parts = []
    for c in (*NUMBERS, *CATEGORIES):
        unseen = "NULL" if c in NUMBERS else (
            f"round(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM ({REFERENCE_SQL}) "
            f"WHERE {c} IS NOT NULL)) / count({c}), 9)")
        parts.append(f"SELECT '{c}' AS \"column\", round(1 - count({c}) / count(*), 9) AS missing_share, "
                     f"CAST({unseen} AS DOUBLE) AS unseen_share FROM ({CURRENT_SQL})")
    return " UNION ALL ".join(parts)


@query("D12 A15 J6", _quality_sql())
def quality_of_day_counts(spark, folder):
    """Missing and unseen shares of the current side from stored counts alone."""
    reference, current = _sides(spark, folder)
    known = daycounts.known_categories(reference, CATEGORIES)
    return daycounts.quality_numbers(current, NUMBERS, CATEGORIES, known).select(
        "column", F.round("missing_share", 9).alias("missing_share"), F.round("unseen_share", 9).alias("unseen_share"))


_WINDOW_SQL = f"SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}'"


@query("D12 P7", " UNION ALL ".join([
    *(f"SELECT '{c}' AS \"column\", CAST(NULL AS VARCHAR) AS value, CAST({SIDES[c]} AS DOUBLE) AS number, count(*) AS n "
      f"FROM ({_WINDOW_SQL}) GROUP BY 3" for c in NUMBERS),
    *(f"SELECT '{c}', {SIDES[c]}, NULL, count(*) FROM ({_WINDOW_SQL}) GROUP BY 2" for c in CATEGORIES),
    f"SELECT '', NULL, NULL, count(*) FROM ({_WINDOW_SQL})"]))
def window_of_day_counts(spark, folder):
    """Counts of a window that begins and ends inside an hour: stored hours and two cut ones."""
    log, path = _stored(spark, folder)
    return daycounts.window(log, path, _START, _END, NUMBERS, CATEGORIES)
