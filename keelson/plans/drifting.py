"""Drift tables, quality grades, severities, streaks and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import clean, drift, history, monitor
from keelson.plans import standins as S
from keelson.plans.registry import query, table
from keelson.plans.scoring import RUN_STATUS_SQL, task_states
from keelson.plans.served import MATCHED_SQL, matched

# Reference and current side: events before and from the day of the change.
SIDES = {
    "value": "value", "hour": "CAST(hour(ts) AS DOUBLE)", "few": "CAST(user_id % 4 AS DOUBLE)",
    "event_type": "event_type",
    "town": "CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND user_id % 3 > 0 THEN 'phoenix' "
            "WHEN user_id % 2 = 0 THEN 'boston' ELSE 'miami' END",
}
# A number that stops arriving at the change, a category that starts with it, and one never sent.
SIDES |= {
    "gone": "CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN value END",
    "new_code": "CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN event_type END",
    "never": "CAST(NULL AS STRING)",
}
_SELECT = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in SIDES.items()) + " FROM events WHERE ts "
_SELECT = _SELECT.replace("AS STRING", "AS VARCHAR")
REFERENCE_SQL = _SELECT + "< TIMESTAMP '2024-01-16 00:00:00'"
CURRENT_SQL = _SELECT + ">= TIMESTAMP '2024-01-16 00:00:00'"
NUMBERS, CATEGORIES = ["value", "hour", "few"], ["event_type", "town"]


def sides(spark, folder):
    events = table(spark, folder, "events")
    cut = F.lit(f"{S.CHANGE} 00:00:00").cast("timestamp_ntz")
    pick = [f"{e} AS {n}" for n, e in SIDES.items()]
    return (events.where(F.col("ts") < cut).selectExpr(*pick),
            events.where(F.col("ts") >= cut).selectExpr(*pick))


def _stacked(columns, text: bool) -> str:
    cast = (lambda c: f"CAST({c} AS VARCHAR)") if text else (lambda c: f"CAST({c} AS DOUBLE)")
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {cast(c)} AS value, {side} AS side FROM ({source}) "
        f"WHERE {c} IS NOT NULL" for c in columns
        for side, source in ((0, REFERENCE_SQL), (1, CURRENT_SQL)))


def _aligned(columns, text: bool) -> str:
    return (f"SELECT \"column\", value, count(*) FILTER (WHERE side = 0) AS n_ref, "
            f"count(*) FILTER (WHERE side = 1) AS n_cur FROM ({_stacked(columns, text)}) GROUP BY 1, 2")


def js_sql(columns, text: bool = True) -> str:
    return f"""
SELECT "column", CASE WHEN min(tr) > 0 AND min(tc) > 0 THEN
  sqrt(sum(CASE WHEN p > 0 THEN 0.5E0 * p * ln(p / ((p + q) / 2)) ELSE 0 END
  + CASE WHEN q > 0 THEN 0.5E0 * q * ln(q / ((p + q) / 2)) ELSE 0 END)) END AS value
FROM (SELECT *, n_ref / nullif(tr, 0) AS p, n_cur / nullif(tc, 0) AS q FROM (
  SELECT *, sum(n_ref) OVER (PARTITION BY "column") AS tr, sum(n_cur) OVER (PARTITION BY "column") AS tc
  FROM ({_aligned(columns, text)}))) GROUP BY 1"""


def wasserstein_sql(columns) -> str:
    return f"""
SELECT w."column", w.area / greatest(s.std, 0.001) AS value FROM (
  SELECT "column", sum(abs(cr / tr - cc / tc) * (nxt - value)) AS area FROM (
    SELECT "column", value, lead(value) OVER o AS nxt, sum(n_ref) OVER o AS cr,
      sum(n_cur) OVER o AS cc, sum(n_ref) OVER (PARTITION BY "column") AS tr,
      sum(n_cur) OVER (PARTITION BY "column") AS tc
    FROM ({_aligned(columns, False)}) WINDOW o AS (PARTITION BY "column" ORDER BY value))
  WHERE nxt IS NOT NULL GROUP BY 1) w
JOIN (SELECT "column", stddev_pop(value) AS std FROM ({_stacked(columns, False)}) WHERE side = 0
  GROUP BY 1) s USING ("column")"""


DRIFT_SQL = f"""
SELECT "column", method, 0.1E0 AS threshold, round(value, 9) AS value, value >= 0.1 AS drifted
FROM (SELECT "column", 'jensen-shannon' AS method, value FROM ({js_sql(CATEGORIES)})
  UNION ALL SELECT "column", 'jensen-shannon', value FROM ({js_sql(["few"], False)})
  UNION ALL SELECT "column", 'wasserstein', value FROM ({wasserstein_sql(["value", "hour"])}))"""
# The lost columns are compared by the method their values call for; none of them was measured.
LOST_SQL = f"""{DRIFT_SQL}
UNION ALL SELECT "column", c.method, 0.1E0, CASE WHEN n.ref > 0 AND n.cur > 0 THEN 0.0E0 END,
  CASE WHEN n.ref > 0 AND n.cur > 0 THEN FALSE END
FROM (VALUES ('gone', 'wasserstein'), ('new_code', 'jensen-shannon'), ('never', 'jensen-shannon'))
  AS c("column", method)
LEFT JOIN (SELECT "column", sum(n_ref) AS ref, sum(n_cur) AS cur
  FROM ({_aligned(["gone", "new_code", "never"], True)}) GROUP BY 1) n USING ("column")"""


def drift_rows(spark, folder):
    reference, current = sides(spark, folder)
    return drift.drift_table(reference, current, NUMBERS, CATEGORIES)


@query("J7", _aligned(CATEGORIES, True))
def aligned_frequencies(spark, folder):
    return drift.aligned_counts(*sides(spark, folder), CATEGORIES)


@query("D2 J7", f"SELECT \"column\", round(value, 9) AS value FROM ({js_sql(CATEGORIES)})")
def js_distances(spark, folder):
    out = drift.js_distance(drift.aligned_counts(*sides(spark, folder), CATEGORIES))
    return out.withColumn("value", F.round("value", 9))


@query("D3", f"SELECT \"column\", round(value, 9) AS value FROM ({wasserstein_sql(['value', 'hour'])})")
def wasserstein_distances(spark, folder):
    counts = drift.aligned_numbers(*sides(spark, folder), ["value", "hour"])
    return drift.wasserstein(counts).withColumn("value", F.round("value", 9))


@query("D1 D2 D3", DRIFT_SQL)
def feature_drift(spark, folder):
    return drift_rows(spark, folder).withColumn("value", F.round("value", 9))


@query("D1 D2 D3", LOST_SQL)
def drift_with_lost_columns(spark, folder):
    """Columns without values on one side, or on both, keep their rows, unmeasured."""
    found = drift.drift_table(*sides(spark, folder), [*NUMBERS, "gone"], [*CATEGORIES, "new_code", "never"])
    return found.withColumn("value", F.round("value", 9))


@query("D4", f"""
SELECT c."column", round(sum((n_ref - e) * (n_ref - e) / e + (n_ref - e) * (n_ref - e)
  / (n_ref + n_cur - e)), 6) AS statistic, count(*) - 1 AS degrees
FROM (SELECT *, (n_ref + n_cur) * tr / (tr + tc) AS e FROM (SELECT *,
  sum(n_ref) OVER (PARTITION BY "column") AS tr, sum(n_cur) OVER (PARTITION BY "column") AS tc
  FROM ({_aligned(CATEGORIES, True)}))) c GROUP BY 1""")
def chi_square_drift(spark, folder):
    """Statistic and degrees of freedom; the p-value is a function of these two."""
    found = drift.chi_square(*sides(spark, folder), CATEGORIES)
    return found.select("column", F.round("statistic", 6).alias("statistic"), "degrees")


def _severity_sql(source: str) -> str:
    return f"""
SELECT n_drifted, n_unmeasured, round(share, 9) AS drifted_share, round(margin, 6) AS margin_sum,
  CASE WHEN share > 0.5 THEN 'high' WHEN share >= 0.3 OR margin >= 0 THEN 'warning'
    WHEN n_unmeasured > 0 THEN 'insufficient_data' ELSE 'ok' END AS feature_level,
  CASE WHEN margin >= 0 THEN 'warning' ELSE 'ok' END AS margin_level
FROM (SELECT count(*) FILTER (WHERE drifted) AS n_drifted,
  count(*) FILTER (WHERE value IS NULL) AS n_unmeasured,
  count(*) FILTER (WHERE drifted) / count(*) AS share, sum(value - threshold) AS margin
  FROM ({source}))"""


def _severity(table):
    return drift.drift_totals(table).select(
        "n_drifted", "n_unmeasured", F.round("drifted_share", 9).alias("drifted_share"),
        F.round("margin_sum", 6).alias("margin_sum"),
        drift.feature_level(F.col("drifted_share"), F.col("margin_sum"), F.col("n_unmeasured"))
        .alias("feature_level"), drift.margin_level(F.col("margin_sum")).alias("margin_level"))


@query("A17 A18 D6 D7", _severity_sql(DRIFT_SQL))
def feature_severity(spark, folder):
    return _severity(drift_rows(spark, folder))


@query("A17 A18 D6 D7", _severity_sql(f"""SELECT * FROM ({LOST_SQL}) WHERE "column" IN ('value', 'hour',
  'gone')"""))
def feature_severity_with_lost_column(spark, folder):
    """Two columns that did not move and one that was lost: not ok."""
    return _severity(drift.drift_table(*sides(spark, folder), ["value", "hour", "gone"], []))


@query("D8", f"SELECT CASE WHEN bool_or(value >= 0.1) THEN 'high' ELSE 'ok' END AS level "
             f"FROM ({wasserstein_sql(['value'])})")
def prediction_severity(spark, folder):
    moved = drift.drift_table(*sides(spark, folder), ["value"], [])
    return moved.agg(drift.prediction_level(F.bool_or("drifted")).alias("level"))


_LIVE = f"""SELECT *, actual > 0.5 AS flag, probability AS score FROM ({MATCHED_SQL})
WHERE model_name = '{S.CLASSIFIER}'"""


@query("D13 A9 A10 A11 J1", f"""
SELECT 'regression' AS task, round(sqrt(avg((actual - prediction) * (actual - prediction))), 6)
  AS main_score, count(*) AS n, NULL AS recall FROM ({MATCHED_SQL})
WHERE model_name = '{S.REGRESSOR}'
UNION ALL SELECT 'classification', round((SELECT (sum(r * p) - sum(p) * (sum(p) + 1) / 2)
  / (sum(p) * CAST(count(*) - sum(p) AS DOUBLE)) FROM (SELECT CAST(flag AS INTEGER) AS p,
  rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0E0 AS r
  FROM ({_LIVE}))), 6), count(*), round(count(*) FILTER (WHERE flag AND score >= 0.3)
  / count(*) FILTER (WHERE flag), 6) FROM ({_LIVE})""")
def live_performance(spark, folder):
    def scored(model, task, main):
        joined = matched(spark, folder, model)
        n = joined.count()
        out = monitor.live_scores(joined, task, 0.3)
        recall = F.round("recall", 6) if task == "classification" else F.lit(None).cast("double")
        return out.select(F.lit(task).alias("task"), F.round(main, 6).alias("main_score"),
                          F.lit(n).cast("bigint").alias("n"), recall.alias("recall"))
    return scored(S.REGRESSOR, "regression", "rmse").unionByName(
        scored(S.CLASSIFIER, "classification", "auc"))


def _performance_sql() -> str:
    ratio = "rmse / (100 + CAST(o_custkey % 7 AS DOUBLE) * 20) / 1500"
    return f"""
SELECT o_custkey, CASE WHEN n < 50 THEN 'insufficient_data' WHEN {ratio} > 1.5 THEN 'high'
  WHEN {ratio} >= 1.2 THEN 'warning' ELSE 'ok' END AS rmse_level,
  CASE WHEN n < 50 THEN 'insufficient_data' WHEN 0.8E0 - auc >= 0.10 THEN 'high'
  WHEN 0.8E0 - auc >= 0.05 THEN 'warning' ELSE 'ok' END AS auc_level
FROM (SELECT o_custkey % 97 AS o_custkey, avg(o_totalprice) AS rmse, count(*) % 200 AS n,
  avg(o_totalprice) / 350000 AS auc FROM orders GROUP BY 1)"""


@query("D9", _performance_sql())
def performance_severity(spark, folder):
    groups = table(spark, folder, "orders").groupBy((F.col("o_custkey") % 97).alias("o_custkey")).agg(
        F.avg("o_totalprice").alias("rmse"), (F.count(F.lit(1)) % 200).alias("n"),
        (F.avg("o_totalprice") / 350000).alias("auc"))
    reference = (100 + (F.col("o_custkey") % 7).cast("double") * 20) * 1500
    return groups.select(
        "o_custkey",
        drift.performance_level("regression", F.col("rmse"), reference, F.col("n"))
        .alias("rmse_level"),
        drift.performance_level("classification", F.col("auc"), F.lit(0.8), F.col("n"))
        .alias("auc_level"))


_WORDS = ["city", "property_type"]
_KNOWN_SQL = " UNION ".join(
    f"SELECT '{c}' AS \"column\", {S.sql_words(c)} AS value FROM ({S.HOUSES_SQL}) "
    f"WHERE {S.sql_words(c)} IS NOT NULL" for c in _WORDS)


@query("A14", _KNOWN_SQL)
def known_categories(spark, folder):
    raw = S.raw_houses(spark, folder, _WORDS)
    return drift.known_categories(raw, _WORDS, monitor.clean_category(S.SPEC))


_SENT = ["city", "property_type", "bedrooms", "listing_date", "has_pool"]
_QUALITY_NUMERIC = ["bedrooms", "has_pool", "listing_year"]
_SERVED_SQL = ("SELECT " + ", ".join(f"json_extract_string(raw_input, '$.{c}') AS {c}" for c in _SENT)
               + f" FROM ({S.PREDICTIONS_SQL})")


def _quality_sql(source: str) -> str:
    clean_columns = {
        "city": S.sql_clean("city"), "property_type": S.sql_clean("property_type"),
        "bedrooms": S.sql_clean("bedrooms"), "has_pool": S.sql_clean("has_pool"),
        "listing_year": f"year({S.sql_day('listing_date')})",
    }
    parts = []
    for name, expr in clean_columns.items():
        unseen = "NULL"
        if name in _WORDS:
            unseen = (f"count(*) FILTER (WHERE v IS NOT NULL AND v NOT IN (SELECT value FROM "
                      f"({_KNOWN_SQL}) WHERE \"column\" = '{name}')) / count(v)")
        parts.append(f"SELECT '{name}' AS \"column\", 1 - count(v) / count(*) AS missing_share, "
                     f"{unseen} AS unseen_share FROM (SELECT {expr} AS v FROM ({source}))")
    return " UNION ALL ".join(parts)


def _quality(spark, folder):
    raw = S.raw_houses(spark, folder, _SENT)
    known = drift.known_categories(raw, _WORDS, monitor.clean_category(S.SPEC))
    served = clean.decode_json(
        S.predictions(spark, folder).select("raw_input"), "raw_input", _SENT)
    return tuple(
        drift.quality_numbers(clean.clean_table(side, S.SPEC, numeric_booleans=True),
                              _QUALITY_NUMERIC, _WORDS, known) for side in (raw, served))


@query("A15 J6", f"SELECT \"column\", round(missing_share, 9) AS missing_share, "
                 f"round(unseen_share, 9) AS unseen_share FROM ({_quality_sql(_SERVED_SQL)})")
def quality_numbers(spark, folder):
    return _quality(spark, folder)[1].select(
        "column", F.round("missing_share", 9).alias("missing_share"),
        F.round("unseen_share", 9).alias("unseen_share"))


_GRADED_SQL = f"""
SELECT "column", rise AS missing_increase_points, round(unseen_share, 9) AS unseen_share,
  CASE WHEN rise > 20 OR coalesce(unseen_share, 0) > 0.2 THEN 'high'
    WHEN rise >= 5 OR coalesce(unseen_share, 0) >= 0.05 THEN 'warning' ELSE 'ok' END AS level
FROM (SELECT c."column", round((c.missing_share - r.missing_share) * 100, 4) AS rise, c.unseen_share
  FROM ({_quality_sql(_SERVED_SQL)}) c JOIN ({_quality_sql(S.HOUSES_SQL)}) r USING ("column"))"""


@query("D10 F19 A19", _GRADED_SQL)
def input_quality(spark, folder):
    return drift.input_quality(*_quality(spark, folder)).withColumn(
        "unseen_share", F.round("unseen_share", 9))


@query("L6 D10", f"SELECT \"column\", level, row_number() OVER (ORDER BY level = 'high' DESC, "
                 f"\"column\") AS place FROM ({_GRADED_SQL}) WHERE level <> 'ok'")
def flagged_columns(spark, folder):
    from pyspark.sql import Window
    flagged = drift.flagged_columns(drift.input_quality(*_quality(spark, folder)))
    # One row per column at most.
    place = Window.orderBy(drift.severity_rank(F.col("level")).desc(), "column")
    return flagged.select("column", "level", F.row_number().over(place).cast("bigint").alias("place"))


# Monitoring history: a run per day and model, its parts graded from the day's events.
HISTORY_SQL = f"""
SELECT model_name, max(model_version) AS model_version, dt, model_name || '-' || CAST(dt AS VARCHAR)
  AS run_id,
  CASE WHEN avg(prediction) > 25000 THEN 'high' WHEN avg(prediction) >= 20000 THEN 'warning'
    ELSE 'ok' END AS feature,
  CASE WHEN count(*) % 3 = 0 THEN 'high' ELSE 'ok' END AS prediction,
  CASE WHEN count(*) % 5 < 3 THEN 'warning' ELSE 'insufficient_data' END AS performance,
  CASE WHEN max(prediction) > 130000 THEN 'warning' ELSE 'ok' END AS input_quality,
  avg(prediction) AS current_rmse, CASE WHEN count(*) % 4 > 0 THEN min(prediction) + 15000 END
    AS reference_rmse, avg(probability) AS current_auc, max(probability) AS reference_auc
FROM ({S.PREDICTIONS_SQL}) GROUP BY model_name, dt"""


def summaries(spark, folder):
    log = S.predictions(spark, folder)
    n, p = F.count(F.lit(1)), F.col("prediction")
    return log.groupBy("model_name", "dt").agg(
        F.max("model_version").alias("model_version"),
        drift.parse.level(F.avg(p), 20000, 25000).alias("feature"),
        F.when(n % 3 == 0, "high").otherwise("ok").alias("prediction"),
        F.when(n % 5 < 3, "warning").otherwise("insufficient_data").alias("performance"),
        F.when(F.max(p) > 130000, "warning").otherwise("ok").alias("input_quality"),
        F.avg(p).alias("current_rmse"),
        F.when(n % 4 > 0, F.min(p) + 15000).alias("reference_rmse"),
        F.avg("probability").alias("current_auc"), F.max("probability").alias("reference_auc"),
    ).withColumn("run_id", F.concat("model_name", F.lit("-"), F.col("dt").cast("string")))


PARTS_SQL = " UNION ALL ".join(
    f"SELECT model_name, model_version, dt, '{p}' AS part, {p} AS level FROM ({HISTORY_SQL})"
    for p in drift.PARTS)


def part_levels(spark, folder):
    return summaries(spark, folder).unpivot(
        ["model_name", "model_version", "dt"], list(drift.PARTS), "part", "level")


@query("A19", f"""
SELECT run_id, CASE WHEN 'high' IN (feature, prediction, performance, input_quality) THEN 'high'
  WHEN 'warning' IN (feature, prediction, performance, input_quality) THEN 'warning'
  WHEN 'ok' IN (feature, prediction, performance, input_quality) THEN 'ok'
  ELSE 'insufficient_data' END AS severity FROM ({HISTORY_SQL})""")
def overall_severity(spark, folder):
    return summaries(spark, folder).select(
        "run_id", drift.worst(*[F.col(p) for p in drift.PARTS]).alias("severity"))


# Counted back from each run to the last one that broke the streak.
STREAKS_SQL = f"""
SELECT model_name, part, dt, level, CAST(CASE WHEN level = 'warning' THEN nth - broke ELSE 0 END
  AS BIGINT) AS streak
FROM (SELECT *, coalesce(max(CASE WHEN level <> 'warning' THEN nth WHEN fresh THEN nth - 1 END)
  OVER (PARTITION BY model_name, part ORDER BY dt), 0) AS broke
  FROM (SELECT *, row_number() OVER w AS nth,
    model_version IS DISTINCT FROM lag(model_version) OVER w AS fresh
    FROM ({PARTS_SQL}) WINDOW w AS (PARTITION BY model_name, part ORDER BY dt)))"""


def streaks(spark, folder):
    return history.warning_streaks(part_levels(spark, folder), ["model_name", "part"], ["dt"])


@query("T10", STREAKS_SQL)
def warning_streaks(spark, folder):
    return streaks(spark, folder).select("model_name", "part", "dt", "level",
                                         F.col("streak").cast("bigint").alias("streak"))


_RANK = "CASE {} WHEN 'ok' THEN 0 WHEN 'warning' THEN 1 WHEN 'high' THEN 2 END"


@query("T11", f"""
SELECT model_name, part, dt, level, before AS previous_level,
  before IS NOT NULL AND before <> level AS changed,
  {_RANK.format('level')} > {_RANK.format('before')} AS worse,
  coalesce(version_before = model_version, TRUE) AS comparable, recent_high
FROM (SELECT *, lag(level) OVER w AS before, lag(model_version) OVER w AS version_before,
  count(*) FILTER (WHERE level = 'high') OVER (PARTITION BY model_name, part ORDER BY dt
    ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS recent_high
  FROM ({PARTS_SQL}) WINDOW w AS (PARTITION BY model_name, part ORDER BY dt))""")
def history_changes(spark, folder):
    return history.changes(part_levels(spark, folder), ["model_name", "part"], ["dt"]).drop(
        "model_version")


@query("L1", f"SELECT model_name, run_id, feature FROM (SELECT *, row_number() OVER (PARTITION BY "
             f"model_name ORDER BY dt DESC) AS nth FROM ({HISTORY_SQL})) WHERE nth = 1")
def latest_summaries(spark, folder):
    found = history.latest(summaries(spark, folder), at="dt")
    return found.select("model_name", "run_id", "feature")


_STAMP = "CAST(dt AS STRING) || 'T08:00:00' || CASE WHEN day(dt) % 3 = 0 THEN '' ELSE '+00:00' END"


@query("L2", f"SELECT run_id, computed_at FROM (SELECT run_id, {_STAMP} AS computed_at, day(dt) % 3 "
             f"= 0 AS bad, dt FROM ({HISTORY_SQL})) ORDER BY bad, CASE WHEN NOT bad THEN dt END DESC, "
             "run_id DESC LIMIT 45")
def history_newest_first(spark, folder):
    stamped = summaries(spark, folder).selectExpr("run_id", f"{_STAMP} AS computed_at")
    return history.newest_first(stamped, history.zoned_moment(F.col("computed_at")), "run_id", 45)


@query("A21", "SELECT run_id, round(CASE WHEN reference_rmse > 0 THEN current_rmse / reference_rmse "
              "END, 9) AS rmse_ratio, round(reference_auc - current_auc, 9) AS auc_drop "
              f"FROM ({HISTORY_SQL})")
def live_ratios(spark, folder):
    return history.live_ratios(summaries(spark, folder)).select(
        "run_id", F.round("rmse_ratio", 9).alias("rmse_ratio"),
        F.round("auc_drop", 9).alias("auc_drop"))


@query("R9 T10 A20", f"""
WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name, part ORDER BY dt
  DESC) AS nth FROM ({STREAKS_SQL})) WHERE nth = 1)
SELECT 'level_high' AS rule, model_name, part, level AS detail FROM last WHERE level = 'high'
UNION ALL SELECT 'warning_persistent', model_name, part, CAST(streak AS VARCHAR) FROM last
  WHERE streak > 2
UNION ALL SELECT 'run_failed', 'run-' || CAST(run_id AS VARCHAR), NULL, status
  FROM ({RUN_STATUS_SQL}) WHERE status IN ('failed', 'smoke_test_failed')""")
def alert_rows(spark, folder):
    runs = streaks(spark, folder)
    newest = runs.groupBy("model_name", "part").agg(
        F.max_by(F.struct("level", "streak"), "dt").alias("r")).select("model_name", "part", "r.*")
    outcomes = history.run_outcomes(task_states(spark, folder)).select(
        F.concat(F.lit("run-"), F.col("run_id").cast("string")).alias("model_name"), "status")
    return history.alerts(newest, outcomes)


def _live_groups_sql(model: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS group_column, {S.sql_words(f"json_extract_string(raw_input, '$.{c}')")} AS group_name, "
        f"actual, prediction, probability FROM ({MATCHED_SQL}) WHERE model_name = '{model}'"
        for c in S.SPEC.group_columns)


@query("A13 D12", f"""
SELECT group_column, group_name, count(*) AS n, count(*) < 50 AS insufficient_data,
  CASE WHEN count(*) >= 50 THEN round(avg(abs(actual - prediction)), 6) END AS mae,
  CASE WHEN count(*) >= 50 THEN round(sqrt(avg((actual - prediction) * (actual - prediction))), 6) END AS rmse
FROM ({_live_groups_sql(S.REGRESSOR)}) WHERE group_name IS NOT NULL GROUP BY 1, 2""")
def live_group_scores(spark, folder):
    out = monitor.group_scores(matched(spark, folder, S.REGRESSOR), S.SPEC, "regression", 0.5)
    return out.select("group_column", "group_name", "n", "insufficient_data",
                      F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


@query("A13 D12", f"""
SELECT group_column, group_name, count(*) AS n, count(*) < 50 AS insufficient_data,
  CASE WHEN count(*) >= 50 THEN round(count(*) FILTER (WHERE (actual > 0.5) = (probability >= 0.3)) / count(*), 9)
    END AS accuracy
FROM ({_live_groups_sql(S.CLASSIFIER)}) WHERE group_name IS NOT NULL GROUP BY 1, 2""")
def live_group_scores_of_classifier(spark, folder):
    out = monitor.group_scores(matched(spark, folder, S.CLASSIFIER), S.SPEC, "classification", 0.3)
    return out.select("group_column", "group_name", "n", "insufficient_data",
                      F.round("accuracy", 9).alias("accuracy"))
