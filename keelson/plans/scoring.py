"""Scores, group scores, gates and run lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import feedback, history, metrics
from keelson.plans import standins as S
from keelson.plans.registry import query, rows_of, table
from keelson.plans.splitting import HOUSE_POINTS_SQL, house_rules, set_name_sql

# A price guess, a renovation guess and their truths, from the order lines.
SCORED = {
    "truth": "l_extendedprice",
    "guess": "l_extendedprice * (0.9E0 + (l_partkey % 21) / 100.0E0)",
    "flag": "l_returnflag = 'R'",
    "score": "CAST((l_partkey * 7 + CASE WHEN l_returnflag = 'R' THEN 35 ELSE 0 END) % 101 AS DOUBLE)"
             " / 100",
    "city": "CASE WHEN l_suppkey % 9 = 0 THEN NULL WHEN l_suppkey % 2 = 0 THEN upper(l_linestatus) "
            "|| '_Town ' ELSE lower(l_linestatus) || ' town' END",
    "property_type": "CASE WHEN l_partkey % 1900 = 3 THEN 'Castle' WHEN l_partkey % 3 = 0 THEN "
                     "'Single_Family' ELSE 'condo' END",
}
SCORED_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in SCORED.items()) + " FROM lineitem"


def scored(spark, folder):
    rows = rows_of(spark, folder, "lineitem").selectExpr(
        *[f"{e} AS {n}" for n, e in SCORED.items()])
    return rows.withColumn("answer", F.col("score") >= 0.6)


def _rounded(df, columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


REGRESSION_SQL = ("round(sqrt(avg((truth - guess) * (truth - guess))), 6) AS rmse, "
                  "round(avg(abs(truth - guess)), 6) AS mae, "
                  "round(1 - sum((truth - guess) * (truth - guess)) / (var_pop(truth) * count(*)), 9)"
                  " AS r2")
CELLS_SQL = ("count(*) FILTER (WHERE flag AND score >= 0.6) AS tp, "
             "count(*) FILTER (WHERE NOT flag AND score >= 0.6) AS fp, "
             "count(*) FILTER (WHERE flag AND score < 0.6) AS fn, "
             "count(*) FILTER (WHERE flag = (score >= 0.6)) AS good, count(*) AS n")
CLASS_SQL = ("round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 9) AS f1, "
             "round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9) AS \"precision\", "
             "round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 9) AS recall, "
             "round(good / n, 9) AS accuracy")


def auc_sql(source: str, keys: str = "") -> str:
    """AUC by mean rank of the positives, a different formula from the Spark job."""
    part = f"PARTITION BY {keys}" if keys else ""
    lead, group = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return f"""
SELECT {lead}CASE WHEN sum(p) > 0 AND sum(p) < count(*) THEN
  (sum(r * p) - sum(p) * (sum(p) + 1) / 2) / (sum(p) * CAST(count(*) - sum(p) AS DOUBLE)) END AS auc
FROM (SELECT {lead}CAST(flag AS INTEGER) AS p,
  rank() OVER ({part} ORDER BY score) + (count(*) OVER (PARTITION BY {lead}score) - 1) / 2.0E0 AS r
  FROM ({source})) {group}"""


@query("A9", f"SELECT {REGRESSION_SQL} FROM ({SCORED_SQL})")
def regression_scores(spark, folder):
    return _rounded(_rounded(metrics.regression(scored(spark, folder), "truth", "guess"),
                             ["rmse", "mae"], 6), ["r2"])


@query("A10", f"SELECT {CLASS_SQL} FROM (SELECT {CELLS_SQL} FROM ({SCORED_SQL}))")
def classification_scores(spark, folder):
    out = metrics.classification(scored(spark, folder), "flag", "answer")
    return _rounded(out, out.columns)


@query("A11", f"SELECT round(auc, 9) AS auc FROM ({auc_sql(SCORED_SQL)})")
def auc(spark, folder):
    return _rounded(metrics.auc(scored(spark, folder), "flag", "score"), ["auc"])


GROUPS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS group_column, {S.sql_words(c)} AS group_name, truth, guess, flag, score "
    f"FROM ({SCORED_SQL}) WHERE {S.sql_words(c)} IS NOT NULL" for c in ("city", "property_type"))


@query("A13", f"""
SELECT group_column, group_name, n, n < 200 AS insufficient_data,
  CASE WHEN n >= 200 THEN rmse END AS rmse, CASE WHEN n >= 200 THEN mae END AS mae,
  CASE WHEN n >= 200 THEN r2 END AS r2
FROM (SELECT group_column, group_name, count(*) AS n, {REGRESSION_SQL} FROM ({GROUPS_SQL})
  GROUP BY 1, 2)""")
def regression_by_group(spark, folder):
    out = metrics.by_group(scored(spark, folder), "regression", ["city", "property_type"],
                           "truth", "guess")
    return _rounded(_rounded(out, ["rmse", "mae"], 6), ["r2"])


@query("A13 A11", f"""
SELECT group_column, group_name, n, n < 200 AS insufficient_data,
  CASE WHEN n >= 200 THEN f1 END AS f1, CASE WHEN n >= 200 THEN "precision" END AS "precision",
  CASE WHEN n >= 200 THEN recall END AS recall, CASE WHEN n >= 200 THEN accuracy END AS accuracy,
  CASE WHEN n >= 200 THEN round(auc, 9) END AS auc
FROM (SELECT group_column, group_name, n, {CLASS_SQL} FROM (SELECT group_column, group_name,
  {CELLS_SQL} FROM ({GROUPS_SQL}) GROUP BY 1, 2))
JOIN ({auc_sql(GROUPS_SQL, 'group_column, group_name')}) USING (group_column, group_name)""")
def classification_by_group(spark, folder):
    out = metrics.by_group(scored(spark, folder), "classification", ["city", "property_type"],
                           "flag", "answer", "score")
    return _rounded(out, ["f1", "precision", "recall", "accuracy", "auc"])


_PAIRS = """
SELECT o_custkey, max(o_totalprice) / 600000 AS candidate_r2, avg(o_totalprice) AS candidate_rmse,
  CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE max(o_totalprice) * 0.6E0 END AS champion_rmse
FROM orders GROUP BY o_custkey"""


@query("M13 J8", f"""
SELECT o_custkey, candidate_r2 >= 0.75 AS floor_passed,
  CASE WHEN candidate_r2 >= 0.75 AND champion_rmse IS NOT NULL
    THEN candidate_rmse <= champion_rmse - abs(champion_rmse) * 0.01E0 + 1e-9 END AS beats_champion,
  candidate_r2 >= 0.75 AND coalesce(candidate_rmse <= champion_rmse - abs(champion_rmse) * 0.01E0
    + 1e-9, TRUE) AS passed
FROM ({_PAIRS})""")
def regression_gate(spark, folder):
    pairs = table(spark, folder, "orders").groupBy("o_custkey").agg(
        (F.max("o_totalprice") / 600000).alias("candidate_r2"),
        F.avg("o_totalprice").alias("candidate_rmse"),
        F.max("o_totalprice").alias("top"),
    ).select("o_custkey", "candidate_r2", "candidate_rmse",
             F.when(F.col("o_custkey") % 4 != 0, F.col("top") * 0.6).alias("champion_rmse"))
    return metrics.gate(pairs, "regression").select(
        "o_custkey", "floor_passed", "beats_champion", "passed")


@query("M13 J8", """
SELECT c_custkey, candidate_auc >= 0.55 AS floor_passed,
  CASE WHEN candidate_auc >= 0.55 AND champion_auc IS NOT NULL
    THEN candidate_auc >= champion_auc + 0.005E0 - 1e-9 END AS beats_champion,
  candidate_auc >= 0.55 AND coalesce(candidate_auc >= champion_auc + 0.005E0 - 1e-9, TRUE) AS passed
FROM (SELECT c_custkey, (c_acctbal + 1000) / 11000 AS candidate_auc,
  CASE WHEN c_nationkey > 3 THEN c_nationkey / 25.0E0 END AS champion_auc FROM customer)""")
def classification_gate(spark, folder):
    pairs = table(spark, folder, "customer").select(
        "c_custkey", ((F.col("c_acctbal") + 1000) / 11000).alias("candidate_auc"),
        F.when(F.col("c_nationkey") > 3, F.col("c_nationkey") / 25.0).alias("champion_auc"))
    return metrics.gate(pairs, "classification").select(
        "c_custkey", "floor_passed", "beats_champion", "passed")


@query("J5", f"""
SELECT count(*) AS overlap FROM ({S.HOUSES_SQL}), ({HOUSE_POINTS_SQL})
WHERE {set_name_sql(S.sql_day('listing_date'))} = 'test' AND property_id IN (
  SELECT property_id FROM ({S.HOUSES_SQL}), ({HOUSE_POINTS_SQL})
  WHERE {set_name_sql(S.sql_day('listing_date'))} = 'train')""")
def train_test_overlap(spark, folder):
    """Ids on both sides when a table is split without deduplication."""
    from keelson.operators import splits
    raw = S.raw_houses(spark, folder, ["property_id", "listing_date"])
    placed = splits.assign_split(raw, S.SPEC, house_rules(spark, folder))
    return feedback.overlap(placed.where("set_name = 'test'"), placed.where("set_name = 'train'"),
                            "property_id")


# Registry tables: a training run per event day and model, a version per run.
RUNS_SQL = f"""
SELECT model_name || '-' || CAST(dt AS VARCHAR) AS run_id, min(request_id) AS data_id,
  min(model_version) AS dataset_version, round(avg(prediction), 6) AS test_rmse
FROM ({S.PREDICTIONS_SQL}) GROUP BY model_name, dt"""
VERSIONS_SQL = """
SELECT model_name, run_id, version, CASE WHEN version = 15 THEN 'champion' END AS alias FROM (
  SELECT model_name, model_name || '-' || CAST(dt AS VARCHAR) AS run_id,
    row_number() OVER (PARTITION BY model_name ORDER BY dt) AS version
  FROM (SELECT DISTINCT model_name, dt FROM (""" + S.PREDICTIONS_SQL + ")))"


@query("J9", f"""
SELECT v.model_name, v.run_id, v.version, r.data_id, r.dataset_version, r.test_rmse
FROM ({VERSIONS_SQL}) v JOIN ({RUNS_SQL}) r ON v.run_id = r.run_id WHERE alias = 'champion'""")
def champion_lineage(spark, folder):
    from pyspark.sql import Window
    log = S.predictions(spark, folder)
    run_id = F.concat("model_name", F.lit("-"), F.col("dt").cast("string"))
    runs = log.groupBy("model_name", "dt").agg(
        F.min("request_id").alias("data_id"), F.min("model_version").alias("dataset_version"),
        F.round(F.avg("prediction"), 6).alias("test_rmse"),
    ).select(run_id.alias("run_id"), "data_id", "dataset_version", "test_rmse")
    order = Window.partitionBy("model_name").orderBy("dt")
    versions = log.select("model_name", "dt").distinct().select(
        "model_name", run_id.alias("run_id"),
        F.row_number().over(order).cast("bigint").alias("version"))
    versions = versions.withColumn("alias", F.when(F.col("version") == 15, "champion"))
    return history.champion(versions, runs).select(
        "model_name", "run_id", "version", "data_id", "dataset_version", "test_rmse")


# Every day's version was built from that of half its number.
_ANCESTRY_SQL = f"""
SELECT model_name || '-' || CAST(n AS VARCHAR) AS version,
  CASE WHEN n > 1 THEN model_name || '-' || CAST(n // 2 AS VARCHAR) END AS source_version
FROM (SELECT model_name, row_number() OVER (PARTITION BY model_name ORDER BY dt) AS n
  FROM (SELECT DISTINCT model_name, dt FROM ({S.PREDICTIONS_SQL})))"""


@query("J9 S12 M17", f"""
WITH RECURSIVE v AS ({_ANCESTRY_SQL}), up AS (
  SELECT version, source_version AS ancestor, 1 AS generation FROM v WHERE source_version IS NOT NULL
  UNION ALL SELECT up.version, v.source_version, generation + 1 FROM up JOIN v ON v.version = up.ancestor
  WHERE v.source_version IS NOT NULL)
SELECT version, ancestor, generation FROM up""")
def version_ancestry(spark, folder):
    """All ancestors of every version, with their generation."""
    from pyspark.sql import Window
    days = S.predictions(spark, folder).select("model_name", "dt").distinct()
    number = F.row_number().over(Window.partitionBy("model_name").orderBy("dt"))
    numbered = days.select("model_name", number.cast("long").alias("n"))
    name = lambda n: F.concat("model_name", F.lit("-"), n.cast("string"))
    return history.ancestors(numbered.select(
        name(F.col("n")).alias("version"),
        F.when(F.col("n") > 1, name(F.floor(F.col("n") / 2))).alias("source_version")))


_TASKS = ["extract", "validate", "train", "evaluate", "stop_no_deploy", "register", "deploy", "tidy"]
TASK_STATES = {
    "run_id": "CAST(floor(event_id / 8) AS BIGINT)",
    "task": S._choose("event_id % 8", _TASKS),
    "state": "CASE WHEN event_type = 'error' AND user_id % 5 = 0 THEN 'failed' "
             "WHEN event_type = 'click' AND user_id % 11 = 0 THEN 'upstream_failed' "
             "WHEN event_type = 'view' THEN 'skipped' ELSE 'success' END",
}
TASK_STATES_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in TASK_STATES.items()) + " FROM events"
RUN_STATUS_SQL = f"""
SELECT run_id, CASE WHEN bool_or(task = 'deploy' AND state = 'failed') THEN 'smoke_test_failed'
  WHEN bool_or(state IN ('failed', 'upstream_failed')) THEN 'failed'
  WHEN bool_or(task = 'stop_no_deploy' AND state = 'success') THEN 'blocked' ELSE 'success' END
  AS status FROM ({TASK_STATES_SQL}) GROUP BY 1"""


def task_states(spark, folder):
    return table(spark, folder, "events").selectExpr(
        *[f"{e} AS {n}" for n, e in TASK_STATES.items()])


@query("A20", RUN_STATUS_SQL)
def run_outcomes(spark, folder):
    return history.run_outcomes(task_states(spark, folder))
