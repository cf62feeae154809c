"""Split points, set assignment, deduplication, samples and time order."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions import parse
from keelson.operators import clean, ranking, rows, splits
from keelson.plans import standins as S
from keelson.plans.cleaning import EVENT_MOMENT_SQL
from keelson.plans.registry import query, rows_of, table

SEED = 42
SAMPLE = 2_000


def split_points_sql(days: str) -> str:
    """t1 and t2 by position in the sorted days of a one-column (day) query."""
    return f"""
WITH d AS (SELECT day FROM ({days}) WHERE day IS NOT NULL),
p AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS pos FROM d),
n AS (SELECT count(*) AS total, CAST(floor(count(*) * 0.1E0) AS BIGINT) AS held,
      max(day) AS last FROM d),
t2 AS (SELECT CASE WHEN held > 0 THEN (SELECT day FROM p WHERE pos = total - held)
       ELSE CAST(last + INTERVAL 1 DAY AS DATE) END AS t2, total FROM n),
b AS (SELECT count(*) AS before FROM d, t2 WHERE day < t2)
SELECT CASE WHEN before > 0 THEN (SELECT day FROM p
  WHERE pos = CAST(floor(before * 0.8E0) AS BIGINT)) ELSE t2 END AS t1, t2,
  total AS dated_rows FROM t2, b"""


HOUSE_DAYS_SQL = f"SELECT {S.sql_day('listing_date')} AS day FROM ({S.HOUSES_SQL})"
HOUSE_POINTS_SQL = split_points_sql(HOUSE_DAYS_SQL)
SHARE_SQL = ("CAST(CAST(('0x' || substr(md5(coalesce(property_id, 'None')), 1, 8)) AS BIGINT) "
             "% 10000 AS DOUBLE) / 10000")


def set_name_sql(moment: str, t1: str = "t1", t2: str = "t2", undated: float = 0.2) -> str:
    return (f"CASE WHEN {moment} IS NULL THEN CASE WHEN {SHARE_SQL} < {undated} THEN 'test' "
            f"ELSE 'train' END WHEN {moment} < {t1} THEN 'train' WHEN {moment} < {t2} THEN 'test' "
            f"ELSE 'simulation' END")


def house_rules(spark, folder) -> dict:
    raw = S.raw_houses(spark, folder, ["listing_date"])
    return {"original": splits.split_rule(raw, S.SPEC)}


@query("T1", split_points_sql("SELECT CAST(o_orderdate AS DATE) AS day FROM orders"))
def order_split_points(spark, folder):
    days = rows_of(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    return splits.split_points(days)


@query("T1 T3", HOUSE_POINTS_SQL)
def house_split_points(spark, folder):
    raw = S.raw_houses(spark, folder, ["listing_date"])
    return splits.split_points(raw.select(clean.event_day(raw, S.SPEC).alias("day")))


@query("T2 F14", f"SELECT row_key, {set_name_sql(S.sql_day('listing_date'))} AS set_name "
                 f"FROM ({S.HOUSES_SQL}), ({HOUSE_POINTS_SQL})")
def assigned_sets(spark, folder):
    raw = S.raw_houses(spark, folder, ["row_key", "property_id", "listing_date"])
    return splits.assign_split(raw, S.SPEC, house_rules(spark, folder)).select(
        "row_key", "set_name")


@query("T2 F13 F10", f"""
SELECT coalesce(record_source, 'original') AS source,
  CASE WHEN record_source = 'feedback' THEN
    CASE WHEN m IS NULL OR m < TIMESTAMP '2024-01-21 06:30:00' THEN 'train' ELSE 'test' END
  ELSE {set_name_sql("m", "DATE '2000-01-01'", "DATE '2001-01-01'")} END AS set_name,
  count(*) AS n
FROM (SELECT *, {EVENT_MOMENT_SQL} AS m FROM ({S.MIXED_SQL})) GROUP BY 1, 2""")
def assigned_by_source(spark, folder):
    rules = {
        "original": {"t1": "2000-01-01", "t2": "2001-01-01", "undated_test_share": 0.2},
        "feedback": {"t1": "2024-01-21T06:30:00", "t2": None, "undated_test_share": 0.0},
    }
    mixed = S.mixed_version(spark, folder)
    placed = splits.assign_split(mixed, S.SPEC, rules)
    return placed.groupBy(clean.record_source(placed).alias("source"), "set_name").agg(
        F.count(F.lit(1)).alias("n"))


FIRST_SQL = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY "
             f"row_key) AS nth FROM ({S.HOUSES_SQL})) WHERE nth = 1")


@query("T4", f"SELECT * EXCLUDE (nth) FROM ({FIRST_SQL})")
def first_per_id(spark, folder):
    # Lines are sorted and moved, and only those that stay are written out as the wide texts of a house.
    lines = S.keyed_lines(S.raw_lines(spark, folder))
    return S.houses_of(rows.dedup_first(lines, ["property_id"], [F.col("row_key")]))


@query("T5", f"""
SELECT property_id, moment, request_id FROM (
  SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY moment DESC, request_id DESC) AS nth
  FROM (SELECT 'p' || CAST(event_id % 5000 AS VARCHAR) AS property_id, ts AS moment,
        'r' || CAST(event_id AS VARCHAR) AS request_id FROM events)) WHERE nth = 1""")
def latest_per_id(spark, folder):
    events = table(spark, folder, "events").selectExpr(
        "'p' || CAST(event_id % 5000 AS STRING) AS property_id", "ts AS moment",
        "'r' || CAST(event_id AS STRING) AS request_id")
    return rows.dedup_latest(events, ["property_id"], F.col("moment"), [F.col("request_id")])


def plan_sql(task: str) -> str:
    """Flagged rows of the set plan: first per id, labelled, placed."""
    return (f"SELECT *, CASE WHEN label IS NOT NULL THEN {set_name_sql(S.sql_day('listing_date'))} "
            f"END AS set_name FROM (SELECT *, {S.LABELS_SQL[task]} AS label FROM ({FIRST_SQL})), "
            f"({HOUSE_POINTS_SQL})")


def _flagged(spark, folder, task, columns=None):
    wanted = columns or S.SPEC.planning_columns(task, S.SPEC.names)
    raw = S.raw_houses(spark, folder, [*wanted, "row_key"])
    return rows.flag_rows(raw, S.SPEC, task, house_rules(spark, folder), [F.col("row_key")])


@query("T12 A12 P8", f"""
SELECT (SELECT count(*) FROM lineitem) - count(*) AS dropped_duplicates,
  count(*) FILTER (WHERE set_name IS NULL) AS dropped_missing_target,
  count(*) FILTER (WHERE set_name = 'train') AS train_available,
  count(*) FILTER (WHERE set_name = 'test') AS test_rows,
  count(*) FILTER (WHERE set_name = 'simulation') AS simulation_rows
FROM ({plan_sql('classification')})""")
def set_plan_counts(spark, folder):
    total = rows_of(spark, folder, "lineitem").count()
    return rows.plan_counts(_flagged(spark, folder, "classification"), total)


_DRAW_SQL = f"md5('{SEED}|' || coalesce(property_id, ''))"


@query("T12 L3", f"""
SELECT set_name, property_id, label FROM (
  SELECT *, row_number() OVER (PARTITION BY set_name ORDER BY {_DRAW_SQL}) AS draw
  FROM ({plan_sql('regression')})) WHERE set_name = 'test' OR (set_name = 'train'
  AND draw <= {SAMPLE})""")
def sampled_set_plan(spark, folder):
    names = ["property_id", "listing_date", "sale_price"]
    raw = S.raw_houses(spark, folder, [*names, "row_key"])
    plan = rows.plan_rows(raw, S.SPEC, "regression", house_rules(spark, folder), SAMPLE, SEED,
                          ["row_key"])
    return plan.train.withColumn("set_name", F.lit("train")).unionByName(
        plan.test.withColumn("set_name", F.lit("test"))).select(
        "set_name", "property_id", F.col("sale_price").alias("label"))


@query("L3 L4", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY "
                f"md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)) LIMIT {SAMPLE}")
def exact_sample(spark, folder):
    orders = rows_of(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return rows.sample_exact(orders, SAMPLE, SEED, F.col("o_orderkey"))


@query("L5", f"""
SELECT draw, c_custkey, c_acctbal FROM (
  SELECT i AS draw, CAST('0x' || substr(md5('{SEED}|' || CAST(i AS VARCHAR)), 1, 13) AS BIGINT)
    % (SELECT count(*) FROM customer) AS pos FROM range((SELECT 2 * count(*) FROM customer)) r(i))
JOIN (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer) USING (pos)""")
def repeated_sample(spark, folder):
    pool = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return rows.sample_with_replacement(pool, 2 * pool.count(), SEED, [F.col("c_custkey")])


@query("T6", f"""
WITH m AS (SELECT epoch_us(ts) AS us, row_number() OVER (ORDER BY ts) - 1 AS pos,
  count(*) OVER () AS n FROM events),
cut AS (SELECT us AS t1 FROM m WHERE pos = CAST(floor(n * 0.8E0) AS BIGINT))
SELECT CASE WHEN us < t1 THEN 'train' ELSE 'test' END AS set_name, count(*) AS n,
  min(us) AS first_us, max(us) AS last_us FROM m, cut GROUP BY 1""")
def feedback_cut(spark, folder):
    stamped = table(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("predicted_at"),
        F.lit("feedback").alias("record_source"),
        F.col("event_id").cast("string").alias("property_id"))
    rules = splits.feedback_rules({"original": {"t2": "2001-01-01"}}, stamped)
    placed = splits.assign_split(stamped, S.SPEC, rules)
    micros = F.unix_micros(parse.moment(F.col("predicted_at")))
    return placed.groupBy("set_name").agg(
        F.count(F.lit(1)).alias("n"), F.min(micros).alias("first_us"),
        F.max(micros).alias("last_us"))


ORDERED_SQL = (f"SELECT row_key, property_id, {S.sql_day('listing_date')} AS day, "
               f"row_number() OVER (ORDER BY {S.sql_day('listing_date')} NULLS FIRST, row_key) - 1 "
               f"AS position, count(*) OVER () AS n, "
               f"count(*) FILTER (WHERE {S.sql_day('listing_date')} IS NULL) OVER () AS undated "
               f"FROM (SELECT DISTINCT row_key, property_id, listing_date FROM ({S.HOUSES_SQL}))")


def _ordered(spark, folder):
    raw = S.raw_houses(spark, folder, ["row_key", "property_id", "listing_date"]).distinct()
    return splits.training_order(raw, S.SPEC, [F.col("row_key")])


@query("T7", f"SELECT row_key, position FROM ({ORDERED_SQL})")
def training_order(spark, folder):
    return _ordered(spark, folder).select("row_key", "position")


@query("T8", f"""
SELECT CASE WHEN position >= n - 5 * ((n - undated) // 6)
  THEN CAST((position - (n - 5 * ((n - undated) // 6))) // ((n - undated) // 6) AS INTEGER) END
  AS scored_in, count(*) AS n, min(position) AS first_position, min(day) AS first_day,
  max(day) AS last_day FROM ({ORDERED_SQL}) GROUP BY 1""")
def time_folds(spark, folder):
    ordered = _ordered(spark, folder)
    size = ordered.agg(F.count(F.lit(1)).alias("n"),
                       F.count_if(F.col("_moment").isNull()).alias("undated")).first()
    folds = splits.time_folds(ordered, 5, size["n"], size["undated"])
    return folds.groupBy("scored_in").agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("first_position"),
        F.min(F.to_date("_moment")).alias("first_day"),
        F.max(F.to_date("_moment")).alias("last_day"))


@query("T6 T9", """
SELECT k, value FROM (SELECT l_extendedprice AS value, row_number() OVER (ORDER BY l_extendedprice)
  - 1 AS k, count(*) OVER () AS n FROM lineitem)
WHERE k IN (0, n // 4, n // 2, n - 1)""")
def order_statistics(spark, folder):
    lines = rows_of(spark, folder, "lineitem")
    n = lines.count()
    found = ranking.order_statistics(lines, {"l_extendedprice": [0, n // 4, n // 2, n - 1]})
    return spark.createDataFrame(
        sorted(found["l_extendedprice"].items()), "k bigint, value double")
