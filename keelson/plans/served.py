"""The prediction log, late outcomes, and feedback versions built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import feedback
from keelson.plans import standins as S
from keelson.plans.registry import query
from keelson.plans.splitting import HOUSE_POINTS_SQL, house_rules, set_name_sql
from keelson.sources import logs

# The days the window touches, as a day filter beside the timestamps.
_WINDOW_SQL = ("\"timestamp\" BETWEEN TIMESTAMP '2024-01-10 12:00:00' AND "
               "TIMESTAMP '2024-01-20 12:00:00'")
_DAYS_SQL = "dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"
WINDOWED_SQL = f"SELECT * FROM ({S.PREDICTIONS_SQL}) WHERE {_WINDOW_SQL}"
MATCHED_SQL = (f"SELECT p.*, o.actual FROM ({WINDOWED_SQL}) p JOIN (SELECT * FROM "
               f"({S.OUTCOMES_SQL}) WHERE {_DAYS_SQL}) o ON p.request_id = o.request_id")


def windowed(spark, folder, model: str | None = None):
    log = logs.in_window(S.predictions(spark, folder), S.LOG_END, S.LOG_HOURS)
    return log if model is None else log.where(F.col("model_name") == model)


def matched(spark, folder, model: str | None = None):
    days = logs.days_in_window(S.LOG_END, S.LOG_HOURS)
    known = S.outcomes(spark, folder).where(F.col("dt").between(days[0], days[-1]))
    return feedback.join_outcomes(windowed(spark, folder, model), known)


@query("P7 S7 U1", f"SELECT request_id, \"timestamp\", prediction, model_name FROM ({WINDOWED_SQL})")
def window_of_log(spark, folder):
    return windowed(spark, folder).select("request_id", "timestamp", "prediction", "model_name")


@query("J1", f"SELECT p.request_id, p.prediction, o.actual FROM ({S.PREDICTIONS_SQL}) p JOIN "
             f"({S.OUTCOMES_SQL}) o ON p.request_id = o.request_id")
def outcomes_joined(spark, folder):
    joined = feedback.join_outcomes(S.predictions(spark, folder), S.outcomes(spark, folder))
    return joined.select("request_id", "prediction", "actual")


@query("J1", f"SELECT p.request_id, p.prediction, o.actual FROM ({S.PREDICTIONS_SQL}) p JOIN "
             f"(SELECT request_id, max(actual) AS actual FROM ({S.OUTCOMES_SQL}) GROUP BY 1) o "
             "ON p.request_id = o.request_id")
def outcomes_joined_once(spark, folder):
    joined = feedback.join_outcomes(S.predictions(spark, folder), S.outcomes(spark, folder),
                                    dedupe_outcomes=True)
    return joined.select("request_id", "prediction", "actual")


@query("J2 P7 S7 J1", f"SELECT request_id, \"timestamp\", actual FROM ({MATCHED_SQL})")
def matched_predictions(spark, folder):
    return matched(spark, folder).select("request_id", "timestamp", "actual")


_KEYS = ["property_id", "listing_date", "city", "property_type", "bedrooms", "has_pool"]
_FIELDS = ", ".join(f"json_extract_string(raw_input, '$.{k}') AS {k}" for k in _KEYS)


def records_sql(model: str, label: str, value: str) -> str:
    return f"""
SELECT {', '.join(_KEYS)}, {label}, 'feedback' AS record_source, predicted_at FROM (
  SELECT {_FIELDS}, {value} AS {label},
    strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS predicted_at,
    row_number() OVER (PARTITION BY json_extract_string(raw_input, '$.property_id')
      ORDER BY "timestamp" DESC, request_id DESC) AS nth
  FROM ({MATCHED_SQL}) WHERE model_name = '{model}') WHERE nth = 1"""


def price_records(spark, folder):
    found = matched(spark, folder, S.REGRESSOR)
    return feedback.records(found, S.SPEC, "regression", _KEYS, [F.col("request_id")])


PRICE_RECORDS_SQL = records_sql(S.REGRESSOR, "sale_price", "CAST(actual AS VARCHAR)")


@query("M16 T5 F15 F16", PRICE_RECORDS_SQL)
def price_feedback_records(spark, folder):
    return price_records(spark, folder)


@query("M16 T5 F17", records_sql(
    S.CLASSIFIER, "needs_renovation", "CASE WHEN actual = 1 THEN 'True' ELSE 'False' END"))
def renovation_feedback_records(spark, folder):
    found = matched(spark, folder, S.CLASSIFIER)
    return feedback.records(found, S.SPEC, "classification", _KEYS, [F.col("request_id")])


@query("J3 U2", f"""
SELECT property_id, listing_date, sale_price, city, NULL AS record_source
FROM ({S.HOUSES_SQL}) h WHERE NOT EXISTS (SELECT 1 FROM ({PRICE_RECORDS_SQL}) r
  WHERE r.property_id IS NOT DISTINCT FROM h.property_id)
UNION ALL SELECT property_id, listing_date, sale_price, city, record_source
FROM ({PRICE_RECORDS_SQL})""")
def merged_version(spark, folder):
    source = S.raw_houses(spark, folder, ["property_id", "listing_date", "sale_price", "city"])
    merged = feedback.merge(source, price_records(spark, folder), "property_id")
    return merged.select("property_id", "listing_date", "sale_price", "city", "record_source")


@query("J3", f"SELECT count(*) AS replaced_records FROM ({S.HOUSES_SQL}) h WHERE property_id IN "
             f"(SELECT property_id FROM ({PRICE_RECORDS_SQL}))")
def replaced_by_feedback(spark, folder):
    source = S.raw_houses(spark, folder, ["property_id"])
    return feedback.replaced_count(source, price_records(spark, folder), "property_id")


@query("J4 P10", f"""
SELECT property_id, row_key FROM ({S.HOUSES_SQL}), ({HOUSE_POINTS_SQL})
WHERE {set_name_sql(S.sql_day('listing_date'))} = 'simulation' AND (property_id IS NULL OR
  property_id NOT IN (SELECT property_id FROM ({S.HOUSES_SQL}), ({HOUSE_POINTS_SQL})
  WHERE {set_name_sql(S.sql_day('listing_date'))} = 'train' AND property_id IS NOT NULL))""")
def holdout_pool(spark, folder):
    from keelson.operators import splits
    rules = house_rules(spark, folder)
    raw = S.raw_houses(spark, folder, ["property_id", "listing_date", "row_key"])
    trained = splits.assign_split(raw, S.SPEC, rules).where("set_name = 'train'")
    return feedback.holdout_pool(raw, S.SPEC, rules, trained).select("property_id", "row_key")


@query("A16", f"SELECT count(*) AS matched, count(DISTINCT json_extract_string(raw_input, "
              f"'$.property_id')) AS houses, count(DISTINCT json_extract_string(raw_input, "
              f"'$.property_id')) >= 500 AS enough FROM ({MATCHED_SQL})")
def feedback_preview(spark, folder):
    return feedback.feedback_preview(matched(spark, folder), "property_id")
