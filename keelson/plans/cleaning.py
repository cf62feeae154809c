"""Projections, value readers and column cleaning over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import parse
from keelson.operators import clean, rows, scenario
from keelson.plans import standins as S
from keelson.plans.registry import query, table
from keelson.session import materialize


def _reader(column: str, value) -> callable:
    def run(spark, folder):
        raw = S.raw_houses(spark, folder, [column])
        return raw.select(F.col(column).alias("raw"), value(F.col(column)).alias("value")) \
            .groupBy("raw", "value").agg(F.count(F.lit(1)).alias("n"))
    return run


def _reader_sql(column: str, value) -> str:
    return (f"SELECT {column} AS raw, {value(column)} AS value, count(*) AS n "
            f"FROM ({S.HOUSES_SQL}) GROUP BY 1, 2")


@query("F1", _reader_sql("sale_price", S.sql_money))
def read_money(spark, folder):
    return _reader("sale_price", parse.money)(spark, folder)


@query("F2", _reader_sql("has_pool", S.sql_boolean))
def read_boolean(spark, folder):
    return _reader("has_pool", parse.boolean)(spark, folder)


@query("F3", _reader_sql("listing_date", S.sql_day))
def read_day(spark, folder):
    return _reader("listing_date", parse.day)(spark, folder)


@query("F4", _reader_sql("zipcode", S.sql_zipcode))
def read_zipcode(spark, folder):
    return _reader("zipcode", parse.zipcode)(spark, folder)


@query("F5", _reader_sql("city", S.sql_words))
def read_words(spark, folder):
    return _reader("city", parse.words)(spark, folder)


@query("F8", _reader_sql("bedrooms", S.sql_number))
def read_number(spark, folder):
    return _reader("bedrooms", parse.number)(spark, folder)


@query("F0 A2", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS {c}"
    for c in ("property_id", "listing_date", "city", "zipcode", "has_pool", "condition"))
    + f" FROM ({S.HOUSES_SQL})")
def missing_values(spark, folder):
    names = ["property_id", "listing_date", "city", "zipcode", "has_pool", "condition"]
    raw = S.raw_houses(spark, folder, names)
    return raw.agg(*[F.count_if(parse.is_missing(F.col(c))).alias(c) for c in names])


_CLIPPED = [c.name for c in S.SPEC.columns if c.kind == "numeric"]


@query("F6", "SELECT row_key, " + ", ".join(f"{S.sql_clean(c)} AS {c}" for c in _CLIPPED)
       + f" FROM ({S.HOUSES_SQL})")
def clip_outliers(spark, folder):
    raw = S.raw_houses(spark, folder, ["row_key", *_CLIPPED])
    return clean.clip_outliers(raw, S.SPEC)


@query("F7", f"SELECT CAST(year({S.sql_day('listing_date')}) AS INTEGER) AS listing_year, "
             f"CAST(month({S.sql_day('listing_date')}) AS INTEGER) AS listing_month, count(*) AS n "
             f"FROM ({S.HOUSES_SQL}) GROUP BY 1, 2")
def date_features(spark, folder):
    parts = clean.date_features(S.raw_houses(spark, folder, ["listing_date"]), S.SPEC)
    return parts.groupBy("listing_year", "listing_month").agg(F.count(F.lit(1)).alias("n"))


_OTHER = [n for n in S.SPEC.names if n != "listing_date"]


@query("F1 F2 F3 F4 F5 F6 F7", "SELECT row_key, " + ", ".join(
    f"{S.sql_clean(n)} AS {n}" for n in _OTHER)
    + f", CAST(year({S.sql_day('listing_date')}) AS INTEGER) AS listing_year, "
      f"CAST(month({S.sql_day('listing_date')}) AS INTEGER) AS listing_month "
      f"FROM ({S.HOUSES_SQL})")
def clean_houses(spark, folder):
    return clean.clean_table(S.raw_houses(spark, folder), S.SPEC)


@query("F18", "SELECT row_key, " + ", ".join(
    f"CAST({S.sql_boolean(c)} AS DOUBLE) AS {c}" for c in ("has_pool", "sold_within_30_days"))
    + f" FROM ({S.HOUSES_SQL})")
def drift_booleans(spark, folder):
    raw = S.raw_houses(spark, folder, ["row_key", "has_pool", "sold_within_30_days"])
    return clean.clean_table(raw, S.SPEC, numeric_booleans=True)


@query("F10", f"SELECT coalesce(record_source, 'original') AS source, count(*) AS n "
              f"FROM ({S.MIXED_SQL}) GROUP BY 1")
def record_sources(spark, folder):
    mixed = S.mixed_version(spark, folder)
    return mixed.groupBy(clean.record_source(mixed).alias("source")).agg(
        F.count(F.lit(1)).alias("n"))


# DuckDB reads the offset form as an instant; the session zone is UTC.
_MOMENT_SQL = ("CASE WHEN predicted_at LIKE '%+02:00' THEN try_cast(replace(predicted_at, "
               "'+02:00', '') AS TIMESTAMP) - INTERVAL 2 HOUR "
               "ELSE try_cast(predicted_at AS TIMESTAMP) END")


@query("F11 F12", f"SELECT predicted_at, {_MOMENT_SQL} AS moment, CAST({_MOMENT_SQL} AS DATE) "
                  f"AS day FROM ({S.MIXED_SQL}) WHERE predicted_at IS NOT NULL")
def prediction_moments(spark, folder):
    stamped = S.mixed_version(spark, folder).where("predicted_at IS NOT NULL")
    return stamped.select(
        "predicted_at", parse.moment(F.col("predicted_at")).alias("moment"),
        parse.moment_day(F.col("predicted_at")).alias("day"))


EVENT_MOMENT_SQL = (f"CASE WHEN record_source = 'feedback' THEN {_MOMENT_SQL} "
                    f"ELSE CAST({S.sql_day('listing_date')} AS TIMESTAMP) END")


@query("F13", f"SELECT coalesce(record_source, 'original') AS source, CAST({EVENT_MOMENT_SQL} "
              f"AS DATE) AS day, count(*) AS n, max({EVENT_MOMENT_SQL}) AS latest "
              f"FROM ({S.MIXED_SQL}) GROUP BY 1, 2")
def event_days(spark, folder):
    mixed = S.mixed_version(spark, folder)
    placed = mixed.select(clean.record_source(mixed).alias("source"),
                          clean.event_day(mixed, S.SPEC).alias("day"),
                          clean.event_moment(mixed, S.SPEC).alias("moment"))
    return placed.groupBy("source", "day").agg(
        F.count(F.lit(1)).alias("n"), F.max("moment").alias("latest"))


@query("F14", "SELECT o_orderkey, CAST(CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))"
              " AS BIGINT) % 10000 AS DOUBLE) / 10000 AS share FROM orders")
def hash_shares(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", parse.hash_share(F.col("o_orderkey")).alias("share"))


@query("F15", "SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS price, "
              "CAST(o_totalprice * 1000 AS VARCHAR) AS large, "
              "CASE WHEN o_totalprice > 250000 THEN 'True' ELSE 'False' END AS dear, "
              "CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def values_as_text(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select(
        "o_orderkey", parse.as_text(F.col("o_totalprice"), T.DoubleType()).alias("price"),
        parse.as_text(F.col("o_totalprice") * 1000, T.DoubleType()).alias("large"),
        parse.as_text(F.col("o_totalprice") > 250000, T.BooleanType()).alias("dear"),
        parse.as_text(F.col("o_custkey"), T.LongType()).alias("customer"))


_KEYS = ["property_id", "listing_date", "city", "bedrooms", "has_pool", "zipcode"]


@query("F16", "SELECT request_id, " + ", ".join(
    f"json_extract_string(raw_input, '$.{c}') AS {c}" for c in _KEYS)
    + f" FROM ({S.PREDICTIONS_SQL})")
def decode_records(spark, folder):
    log = S.predictions(spark, folder).select("request_id", "raw_input")
    return clean.decode_json(log, "raw_input", _KEYS)


@query("F16", "SELECT key, count(*) AS n_records FROM (SELECT unnest(json_keys(raw_input)) AS key "
              f"FROM ({S.PREDICTIONS_SQL})) GROUP BY 1")
def record_keys(spark, folder):
    return clean.json_keys(S.predictions(spark, folder), "raw_input")


@query("F17 F1", f"SELECT row_key, {S.LABELS_SQL['regression']} AS label FROM ({S.HOUSES_SQL})")
def price_label(spark, folder):
    raw = S.raw_houses(spark, folder, ["row_key", "sale_price"])
    return raw.select("row_key", clean.task_label(raw, S.SPEC, "regression").alias("label"))


@query("F17", f"SELECT row_key, {S.LABELS_SQL['classification']} AS label FROM ({S.HOUSES_SQL})")
def renovation_label(spark, folder):
    raw = S.raw_houses(spark, folder, ["row_key", "condition"])
    return raw.select("row_key", clean.task_label(raw, S.SPEC, "classification").alias("label"))


@query("F19", "SELECT CASE WHEN l_quantity > 40 THEN 'high' WHEN l_quantity >= 20 THEN 'warning' "
              "ELSE 'ok' END AS level, count(*) AS n FROM lineitem GROUP BY 1")
def levels(spark, folder):
    graded = table(spark, folder, "lineitem").select(
        parse.level(F.col("l_quantity"), 20, 40).alias("level"))
    return graded.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("F20", f"""
SELECT scenario, row_key,
  CASE WHEN scenario IN ('price_inflation', 'market_rally') AND {S.sql_money('list_price')}
       IS NOT NULL THEN CAST({S.sql_money('list_price')} * 1.2E0 AS VARCHAR) ELSE list_price END
    AS list_price,
  CASE WHEN scenario = 'market_shift' THEN 'phoenix' ELSE city END AS city,
  CASE WHEN scenario = 'new_segment' THEN 'floating home' ELSE property_type END AS property_type,
  {S.sql_money('sale_price')} * CASE WHEN scenario = 'market_rally' THEN 1.2E0 ELSE 1.0E0 END
    AS truth
FROM ({S.HOUSES_SQL}), (VALUES ('none'), ('price_inflation'), ('market_rally'), ('market_shift'),
  ('new_segment')) AS s(scenario) WHERE {S.sql_money('sale_price')} IS NOT NULL""")
def scenarios(spark, folder):
    raw = S.raw_houses(spark, folder,
                       ["row_key", "list_price", "city", "property_type", "sale_price"])
    # Stored with their outcome, as every scenario reads them.
    pool = materialize(raw.withColumn("label", clean.task_label(raw, S.SPEC, "regression")), "pool")
    parts = [
        scenario.build_requests(pool, F.col("label"), name, "regression", "sale_price").drop("label")
        .withColumn("scenario", F.lit(name)) for name in scenario.SCENARIOS
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("P1", "SELECT l_returnflag, l_quantity, CAST(NULL AS VARCHAR) AS not_there FROM lineitem")
def exact_columns(spark, folder):
    return clean.select_columns(table(spark, folder, "lineitem"),
                                ["l_returnflag", "l_quantity", "not_there"])


_NUMERIC, _CATEGORICAL = S.SPEC.encoded_features("classification")


def _feature_sql(name: str) -> str:
    if name in ("listing_year", "listing_month"):
        return f"CAST({name[8:]}({S.sql_day('listing_date')}) AS DOUBLE)"
    return f"CAST({S.sql_clean(name)} AS DOUBLE)" if name in _NUMERIC else S.sql_clean(name)


@query("P2", "SELECT " + ", ".join(f"{_feature_sql(c)} AS {c}" for c in [*_NUMERIC, *_CATEGORICAL])
       + f" FROM ({S.HOUSES_SQL})")
def task_features(spark, folder):
    cleaned = clean.clean_table(S.raw_houses(spark, folder), S.SPEC)
    return clean.feature_structs(cleaned, S.SPEC, "classification").select(
        "numeric.*", "categorical.*")


@query("P6", f"SELECT property_id, listing_date, condition FROM ({S.HOUSES_SQL})")
def planning_columns(spark, folder):
    raw = S.raw_houses(spark, folder)
    return raw.select(*S.SPEC.planning_columns("classification", raw.columns))


@query("P8", "SELECT doc_id, quality FROM (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN "
             "labels l ON d.doc_id = l.doc_id) WHERE quality IS NOT NULL")
def labelled_documents(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    joined = table(spark, folder, "documents").select("doc_id").join(labels, "doc_id", "left")
    return rows.drop_null_label(joined, "quality")


@query("P9", "SELECT row_key, " + ", ".join(
    f"CASE WHEN trim({c}) <> '' THEN {c} END AS {c}"
    for c in ("city", "zipcode", "has_pool", "condition")) + f" FROM ({S.HOUSES_SQL})")
def blanks_as_null(spark, folder):
    return clean.blanks_as_null(
        S.raw_houses(spark, folder, ["row_key", "city", "zipcode", "has_pool", "condition"]))


@query("P10", f"SELECT property_id, listing_date, sale_price FROM ({S.MIXED_SQL})")
def without_bookkeeping(spark, folder):
    return clean.drop_bookkeeping(S.mixed_version(spark, folder))
