"""Tables of the kinds the operators expect, derived from the given tables.

Raw houses come from ``lineitem``, the served-prediction log and its outcomes
from ``events``.  The rules are integer arithmetic written in SQL both Spark and
DuckDB read, so a query and its SQL twin start from the same rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from keelson.plans.registry import table
from keelson.session import spread
from keelson.spec import house_spec

SPEC = house_spec(2026)
REGRESSOR = SPEC.model_names["regression"]
CLASSIFIER = SPEC.model_names["classification"]

LOG_END = datetime(2024, 1, 20, 12, 0)
LOG_HOURS = 240.0
CHANGE = "2024-01-16"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _int(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _two(expr: str) -> str:
    return f"lpad({_text(expr)}, 2, '0')"


def _choose(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def _price(expr: str) -> str:
    whole = f"CAST(floor({expr}) AS BIGINT)"
    return (f"'$' || {_text(f'CAST(floor({expr} / 1000) AS BIGINT)')} || ',' || "
            f"lpad({_text(f'{whole} % 1000')}, 3, '0') || '.50'")


_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_CITIES = ["new york", "boston", "phoenix", "san diego", "miami", "denver", "austin"]
_TYPES = ["single family", "condo", "townhouse", "multi family", "land"]

_BASE = {
    "l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey",
    "l_linenumber": "l_linenumber", "l_quantity": "l_quantity",
    "l_extendedprice": "l_extendedprice", "l_discount": "l_discount", "l_tax": "l_tax",
    "mix": "l_orderkey + l_linenumber",
    "y": _text("year(l_shipdate)"), "m": _two("month(l_shipdate)"), "d": _two("day(l_shipdate)"),
    "mon": f"substr('{_MONTHS}', month(l_shipdate) * 3 - 2, 3)",
    "town": _choose("l_suppkey % 7", _CITIES),
    "house": _choose("l_partkey % 5", _TYPES),
    "ask": "l_extendedprice * 4",
    "sold": "l_extendedprice * 3.5E0 + (l_partkey % 5) * 9000 + l_quantity * 100",
    "row_key": "md5(" + " || '|' || ".join(_text(c) for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax")) + " || l_returnflag || l_linestatus || "
        + " || ".join(_text(f"{p}(l_shipdate)") for p in ("year", "month", "day")) + ")",
}

HOUSE_RULES = {
    "property_id": f"CASE WHEN l_partkey % 397 = 0 THEN NULL ELSE 'p' || {_text('l_orderkey')} END",
    "listing_date": "CASE WHEN l_partkey % 13 = 0 THEN '' WHEN l_partkey % 101 = 1 THEN 'soon' "
                    "WHEN mix % 3 = 0 THEN y || '-' || m || '-' || d "
                    "WHEN mix % 3 = 1 THEN m || '/' || d || '/' || y "
                    "ELSE d || '-' || mon || '-' || y END",
    "city": "CASE WHEN l_partkey % 59 = 0 THEN NULL WHEN l_linenumber % 4 = 0 THEN "
            "replace(town, ' ', '_') WHEN l_linenumber % 4 = 1 THEN upper(town) "
            "WHEN l_linenumber % 4 = 2 THEN '  ' || town || ' ' ELSE replace(town, ' ', '-') END",
    "state": _choose("l_suppkey % 5", ["CA", "ny", "Tx", "FL", "az"]),
    "zipcode": "CASE WHEN l_partkey % 97 = 0 THEN '' WHEN l_partkey % 89 = 0 THEN "
               + _text("1000 + l_suppkey % 9000")
               + f" ELSE lpad({_text('(l_partkey % 300) * 331')}, 5, '0') END",
    "property_type": "CASE WHEN l_linenumber % 3 = 0 THEN upper(house) WHEN l_linenumber % 3 = 1 "
                     "THEN replace(house, ' ', '_') ELSE replace(house, ' ', '-') END",
    "lot_size_sqft": _text("(l_partkey % 1600) * 700"),
    "living_area_sqft": _text("l_extendedprice / 2"),
    "bedrooms": "CASE WHEN l_suppkey % 50 = 7 THEN 'n/a' ELSE "
                + _text("l_partkey % 23 - 1") + " END",
    "bathrooms": _text("l_linenumber * 0.5E0"),
    "year_built": _text("1795 + l_orderkey % 260"),
    "stories": _text("l_linenumber % 4"),
    "garage_spaces": f"CASE WHEN l_partkey % 47 = 0 THEN '' ELSE {_text('l_suppkey % 5')} END",
    "has_pool": _choose("mix % 10", ["Yes", "No", "Y", "N", "1", "0", "True", "False", "", "maybe"]),
    "hoa_fee_monthly": f"CASE WHEN l_suppkey % 5 < 3 THEN '' ELSE {_text('l_quantity * 110')} END",
    "school_rating": _text("l_discount * 100"),
    "crime_index": _text("l_tax * 1000"),
    "distance_to_city_center_km": _text("l_quantity - 3"),
    "condition": _choose("(l_suppkey + l_partkey) % 6",
                         ["Poor", "FAIR", "good", "Excellent", "unknown", ""]),
    "days_on_market": _text(_int("floor(l_quantity * 2)")),
    "list_price": f"CASE WHEN l_orderkey % 20 = 0 THEN {_price('ask')} ELSE {_text('ask')} END",
    "sale_price": "CASE WHEN l_partkey % 211 = 0 THEN 'call for price' WHEN l_partkey % 223 = 0 "
                  f"THEN '' WHEN l_orderkey % 33 = 0 THEN {_price('sold')} "
                  f"ELSE {_text('sold')} END",
    "price_category": _choose("l_suppkey % 4", ["Low", "Medium", "HIGH", "luxury"]),
    "sold_within_30_days": "CASE WHEN l_quantity <= 15 THEN 'Yes' ELSE 'No' END",
    "row_key": "row_key",
}

_RAW_JSON = (
    "'{\"property_id\": \"p' || " + _text("event_id % 5000")
    + " || '\", \"listing_date\": \"' || "
    + "CASE WHEN event_id % 11 = 0 THEN 'unknown' ELSE '2023-0' || "
    + _text("1 + event_id % 9") + " || '-15' END"
    + " || '\", \"city\": \"' || "
    + "CASE event_type WHEN 'view' THEN 'NEW_YORK' WHEN 'click' THEN ' boston ' "
      "WHEN 'purchase' THEN 'Miami' WHEN 'signup' THEN 'denver' ELSE 'Reno' END"
    + " || '\", \"property_type\": \"' || " + _choose("event_id % 5", _TYPES)
    + " || '\", \"has_pool\": \"' || CASE WHEN user_id % 3 = 0 THEN 'Y' ELSE 'no' END"
    + " || '\"' || CASE WHEN event_id % 4 = 0 THEN '' ELSE ', \"bedrooms\": ' || "
    + _text("user_id % 8") + " END || '}'"
)

LOG_RULES = {
    "request_id": f"'r' || {_text('event_id')}",
    "timestamp": "ts",
    "raw_input": _RAW_JSON,
    "prediction": "coalesce(value, 0.0E0) * 1000",
    "probability": "least(coalesce(value, 0.0E0) / 100, 1.0E0)",
    "model_version": f"CASE WHEN ts < TIMESTAMP '{CHANGE} 00:00:00' THEN '1' ELSE '2' END",
    "model_name": f"CASE WHEN user_id % 2 = 0 THEN '{REGRESSOR}' ELSE '{CLASSIFIER}' END",
    "dt": "CAST(ts AS DATE)",
}
OUTCOME_RULES = {
    "request_id": f"'r' || {_text('event_id')}",
    "predicted_on": "CAST(ts AS DATE)",
    "actual": "CASE WHEN user_id % 2 = 0 THEN coalesce(value, 0.0E0) * 1000 "
              "* (0.9E0 + (event_id % 21) / 100.0E0) "
              "ELSE CASE WHEN (event_id * 7 + user_id) % 10 < 3 + coalesce(value, 0.0E0) / 40 "
              "THEN 1.0E0 ELSE 0.0E0 END END",
    "model_name": f"CASE WHEN user_id % 2 = 0 THEN '{REGRESSOR}' ELSE '{CLASSIFIER}' END",
    "dt": "CAST(ts AS DATE)",
}
_ISO = ("{0} || '-' || {1} || '-' || {2} || 'T' || {3} || ':' || {4} || ':' || {5}".format(
    _text("year(ts)"), _two("month(ts)"), _two("day(ts)"), _two("hour(ts)"), _two("minute(ts)"),
    _two("CAST(second(ts) AS BIGINT)")))
FEEDBACK_RULES = {
    "property_id": f"'p' || {_text('event_id % 5000')}",
    "listing_date": "CASE WHEN event_id % 2 = 0 THEN '01/15/2024' END",
    "sale_price": _text(_int("floor(coalesce(value, 1) * 1000)")),
    "record_source": "'feedback'",
    "predicted_at": f"CASE WHEN event_id % 50 = 0 THEN 'garbage' WHEN event_id % 3 = 0 THEN "
                    f"{_ISO} || '+02:00' ELSE {_ISO} END",
}


def _select(rules: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in rules.items()) + f" FROM {source}"


def _build(df: DataFrame, rules: dict[str, str], columns: list[str] | None = None) -> DataFrame:
    return df.selectExpr(*[f"{rules[n]} AS `{n}`" for n in (columns or rules)])


def raw_houses(spark: SparkSession, folder: str, columns: list[str] | None = None, *,
               file_order: bool = False) -> DataFrame:
    """A dirty all-text house table, one row per order line, ids repeated."""
    return houses_of(raw_lines(spark, folder, file_order=file_order), columns)


def houses_of(lines: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The house rows of some order lines."""
    return _build(_build(lines, _BASE), HOUSE_RULES, columns)


def keyed_lines(lines: DataFrame) -> DataFrame:
    """Order lines with the id and the key of their house row: narrower than house rows, for steps that move them."""
    return _build(lines, {c: c for c in lines.columns} | {c: e for c, e in HOUSE_RULES.items() if c == "property_id"}
                  | {"row_key": _BASE["row_key"]})


def raw_lines(spark: SparkSession, folder: str, *, file_order: bool = False) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines if file_order else spread(lines)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _build(spread(table(spark, folder, "events")), LOG_RULES)


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Two of three predictions get an outcome; every fifth of those twice."""
    events = table(spark, folder, "events")
    kept = _build(events.where("event_id % 3 <> 0"), OUTCOME_RULES)
    again = _build(events.where("event_id % 15 = 1"), OUTCOME_RULES)
    return kept.unionByName(again)


def mixed_version(spark: SparkSession, folder: str) -> DataFrame:
    """Original and feedback rows in one table."""
    original = raw_houses(spark, folder, ["property_id", "listing_date", "sale_price"])
    fresh = _build(table(spark, folder, "events"), FEEDBACK_RULES)
    return original.unionByName(fresh, allowMissingColumns=True)


HOUSES_SQL = _select(HOUSE_RULES, f"({_select(_BASE, 'lineitem')})")
PREDICTIONS_SQL = _select(LOG_RULES, "events")
OUTCOMES_SQL = (_select(OUTCOME_RULES, "events") + " WHERE event_id % 3 <> 0 UNION ALL "
                + _select(OUTCOME_RULES, "events") + " WHERE event_id % 15 = 1")
MIXED_SQL = (
    f"SELECT property_id, listing_date, sale_price, NULL AS record_source, NULL AS predicted_at "
    f"FROM ({HOUSES_SQL}) UNION ALL {_select(FEEDBACK_RULES, 'events')}"
)


# The readers of raw values, as DuckDB SQL.
def sql_money(c: str) -> str:
    bare = f"regexp_replace({c}, '[$,\\s]', '', 'g')"
    return (f"CASE WHEN regexp_full_match({bare}, '-?[0-9]+(\\.[0-9]+)?') "
            f"THEN CAST({bare} AS DOUBLE) END")


def sql_boolean(c: str) -> str:
    word = f"lower(trim({c}))"
    return (f"CASE WHEN {word} IN ('yes', 'y', '1', 'true', 't') THEN TRUE "
            f"WHEN {word} IN ('no', 'n', '0', 'false', 'f') THEN FALSE END")


def sql_day(c: str) -> str:
    return f"CAST(try_strptime(trim({c}), ['%Y-%m-%d', '%m/%d/%Y', '%d-%b-%Y']) AS DATE)"


def sql_zipcode(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '[0-9]{{5}}') THEN trim({c}) END"


def sql_words(c: str) -> str:
    return (f"nullif(trim(regexp_replace(replace(replace(lower({c}), '_', ' '), '-', ' '), "
            f"'\\s+', ' ', 'g')), '')")


def sql_number(c: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({c}), "
            f"'[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN CAST(trim({c}) AS DOUBLE) END")


_READERS = {"money": sql_money, "boolean": sql_boolean, "date": sql_day, "zipcode": sql_zipcode,
            "categorical": sql_words, "numeric": sql_number}


def sql_clean(name: str, clip: bool = True) -> str:
    column = SPEC[name]
    if column.kind == "id":
        return name
    value = _READERS[column.kind](name)
    if clip and column.bounded:
        bounded = value
        if column.low is not None:
            bounded = f"greatest({bounded}, {float(column.low)})"
        if column.high is not None:
            bounded = f"least({bounded}, {float(column.high)})"
        value = f"CASE WHEN ({value}) IS NOT NULL THEN {bounded} END"
    return value


CLEAN_SQL = ("SELECT row_key, " + ", ".join(
    f"{sql_clean(n)} AS {n}" for n in SPEC.names) + f" FROM ({HOUSES_SQL})")
LABELS_SQL = {
    "regression": sql_money("sale_price"),
    "classification": f"CASE WHEN {sql_words('condition')} IN ('poor', 'fair', 'good', 'excellent')"
                      f" THEN {sql_words('condition')} IN ('poor', 'fair') END",
}
