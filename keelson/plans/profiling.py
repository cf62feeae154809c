"""Validation report, profiles and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import clean, profile, ranking
from keelson.plans import standins as S
from keelson.plans.registry import query, rows_of
from keelson.session import materialize
from keelson.spec import NUMBER_KINDS


def _outside_sql(name: str) -> str:
    column = S.SPEC[name]
    if not column.bounded:
        return "0"
    value = S.sql_number(name)
    tests = []
    if column.low is not None:
        tests.append(f"({value}) < {float(column.low)}")
    if column.high is not None:
        tests.append(f"({value}) > {float(column.high)}")
    return f"count(*) FILTER (WHERE {' OR '.join(tests)})"


def validation_sql(source: str, blanks_missing: bool) -> str:
    """One row per column of a raw house query."""
    parts = []
    for c in S.SPEC.columns:
        missing = f"{c.name} IS NULL" + (f" OR trim({c.name}) = ''" if blanks_missing else "")
        parts.append(
            f"SELECT '{c.name}' AS \"column\", '{c.kind}' AS kind, "
            f"round(avg(CASE WHEN {missing} THEN 1.0E0 ELSE 0.0E0 END), 6) AS missing_rate, "
            f"CAST({_outside_sql(c.name)} AS BIGINT) AS out_of_bounds FROM h")
    key = "nullif(trim(property_id), '')" if blanks_missing else "property_id"
    return (f"WITH h AS ({source}), t AS (SELECT count(*) AS row_count, count(*) - count(DISTINCT "
            f"{key}) - CASE WHEN count({key}) < count(*) THEN 1 ELSE 0 END AS duplicate_rows FROM h) "
            f"SELECT * FROM t, (" + " UNION ALL ".join(parts) + ")")


@query("A1 A2 A3 P9", validation_sql(S.HOUSES_SQL, True))
def validation_report(spark, folder):
    return profile.validation_columns(
        clean.blanks_as_null(S.raw_houses(spark, folder, S.SPEC.names)), S.SPEC)


@query("A1 A2 A3", validation_sql(S.HOUSES_SQL, False))
def validation_report_nulls_only(spark, folder):
    return profile.validation_columns(S.raw_houses(spark, folder, S.SPEC.names), S.SPEC)


@query("A4", f"""
SELECT task, avg(missing) <= 0.5 AS ok, CASE WHEN avg(missing) > 0.5 THEN 1 ELSE 0 END AS n_fatal
FROM (SELECT 'regression' AS task, CASE WHEN trim(sale_price) = '' OR sale_price IS NULL
  THEN 1.0E0 ELSE 0.0E0 END AS missing FROM ({S.HOUSES_SQL}) UNION ALL
  SELECT 'classification', CASE WHEN trim(condition) = '' OR condition IS NULL THEN 1.0E0
  ELSE 0.0E0 END FROM ({S.HOUSES_SQL})) GROUP BY 1""")
def validation_verdicts(spark, folder):
    raw = S.raw_houses(spark, folder, S.SPEC.names)
    reports = profile.validate_tasks(raw, S.SPEC, list(S.SPEC.targets))
    return spark.createDataFrame([(task, r["ok"], len(r["fatal"])) for task, r in reports.items()],
                                 "task string, ok boolean, n_fatal int")


_SPARSE = "substr(row_key, 1, 1) < '5'"


@query("A4", f"""
SELECT 'absent column' AS broken, FALSE AS ok, 1 AS n_fatal
UNION ALL SELECT 'no rows', count(*) > 0, CAST(count(*) = 0 AS INTEGER) FROM ({S.HOUSES_SQL}) WHERE FALSE
UNION ALL SELECT 'sparse target', avg(missing) <= 0.5, CAST(avg(missing) > 0.5 AS INTEGER) FROM (
  SELECT CASE WHEN {_SPARSE} AND trim(sale_price) <> '' THEN 0.0E0 ELSE 1.0E0 END AS missing
  FROM ({S.HOUSES_SQL}))""")
def validation_of_broken_tables(spark, folder):
    """A table without a column, without rows, and with prices in a third of its rows."""
    raw = S.raw_houses(spark, folder, [*S.SPEC.names, "row_key"])
    whole = raw.drop("row_key")
    sparse = raw.withColumn("sale_price", F.when(F.expr(_SPARSE), F.col("sale_price")))
    broken = {"absent column": whole.drop("garage_spaces"), "no rows": whole.where("false"),
              "sparse target": sparse.drop("row_key")}
    reports = {name: profile.validate(df, S.SPEC, "regression") for name, df in broken.items()}
    return spark.createDataFrame([(name, r["ok"], len(r["fatal"])) for name, r in reports.items()],
                                 "broken string, ok boolean, n_fatal int")


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _numeric_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(1 - count({c}) / count(*), 9) AS missing_rate, "
        f"count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 6) AS p25, "
        f"round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75 "
        f"FROM ({source})" for c in columns)


def _rounded(df):
    return df.select("column", F.round("missing_rate", 9).alias("missing_rate"), "n",
                     *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min", "max",
                     *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")])


@query("A5", _numeric_sql("lineitem", _MEASURES))
def numeric_profile(spark, folder):
    return _rounded(profile.numeric_profile(rows_of(spark, folder, "lineitem"), _MEASURES))


_TAILS = (0.01, 0.1, 0.9, 0.99)


@query("A5", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {s}E0 AS share, round(quantile_cont({c}, {s}), 6) AS value FROM lineitem"
    for c in _MEASURES for s in _TAILS))
def numeric_profile_by_order_statistics(spark, folder):
    """Tails of the same columns."""
    found = ranking.linear_quantiles(rows_of(spark, folder, "lineitem"), _MEASURES, _TAILS)
    rows = [(c, s, round(v, 6)) for c, values in found.items() for s, v in zip(_TAILS, values, strict=True)]
    return spark.createDataFrame(rows, "column string, share double, value double")


def histogram_sql(source: str, columns: list[str], bins: int) -> str:
    parts = []
    for c in columns:
        parts.append(f"""
SELECT '{c}' AS "column", CAST(b AS INTEGER) AS bin,
  round(lo + (hi - lo) / {bins} * b, 6) AS low,
  round(CASE WHEN b = {bins - 1} THEN hi ELSE lo + (hi - lo) / {bins} * (b + 1) END, 6) AS high,
  count(v) AS n
FROM (SELECT CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS lo,
  CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS hi
  FROM ({source})) e CROSS JOIN range({bins}) r(b)
LEFT JOIN (SELECT {c} AS v FROM ({source}) WHERE {c} IS NOT NULL) d
  ON least(CAST(floor({bins} * (v - lo) / (hi - lo)) AS BIGINT), {bins - 1}) = b
GROUP BY b, lo, hi""")
    return " UNION ALL ".join(parts)


@query("A6", histogram_sql("lineitem", ["l_quantity", "l_extendedprice"], 20))
def histograms(spark, folder):
    binned = profile.histogram(rows_of(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"])
    return binned.select("column", "bin", F.round("low", 6).alias("low"),
                         F.round("high", 6).alias("high"), "n")


_WORDS = ["city", "state", "zipcode", "property_type", "condition", "price_category"]


def _counts_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value FROM ({source})" for c in columns)


@query("A7", "SELECT \"column\", round(1 - count(value) / count(*), 9) AS missing_rate, "
             f"count(DISTINCT value) AS n_unique FROM ({_counts_sql(_WORDS, S.CLEAN_SQL)}) GROUP BY 1")
def categorical_profile(spark, folder):
    cleaned = clean.clean_table(S.raw_houses(spark, folder, _WORDS), S.SPEC)
    return profile.categorical_profile(cleaned, _WORDS).withColumn(
        "missing_rate", F.round("missing_rate", 9))


@query("A7", "SELECT \"column\", value, count(*) AS n, round(count(*) / sum(count(*)) OVER "
             "(PARTITION BY \"column\"), 9) AS share FROM "
             f"({_counts_sql(_WORDS, S.CLEAN_SQL)}) WHERE value IS NOT NULL GROUP BY 1, 2")
def category_shares(spark, folder):
    cleaned = clean.clean_table(S.raw_houses(spark, folder, _WORDS), S.SPEC)
    return profile.distribution(cleaned, _WORDS).withColumn("share", F.round("share", 9))


_FEATURES = S.SPEC.features("regression")
_NUMBERS = [c for c in _FEATURES if S.SPEC[c].kind in NUMBER_KINDS]


def _as_number(name: str) -> str:
    return (f"CAST({name} AS DOUBLE) AS {name}" if S.SPEC[name].kind == "boolean" else name)


@query("A8 M14", _numeric_sql(f"SELECT {', '.join(_as_number(c) for c in _NUMBERS)} "
                              f"FROM ({S.CLEAN_SQL})", _NUMBERS))
def baseline_profile(spark, folder):
    """The numeric section of a cleaned table's baseline."""
    # Stored, as the profile reads its numbers several times.
    cleaned = materialize(clean.clean_table(S.raw_houses(spark, folder, _FEATURES), S.SPEC, split_date=False),
                          "cleaned")
    return _rounded(profile.compute_profile(cleaned, S.SPEC, _FEATURES)["numeric"])
