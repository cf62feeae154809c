"""What the encoder learns, and models trained on whole tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keelson.operators import clean, encode, rows, splits, train
from keelson.operators.profile import rank_per_column, value_counts
from keelson.plans import standins as S
from keelson.plans.registry import query, table
from keelson.plans.profiling import histogram_sql
from keelson.plans.splitting import HOUSE_POINTS_SQL, house_rules, set_name_sql
from keelson.session import materialize
from keelson.spec import NUMBER_KINDS

_NUMBERS = ["lot_size_sqft", "bedrooms", "school_rating", "has_pool"]
_WORDS = ["city", "zipcode", "property_type", "condition"]


def _long(columns, cast="VARCHAR"):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS {cast}) AS value "
                              f"FROM ({S.CLEAN_SQL})" for c in columns)


def _cleaned(spark, folder, columns):
    return clean.clean_table(S.raw_houses(spark, folder, columns), S.SPEC, split_date=False,
                             numeric_booleans=True)


@query("M1", "SELECT \"column\", round(quantile_cont(value, 0.5), 6) AS median "
             f"FROM ({_long(_NUMBERS, 'DOUBLE')}) GROUP BY 1")
def medians(spark, folder):
    found = encode.medians(_cleaned(spark, folder, _NUMBERS), _NUMBERS)
    return spark.createDataFrame([(c, round(m, 6)) for c, m in found.items()],
                                 "column string, median double")


MODES_SQL = (f"SELECT \"column\", value AS mode, n FROM (SELECT *, row_number() OVER (PARTITION BY "
             f"\"column\" ORDER BY n DESC, value) AS nth FROM (SELECT \"column\", value, count(*) AS n "
             f"FROM ({_long(_WORDS)}) WHERE value IS NOT NULL GROUP BY 1, 2)) WHERE nth = 1")


@query("M2", MODES_SQL)
def modes(spark, folder):
    return rank_per_column(value_counts(_cleaned(spark, folder, _WORDS), _WORDS))


@query("M3", "SELECT " + ", ".join(
    f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std" for c in _NUMBERS)
    + " FROM (SELECT " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM "
    f"({S.CLEAN_SQL}))) AS {c}" for c in _NUMBERS) + f" FROM ({S.CLEAN_SQL}))")
def scales(spark, folder):
    learned = encode.fit_encoding(_cleaned(spark, folder, _NUMBERS), _NUMBERS, [])
    row = {f"{c}_mean": round(learned.means[c], 6) for c in _NUMBERS}
    row |= {f"{c}_std": round(learned.deviations[c], 6) for c in _NUMBERS}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" for c in row))


@query("M4 M2", f"""
SELECT "column", value, n, n < 0.01E0 * sum(n) OVER (PARTITION BY "column") AS is_rare FROM (
  SELECT l."column", coalesce(l.value, m.mode) AS value, count(*) AS n FROM ({_long(_WORDS)}) l
  JOIN ({MODES_SQL}) m ON l."column" = m."column" GROUP BY 1, 2)""")
def category_groups(spark, folder):
    return encode.category_groups(_cleaned(spark, folder, _WORDS), _WORDS)


@query("M1 M2 M3 M4 M5")
def encoded_features(spark, folder):
    """Length and sum of the feature vector of every raw row."""
    raw = S.raw_houses(spark, folder)
    read = materialize(encode.RawFeatures.of(S.SPEC, "classification").transform(raw), "features")
    numeric, categorical = S.SPEC.encoded_features("classification")
    learned = encode.fit_encoding(read, [f"x_{c}" for c in numeric],
                                  [f"x_{c}" for c in categorical])
    ready = read
    for stage in encode.encoder_stages(read, learned):
        ready = stage.transform(ready)
    vector = vector_to_array("features")
    return ready.select("row_key", F.size(vector).alias("width"),
                        F.round(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x), 6)
                        .alias("total"))


def _sets(spark, folder, task):
    """Train and test rows of the house table, as the plan has stored them."""
    raw = S.raw_houses(spark, folder)
    plan = rows.plan_rows(raw, S.SPEC, task, house_rules(spark, folder), None, 42,
                          ["row_key"])
    return plan.train, plan.test


@query("M6 M9 M11 M12 M13 J5 J8")
def ridge_training_run(spark, folder):
    """Verdict of a ridge candidate against a more regularized champion."""
    learn, test = _sets(spark, folder, "regression")
    ties = [F.col("row_key")]
    prepared = train.prepare(learn, S.SPEC, "regression", ties=ties)
    candidate, run = train.train_job(learn, S.SPEC, "regression", "ridge", "run-1", "data-1", "v1",
                                     ties=ties, prepared=prepared)
    champion = train.fit_prepared(prepared, "ridge", settings={"alpha": 1e6})
    verdict, _ = train.evaluate_job(test, S.SPEC, "regression", candidate, champion, learn)
    return verdict.withColumn("train_r2", F.lit(run.first()["train_r2"]))


@query("M7 M9 M10 M12 A13 T7 T9")
def svm_training_run(spark, folder):
    """Group scores of a calibrated linear classifier at its own threshold."""
    learn, test = _sets(spark, folder, "classification")
    model = train.fit(learn, S.SPEC, "classification", "svm", ties=[F.col("row_key")])
    _, groups = train.evaluate_job(test, S.SPEC, "classification", model, None, None)
    return groups.withColumn("threshold", F.lit(model.threshold))


@query("M8 T8")
def tuned_ridge(spark, folder):
    """Test scores of a ridge whose penalty was picked on forward folds."""
    learn, test = _sets(spark, folder, "regression")
    model = train.fit(learn, S.SPEC, "regression", "ridge", ties=[F.col("row_key")], tuned=True)
    labelled = test.withColumn(train.LABEL, train.label_column(test, S.SPEC, "regression"))
    return train.scores(model.score(labelled), "regression").withColumn(
        "alpha", F.lit(model.settings["alpha"]))


@query("T9 A11", """
SELECT c_nationkey % 5 AS bucket, CASE WHEN count(*) FILTER (WHERE pos) = 0 THEN 0.5E0 ELSE
  min(score) FILTER (WHERE pos AND nth <= needed) END AS threshold
FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey % 5, pos ORDER BY score DESC) AS nth,
  greatest(ceil(0.7E0 * count(*) FILTER (WHERE pos) OVER (PARTITION BY c_nationkey % 5)), 1) AS needed
  FROM (SELECT c_nationkey, c_acctbal / 10000 AS score, c_mktsegment = 'BUILDING' AS pos
  FROM customer)) GROUP BY 1""")
def recall_thresholds(spark, folder):
    scored = table(spark, folder, "customer").select(
        (F.col("c_nationkey") % 5).alias("bucket"), (F.col("c_acctbal") / 10000).alias("score"),
        (F.col("c_mktsegment") == "BUILDING").alias("pos"))
    found = train.choose_thresholds(scored, F.col("bucket"), F.col("pos"), F.col("score"))
    return spark.createDataFrame(sorted(found.items()), "bucket int, threshold double")


_FEATURES = S.SPEC.features("regression")
_SHARED = [c for c in _FEATURES if S.SPEC[c].kind not in NUMBER_KINDS]
_TRAIN_SQL = (f"SELECT {', '.join(f'{S.sql_clean(c)} AS {c}' for c in _FEATURES)} FROM (SELECT h.* FROM "
              f"({S.HOUSES_SQL}) h, ({HOUSE_POINTS_SQL}) WHERE {set_name_sql(S.sql_day('listing_date'))} = 'train')")
_MEASURED = [c for c in _FEATURES if S.SPEC[c].kind in NUMBER_KINDS]
_NUMBERS_SQL = f"SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _MEASURED)} FROM ({_TRAIN_SQL})"


def _baseline(spark, folder):
    """The sections of the train set's baseline."""
    from keelson.operators import profile
    raw = S.raw_houses(spark, folder)
    placed = splits.assign_split(raw, S.SPEC, house_rules(spark, folder)).where(
        "set_name = 'train'").drop("set_name")
    cleaned = materialize(clean.clean_table(placed, S.SPEC, split_date=False), "baseline")
    return profile.compute_profile(cleaned, S.SPEC, _FEATURES)


@query("M14 A8", histogram_sql(_NUMBERS_SQL, _MEASURED, 20))
def promotion_baseline(spark, folder):
    """Histogram section of the train set's baseline."""
    return _baseline(spark, folder)["histogram"].select(
        "column", "bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


def _as_text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


_WORDS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {_as_text(c)} AS value FROM ({_TRAIN_SQL})" for c in _SHARED)


@query("M14 A8", f"""
SELECT "column", NULL AS value, round(1 - count(value) / count(*), 9) AS share, count(DISTINCT value) AS n
FROM ({_WORDS_SQL}) GROUP BY 1
UNION ALL SELECT "column", value, round(count(*) / sum(count(*)) OVER (PARTITION BY "column"), 9), count(*)
FROM ({_WORDS_SQL}) WHERE value IS NOT NULL GROUP BY 1, 2""")
def promotion_baseline_categories(spark, folder):
    """Its categories: missing share and distinct values (null value), and the share of each value."""
    found = _baseline(spark, folder)
    missing = found["categorical"].select("column", F.lit(None).cast("string").alias("value"),
                                          F.round("missing_rate", 9).alias("share"), F.col("n_unique").alias("n"))
    return missing.unionByName(found["distribution"].select(
        "column", "value", F.round("share", 9).alias("share"), "n"))
