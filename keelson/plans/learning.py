"""Penalties picked from sums of products, and trees scored by expressions."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from keelson.operators import clean, gram, ranking, splits, train, treescore
from keelson.plans import standins as S
from keelson.plans.encoding import _sets
from keelson.plans.registry import query, rows_of
from keelson.session import materialize

ALPHAS = [0.1, 1.0, 10.0, 1e4, 1e6]
_PAIR = ["school_rating", "distance_to_city_center_km"]
_ORDERED_PAIRS_SQL = f"""
SELECT *, CASE WHEN position >= n - 5 * size THEN (position - (n - 5 * size)) // size + 1 ELSE 0 END AS block FROM (
  SELECT *, (n - undated) // 6 AS size FROM (
    SELECT x1, x2, y, row_number() OVER (ORDER BY day NULLS FIRST, row_key) - 1 AS position, count(*) OVER () AS n,
      count(*) FILTER (WHERE day IS NULL) OVER () AS undated
    FROM (SELECT DISTINCT row_key, {S.sql_day('listing_date')} AS day, CAST({S.sql_clean(_PAIR[0])} AS DOUBLE) AS x1,
      CAST({S.sql_clean(_PAIR[1])} AS DOUBLE) AS x2, {S.sql_money('sale_price')} AS y FROM ({S.HOUSES_SQL}))
    WHERE y IS NOT NULL))"""


def _line_sql(rows: str, keys: str) -> str:
    """Closed form of a ridge on two columns, for each ``alpha`` and key."""
    return f"""
SELECT {keys}, alpha, learned, m1, m2, my, ((c22 + alpha) * c1y - c12 * c2y) / det AS w1,
  ((c11 + alpha) * c2y - c12 * c1y) / det AS w2 FROM (SELECT *, (c11 + alpha) * (c22 + alpha) - c12 * c12 AS det FROM (
    SELECT {keys}, count(*) AS learned, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) * count(*) AS c11,
      var_pop(x2) * count(*) AS c22, covar_pop(x1, x2) * count(*) AS c12, covar_pop(x1, y) * count(*) AS c1y,
      covar_pop(x2, y) * count(*) AS c2y FROM ({rows}) GROUP BY {keys}),
    (SELECT unnest([{", ".join(f"{a!r}::DOUBLE" for a in ALPHAS)}]) AS alpha))"""


_TRIALS_SQL = f"""
WITH o AS ({_ORDERED_PAIRS_SQL}),
learn AS ({_line_sql("SELECT fold, o.* FROM o, (SELECT unnest(range(0, 5)) AS fold) WHERE block <= fold", "fold")})
SELECT alpha, CAST(fold AS INTEGER) AS fold, learned, count(*) AS scored,
  round(sqrt(avg((y - my - w1 * (x1 - m1) - w2 * (x2 - m2)) ** 2)), 4) AS rmse
FROM learn JOIN o ON o.block = learn.fold + 1 GROUP BY ALL"""


def _pairs(spark, folder):
    """Two columns and the label of every distinct house, in training order, as vectors."""
    raw = S.raw_houses(spark, folder, ["row_key", "listing_date", "sale_price", *_PAIR]).distinct()
    labelled = raw.select("row_key", "listing_date", train.label_column(raw, S.SPEC, "regression").alias(train.LABEL), *[
        clean.parse.clip(clean.read_as(S.SPEC[c].kind, F.col(c), raw.schema[c].dataType), S.SPEC[c].low, S.SPEC[c].high)
        .cast("double").alias(c) for c in _PAIR]).where(f"{train.LABEL} is not null")
    ordered = splits.training_order(labelled, S.SPEC, [F.col("row_key")])
    vectors = VectorAssembler(inputCols=_PAIR, outputCol="features").transform(ordered)
    return materialize(vectors.select(train.LABEL, "position", "_moment", "features"), "pairs")


def _tuned(spark, folder):
    vectors = _pairs(spark, folder)
    size = vectors.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_moment").isNull()).alias("undated")).first()
    return train.tune_ridge(vectors, size["rows"], size["undated"], grid={"alpha": ALPHAS})


@query("M8 T8", _TRIALS_SQL)
def ridge_trials(spark, folder):
    """Every penalty on every forward fold, from one pass over the vectors."""
    _, _, found = _tuned(spark, folder)
    return spark.createDataFrame([(t.alpha, t.fold, t.learned, t.scored, round(t.rmse, 4)) for t in found],
                                 "alpha double, fold int, learned long, scored long, rmse double")


@query("M6 M8", f"""
WITH trials AS ({_TRIALS_SQL}), o AS ({_ORDERED_PAIRS_SQL}),
best AS (SELECT alpha FROM trials GROUP BY alpha ORDER BY avg(rmse), alpha LIMIT 1),
line AS ({_line_sql("SELECT 0 AS k, * FROM o", "k")})
SELECT alpha, learned, round(w1, 4) AS w1, round(w2, 4) AS w2, round(my - w1 * m1 - w2 * m2, 4) AS intercept,
  (SELECT round(sqrt(avg((y - my - w1 * (x1 - m1) - w2 * (x2 - m2)) ** 2)), 4) FROM o) AS rmse
FROM line JOIN best USING (alpha)""")
def tuned_line(spark, folder):
    """The line of the best penalty over all rows, from the same sums."""
    settings, blocks, _ = _tuned(spark, folder)
    whole = sum(list(blocks.values())[1:], blocks[0])
    line = whole.ridge(settings["alpha"])
    return spark.createDataFrame(
        [(settings["alpha"], whole.rows, *(round(w, 4) for w in line.weights), round(line.intercept, 4),
          round(whole.rmse(line), 4))],
        "alpha double, learned long, w1 double, w2 double, intercept double, rmse double")


# A tree of one split on columns of few values has a closed form: the split between two
# neighbouring values that leaves the least squared error (or impurity).
_STUMP_COLUMNS = {"x1": "l_linenumber", "x2": "floor(l_quantity / 5)", "x3": "l_partkey % 5"}
_STUMP_ROWS_SQL = (f"SELECT {', '.join(f'CAST({e} AS DOUBLE) AS {c}' for c, e in _STUMP_COLUMNS.items())}, "
                   f"row_key, sold AS y, CASE WHEN l_quantity + l_partkey % 7 < 24 THEN 1.0E0 ELSE 0.0E0 END AS t "
                   f"FROM ({S._select(S._BASE, 'lineitem')})")


def _stump_sql(rows: str, y: str, gain: str) -> str:
    """The best split of ``rows`` by ``y``: column, threshold, mean on both sides."""
    longs = " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS x, {y} AS y FROM {rows}" for c in _STUMP_COLUMNS)
    return f"""
SELECT c, (x + above) / 2 AS cut, s / n AS low, (total - s) / (rows - n) AS high FROM (
  SELECT c, x, lead(x) OVER w AS above, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(n) OVER (PARTITION BY c) AS rows,
    sum(s) OVER (PARTITION BY c) AS total FROM (SELECT c, x, count(*) AS n, sum(y) AS s FROM ({longs}) GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY c ORDER BY x)) WHERE above IS NOT NULL ORDER BY {gain} DESC, c, x LIMIT 1"""


def _side_sql(stump: str) -> str:
    entry = f"CASE {stump}.c " + " ".join(f"WHEN '{c}' THEN {c}" for c in _STUMP_COLUMNS) + " END"
    return f"CASE WHEN {entry} <= {stump}.cut THEN {stump}.low ELSE {stump}.high END"


_SQUARES = "s * s / n + (total - s) * (total - s) / (rows - n)"
_GINI = ("(s * s + (n - s) * (n - s)) / n + "
         "((total - s) * (total - s) + (rows - n - total + s) * (rows - n - total + s)) / (rows - n)")


def _stump_vectors(spark, folder):
    lines = S._build(S.raw_lines(spark, folder), S._BASE)
    rows = lines.select("row_key", *[F.expr(e).cast("double").alias(c) for c, e in _STUMP_COLUMNS.items()],
                        F.col("sold").alias("y"),
                        F.when(F.expr("l_quantity + l_partkey % 7 < 24"), 1.0).otherwise(0.0).alias("t"))
    return materialize(VectorAssembler(inputCols=list(_STUMP_COLUMNS), outputCol="features").transform(rows)
                       .select("row_key", "y", "t", "features"), "stumps")


@query("M6 M9", f"""
WITH r AS ({_STUMP_ROWS_SQL}), one AS ({_stump_sql("r", "y", _SQUARES)}),
p AS (SELECT r.*, {_side_sql("one")} AS first FROM r, one), g AS (SELECT *, 2 * (y - first) AS rest FROM p),
two AS ({_stump_sql("g", "rest", _SQUARES)})
SELECT row_key, round(first + 0.5E0 * ({_side_sql("two")}), 4) AS prediction FROM g, two""")
def boosted_stumps_scored(spark, folder):
    """Two boosted splits learned from all rows, compiled, and all rows scored by the expression."""
    vectors = _stump_vectors(spark, folder)
    model = GBTRegressor(featuresCol="features", labelCol="y", maxIter=2, maxDepth=1, stepSize=0.5, seed=train.SEED).fit(vectors)
    return treescore.score(vectors, treescore.read_ensemble(model)).select(
        "row_key", F.round("score", 4).alias("prediction"))


@query("M7 M9", f"""
WITH r AS ({_STUMP_ROWS_SQL}), one AS ({_stump_sql("r", "t", _GINI)})
SELECT row_key, round({_side_sql("one")}, 6) AS probability FROM r, one""")
def forest_stump_scored(spark, folder):
    """One split of classes learned from all rows, compiled, and all rows scored by the expression."""
    vectors = _stump_vectors(spark, folder)
    model = RandomForestClassifier(featuresCol="features", labelCol="t", numTrees=1, maxDepth=1, bootstrap=False,
                                   featureSubsetStrategy="all", seed=train.SEED).fit(vectors)
    return treescore.score(vectors, treescore.read_ensemble(model)).select(
        "row_key", F.round("score", 6).alias("probability"))


def _tree_run(spark, folder, task, name, settings):
    """Test scores of a tree model, and how far its expression is from it at most."""
    learn, test = _sets(spark, folder, task)
    model = train.fit(learn, S.SPEC, task, name, ties=[F.col("row_key")], settings=settings)
    labelled = test.withColumn(train.LABEL, train.label_column(test, S.SPEC, task)).where(f"{train.LABEL} is not null")
    vectors = materialize(model.encode(labelled).select(train.LABEL, "features"), "vectors")
    scored = model.score_vectors(vectors)
    ensemble = treescore.read_ensemble(model.chain.stages[-1])
    own = "prediction" if task == "regression" else "probability"
    away = F.abs(F.col("score") - F.col(own)) / F.greatest(F.abs(own), F.lit(1.0))
    gap = treescore.score(scored, ensemble).agg(F.max(away).alias("gap")).first()["gap"]
    return train.scores(scored, task).withColumns({
        "threshold": F.lit(model.threshold).cast("double"), "nodes": F.lit(len(ensemble.feature)),
        "trees": F.lit(len(ensemble.roots)), "agrees": F.lit(gap is not None and gap < 1e-9)})


@query("M6 M9 M12")
def boosted_regression_run(spark, folder):
    return _tree_run(spark, folder, "regression", "xgboost", {"maxIter": 12, "maxDepth": 4, "stepSize": 0.3})


@query("M6 M9 M12")
def forest_regression_run(spark, folder):
    return _tree_run(spark, folder, "regression", "random_forest", {"numTrees": 16, "maxDepth": 8})


@query("M7 M9 M10 M12")
def boosted_classification_run(spark, folder):
    return _tree_run(spark, folder, "classification", "xgboost", {"maxIter": 12, "maxDepth": 4, "stepSize": 0.3})


@query("M7 M9 M10 M12")
def forest_classification_run(spark, folder):
    return _tree_run(spark, folder, "classification", "random_forest", {"numTrees": 16, "maxDepth": 8})


_RANKED = ["l_extendedprice", "l_quantity", "l_discount"]


@query("A5 M1 T9", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", k, {c} AS value FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS k,
  count(*) OVER () AS n FROM lineitem) WHERE k IN (0, n // 4, n // 2, 3 * n // 4, n - 1)""" for c in _RANKED))
def order_statistics_by_sketch(spark, folder):
    """Exact order statistics in two reads: a sketch brackets each rank, a count finds it."""
    lines = rows_of(spark, folder, "lineitem")
    n = lines.count()
    ranks = [0, n // 4, n // 2, 3 * n // 4, n - 1]
    found = ranking.sketched_statistics(lines, dict.fromkeys(_RANKED, ranks))
    return spark.createDataFrame([(c, r, v) for c, values in found.items() for r, v in sorted(values.items())],
                                 "column string, k long, value double")
