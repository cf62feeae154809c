"""Ridges from sums of products, trees as expressions, monitoring from stored counts."""

from datetime import date, datetime, timedelta

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from keelson.operators import daycounts, drift, gram, history, monitor, ranking, splits, train, treescore


@pytest.fixture(scope="module")
def vectors(spark):
    """60 features, more than one aggregate row holds, most of them rarely set."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 60)) * (rng.random((700, 60)) < 0.3)
    y = x[:, :5] @ [3.0, -2.0, 1.0, 0.5, 4.0] + 50 + rng.normal(size=700)
    rows = [(k, *map(float, r), float(v)) for k, (r, v) in enumerate(zip(x, y, strict=True))]
    names = [f"f{k}" for k in range(60)]
    df = spark.createDataFrame(rows, ", ".join(["position long", *[f"{n} double" for n in names], f"{train.LABEL} double"]))
    out = VectorAssembler(inputCols=names, outputCol="features").transform(df).select("position", train.LABEL, "features")
    return out.repartition(5).cache(), x, y


def solved(x, y, alpha):
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(axis=0) @ w


def test_sums_give_every_fold(vectors):
    df, x, y = vectors
    bounds = splits.fold_bounds(700, 40, 5)
    blocks = gram.grams(df, train.LABEL, gram.block_of(F.col("position"), bounds))
    assert [b.rows for b in blocks.values()] == [150, *[110] * 5]
    alphas = [0.1, 10.0, 1000.0]
    found = gram.trials(blocks, alphas)
    assert len(found) == 15
    for t in found:
        start, end = bounds[t.fold]
        w, b = solved(x[:start], y[:start], t.alpha)
        want = np.sqrt(np.mean((y[start:end] - x[start:end] @ w - b) ** 2))
        assert (t.learned, t.scored) == (start, end - start)
        assert t.rmse == pytest.approx(want, rel=1e-9)
    assert train.tune(df, "regression", "ridge", 700, 40, grid={"alpha": alphas}) == {"alpha": gram.best_alpha(found, alphas)}


def test_whole_sums_and_edge_cases(spark, vectors):
    df, x, y = vectors
    line = gram.grams(df, train.LABEL)[0].ridge(1.0)
    w, b = solved(x, y, 1.0)
    assert np.allclose(line.weights, w)
    assert line.intercept == pytest.approx(b)
    scored = train.LinearScore.of(line).transform(df).orderBy("position").select("prediction").toPandas()["prediction"]
    assert np.allclose(scored, x @ w + b)
    assert gram.grams(df.limit(0), train.LABEL) == {}
    twin = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame([(float(k), float(k), 2.0 * k) for k in range(5)], f"a double, b double, {train.LABEL} double"))
    whole = gram.grams(twin, train.LABEL)[0]
    assert whole.rmse(whole.ridge(0.0)) == pytest.approx(0, abs=1e-6)


def test_ridge_tuning_reads_the_vectors_once(spark, vectors, monkeypatch):
    calls = []
    real = gram.grams
    monkeypatch.setattr(gram, "grams", lambda *a, **k: calls.append(1) or real(*a, **k))
    prepared = train.Prepared("regression", [], vectors[0], 700, 40, True)
    model = train.fit_prepared(prepared, "ridge", tuned=True)
    assert len(calls) == 1
    assert set(model.settings) == {"alpha"}
    with pytest.raises(ValueError, match="order"):
        train.fit_prepared(train.Prepared("regression", [], vectors[0], 700, 0, False), "ridge", tuned=True)


@pytest.fixture(scope="module")
def labelled(spark):
    df = spark.range(900).select(
        F.col("id").alias("position"), (F.col("id") * 7919 % 101).cast("double").alias("a"),
        (F.col("id") * 31 % 17).cast("double").alias("b"), (F.col("id") % 2).cast("double").alias("c"))
    df = df.withColumns({"y": F.col("a") * 3 + F.col("b") * F.col("c"),
                         "t": ((F.col("a") + 10 * F.col("c") + F.col("b")) > 60).cast("double")})
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


MODELS = [
    (GBTRegressor, {"labelCol": "y", "maxIter": 4, "maxDepth": 3, "seed": 1}),
    (RandomForestRegressor, {"labelCol": "y", "numTrees": 5, "maxDepth": 4, "seed": 1}),
    (DecisionTreeRegressor, {"labelCol": "y", "maxDepth": 5}),
    (GBTClassifier, {"labelCol": "t", "maxIter": 4, "maxDepth": 3, "seed": 1}),
    (RandomForestClassifier, {"labelCol": "t", "numTrees": 5, "maxDepth": 4, "seed": 1}),
    (DecisionTreeClassifier, {"labelCol": "t", "maxDepth": 5}),
    (RandomForestRegressor, {"labelCol": "y", "numTrees": 2, "maxDepth": 0, "seed": 1}),
]


@pytest.mark.parametrize(("kind", "settings"), MODELS)
@pytest.mark.parametrize("nodes", [0, 1024], ids=["walk", "case"])
def test_expressions_equal_the_model(spark, labelled, kind, settings, nodes, monkeypatch):
    monkeypatch.setattr(treescore, "CASE_NODES", nodes)
    model = kind(**settings).fit(labelled)
    ensemble = treescore.read_ensemble(model)
    own = F.col("prediction") if settings["labelCol"] == "y" else vector_to_array("probability")[1]
    new = spark.createDataFrame([(float("nan"), 3.0, 1.0), (-1e9, 1e9, 0.0)], "a double, b double, c double")
    new = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(new)
    rows = labelled.select("features").unionByName(new.select("features"))
    both = treescore.score(model.transform(rows), ensemble).select(own.alias("own"), "score").collect()
    assert len(both) == 902
    assert all(r["score"] == pytest.approx(r["own"], rel=1e-12, abs=1e-12) for r in both)


def test_other_engines_read_the_case_form(labelled):
    model = GBTClassifier(labelCol="t", maxIter=3, maxDepth=2, seed=1).fit(labelled)
    sql = treescore.to_sql(treescore.read_ensemble(model), lambda k: "abc"[k])
    frame = model.transform(labelled).select("a", "b", "c", vector_to_array("probability")[1].alias("own")).toPandas()
    got = duckdb.sql(f"SELECT own, {sql} AS score FROM frame").df()
    assert len(frame) == 900
    assert np.allclose(got["own"], got["score"])


def test_one_hot_entries_and_trained_chains(spark, spec):
    df = spark.range(500).select(
        F.concat(F.lit("p"), "id").alias("property_id"), F.when(F.col("id") % 3 == 0, "ny").otherwise("la").alias("city"),
        F.when(F.col("id") % 5 < 2, "condo").otherwise("land").alias("property_type"),
        F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).cast("string").alias("listing_date"),
        F.when(F.col("id") % 3 == 0, "900000").otherwise(F.when(F.col("id") % 5 < 2, "500000").otherwise("100000")).alias("sale_price"))
    model = train.fit(df, spec, "regression", "xgboost", ties=[F.col("property_id")], settings={"maxIter": 2, "maxDepth": 2})
    ensemble = treescore.read_ensemble(model.chain.stages[-1])
    scored = model.score_vectors(model.encode(df).select("property_id", "features"))
    rows = treescore.score(scored, ensemble).select("prediction", "score").collect()
    assert {round(r["prediction"]) for r in rows} == {round(r["score"]) for r in rows}
    raw = {r["property_id"]: r["prediction"] for r in model.score(df).collect()}
    assert {r["property_id"]: r["prediction"] for r in scored.collect()} == pytest.approx(raw)


def test_champion_with_the_same_encoder_shares_vectors(spark, spec):
    df = spark.range(400).select(
        F.concat(F.lit("p"), "id").alias("property_id"), F.lit("ny").alias("city"),
        (F.col("id") * 7 % 300 + 500).cast("string").alias("living_area_sqft"),
        (F.col("id") * 7 % 300 * 100).cast("string").alias("sale_price"))
    prepared = train.prepare(df, spec, "regression", ties=[F.col("property_id")])
    mine, rival = (train.fit_prepared(prepared, "ridge", settings={"alpha": a}) for a in (1.0, 1e6))
    alone = train.fit(df, spec, "regression", "ridge", ties=[F.col("property_id")], settings={"alpha": 1e6})
    assert mine.encodes_like(rival)
    assert not mine.encodes_like(alone)
    one, two = (train.evaluate_job(df, spec, "regression", mine, r, df)[0].first().asDict() for r in (rival, alone))
    assert one == pytest.approx(two)


def log_rows(spark, n=600):
    return spark.range(n).select(
        "id", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 1777).alias("timestamp"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 13).cast("double")).alias("x"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), (F.col("id") % 4).cast("string"))).alias("town")).withColumn(
        "dt", F.to_date("timestamp"))


def plain(df):
    return sorted((tuple(r) for r in df.select("column", "value", "number", "n").collect()), key=repr)


def test_late_days_are_counted_again_and_only_those(spark, tmp_path):
    log, path = log_rows(spark), str(tmp_path / "counts")
    early = log.where("id < 300 and id % 50 <> 3")
    first = daycounts.refresh(early, path, ["x"], ["town"])
    assert first[0] == date(2024, 1, 1)
    assert daycounts.refresh(early, path, ["x"], ["town"]) == []
    late = log.where("id < 300 and (id % 50 <> 3 or id = 103)")
    day = log.where("id = 103").first()["dt"]
    assert daycounts.refresh(late, path, ["x"], ["town"]) == [day]
    daycounts.refresh(log, path, ["x"], ["town"])
    counts = daycounts.read(spark, path)
    assert plain(daycounts.merged(counts.where("column <> ''"))) == plain(daycounts.count_values(log, ["x"], ["town"]))
    assert counts.where("column = ''").agg(F.sum("n")).first()[0] == 600


@pytest.mark.parametrize(("start", "end"), [
    (datetime(2024, 1, 2, 3, 17), datetime(2024, 1, 7, 9, 1, 13)), (datetime(2024, 1, 2), datetime(2024, 1, 3)),
    (datetime(2024, 1, 4, 5, 10), datetime(2024, 1, 4, 5, 50)), (datetime(2024, 1, 4, 5, 10), datetime(2024, 1, 4, 6, 20)),
    (datetime(2024, 1, 1), datetime(2024, 1, 1)), (datetime(2023, 1, 1), datetime(2023, 6, 1))])
def test_windows_equal_the_raw_rows(spark, tmp_path, start, end):
    log, path = log_rows(spark), str(tmp_path / "counts")
    daycounts.refresh(log, path, ["x"], ["town"])
    got = daycounts.window(log, path, start, end, ["x"], ["town"])
    raw = log.where(F.col("timestamp").between(F.lit(start), F.lit(end)))
    assert plain(got.where("column <> ''")) == plain(daycounts.count_values(raw, ["x"], ["town"]))
    assert got.where("column = ''").agg(F.sum("n")).first()[0] == raw.count()


def test_drift_and_quality_of_counts_equal_those_of_rows(spark, tmp_path):
    log = log_rows(spark).withColumn("few", F.when(F.col("id") > 300, F.lit(1.0)).otherwise(F.col("id") % 2).cast("double"))
    log = log.withColumn("town", F.when(F.col("id") > 500, F.lit("new")).otherwise(F.col("town")))
    a, b = log.where("id < 350"), log.where("id >= 350")
    ca, cb = (daycounts.count_values(d, ["x", "few"], ["town"]) for d in (a, b))
    want = {r["column"]: r.asDict() for r in drift.drift_table(a, b, ["x", "few"], ["town"]).collect()}
    got = {r["column"]: r.asDict() for r in daycounts.drift_table(ca, cb, ["x", "few"], ["town"]).collect()}
    for c, row in want.items():
        assert got[c] == pytest.approx(row)
    known = daycounts.known_categories(ca, ["town"])
    mine = {r[0]: tuple(r)[1:] for r in daycounts.quality_numbers(cb, ["x", "few"], ["town"], known).select(
        "column", "missing_share", "unseen_share").collect()}
    theirs = {r[0]: tuple(r)[1:] for r in drift.quality_numbers(b, ["x", "few"], ["town"], known).select(
        "column", "missing_share", "unseen_share").collect()}
    assert mine.keys() == theirs.keys()
    assert all(mine[c] == pytest.approx(theirs[c]) for c in mine)


def test_a_run_with_stored_reference_counts_is_the_same(spark, spec, tmp_path):
    df = spark.range(300).select(
        F.concat(F.lit("p"), "id").alias("property_id"), F.when(F.col("id") % 3 == 0, "NEW_YORK").otherwise("boston").alias("city"),
        (F.col("id") * 7919 % 3000 + 500).cast("string").alias("living_area_sqft"),
        ((F.col("id") * 7919 % 3000 + 500) * 100).cast("string").alias("sale_price"))
    model = train.fit(df, spec, "regression", "ridge", ties=[F.col("property_id")])
    log = model.score(df).select(
        F.col("property_id").alias("request_id"), F.lit(datetime(2024, 5, 1)).alias("timestamp"),
        F.to_json(F.struct("city", "living_area_sqft")).alias("raw_input"), "prediction", F.lit(None).cast("double").alias("probability"),
        F.lit("m").alias("model_name"), F.lit("1").alias("model_version"), F.lit(date(2024, 5, 1)).alias("dt"))
    outcomes = log.select("request_id", F.col("dt").alias("predicted_on"), F.col("prediction").alias("actual"), "model_name", "dt")
    given = {"model_name": "m", "model_version": "1", "reference_scores": {"rmse": 1.0}, "run_id": "r",
             "now": datetime(2024, 5, 1) + timedelta(hours=1)}
    path = str(tmp_path / "reference")
    built = []

    def build():
        built.append(1)
        return monitor.count_reference(df, model, spec)
    plainly = monitor.summarize(log, outcomes, df, model, spec, **given).first()
    for _ in range(2):
        counts = daycounts.stored_once(path, spark, build)
        assert monitor.summarize(log, outcomes, df.limit(0), model, spec, reference_counts=counts, **given).first() == plainly
    assert built == [1]
    assert plainly["parts"]["prediction"] == "ok"


def test_ancestors_of_versions(spark):
    kind = "version string, source_version string"
    rows = [("v1", None), ("v2", "v1"), ("v3", "v2"), ("v3", "side"), ("v4", "v3"), ("v4", "v3"), (None, "v1")]
    found = {tuple(r) for r in history.ancestors(spark.createDataFrame(rows, kind)).collect()}
    assert found == {("v2", "v1", 1), ("v3", "v2", 1), ("v3", "side", 1), ("v3", "v1", 2),
                     ("v4", "v3", 1), ("v4", "v2", 2), ("v4", "side", 2), ("v4", "v1", 3)}
    assert history.ancestors(spark.createDataFrame([], kind)).count() == 0
    for circle in ([("a", "a")], [("a", "b"), ("b", "c"), ("c", "b")]):
        with pytest.raises(Exception, match="own ancestor"):
            history.ancestors(spark.createDataFrame(circle, kind)).collect()


@pytest.mark.parametrize("margin", [0.002, 0.2, -0.3])
def test_sketched_statistics_are_exact_in_two_reads(spark, margin, monkeypatch):
    """A bracket that misses (negative margin) falls back to narrowing."""
    rng = np.random.default_rng(1)
    a = np.concatenate([rng.normal(size=20_000), [np.inf, -np.inf, np.nan], np.full(5000, 0.25)])
    b = rng.integers(0, 7, len(a)).astype(float)
    path_rows = [(float(x), float(y), None) for x, y in zip(a, b, strict=True)]
    stored = spark.createDataFrame(path_rows, "a double, b double, c double").repartition(4).cache()
    read = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    table = stored.mapInArrow(watched, stored.schema)
    fell_back = []
    real = ranking.order_statistics
    monkeypatch.setattr(ranking, "order_statistics", lambda *x, **y: fell_back.append(1) or real(*x, **y))
    clean_a, n = np.sort(a[~np.isnan(a)]), len(a)
    ranks = {"a": [0, 1, 777, 12_500, len(clean_a) - 1, 10**9], "b": [0, n // 2, n - 1], "c": [0]}
    found = ranking.sketched_statistics(table, ranks, margin=margin)
    assert found == {"a": {r: clean_a[r] for r in ranks["a"][:-1]}, "b": {r: np.sort(b)[r] for r in ranks["b"]}, "c": {}}
    if margin > 0:
        assert not fell_back
        assert read.value == 2 * n
    else:
        assert fell_back
    assert ranking.sketched_statistics(stored.limit(0), {"a": [0]}) == {"a": {}}
