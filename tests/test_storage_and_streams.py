"""Versions, logs and caches on disk, feedback end to end, streams against batch."""

import json
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import clean, feedback, rows, splits, train, versions
from keelson.sources import logs, tables
from keelson.streaming import jobs, windows

MODEL = "house_price_regressor"
NOW = datetime(2026, 9, 26, 12, 0)


def source(spark, n=1000):
    return spark.range(n).select(
        F.concat(F.lit("p"), "id").alias("property_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).cast("string")
        .alias("listing_date"),
        F.lit("boston").alias("city"), F.lit("good").alias("condition"),
        F.lit("100000").alias("sale_price"))


def serve(spark, ids, actual):
    data = [(f"r{i}", NOW - timedelta(hours=2) + timedelta(seconds=i),
             json.dumps({"property_id": p, "listing_date": "2020-01-05", "city": "MIAMI",
                         "bedrooms": 3}), 1.0, None, "1", MODEL) for i, p in enumerate(ids)]
    predictions = spark.createDataFrame(
        data, "request_id string, timestamp timestamp, raw_input string, prediction double, "
              "probability double, model_version string, model_name string")
    outcomes = spark.createDataFrame(
        [(f"r{i}", NOW.date(), a, MODEL) for i, a in enumerate(actual)],
        "request_id string, predicted_on date, actual double, model_name string")
    return predictions, outcomes


def build(spark, spec, root, ids, actual, task="regression", name="v1-fb1"):
    predictions, outcomes = serve(spark, ids, actual)
    return versions.build_version(
        spark, root, feedback.join_outcomes(predictions, outcomes), spec, task=task,
        model_name=MODEL, source_version="v1", new_version=name, start=NOW - timedelta(days=1),
        end=NOW, columns=["property_id", "listing_date", "city", "bedrooms"],
        order=[F.col("request_id")])


@pytest.fixture
def root(spark, spec, tmp_path):
    tables.publish_version(source(spark), spec, str(tmp_path), "v1")
    return str(tmp_path)


def test_csv_stays_text(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('property_id,city,sale_price,notes\n1,"NEW YORK","$450,000",\n2,,380000,"a, b"\n'
                    '3,boston,,"say ""hi"""\n')
    assert tables.ingest_csv(spark, str(path), str(tmp_path / "out")) == 3
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("property_id").collect()
    assert [tuple(r) for r in got] == [("1", "NEW YORK", "$450,000", ""), ("2", "", "380000", "a, b"),
                                       ("3", "boston", "", 'say "hi"')]


def test_header_only_csv_writes_nothing(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("property_id,city\n")
    assert tables.ingest_csv(spark, str(path), str(tmp_path / "out")) == 0
    assert not tables.path_exists(spark, str(tmp_path / "out"))


def test_version_name_is_taken_once(spark, spec, root):
    with pytest.raises(tables.VersionExistsError):
        tables.publish_version(source(spark), spec, root, "v1")
    with pytest.raises(ValueError):
        tables.publish_version(source(spark).drop("listing_date"), spec, root, "v2")


def test_copies_are_reused(spark, spec, root):
    first, second = tables.working_copy(spark, root, "v1"), tables.working_copy(spark, root, "v1")
    assert first == second
    assert tables.data_id("a", None, 42) != tables.data_id("a", 200_000, 42)
    calls = []

    def make():
        calls.append(1)
        return spark.range(3), spark.range(2)

    for force in (False, False, True):
        learn, test = tables.prepared_sets(spark, root, "k", "regression", make, force=force)
    assert (learn.count(), test.count(), len(calls)) == (3, 2, 2)


def test_fingerprint_sees_duplicates_but_not_order(spark):
    def mark(df):
        return tuple(tables.fingerprint(df).first())
    df = spark.range(10)
    assert mark(df) == mark(df.orderBy(F.desc("id")).repartition(3))
    assert mark(df) != mark(df.union(df.where("id < 2")))


def test_head_follows_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).orderBy(F.desc("id")).coalesce(1).write.parquet(path)
    first, total = tables.head_and_total(spark.read.parquet(path), 3)
    assert [r["id"] for r in first.collect()] == [99, 98, 97] and total == 100
    with pytest.raises(ValueError):
        tables.head(spark.read.parquet(path), 0)


def test_log_window_excludes_same_day_rows_outside(spark, tmp_path):
    path = str(tmp_path / "log")
    assert logs.read_predictions(spark, path, MODEL, NOW, 1).count() == 0
    predictions, _ = serve(spark, ["a", "b"], [])
    early = predictions.withColumn("timestamp", F.col("timestamp") - F.expr("INTERVAL 5 HOURS"))
    logs.write_predictions(predictions.unionByName(early), path)
    assert logs.read_predictions(spark, path, MODEL, NOW, 2.5).count() == 2
    assert logs.read_predictions(spark, path, MODEL, NOW, 24).count() == 4
    assert len(logs.days_in_window(datetime(2026, 9, 20, 9, tzinfo=UTC), 24)) == 2


def test_feedback_replaces_and_records_lineage(spark, spec, root):
    ids = [f"p{i}" for i in range(100)] + [f"new{i}" for i in range(500)]
    manifest = build(spark, spec, root, ids, [250_000.0] * 600)
    data = tables.read_version(spark, root, "v1-fb1")
    assert data.count() == manifest["row_count"] == 1500
    assert manifest["lineage"]["feedback_records"] == "600"
    assert manifest["lineage"]["replaced_records"] == "100"
    fresh = data.where("record_source = 'feedback'")
    assert {r[0] for r in fresh.select("sale_price").distinct().collect()} == {"250000.0"}
    assert data.where("property_id = 'p0'").count() == 1
    with pytest.raises(tables.VersionExistsError):
        build(spark, spec, root, ids, [1.0] * 600)


def test_latest_feedback_is_the_test_set(spark, spec, root):
    before = tables.read_manifest(spark, root, "v1")["split_points"]
    manifest = build(spark, spec, root, [f"new{i}" for i in range(600)], [1.0] * 600)
    data = tables.read_version(spark, root, "v1-fb1")
    placed = splits.assign_split(data, spec, manifest["split_points"])
    counts = {(r[0], r[1]): r[2] for r in placed.groupBy(
        clean.record_source(placed), "set_name").count().collect()}
    simulation = splits.assign_split(source(spark), spec, before).where(
        "set_name = 'simulation'").count()
    assert counts == {("feedback", "test"): 120, ("feedback", "train"): 480,
                      ("original", "train"): 1000 - simulation,
                      ("original", "simulation"): simulation}


def test_too_little_feedback_is_refused(spark, spec, root):
    with pytest.raises(feedback.NotEnoughFeedbackError, match="500"):
        build(spark, spec, root, [f"new{i}" for i in range(499)], [1.0] * 499)
    assert not tables.dataset_exists(spark, root, "v1-fb1")


def test_observed_label_reaches_the_sets(spark, spec, root):
    manifest = build(spark, spec, root, [f"new{i}" for i in range(600)], [1.0, 0.0] * 300,
                     task="classification")
    data = tables.read_version(spark, root, "v1-fb1").withColumn(
        "row_key", F.col("property_id"))
    plan = rows.plan_rows(data, spec, "classification", manifest["split_points"], None, 42,
                          ["row_key"])
    kept = plan.train.unionByName(plan.test)
    assert kept.where("needs_renovation").count() == 300
    assert plan.counts["dropped_missing_target"] == 0


def test_twice_predicted_house_keeps_the_latest(spark, spec):
    predictions, outcomes = serve(spark, ["p1", "p1"], [100.0, 200.0])
    got = feedback.records(feedback.join_outcomes(predictions, outcomes), spec, "regression",
                           ["property_id"], [F.col("request_id")]).collect()
    assert [r["sale_price"] for r in got] == ["200.0"]


def test_missing_id_is_replaced_by_missing_id(spark):
    old = spark.createDataFrame([("a", "1"), (None, "2")], "id string, v string")
    new = spark.createDataFrame([(None, "9")], "id string, w string")
    got = feedback.merge(old, new, "id").collect()
    assert sorted(tuple(r) for r in got if r["id"]) == [("a", "1", None)]
    assert [tuple(r) for r in got if r["id"] is None] == [(None, None, "9")]
    assert feedback.replaced_count(old, new, "id").first()[0] == 1


def houses(spark, n=1500):
    return spark.range(n).select(
        F.concat(F.lit("p"), "id").alias("property_id"),
        F.when(F.col("id") % 11 > 0, F.date_add(F.lit("2015-01-01").cast("date"),
                                                F.col("id").cast("int")).cast("string"))
        .alias("listing_date"),
        F.when(F.col("id") % 3 == 0, "NEW_YORK").otherwise("boston").alias("city"),
        (F.col("id") * 7919 % 3000 + 500).cast("string").alias("living_area_sqft"),
        F.when((F.col("id") * 31 % 10) < 4, "Poor").otherwise("good").alias("condition"),
        F.when((F.col("id") * 31 % 10) < 4, "1").otherwise("9").alias("school_rating"),
    ).withColumn("sale_price", F.concat(F.lit("$"), (
        F.col("living_area_sqft").cast("int") * 100 + F.when(F.col("city") == "boston", 5000)
        .otherwise(0)).cast("string")))


def test_ridge_scores_raw_rows_and_survives_storage(spark, spec, tmp_path):
    df = houses(spark)
    model = train.fit(df, spec, "regression", "ridge", ties=[F.col("property_id")])
    got = train.scores(model.score(df.withColumn(
        train.LABEL, train.label_column(df, spec, "regression"))), "regression").first()
    assert got["r2"] > 0.999
    train.save(model, str(tmp_path / "model"))
    again = train.load(spark, str(tmp_path / "model"))
    bare = spark.createDataFrame([("BOSTON", "1000")], "city string, living_area_sqft string")
    one, two = model.score(bare).first(), again.score(bare).first()
    assert one["prediction"] == pytest.approx(two["prediction"])
    assert one["prediction"] == pytest.approx(105_000, rel=0.05)


def test_classifier_threshold_reaches_its_recall(spark, spec):
    df = houses(spark)
    model = train.fit(df, spec, "classification", "svm", ties=[F.col("property_id")],
                      settings={"maxIter": 5})
    scored = model.score(df.withColumn("truth", train.label_column(df, spec, "classification")))
    caught = scored.where("truth = 1").agg(F.avg(F.col("answer").cast("double"))).first()[0]
    assert 0 < model.threshold < 1 and caught >= 0.65


@pytest.mark.parametrize(("task", "name", "settings"), [
    ("regression", "xgboost", {"maxIter": 3, "maxDepth": 2}),
    ("regression", "random_forest", {"numTrees": 3, "maxDepth": 4}),
    ("classification", "xgboost", {"maxIter": 3, "maxDepth": 2}),
    ("classification", "random_forest", {"numTrees": 3, "maxDepth": 4}),
])
def test_tree_models_learn_from_raw_rows(spark, spec, task, name, settings):
    df = houses(spark, 600)
    model = train.fit(df, spec, task, name, ties=[F.col("property_id")], settings=settings)
    scored = model.score(df.withColumn(train.LABEL, train.label_column(df, spec, task)))
    row = train.scores(scored, task).first()
    assert row["r2"] > 0.5 if task == "regression" else row["auc"] > 0.95


def test_tuning_prefers_the_fitting_penalty(spark, spec):
    df = houses(spark, 600)
    model = train.fit(df, spec, "regression", "ridge", ties=[F.col("property_id")], tuned=True,
                      grid={"alpha": [1e9, 1.0]}, folds=3)
    assert model.settings == {"alpha": 1.0}


def test_ridge_equals_the_normal_equations(spark, spec):
    df = houses(spark, 400)
    model = train.fit(df, spec, "regression", "ridge", ties=[F.col("property_id")])
    rows_ = model.chain.transform(df).select("features", "prediction", train.label_column(
        df, spec, "regression").alias("y")).collect()
    x = np.array([r["features"].toArray() for r in rows_])
    y = np.array([r["y"] for r in rows_])
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
    want = xc @ w + y.mean()
    assert np.allclose([r["prediction"] for r in rows_], want, rtol=1e-4)


def test_estimator_of_the_other_task_is_refused():
    with pytest.raises(ValueError):
        train.build_estimator("regression", "svm", 10)


def test_unseen_category_without_rare_group_is_all_zeros(spark, spec):
    df = houses(spark)
    model = train.fit(df, spec, "regression", "ridge", ties=[F.col("property_id")])
    new = spark.createDataFrame([("atlantis",), (None,)], "city string")
    features = model.chain.transform(new).select("h_x_city").collect()
    assert features[0][0].numNonzeros() == 0 and features[1][0].numNonzeros() == 1


def test_sliding_sums_equal_plain_windows(spark):
    df = spark.range(500).select(F.timestamp_seconds(F.col("id") * 97).alias("ts"),
                                 F.lit(1.0).alias("value"))
    got = windows.window_activity(df, size="3 hours", slide="1 hour").orderBy("window_start").collect()
    want = df.groupBy(F.window("ts", "3 hours", "1 hour").alias("w")).count().orderBy(
        "w.start").collect()
    assert [(r["window_start"], r["n"]) for r in got] == [(r["w"]["start"], r["count"]) for r in want]
    with pytest.raises(ValueError):
        windows.window_activity(df, size="90 minutes", slide="1 hour")


def test_streaks_continue_over_batches(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    shape = ("model_name string, part string, run_at timestamp, model_version string, level string")
    steps = [("1", "warning"), ("1", "warning"), ("1", "warning"), ("2", "warning"), ("2", "ok")]
    for i, (version, level) in enumerate(steps):
        spark.createDataFrame([("m", "feature", NOW + timedelta(hours=i), version, level)], shape) \
            .coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(path)
    jobs.live_streaks(stream).writeStream.outputMode("update").foreachBatch(
        lambda batch, _: batch.write.mode("append").parquet(out)).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start() \
        .awaitTermination()
    got = spark.read.parquet(out).orderBy("run_at").collect()
    assert [r["streak"] for r in got] == [1, 2, 3, 1, 0]


def test_plans_prune_and_push_down(spark, tmp_path):
    path = str(tmp_path / "log")
    predictions, _ = serve(spark, ["a"], [])
    logs.write_predictions(predictions, path)
    plan = logs.read_predictions(spark, path, MODEL, NOW, 24).select("prediction") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model_name" in plan and "PushedFilters: [IsNotNull(timestamp" in plan
    assert "ReadSchema: struct<timestamp:timestamp,prediction:double>" in plan


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = rows.dedup_first(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
