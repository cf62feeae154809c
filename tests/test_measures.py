"""Validation, profiles, scores, gates, drift and grading."""

import json

import math

import pytest
from pyspark.sql import functions as F

from keelson.operators import drift, history, metrics, monitor, profile, scenario, train


def valid_rows(spark, spec, n=4):
    data = [tuple(f"p{i}" if c == "property_id" else "1" for c in spec.names) for i in range(n)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in spec.names))


def test_valid_table_is_ok(spark, spec):
    report = profile.validate(valid_rows(spark, spec), spec, "regression")
    assert report["ok"] and report["row_count"] == 4 and report["duplicate_rows"] == 0
    assert report["columns"]["year_built"]["out_of_bounds"] == 4


def test_fatal_reasons(spark, spec):
    base = valid_rows(spark, spec)
    assert "absent" in profile.validate(base.drop("city"), spec, "regression")["fatal"][0]
    assert profile.validate(base.limit(0), spec, "regression")["fatal"] == ["no rows"]
    half = base.withColumn("sale_price", F.when(F.col("property_id").isin("p0", "p1"), "5"))
    assert profile.validate(half, spec, "regression")["ok"]
    most = base.withColumn("sale_price", F.when(F.col("property_id") == "p0", "5"))
    assert not profile.validate(most, spec, "regression")["ok"]
    assert profile.validate(most, spec, "classification")["ok"]


def test_blank_counts_as_missing_only_when_asked(spark, spec):
    df = valid_rows(spark, spec).withColumn("city", F.lit(" "))
    assert profile.validate(df, spec, "regression")["columns"]["city"]["missing_rate"] == 1.0
    raw = profile.validate(df, spec, "regression", blanks_missing=False)
    assert raw["columns"]["city"]["missing_rate"] == 0.0


def test_duplicates_count_missing_ids_as_one(spark, spec):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,)], "property_id string")
    assert profile.validation_row(df, spec).first()["duplicate_rows"] == 3


def test_numeric_profile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v double")
    row = profile.numeric_profile(df, ["v"]).first()
    assert (row["missing_rate"], row["mean"], row["std"]) == (0.25, 2.0, 1.0)
    assert (row["p25"], row["p50"], row["p75"]) == (1.5, 2.0, 2.5)
    bins = profile.histogram(df, ["v"], 2).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [1, 2]
    assert [(r["low"], r["high"]) for r in bins] == [(1.0, 2.0), (2.0, 3.0)]


def test_all_missing_column_has_no_statistics(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    row = profile.numeric_profile(df, ["v"]).first()
    assert row["missing_rate"] == 1.0 and row["mean"] is None and row["p50"] is None


def test_single_value_histogram_is_centred(spark):
    df = spark.createDataFrame([(5.0,)] * 3, "v double")
    bins = profile.histogram(df, ["v"], 4).orderBy("bin").collect()
    assert (bins[0]["low"], bins[-1]["high"]) == (4.5, 5.5)
    assert [r["n"] for r in bins] == [0, 0, 3, 0]


def test_category_shares_sum_to_one(spark):
    df = spark.createDataFrame([("boston",), ("boston",), ("miami",), (None,)], "city string")
    assert {r["value"]: r["share"] for r in profile.distribution(df, ["city"]).collect()} == \
        pytest.approx({"boston": 2 / 3, "miami": 1 / 3})
    row = profile.categorical_profile(df, ["city"]).first()
    assert (row["missing_rate"], row["n_unique"]) == (0.25, 2)


def test_scores_without_anything_to_divide_by(spark):
    df = spark.createDataFrame([(False, False)] * 3, "t boolean, a boolean")
    assert metrics.classification(df, "t", "a").first().asDict() == {
        "f1": 0.0, "precision": 0.0, "recall": 0.0, "accuracy": 1.0}


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(True, 0.5), (False, 0.5), (True, 0.9), (False, 0.1)],
                               "t boolean, s double")
    assert metrics.auc(df, "t", "s").first()["auc"] == pytest.approx(3.5 / 4)
    assert metrics.auc(df.where("t"), "t", "s").first()["auc"] is None


def test_small_group_keeps_its_count_only(spark):
    data = [("Boston", 1.0, 2.0)] * 5 + [("boston ", 3.0, 3.0)] + [("Tulsa", 1.0, 1.0), (None, 1., 1.)]
    df = spark.createDataFrame(data, "city string, t double, p double")
    got = {r["group_name"]: r for r in metrics.by_group(
        df, "regression", ["city", "property_type"], "t", "p", min_rows=5).collect()}
    assert set(got) == {"boston", "tulsa"}
    assert got["boston"]["n"] == 6 and not got["boston"]["insufficient_data"]
    assert got["tulsa"]["insufficient_data"] and got["tulsa"]["rmse"] is None


@pytest.mark.parametrize(("task", "candidate", "champion", "passed", "beats"), [
    ("regression", {"r2": 0.95, "rmse": 41000.0}, None, True, None),
    ("regression", {"r2": 0.95, "rmse": 40800.0}, {"rmse": 41000.0}, False, False),
    ("regression", {"r2": 0.95, "rmse": 49500.0}, {"rmse": 50000.0}, True, True),
    ("regression", {"r2": 0.74, "rmse": 1.0}, {"rmse": 50000.0}, False, None),
    ("classification", {"auc": 0.50}, None, False, None),
    ("classification", {"auc": 0.705}, {"auc": 0.70}, True, True),
    ("classification", {"auc": 0.704}, {"auc": 0.70}, False, False),
])
def test_gates(spark, task, candidate, champion, passed, beats):
    row = {f"candidate_{k}": v for k, v in candidate.items()}
    key = "champion_" + ("rmse" if task == "regression" else "auc")
    row[key] = None if champion is None else champion[key.removeprefix("champion_")]
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" for c in row))
    got = metrics.gate(df, task).first()
    assert (got["passed"], got["beats_champion"]) == (passed, beats)


def test_gate_refuses_a_missing_score(spark):
    df = spark.createDataFrame([(None, 1.0, None)],
                               "candidate_r2 double, candidate_rmse double, champion_rmse double")
    with pytest.raises(Exception, match="candidate_r2"):
        metrics.gate(df, "regression").collect()


def test_one_city_against_21_equal_cities(spark):
    ref = spark.createDataFrame([(f"c{i}",) for i in range(21)], "city string")
    cur = spark.createDataFrame([("c0",)] * 5, "city string")
    value = drift.js_distance(drift.aligned_counts(ref, cur, ["city"])).first()["value"]
    assert value == pytest.approx(0.772, abs=0.001)


def test_wasserstein_is_the_shift_over_the_deviation(spark):
    ref = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    cur = ref.select((F.col("v") + 50).alias("v"))
    std = ((1000 ** 2 - 1) / 12) ** 0.5
    value = drift.wasserstein(drift.aligned_numbers(ref, cur, ["v"])).first()["value"]
    assert value == pytest.approx(50 / std)


def test_method_by_distinct_values(spark):
    ref = spark.range(100).select((F.col("id") % 4).alias("few"), F.col("id").alias("many"),
                                  F.lit("a").alias("word"))
    table = {r["column"]: r["method"] for r in drift.drift_table(
        ref, ref, ["few", "many"], ["word"]).collect()}
    assert table == {"few": "jensen-shannon", "many": "wasserstein", "word": "jensen-shannon"}


def test_margins_and_missing_columns(spark):
    df = spark.createDataFrame([("city", "jensen-shannon", 0.1, 0.775448, True),
                                ("bedrooms", "wasserstein", 0.1, 0.051171, False)],
                               "column string, method string, threshold double, value double, "
                               "drifted boolean")
    row = drift.drift_totals(df).first()
    assert (row["n_drifted"], row["drifted_share"]) == (1, 0.5)
    assert row["margin_sum"] == pytest.approx(0.675448 - 0.048829)
    with pytest.raises(Exception, match="no column"):
        drift.drift_totals(df.limit(0)).collect()


def grade(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("share", "margin", "level"), [
    (0.1, None, "ok"), (0.3, None, "warning"), (0.5, None, "warning"), (0.51, None, "high"),
    (0.0909, 0.3901, "warning"), (0.0909, -0.2844, "ok"), (0.0909, 0.0, "warning"),
    (0.8, -5.0, "high"),
])
def test_feature_level_edges(spark, share, margin, level):
    margin = F.lit(margin).cast("double")
    assert grade(spark, drift.feature_level(F.lit(share), margin, F.lit(0))) == level


@pytest.mark.parametrize(("task", "now", "then", "n", "level"), [
    ("regression", 41000.0, 41000.0, 500, "ok"), ("regression", 70000.0, 41000.0, 500, "high"),
    ("regression", 1.2, 1.0, 50, "warning"), ("regression", 1.5, 1.0, 50, "warning"),
    ("regression", 9.0, 1.0, 49, "insufficient_data"), ("classification", 0.5, 0.75, 99, "high"),
    ("classification", 0.75, 0.70, 99, "ok"), ("classification", 0.5, 0.5625, 99, "warning"),
])
def test_performance_level_edges(spark, task, now, then, n, level):
    column = drift.performance_level(task, F.lit(now), F.lit(then), F.lit(n))
    assert grade(spark, column) == level


def test_overall_level_skips_the_unmeasured(spark):
    none = F.lit(drift.INSUFFICIENT)
    assert grade(spark, drift.worst(F.lit("ok"), none)) == "ok"
    assert grade(spark, drift.worst(F.lit("warning"), F.lit("high"), none)) == "high"
    assert grade(spark, drift.worst(none, none)) == drift.INSUFFICIENT


def test_unseen_share_is_of_present_values(spark, spec):
    df = spark.createDataFrame([("BOSTON",), ("denver",), (None,), ("Miami",)], "city string")
    known = spark.createDataFrame([("city", "boston"), ("city", "miami")],
                                  "column string, value string")
    cleaned = df.select(monitor.clean_category(spec)("city", F.col("city")).alias("city"))
    row = drift.quality_numbers(cleaned, [], ["city"], known).first()
    assert row["missing_share"] == 0.25
    assert row["unseen_share"] == pytest.approx(1 / 3)


def test_input_quality_grades(spark):
    shape = "column string, missing_share double, unseen_share double"
    ref = spark.createDataFrame([("listing_year", 0.08, None), ("city", 0.0, 0.0)], shape)
    cur = spark.createDataFrame([("listing_year", 0.95, None), ("city", 0.0, 0.05)], shape)
    graded = drift.input_quality(ref, cur)
    flagged = drift.flagged_columns(graded).collect()
    assert [(r["column"], r["level"]) for r in flagged] == [
        ("listing_year", "high"), ("city", "warning")]
    assert flagged[0]["missing_increase_points"] == 87.0
    assert drift.quality_level(graded, 300).first()["level"] == "high"
    assert drift.quality_level(graded, 49).first()["level"] == "insufficient_data"


def test_streak_restarts_on_a_new_version(spark):
    levels = ["warning", "warning", "ok", "warning", "warning", "warning", "insufficient_data"]
    versions = ["3", "3", "3", "4", "4", "5", "5"]
    df = spark.createDataFrame([("m", "feature", i, v, lv) for i, (v, lv) in
                                enumerate(zip(versions, levels, strict=True))],
                               "model_name string, part string, i int, model_version string, level string")
    got = history.warning_streaks(df, ["model_name", "part"], ["i"]).orderBy("i").collect()
    assert [r["streak"] for r in got] == [1, 2, 0, 1, 2, 1, 0]


def test_history_puts_bad_times_last(spark):
    df = spark.createDataFrame([("a", "2026-09-20T07:56:45"), ("b", "2026-09-20T07:00:00+00:00"),
                                ("c", None), ("d", "2026-09-20T10:00:00+02:00"), ("e", "junk")],
                               "k string, t string")
    got = history.newest_first(df, history.zoned_moment(F.col("t")), "k", 4).collect()
    assert [r["k"] for r in got] == ["d", "b", "e", "c"]


def test_run_outcomes(spark):
    states = [(1, "deploy", "failed"), (1, "train", "failed"), (2, "train", "upstream_failed"),
              (2, "stop_no_deploy", "success"), (3, "stop_no_deploy", "success"),
              (3, "register", "skipped"), (4, "deploy", "success")]
    df = spark.createDataFrame(states, "run_id int, task string, state string")
    got = {r["run_id"]: r["status"] for r in history.run_outcomes(df).collect()}
    assert got == {1: "smoke_test_failed", 2: "failed", 3: "blocked", 4: "success"}


def test_untraceable_champion_is_an_error(spark):
    versions = spark.createDataFrame([("m", "r1", "champion")], "model_name string, run_id string, alias string")
    runs = spark.createDataFrame([("r1", None)], "run_id string, data_id string")
    with pytest.raises(Exception, match="no data id"):
        history.champion(versions, runs).collect()


@pytest.mark.parametrize(("y", "p", "recall", "want"), [
    ([1, 1, 1, 0], [0.9, 0.6, 0.2, 0.1], 0.66, 0.6), ([0, 0], [0.4, 0.3], 0.7, 0.5)])
def test_threshold(spark, y, p, recall, want):
    df = spark.createDataFrame(list(zip(y, p, strict=True)), "y int, p double")
    assert train.choose_threshold(df, F.col("y") == 1, F.col("p"), recall) == want


def test_scenarios_move_one_column(spark):
    df = spark.createDataFrame([("$400,000", "boston", "condo"), ("call us", "miami", "land")],
                               "list_price string, city string, property_type string")
    raised = scenario.apply_scenario(df, "price_inflation").collect()
    assert [r["list_price"] for r in raised] == ["480000.0", "call us"]
    assert {r["city"] for r in scenario.apply_scenario(df, "market_shift").collect()} == {"phoenix"}
    assert scenario.apply_scenario(df.drop("city"), "market_shift").columns == [
        "list_price", "property_type"]
    with pytest.raises(ValueError):
        scenario.apply_scenario(df, "market_raly")
    assert grade(spark, scenario.adjust_truth(F.lit(420000.0), "market_rally", "regression")) == 504000.0


def test_lost_columns_stay_and_never_grade_ok(spark):
    ref = spark.createDataFrame([(float(i), "a", None, 1.0) for i in range(40)], "x double, c string, d string, z double")
    cur = spark.createDataFrame([(None, "a", "n", 1.0)] * 40, "x double, c string, d string, z double")
    table = drift.drift_table(ref, cur, ["x", "z"], ["c", "d"])
    found = {r["column"]: (r["value"], r["drifted"]) for r in table.collect()}
    assert found == {"x": (None, None), "c": (0.0, False), "d": (None, None), "z": (0.0, False)}
    totals = drift.drift_totals(table)
    assert tuple(totals.first()[:3]) == (0, 2, 0.0)
    level = totals.select(drift.feature_level(F.col("drifted_share"), F.col("margin_sum"), F.col("n_unmeasured")))
    assert level.first()[0] == "insufficient_data"


@pytest.mark.parametrize(("statistic", "degrees", "p"), [
    (3.841459, 1, 0.05), (0.0, 3, 1.0), (18.307038, 10, 0.05), (2.0, 2, 0.36787944), (300.0, 2, 7.1750959731644e-66)])
def test_chi_square_tail(statistic, degrees, p):
    assert drift.chi_square_tail(statistic, degrees) == pytest.approx(p, rel=2e-3)


@pytest.mark.parametrize(("statistic", "degrees"), [(1000.0, 900), (850.0, 900), (25_000.0, 24_500), (9.0, 8)])
def test_chi_square_tail_is_a_poisson_sum_for_even_degrees(statistic, degrees):
    x = statistic / 2
    want = math.fsum(math.exp(k * math.log(x) - x - math.lgamma(k + 1)) for k in range(degrees // 2))
    assert drift.chi_square_tail(statistic, degrees) == pytest.approx(want, rel=1e-8)


def test_counter_that_starts_again(spark):
    from keelson.streaming import windows
    df = spark.createDataFrame([(0, 90), (10, 95), (20, 2), (400, 2), (410, 9)], "s long, n long").select(
        F.timestamp_seconds("s").alias("at"), "n")
    assert [r["increase"] for r in windows.counter_increase(df, "at", "n").collect()] == [7]


def test_streaks_go_on_from_the_previous_summary(spark):
    levels = {"feature": "warning", "prediction": "ok", "performance": "warning", "input_quality": "high"}
    previous = spark.createDataFrame([("1", {"feature": 2, "prediction": 4, "performance": 0, "input_quality": 1})],
                                     "model_version string, consecutive_warnings struct<feature: long, "
                                     "prediction: long, performance: long, input_quality: long>")
    assert list(monitor._streaks(levels, "1", previous).values()) == [3, 0, 1, 0]
    assert list(monitor._streaks(levels, "2", previous).values()) == [1, 0, 1, 0]
    assert list(monitor._streaks(levels, "1", None).values()) == [1, 0, 1, 0]


def test_latest_breaks_ties_by_run(spark):
    df = spark.createDataFrame([("m", "t", "r1"), ("m", "t", "r3"), ("m", "t", "r2")], "model_name string, computed_at string, run_id string")
    assert history.latest(df).first()["run_id"] == "r3"


def test_chi_square_sees_a_moved_category(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "city string")
    cur = spark.createDataFrame([("a",)] * 5 + [("b",)] * 95, "city string")
    row = drift.chi_square(ref, cur, ["city"]).first()
    assert row["drifted"] and row["value"] < 1e-6
    assert not drift.chi_square(ref, ref, ["city"]).first()["drifted"]


def test_shifted_column_alone_raises_the_margin(spark):
    ref = spark.range(2000).select((F.col("id") % 21).cast("string").alias("city"),
                                   (F.col("id") % 97).cast("double").alias("size"))
    before = {r["column"]: r["value"] for r in drift.drift_table(ref, ref, ["size"], ["city"]).collect()}
    moved = scenario.apply_scenario(ref, "market_shift")
    after = {r["column"]: r["value"] for r in drift.drift_table(ref, moved, ["size"], ["city"]).collect()}
    assert after["size"] == before["size"] and after["city"] > 0.5 > before["city"]


def test_manifest_shape():
    from keelson.sources.tables import MANIFEST
    assert json.loads(MANIFEST.json())["fields"][0]["name"] == "dataset_version"
