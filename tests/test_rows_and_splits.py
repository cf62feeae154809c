"""Split points, assignment, deduplication, samples and order."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from keelson.operators import ranking, rows, splits


def listings(spark, n, undated=0):
    data = [(f"p{i}", str(date(2020, 1, 1) + timedelta(days=i)), "100000") for i in range(n)]
    data += [(f"u{i}", None, "100000") for i in range(undated)]
    return spark.createDataFrame(data, "property_id string, listing_date string, sale_price string")


def sizes(df):
    return {r["set_name"]: r["count"] for r in df.groupBy("set_name").count().collect()}


def test_thousand_days_give_720_180_100(spark, spec):
    df = listings(spark, 1000)
    rules = {"original": splits.split_rule(df, spec)}
    assert sizes(splits.assign_split(df, spec, rules)) == {
        "train": 720, "test": 180, "simulation": 100}


def test_simulation_takes_its_share_unless_told_otherwise(spark):
    days = spark.range(300_000).select(
        F.date_add(F.lit("1200-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    for most, want in ((None, 30_000), (20_000, 20_000)):
        row = splits.split_points(days, most_held=most).first()
        assert days.where(F.col("day") >= F.lit(row["t2"])).count() == want


def test_one_day_only_leaves_no_simulation(spark, spec):
    df = spark.createDataFrame([("a", "2020-01-01")] * 3, "property_id string, listing_date string")
    rule = splits.split_rule(df, spec)
    assert (rule["t1"], rule["t2"]) == ("2020-01-01", "2020-01-02")


def test_no_date_is_an_error(spark, spec):
    df = spark.createDataFrame([("a", "soon")], "property_id string, listing_date string")
    with pytest.raises(ValueError):
        splits.split_rule(df, spec)


def test_undated_rows_go_to_train_and_test_only(spark, spec):
    df = listings(spark, 0, 2000)
    rules = {"original": {"t1": "2021-01-01", "t2": "2022-01-01", "undated_test_share": 0.2}}
    got = sizes(splits.assign_split(df, spec, rules))
    assert "simulation" not in got
    assert 0.15 < got["test"] / 2000 < 0.25


def test_unknown_source_is_an_error(spark, spec):
    df = spark.createDataFrame([("a", "2020-01-01", "other")],
                               "property_id string, listing_date string, record_source string")
    rules = {"original": {"t1": "2021-01-01", "t2": None}}
    with pytest.raises(Exception, match="no split rule"):
        splits.assign_split(df, spec, rules).collect()


def test_dedup_keeps_first_and_groups_null_ids(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4), (None, 5)],
                               "property_id string, n int")
    got = rows.dedup_first(df, ["property_id"], [F.col("n")])
    assert sorted(r["n"] for r in got.collect()) == [1, 2, 4]


def test_dedup_by_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 9), ("a", 1), ("b", 5)], "id string, n int").coalesce(1) \
        .write.parquet(path)
    placed = rows.with_file_order(spark.read.parquet(path))
    got = rows.dedup_first(placed, ["id"], [F.col(c) for c in rows.FILE_ORDER])
    assert sorted(r["n"] for r in got.collect()) == [5, 9]


def test_plan_disjoint_repeatable_and_test_set_fixed(spark, spec):
    df = listings(spark, 1200).union(listings(spark, 50)).withColumn(
        "row_key", F.monotonically_increasing_id())
    rules = {"original": splits.split_rule(df, spec)}

    def ids(part):
        return sorted(r[0] for r in part.select("property_id").collect())

    full = rows.plan_rows(df, spec, "regression", rules, None, 42, ["row_key"])
    small = rows.plan_rows(df.repartition(7), spec, "regression", rules, 100, 42,
                           ["row_key"])
    again = rows.plan_rows(df, spec, "regression", rules, 100, 42, ["row_key"])
    assert full.counts["dropped_duplicates"] == 50
    assert not set(ids(full.train)) & set(ids(full.test))
    assert ids(full.test) == ids(small.test)
    assert len(ids(small.train)) == 100 and ids(small.train) == ids(again.train)
    assert set(ids(small.train)) <= set(ids(full.train))
    with pytest.raises(ValueError):
        rows.plan_rows(df, spec, "regression", rules, 0, 42, ["row_key"])


def test_sample_sizes(spark):
    df = spark.range(1000)
    assert rows.sample_exact(df, 137, 1, F.col("id")).count() == 137
    assert rows.sample_exact(df, 5000, 1, F.col("id")).count() == 1000
    with pytest.raises(ValueError, match="repeats"):
        rows.sample_exact(spark.range(100).select(F.lit(1).alias("id")), 3, 1, F.col("id"))


def test_sample_with_replacement_reaches_the_size(spark):
    got = rows.sample_with_replacement(spark.range(3), 10, 7, [F.col("id")])
    assert got.count() == 10 and got.select("draw").distinct().count() == 10


def test_training_order(spark, spec):
    raw = ["2021-03-01", None, "2020-01-01", "garbage", "2020-06-01"]
    df = spark.createDataFrame([(i, f"p{i}", d) for i, d in enumerate(raw)],
                               "i int, property_id string, listing_date string")
    got = splits.training_order(df, spec, [F.col("i")]).orderBy("position").collect()
    assert [r["i"] for r in got] == [1, 3, 2, 4, 0]
    assert [r["position"] for r in got] == [0, 1, 2, 3, 4]


def test_fold_bounds_follow_the_dated_rows():
    assert splits.fold_bounds(rows=68, undated=8, folds=5) == [
        (18, 28), (28, 38), (38, 48), (48, 58), (58, 68)]
    assert splits.fold_bounds(64, 0, 5)[0] == (14, 24)
    with pytest.raises(ValueError):
        splits.fold_bounds(5, 2, 5)


@pytest.mark.parametrize("values", [
    list(range(1000)), [5.0] * 700 + [1.0, 9.0], [0.0] * 10 + [1.7e308, -1.7e308, 1e-300],
    [float("inf"), float("-inf"), 1.0, 2.0, 3.0] * 3,
    [float(i % 7) for i in range(500)] + [1e9],
])
def test_order_statistics_match_a_sort(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    ranks = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1})
    want = {k: float(sorted(values)[k]) for k in ranks}
    assert ranking.order_statistics(df, {"v": ranks}, bins=4)["v"] == want
    assert ranking.order_statistics(df, {"v": ranks}, bins=16)["v"] == want


def test_quantiles_equal_the_built_in_ones(spark):
    df = spark.range(997).select((F.col("id") * 7919 % 997 / 3).alias("v"), F.lit(1.5).alias("w"))
    shares = [0.25, 0.5, 0.75, 0.99]
    found = ranking.linear_quantiles(df, ["v", "w"], shares)
    for column in ("v", "w"):
        want = df.agg(F.percentile(column, F.array(*map(F.lit, shares)))).first()[0]
        assert found[column] == pytest.approx(want)


def test_global_rank_with_a_hot_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(
        F.col("id")).alias("v")).repartition(5)
    got = ranking.global_rank(df, [F.col("v"), F.col("id")]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(3000))
    assert [(r["v"], r["id"]) for r in got] == sorted((r["v"], r["id"]) for r in got)


def test_running_totals_cross_ranges(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"),
                                 F.lit(1).alias("n"))
    got = ranking.running_totals(df, ["k"], "v", ["n"]).orderBy("k", "v").collect()
    for k in (0, 1):
        mine = [r for r in got if r["k"] == k]
        assert [r["cum_n"] for r in mine] == list(range(1, 251))
        assert [r["next_value"] for r in mine] == [r["v"] for r in mine[1:]] + [None]


def test_feedback_cut_splits_inside_one_hour(spark, spec):
    df = spark.range(600).select(
        F.col("id").cast("string").alias("property_id"), F.lit("feedback").alias("record_source"),
        F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")),
                      "yyyy-MM-dd'T'HH:mm:ssxxx").alias("predicted_at"))
    rules = splits.feedback_rules({"original": {"t2": "2024-10-15"}}, df)
    assert rules["original"] == {"t1": "2024-10-15", "t2": "2024-10-15", "undated_test_share": 0.0}
    assert sizes(splits.assign_split(df, spec, rules)) == {"train": 480, "test": 120}
