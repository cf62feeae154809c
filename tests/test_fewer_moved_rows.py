"""Whole rows are neither moved nor stored unless a set needs them."""

from datetime import datetime

from pyspark.sql import functions as F

from keelson.operators import rows, splits
from keelson.plans import encoding


def test_key_filter_loses_no_partner_and_drops_most_others(spark):
    keys = spark.range(0, 40_000, 10).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    df = spark.range(40_000).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"), F.lit("x").alias("rest"))
    df = df.unionByName(df.where("k < 100")).unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS k, 't' AS t, 'x' AS rest"))
    got = rows.may_hold(df, keys, ["k", "t"], 4000)
    assert got.columns == df.columns
    assert got.join(keys, ["k", "t"]).count() == 4000 + 10
    assert got.count() < 4010 + 36_091 // 12
    assert rows.may_hold(df, keys.where("false"), ["k", "t"], 0).count() == 0


def test_plan_moves_few_whole_rows(spark, spec, monkeypatch):
    df = spark.range(4000).select(
        F.format_string("p%d", F.col("id") % 500).alias("property_id"), F.lit("good").alias("condition"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).cast("string").alias("listing_date"),
        F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("sale_price"), F.col("id").alias("row_key"))
    rules = {"original": splits.split_rule(df, spec)}
    moved, plain = [], rows.may_hold
    monkeypatch.setattr(rows, "may_hold", lambda *a: moved.append(plain(*a)) or moved[-1])
    plan = rows.plan_rows(df, spec, "regression", rules, None, 42, ["row_key"])
    first = {r["property_id"]: r for r in df.orderBy(F.col("row_key").desc()).collect()}
    placed = splits.assign_split(df, spec, rules).where("sale_price IS NOT NULL")
    for name, got in (("train", plan.train), ("test", plan.test)):
        keys = {r["row_key"] for r in placed.where(F.col("set_name") == name).collect()}
        want = sorted(r["row_key"] for r in first.values() if r["row_key"] in keys)
        assert want and sorted(r["row_key"] for r in got.collect()) == want
    assert moved[0].count() < 1000


def test_training_runs_store_no_copy_of_the_raw_table(spark, tmp_path, monkeypatch):
    lines = [(k // 3, k * 7 % 400, k % 50, k % 4, float(k % 50), 1000.0 + k, 0.05, 0.02, "N", "O",
              datetime(2020, 1 + k % 12, 3)) for k in range(600)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    stored, plain = [], rows.materialize
    for module in (rows, encoding):
        monkeypatch.setattr(module, "materialize", lambda df, label: stored.append(label) or plain(df, label))
    learn, test = encoding._sets(spark, str(tmp_path), "regression")
    assert learn.count() > 0 and test.count() > 0
    assert stored == ["plan", "sets"]
