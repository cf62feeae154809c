"""Tables are read and measured once for several answers."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keelson.operators import gram, profile, ranking


def test_tasks_share_one_measurement(spark, spec, monkeypatch):
    calls, plain = [], profile.validation_row
    monkeypatch.setattr(profile, "validation_row", lambda *a: calls.append(1) or plain(*a))
    raw = spark.createDataFrame([("p1", "", "good")], "property_id string, sale_price string, condition string")
    reports = profile.validate_tasks(raw, spec, list(spec.targets))
    assert calls == [1]
    assert {t: len(r["fatal"]) for t, r in reports.items()} == {"regression": 2, "classification": 1}


def test_numbers_are_measured_side_by_side(spark, monkeypatch):
    rows = spark.createDataFrame([(1.0, None), (2.0, float("nan")), (4.0, 5.0)], "a double, b double")
    assert ranking.order_statistics(rows, {"a": [0, 2], "b": [0, 1]}) == {"a": {0: 1.0, 2: 4.0}, "b": {0: 5.0}}
    found = {r["column"]: r for r in profile.numeric_profile(rows, ["a", "b"]).collect()}
    assert (found["a"]["n"], found["a"]["p50"], found["b"]["n"], found["b"]["missing_rate"]) == (3, 2.0, 1, 1 - 1 / 3)
    assert profile.numeric_profile(rows.where("false"), ["a", "b"]).count() == 0
    plan = profile.histogram(rows, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") <= 1


def test_short_vectors_are_summed_without_copies(spark, monkeypatch):
    rows = np.array([[1.0, 2.0, 3.0], [0.0, -1.0, 5.0], [2.5, 0.0, 1.0]])
    df = spark.createDataFrame([(Vectors.dense(r[:2]), float(r[2])) for r in rows], ["features", "y"])
    monkeypatch.setattr(F, "posexplode", lambda *a: pytest.fail("rows are copied for each entry"))
    z = np.column_stack([np.ones(3), rows])
    assert np.allclose(gram.grams(df, "y")[0].sums, z.T @ z)
