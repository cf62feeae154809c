"""Rows are moved before they are written out as wide texts."""

from datetime import datetime

from pyspark.sql import functions as F

from keelson.operators import rows
from keelson.plans import splitting
from keelson.plans import standins as S


def test_first_per_id_moves_lines_only(spark, tmp_path, monkeypatch):
    lines = [(k // 3, k * 7 % 400, k % 50, k % 4, float(k % 50), 1000.0 + k, 0.05, 0.02, "N", "O",
              datetime(2020, 1 + k % 12, 3)) for k in range(600)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    moved, plain = [], rows.dedup_first
    monkeypatch.setattr(rows, "dedup_first", lambda df, *a: moved.extend(df.columns) or plain(df, *a))
    found = splitting.first_per_id(spark, str(tmp_path))
    whole = S.raw_houses(spark, str(tmp_path))
    assert found.columns == whole.columns
    assert "zipcode" not in moved and {"property_id", "row_key"} <= set(moved)
    want = {}
    for r in whole.orderBy(F.col("row_key")).collect():
        want.setdefault(r["property_id"], r)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.values()))
