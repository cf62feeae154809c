"""Values of plain shape are read by one match; others by the steps that accept them."""

import pytest
from pyspark.sql import functions as F

from keelson.functions import parse

READ = {
    "words": {"New_York": "new york", " a \t b ": "a b", "a--b": "a b", "a b": "a b", "ok": "ok", "_": None},
    "number": {"12.5": 12.5, " 7 ": 7.0, "1d": None, "0x1p3": None, "-inf": float("-inf"), "": None, "5\n": 5.0},
    "zipcode": {"02134": "02134", " 02134\n": "02134", "2134": None},
    "money": {"15.5": 15.5, "$1,200.50": 1200.5, "call": None, "-3": -3.0},
    "day": {"2024-02-03": "2024-02-03", "02/03/2024": "2024-02-03", "3-FEB-2024": "2024-02-03",
            " 03-feb-2024 ": "2024-02-03", "03-anf-2024": None, "2024-02-30": None, "soon": None},
}


@pytest.mark.parametrize("kind", READ)
def test_plain_and_other_values(spark, kind):
    rows = spark.createDataFrame([(v,) for v in READ[kind]], "v string")
    read = getattr(parse, kind)(F.col("v"))
    found = {r["v"]: r["x"] for r in rows.select("v", (read.cast("string") if kind == "day" else read).alias("x")).collect()}
    assert found == READ[kind]
    # The shape is tried on the value as it came, before any trimming.
    steps = rows.select(read)._jdf.queryExecution().analyzed().toString().lower()
    assert "case when rlike(v#" in steps or kind == "words" and "rlike(replace(replace(lower(v#" in steps
