"""What-if rewrites of served rows, to see how the drift grades react."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import parse

# Scenario names, factor, city and the category no one trained on.
SCENARIOS = ("none", "price_inflation", "market_rally", "market_shift", "new_segment")
PRICE_FACTOR = 1.2
SHIFT_CITY = "phoenix"
NEW_PROPERTY_TYPE = "floating home"


def _check(scenario: str) -> None:
    if scenario not in SCENARIOS:
        raise ValueError(f"unknown scenario {scenario!r}, expected one of {SCENARIOS}")


def apply_scenario(df: DataFrame, scenario: str) -> DataFrame:
    """Rewrites the column a scenario moves; absent columns and unreadable prices stay."""
    _check(scenario)
    if scenario in ("price_inflation", "market_rally") and "list_price" in df.columns:
        raw = F.col("list_price").cast("string")
        raised = parse.as_text(parse.money(raw) * PRICE_FACTOR, T.DoubleType())
        return df.withColumn("list_price", F.coalesce(raised, raw))
    if scenario == "market_shift" and "city" in df.columns:
        return df.withColumn("city", F.lit(SHIFT_CITY))
    if scenario == "new_segment" and "property_type" in df.columns:
        return df.withColumn("property_type", F.lit(NEW_PROPERTY_TYPE))
    return df


def adjust_truth(actual: Column, scenario: str, task: str) -> Column:
    """The outcome under a scenario: only a rally moves it, and only for prices."""
    _check(scenario)
    if task == "regression" and scenario == "market_rally":
        return actual * PRICE_FACTOR
    return actual


def build_requests(pool: DataFrame, label: Column, scenario: str, task: str,
                   label_name: str) -> DataFrame:
    """Sampled pool rows as requests: rewritten record plus the true outcome.

    Rows whose outcome cannot be read are left out; the label is not sent.
    """
    _check(scenario)
    with_truth = pool.withColumn("truth", label).where(F.col("truth").isNotNull())
    sent = apply_scenario(with_truth.drop(label_name), scenario)
    return sent.withColumn("truth", adjust_truth(F.col("truth"), scenario, task))
