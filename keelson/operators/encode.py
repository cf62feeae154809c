"""From raw rows to a feature vector: cleaning, imputing, scaling, one-hot.

The learned part is a handful of numbers and at most a hundred categories per
column, so it is kept as JSON in the stage's parameters.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators import clean, ranking
from keelson.operators.profile import rank_per_column, value_counts
from keelson.spec import TableSpec

RARE_SHARE = 0.01
RARE = "infrequent"


class _JsonStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose whole setup is one JSON text."""

    setup = Param(Params._dummy(), "setup", "what the stage does, as JSON",
                  TypeConverters.toString)

    def __init__(self, setup: str = "{}"):
        super().__init__()
        self._set(setup=setup)

    def settings(self) -> dict:
        return json.loads(self.getOrDefault(self.setup))


class RawFeatures(_JsonStage):
    """Cleans a raw table and adds the task's features; absent ones become null.

    Other columns stay beside them, so ids and labels reach the scored table.
    """

    @classmethod
    def of(cls, spec: TableSpec, task: str) -> RawFeatures:
        return cls(json.dumps({"spec": spec.to_json(), "task": task}))

    def _transform(self, df: DataFrame) -> DataFrame:
        setup = self.settings()
        spec, task = TableSpec.from_json(setup["spec"]), setup["task"]
        numeric, categorical = spec.encoded_features(task)
        # Copies under other names, so ids and labels stay as they were sent.
        held = df.columns
        copies = df.select("*", *[
            clean.read_as(spec[c].kind, F.col(c), df.schema[c].dataType).alias(f"_read_{c}")
            for c in held if c in spec
        ])
        finished = {}
        for c in held:
            if c not in spec:
                continue
            value = F.col(f"_read_{c}")
            if c == spec.date_column:
                year, month = spec.date_parts
                finished |= {year: F.year(value), month: F.month(value)}
            elif spec[c].bounded:
                finished[c] = clean.parse.clip(value, spec[c].low, spec[c].high)
            else:
                finished[c] = value
        return copies.select(
            *held,
            *[finished.get(c, F.lit(None)).cast("double").alias(f"x_{c}") for c in numeric],
            *[finished.get(c, F.lit(None)).cast("string").alias(f"x_{c}") for c in categorical],
        )


@dataclass
class Encoding:
    """What the encoder learned from a train set."""

    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]
    modes: dict[str, str]
    kept: dict[str, list[str]]
    has_rare: dict[str, bool]


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in ranking.linear_quantiles(df, columns, [0.5]).items()}


def filled_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) after missing values took the column's mode."""
    counts = value_counts(df, columns)
    modes = rank_per_column(counts).select("column", "mode")
    return counts.join(F.broadcast(modes), "column").groupBy(
        "column", F.coalesce("value", "mode").alias("value")).agg(F.sum("n").alias("n"))


def category_groups(df: DataFrame, columns: Sequence[str], share: float = RARE_SHARE) -> DataFrame:
    """(column, value, n, is_rare): categories below ``share`` of the rows are rare."""
    counts = filled_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", (F.col("n") < F.col("total") * share).alias("is_rare"))


def fit_encoding(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Encoding:
    """Learns medians, scales, modes and frequent categories (population deviation)."""
    middle = {c: 0.0 if m is None else m for c, m in medians(df, numeric).items()}
    scale = df.agg(*[
        part for c in numeric for part in (
            F.avg(F.coalesce(c, F.lit(middle[c]))).alias(f"{c}:mean"),
            F.stddev_pop(F.coalesce(c, F.lit(middle[c]))).alias(f"{c}:std"),
        )
    ]).first().asDict() if numeric else {}
    kept: dict[str, list[str]] = {c: [] for c in categorical}
    has_rare = dict.fromkeys(categorical, False)
    modes: dict[str, str] = dict.fromkeys(categorical, "")
    if categorical:
        groups = category_groups(df, categorical)
        # At 1% or more of the rows each, a column keeps at most 100 categories.
        for row in groups.where(~F.col("is_rare")).orderBy("column", "value").collect():
            kept[row["column"]].append(row["value"])
        for row in groups.where("is_rare").select("column").distinct().collect():
            has_rare[row["column"]] = True
        for row in rank_per_column(value_counts(df, categorical)).collect():
            modes[row["column"]] = row["mode"]
    return Encoding(
        middle,
        {c: scale[f"{c}:mean"] or 0.0 for c in numeric},
        {c: scale[f"{c}:std"] or 1.0 for c in numeric},
        modes, kept, has_rare,
    )


class FillAndScale(_JsonStage):
    """Imputes and scales numbers, imputes and groups categories."""

    @classmethod
    def of(cls, encoding: Encoding) -> FillAndScale:
        return cls(json.dumps(asdict(encoding)))

    def _transform(self, df: DataFrame) -> DataFrame:
        e = Encoding(**self.settings())
        numbers = {
            f"n_{c}": (F.coalesce(F.col(c), F.lit(e.medians[c])) - e.means[c]) / e.deviations[c]
            for c in e.medians
        }
        groups = {}
        for c, values in e.kept.items():
            filled = F.coalesce(F.col(c), F.lit(e.modes[c]))
            rest = F.lit(RARE) if e.has_rare[c] else filled
            groups[f"c_{c}"] = F.when(filled.isin(*values), filled).otherwise(rest) \
                if values else rest
        return df.withColumns({**numbers, **groups})


def encoder_stages(df: DataFrame, encoding: Encoding) -> list:
    """The stages after ``RawFeatures``: fill, index, one-hot, assemble.

    An unseen category goes to the rare group where there is one, else to the
    indexer's spare slot, which the one-hot step drops: all zeros.
    """
    fill = FillAndScale.of(encoding)
    numeric = [f"n_{c}" for c in encoding.medians]
    categorical = [c for c in encoding.kept if encoding.kept[c] or encoding.has_rare[c]]
    stages: list = [fill]
    hot = []
    if categorical:
        # One indexer per column: label lists of different lengths cannot share one.
        indexers = [
            StringIndexerModel.from_labels(
                encoding.kept[c] + ([RARE] if encoding.has_rare[c] else []),
                f"c_{c}", f"i_{c}", "keep")
            for c in categorical
        ]
        hot = [f"h_{c}" for c in categorical]
        encoder = OneHotEncoder(inputCols=[f"i_{c}" for c in categorical], outputCols=hot,
                                dropLast=True, handleInvalid="error")
        # Sizes come from the indexer's column metadata, so this reads no rows.
        indexed = fill.transform(df)
        for indexer in indexers:
            indexed = indexer.transform(indexed)
        stages += [*indexers, encoder.fit(indexed)]
    return [*stages, VectorAssembler(inputCols=[*numeric, *hot], outputCol="features")]


