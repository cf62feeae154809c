"""Training, tuning, scoring and judging MLlib models on raw rows."""

from __future__ import annotations

import functools
import itertools
import json
import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators import clean, encode, gram, metrics, ranking, splits
from keelson.operators.feedback import overlap
from keelson.operators.profile import side_by_side
from keelson.session import materialize
from keelson.spec import TableSpec

# Model names per task, defaults, grids and thresholds.
ESTIMATORS = {
    "regression": ("ridge", "xgboost", "random_forest"),
    "classification": ("xgboost", "svm", "random_forest"),
}
DEFAULT_ESTIMATOR = "xgboost"
SEED = 42
TARGET_RECALL = 0.70
HOLDOUT_SHARE = 0.20
FOLDS = 5
GRIDS = {
    "ridge": {"alpha": [0.1, 1.0, 10.0]},
    "xgboost": {"maxIter": [100, 300], "maxDepth": [3, 6], "stepSize": [0.05, 0.1]},
    "random_forest": {"numTrees": [100, 300], "maxDepth": [30, 10, 20]},
    "svm": {"regParam": [0.1, 1.0, 10.0]},
}
DEFAULTS = {
    "ridge": {"alpha": 1.0},
    "xgboost": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3},
    "random_forest": {"numTrees": 100, "maxDepth": 30},  # 30 is MLlib's deepest
    "svm": {"regParam": 1.0},
}
LABEL = "_label"


def checked_name(task: str, name: str) -> str:
    """Refuses a name of the other task."""
    if name not in ESTIMATORS.get(task, ()):
        raise ValueError(f"{task} offers {ESTIMATORS.get(task, ())}, got {name!r}")
    return name


def build_estimator(task: str, name: str, settings: dict | None = None) -> Estimator:
    """An unfitted MLlib estimator; a name of the other task is refused.

    ``xgboost`` is MLlib's gradient boosted trees, ``svm`` a linear one.  A ridge is
    solved from sums of products (see ``gram``) and has no estimator.
    """
    checked_name(task, name)
    chosen = {**DEFAULTS[name], **(settings or {})}
    common = {"featuresCol": "features", "labelCol": LABEL}
    if name == "svm":
        return LinearSVC(rawPredictionCol="margin", predictionCol="side", **chosen, **common)
    kinds = {
        ("regression", "xgboost"): GBTRegressor, ("classification", "xgboost"): GBTClassifier,
        ("regression", "random_forest"): RandomForestRegressor,
        ("classification", "random_forest"): RandomForestClassifier,
    }
    return kinds[task, name](seed=SEED, **chosen, **common)


class LinearScore(encode._JsonStage):
    """``prediction`` of a fitted line, as an expression of the feature vector."""

    @classmethod
    def of(cls, line: gram.Line) -> LinearScore:
        return cls(json.dumps({"intercept": line.intercept, "weights": line.weights}))

    def _transform(self, df: DataFrame) -> DataFrame:
        line = self.settings()
        terms = F.zip_with(vector_to_array(F.col("features")), F.array(*map(F.lit, line["weights"])).cast("array<double>"),
                           lambda x, w: x * w)
        return df.withColumn("prediction", F.aggregate(terms, F.lit(line["intercept"]), lambda a, t: a + t))


@dataclass
class TrainedModel:
    """A fitted chain that accepts raw rows, and its decision threshold.

    The first ``encoders`` stages of the chain make the feature vector.
    """

    task: str
    chain: PipelineModel
    threshold: float | None = None
    settings: dict | None = None
    encoders: int = 0

    def score(self, raw: DataFrame) -> DataFrame:
        """Adds ``prediction``, and for classification ``probability`` and ``answer``."""
        return self._answers(raw, self.chain.transform(raw))

    def score_vectors(self, vectors: DataFrame) -> DataFrame:
        """The same for rows that already have their feature vector."""
        return self._answers(vectors, PipelineModel(self.chain.stages[self.encoders:]).transform(vectors))

    def encode(self, raw: DataFrame) -> DataFrame:
        return PipelineModel(self.chain.stages[:self.encoders]).transform(raw)

    def encodes_like(self, other: TrainedModel) -> bool:
        """Whether both make their feature vectors by the same fitted stages."""
        mine, theirs = (m.chain.stages[:m.encoders] for m in (self, other))
        return bool(mine) and len(mine) == len(theirs) and all(a is b for a, b in zip(mine, theirs, strict=True))

    def _answers(self, raw: DataFrame, scored: DataFrame) -> DataFrame:
        if self.task == "regression":
            return scored.select(*raw.columns, "prediction")
        probability = vector_to_array(F.col("probability"))[1]
        return scored.select(
            *raw.columns, probability.alias("probability"),
            (probability >= (0.5 if self.threshold is None else self.threshold)).alias("answer"),
        ).withColumn("prediction", F.col("answer").cast("double"))


def label_column(df: DataFrame, spec: TableSpec, task: str) -> Column:
    return clean.task_label(df, spec, task).cast("double")


def _encode(labelled: DataFrame, spec: TableSpec, task: str) -> tuple[list, DataFrame]:
    """Encoder stages learned from all train rows, and the rows as feature vectors.

    The vectors are stored once: every fold, trial and final fit reads them, so
    raw rows are cleaned a single time.
    """
    raw_step = encode.RawFeatures.of(spec, task)
    numeric, categorical = spec.encoded_features(task)
    read = raw_step.transform(labelled).persist()
    try:
        encoding = encode.fit_encoding(read, [f"x_{c}" for c in numeric],
                                       [f"x_{c}" for c in categorical])
        stages = encode.encoder_stages(read, encoding)
        kept = [c for c in (LABEL, "position", "_moment") if c in labelled.columns]
        vectors = materialize(PipelineModel(stages).transform(read).select(*kept, "features"),
                              "vectors")
    finally:
        read.unpersist()
    return [raw_step, *stages], vectors


def _fit_tail(vectors: DataFrame, task: str, name: str, settings: dict | None) -> list:
    """The fitted stages after the encoder; an SVM gets a logistic curve on its margin."""
    if checked_name(task, name) == "ridge":
        return [_ridge(gram.grams(vectors, LABEL), settings)]
    model = build_estimator(task, name, settings).fit(vectors)
    if name != "svm":
        return [model]
    up = _MarginUp("{}")
    spread = VectorAssembler(inputCols=["margin_up"], outputCol="margin_vector")
    margins = spread.transform(up.transform(model.transform(vectors)))
    sigmoid = LogisticRegression(featuresCol="margin_vector", labelCol=LABEL,
                                 rawPredictionCol="sigmoid_raw").fit(margins)
    return [model, up, spread, sigmoid]


def _ridge(blocks: dict[int, gram.Gram], settings: dict | None) -> LinearScore:
    if not blocks:
        raise ValueError("no rows to learn from")
    whole = functools.reduce(operator.add, blocks.values())
    return LinearScore.of(whole.ridge({**DEFAULTS["ridge"], **(settings or {})}["alpha"]))


class _MarginUp(encode._JsonStage):
    """Takes the positive-side margin out of a two-entry vector."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("margin_up", vector_to_array(F.col("margin"))[1])


def choose_threshold(scored: DataFrame, truth: Column, probability: Column,
                     recall: float = TARGET_RECALL) -> float:
    """The highest score that still catches ``recall`` of the positives; 0.5 without any."""
    positive = scored.where(truth).select(probability.alias("p")).where("p is not null")
    n = positive.count()
    if n == 0:
        return 0.5
    needed = max(math.ceil(recall * n), 1)
    return ranking.kth_smallest(positive, F.col("p"), n - needed)


def choose_thresholds(scored: DataFrame, group: Column, truth: Column, probability: Column,
                      recall: float = TARGET_RECALL) -> dict:
    """``choose_threshold`` for each group, all groups in the same passes over the rows."""
    rows = scored.select(group.alias("g"), F.when(truth, probability.cast("double")).alias("p"))
    counts = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count("p").alias("n")).collect()}
    names = {g: f"p{k}" for k, g in enumerate(g for g, n in counts.items() if n)}
    ranks = {name: [counts[g] - max(math.ceil(recall * counts[g]), 1)] for g, name in names.items()}
    found = ranking.order_statistics(rows.select(*[
        F.when(F.col("g").eqNullSafe(F.lit(g)), F.col("p")).alias(name) for g, name in names.items()]), ranks)
    return {g: found[names[g]][ranks[names[g]][0]] if n else 0.5 for g, n in counts.items()}


def _score_fold(model: TrainedModel, rows: DataFrame) -> float:
    """Lower is better for both tasks."""
    scored = model.score(rows)
    if model.task == "regression":
        return metrics.regression(scored, LABEL, "prediction").first()["rmse"]
    value = metrics.auc(scored, LABEL, "probability").first()["auc"]
    return -(value if value is not None else 0.0)


def tune(vectors: DataFrame, task: str, name: str, rows: int, undated: int,
         folds: int = FOLDS, grid: dict | None = None) -> dict:
    """The grid entry with the best mean score over forward-chaining folds.

    ``vectors`` has a ``position`` (see ``splits.training_order``): fold i learns
    from all rows before its block.  A ridge needs one pass for all folds and
    penalties (see ``tune_ridge``), other models a fit for each.
    """
    if name == "ridge":
        return tune_ridge(vectors, rows, undated, folds, grid)[0]
    grid = grid or GRIDS[name]
    bounds = splits.fold_bounds(rows, undated, folds)
    best, best_score = {}, math.inf
    for values in itertools.product(*grid.values()):
        settings = dict(zip(grid, values, strict=True))
        total = 0.0
        for start, end in bounds:
            learn = vectors.where(F.col("position") < start)
            block = vectors.where((F.col("position") >= start) & (F.col("position") < end))
            tail = _fit_tail(learn, task, name, settings)
            total += _score_fold(TrainedModel(task, PipelineModel(tail)), block)
        if total / folds < best_score:
            best, best_score = settings, total / folds
    return best


def tune_ridge(vectors: DataFrame, rows: int, undated: int, folds: int = FOLDS,
               grid: dict | None = None) -> tuple[dict, dict[int, gram.Gram], list[gram.Trial]]:
    """The best penalty, the sums of all blocks it was found from, and every trial."""
    alphas = (grid or GRIDS["ridge"])["alpha"]
    bounds = splits.fold_bounds(rows, undated, folds)
    blocks = gram.grams(vectors, LABEL, gram.block_of(F.col("position"), bounds))
    found = gram.trials(blocks, alphas)
    return {"alpha": gram.best_alpha(found, alphas)}, blocks, found


@dataclass
class Prepared:
    """Train rows as stored feature vectors, with the stages that made them; several models may be fitted on them."""

    task: str
    stages: list
    vectors: DataFrame
    rows: int
    undated: int
    ordered: bool


def prepare(train: DataFrame, spec: TableSpec, task: str, *, ties: Sequence[Column],
            ordered: bool | None = None) -> Prepared:
    """Cleans and encodes raw train rows once.

    Rows are put in time order when something depends on it: tuning folds
    (``ordered``), or a classifier's threshold.  The encoder learns from every row.
    """
    labelled = train.withColumn(LABEL, label_column(train, spec, task)).where(
        F.col(LABEL).isNotNull())
    ordered = task == "classification" if ordered is None else ordered
    stages, vectors = _encode(
        splits.training_order(labelled, spec, ties) if ordered else labelled, spec, task)
    moments = F.count_if(F.col("_moment").isNull()) if ordered else F.lit(0).cast("long")
    size = vectors.agg(F.count(F.lit(1)).alias("rows"), moments.alias("undated")).first()
    return Prepared(task, stages, vectors, size["rows"], size["undated"], ordered)


def fit(train: DataFrame, spec: TableSpec, task: str, name: str = DEFAULT_ESTIMATOR, *,
        ties: Sequence[Column], settings: dict | None = None, tuned: bool = False,
        grid: dict | None = None, folds: int = FOLDS) -> TrainedModel:
    """Fits a model on raw train rows; see ``fit_prepared``."""
    checked_name(task, name)
    prepared = prepare(train, spec, task, ties=ties, ordered=task == "classification" or tuned)
    return fit_prepared(prepared, name, settings=settings, tuned=tuned, grid=grid, folds=folds)


def fit_prepared(prepared: Prepared, name: str = DEFAULT_ESTIMATOR, *, settings: dict | None = None,
                 tuned: bool = False, grid: dict | None = None, folds: int = FOLDS) -> TrainedModel:
    """Fits a model on prepared rows.

    A classifier's threshold is read off the latest 20% as scored by a model of
    the earliest 80%.  The final model learns from every row.
    """
    task, vectors, rows = prepared.task, prepared.vectors, prepared.rows
    checked_name(task, name)
    if not prepared.ordered and (tuned or task == "classification"):
        raise ValueError("rows must be prepared in time order for this")

    def model(tail: list, threshold: float | None = None) -> TrainedModel:
        return TrainedModel(task, PipelineModel([*prepared.stages, *tail]), threshold, settings, len(prepared.stages))

    if tuned and name == "ridge":
        settings, blocks, _ = tune_ridge(vectors, rows, prepared.undated, folds, grid)
        return model([_ridge(blocks, settings)])
    if tuned:
        settings = tune(vectors, task, name, rows, prepared.undated, folds, grid)
    tail = _fit_tail(vectors, task, name, settings)
    if task == "regression":
        return model(tail)
    cut = int(rows * (1 - HOLDOUT_SHARE))
    early = vectors.where(F.col("position") < cut)
    late = vectors.where(F.col("position") >= cut)
    both = early.select(LABEL).distinct().count() == 2
    if not both or late.where(F.col(LABEL) == 1).isEmpty():
        return model(tail, 0.5)
    trial = TrainedModel(task, PipelineModel(_fit_tail(early, task, name, settings)), 0.5)
    return model(tail, choose_threshold(trial.score(late), F.col(LABEL) == 1, F.col("probability")))


def save(model: TrainedModel, path: str) -> None:
    model.chain.write().save(f"{path}/chain")
    SparkSession.active().createDataFrame([(model.task, model.threshold)], "task string, threshold double") \
        .coalesce(1).write.json(f"{path}/decision")


def load(spark, path: str) -> TrainedModel:
    row = spark.read.schema("task string, threshold double").json(f"{path}/decision").first()
    return TrainedModel(row["task"], PipelineModel.load(f"{path}/chain"), row["threshold"])


def scores(scored: DataFrame, task: str, truth: str = LABEL) -> DataFrame:
    """One row with the scores of a scored table."""
    if task == "regression":
        return metrics.regression(scored, truth, "prediction")
    flat = scored.select(F.col(truth).cast("boolean").alias("t"), F.col("answer").alias("a"),
                         F.col("probability").alias("p"))
    return side_by_side(metrics.classification(flat, "t", "a"), metrics.auc(flat, "t", "p"))


def train_job(train: DataFrame, spec: TableSpec, task: str, name: str, run_id: str, data_id: str,
              dataset_version: str, *, ties: Sequence[Column], settings: dict | None = None,
              tuned: bool = False, grid: dict | None = None, folds: int = FOLDS,
              prepared: Prepared | None = None) -> tuple[TrainedModel, DataFrame]:
    """Fits a model and returns it with its row for the runs table.

    Raw rows are cleaned and encoded once, for the fit and for the train scores, or
    not at all if they come ``prepared``.
    """
    checked_name(task, name)
    prepared = prepared or prepare(train, spec, task, ties=ties, ordered=task == "classification" or tuned)
    model = fit_prepared(prepared, name, settings=settings, tuned=tuned, grid=grid, folds=folds)
    measured = scores(model.score_vectors(prepared.vectors), task)
    run = measured.select(
        F.lit(run_id).alias("run_id"), F.lit(task).alias("task_type"),
        F.lit(name).alias("estimator"), F.lit(data_id).alias("data_id"),
        F.lit(dataset_version).alias("dataset_version"),
        F.lit(model.threshold).cast("double").alias("threshold"),
        F.to_json(F.create_map(*[F.lit(x) for kv in (model.settings or {}).items()
                                 for x in (kv[0], str(kv[1]))])
                  if model.settings else F.create_map()).alias("params"),
        *[F.col(c).alias(f"train_{c}") for c in measured.columns],
    )
    return model, run


def evaluate_job(test: DataFrame, spec: TableSpec, task: str, candidate: TrainedModel,
                 champion: TrainedModel | None, champion_train: DataFrame | None = None,
                 min_rows: int = metrics.EVALUATION_GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """Scores candidate and champion on the same rows; (verdict row, group scores).

    The rows' feature vectors are stored once, so verdict, groups and a champion
    with the same encoder read the same ones.
    """
    labelled = test.withColumn(LABEL, label_column(test, spec, task)).where(
        F.col(LABEL).isNotNull())
    shared = champion is not None and champion.encodes_like(candidate)
    if candidate.encoders:
        needed = [c for c in dict.fromkeys([LABEL, *spec.group_columns]) if c in labelled.columns]
        vectors = materialize(candidate.encode(labelled).select(*needed, "features"), "vectors")
        mine = candidate.score_vectors(vectors).drop("features")
    else:
        mine = materialize(candidate.score(labelled), "scored")
    own = scores(mine, task)
    parts = [own.select(*[F.col(c).alias(f"candidate_{c}") for c in own.columns]),
             overlap(test, champion_train, spec.id_column)]
    if champion is not None:
        rival = scores(champion.score_vectors(vectors) if shared else champion.score(labelled), task)
        parts.append(rival.select(*[F.col(c).alias(f"champion_{c}") for c in rival.columns]))
    row = side_by_side(*parts)
    for c in own.columns:
        if f"champion_{c}" not in row.columns:
            row = row.withColumn(f"champion_{c}", F.lit(None).cast("double"))
    verdict = metrics.gate(row, task)
    if task == "regression":
        groups = metrics.by_group(mine, task, spec.group_columns, LABEL, "prediction",
                                  min_rows=min_rows)
    else:
        flat = mine.withColumn(LABEL, F.col(LABEL).cast("boolean"))
        groups = metrics.by_group(flat, task, spec.group_columns, LABEL, "answer", "probability",
                                  min_rows)
    return verdict, groups
