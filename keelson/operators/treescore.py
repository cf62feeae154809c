"""Fitted tree ensembles as plain expressions.

A boosted or random forest is read into one flat table of nodes.  Scoring is then a
projection of built-in expressions over the feature vector: nested CASE for shallow
ensembles, or a walk through arrays of nodes for deep ones, whose size in the plan does not
grow with the number of trees.  The CASE form is SQL text that other engines read as well.

Every split is brought to the form ``entry <= threshold``.  One-hot entries, which MLlib
splits as categories, take 0.5 as threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import scratch_path

#: Up to so many nodes an ensemble is written as nested CASE.
CASE_NODES = 1024


@dataclass
class Ensemble:
    """Nodes of all trees one after the other; a leaf's children are itself."""

    kind: str  #: ``sum`` of weighted leaves, or ``odds``: a logistic curve on twice that sum
    roots: list[int]
    weights: list[float]
    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    @property
    def depth(self) -> int:
        def below(node: int) -> int:
            return 0 if self.left[node] == node else 1 + max(below(self.left[node]), below(self.right[node]))
        return max(map(below, self.roots), default=0)


def read_ensemble(model) -> Ensemble:
    """The nodes of a fitted MLlib tree model, of any of the four kinds or a single tree.

    A forest's weights are shares, so regression takes the mean of its trees and
    classification the mean of the leaves' shares of the second class.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    many = "treeID" in rows.columns
    flat = rows.select("treeID", "nodeData.*") if many else rows.withColumn("treeID", F.lit(0))
    boosted = type(model).__name__.startswith("GBT")
    shares = not boosted and "Classification" in type(model).__name__
    weights = list(model.treeWeights) if many else [1.0]
    if many and not boosted:
        weights = [w / sum(weights) for w in weights]
    out = Ensemble("odds" if boosted and "Classification" in type(model).__name__ else "sum", [], weights, [], [], [], [], [])
    trees: dict[int, list] = {}
    # MLlib itself keeps a model on the driver.
    for row in flat.orderBy("treeID", "id").collect():
        trees.setdefault(row["treeID"], []).append(row)
    for tree in sorted(trees):
        begin = len(out.feature)
        out.roots.append(begin)
        for at, row in enumerate(trees[tree], begin):
            stats = row["impurityStats"]
            out.value.append(stats[1] / sum(stats) if shares else row["prediction"])
            if row["leftChild"] < 0:
                split = (0, 0.0, at, at)
            else:
                split = (*_threshold(row["split"]), begin + row["leftChild"], begin + row["rightChild"])
                if row["split"]["numCategories"] == 2 and row["split"]["leftCategoriesOrThreshold"] == [1.0]:
                    split = (*split[:2], split[3], split[2])
            for column, v in zip((out.feature, out.threshold, out.left, out.right), split, strict=True):
                column.append(v)
    return out


def _threshold(split) -> tuple[int, float]:
    if split["numCategories"] == -1:
        return split["featureIndex"], split["leftCategoriesOrThreshold"][0]
    if split["numCategories"] > 2:
        raise ValueError(f"entry {split['featureIndex']} has {split['numCategories']} categories; one-hot encode it")
    return split["featureIndex"], 0.5


def _number(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def to_sql(ensemble: Ensemble, entry: Callable[[int], str]) -> str:
    """The score as SQL text; ``entry`` writes the feature vector's entry at an index."""
    def case(node: int) -> str:
        if ensemble.left[node] == node:
            return _number(ensemble.value[node])
        return (f"CASE WHEN {entry(ensemble.feature[node])} <= {_number(ensemble.threshold[node])} "
                f"THEN {case(ensemble.left[node])} ELSE {case(ensemble.right[node])} END")
    terms = [f"{_number(w)} * ({case(r)})" for r, w in zip(ensemble.roots, ensemble.weights, strict=True)]
    total = " + ".join(terms) or _number(0.0)
    return f"1 / (1 + exp(-2 * ({total})))" if ensemble.kind == "odds" else total


def _literal(values: Sequence, kind: str) -> Column:
    """An array constant that is one node of the plan, however long."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def walk(ensemble: Ensemble, array: Column) -> Column:
    """The score by walking each tree from its root, ``depth`` steps; a leaf stays where it is."""
    feature, left, right = (_literal(v, "int") for v in (ensemble.feature, ensemble.left, ensemble.right))
    threshold, value = (_literal(v, "double") for v in (ensemble.threshold, ensemble.value))
    steps = _literal(range(ensemble.depth), "int") if ensemble.depth else F.array().cast("array<int>")

    def leaf(root: Column) -> Column:
        return F.aggregate(steps, root, lambda node, _: F.when(
            F.get(array, F.get(feature, node)) <= F.get(threshold, node), F.get(left, node)).otherwise(F.get(right, node)))

    trees = F.arrays_zip(_literal(ensemble.roots, "int").alias("root"), _literal(ensemble.weights, "double").alias("weight"))
    total = F.aggregate(trees, F.lit(0.0), lambda a, t: a + t["weight"] * F.get(value, leaf(t["root"])))
    return 1 / (1 + F.exp(-2 * total)) if ensemble.kind == "odds" else total


def score(df: DataFrame, ensemble: Ensemble, name: str = "score", features: str = "features") -> DataFrame:
    """Adds the ensemble's score of an MLlib vector column; a class score is the probability of the second class."""
    held = df.withColumn("_entries", vector_to_array(features))
    if len(ensemble.feature) <= CASE_NODES:
        # Entries are taken out once, by name; nested CASE then compares plain columns.
        used = sorted({f for f, left, at in zip(ensemble.feature, ensemble.left, range(len(ensemble.left)), strict=True)
                       if left != at})
        held = held.select("*", *[F.get("_entries", F.lit(f)).alias(f"_entry_{f}") for f in used])
        return held.withColumn(name, F.expr(to_sql(ensemble, lambda f: f"_entry_{f}"))).drop(
            "_entries", *[f"_entry_{f}" for f in used])
    return held.withColumn(name, walk(ensemble, F.col("_entries"))).drop("_entries")
