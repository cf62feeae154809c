"""Least squares from sums of products.

A ridge depends on its rows only through the sums of products of (1, features, label).
Such sums add up over blocks of rows, so one pass over stored vectors serves every
forward fold and every penalty: the sums of a fold's learning rows are a prefix sum over
blocks, and its error on the next block follows from that block's sums alone.

The pass is an aggregate of built-in expressions with partial sums in every task.  The
driver sees one small matrix for each block, whose size is that of a feature vector.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums that one aggregate row holds; longer vectors take several rows.
SUMS_IN_ROW = 48


@dataclass
class Gram:
    """Sums of products of (1, features, label) over some rows."""

    sums: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.sums + other.sums)

    @property
    def rows(self) -> int:
        return round(self.sums[0, 0])

    def ridge(self, alpha: float) -> Line:
        """The line of least squared error plus ``alpha`` times the squared weights; the intercept is free."""
        n = self.sums[0, 0]
        if not n:
            raise ValueError("no rows to learn from")
        means = self.sums[0, 1:] / n
        centred = self.sums[1:, 1:] - n * np.outer(means, means)
        penalized = centred[:-1, :-1] + alpha * np.eye(len(means) - 1)
        # Least squares of the equations themselves, for columns that vary together and no penalty.
        weights = np.linalg.lstsq(penalized, centred[:-1, -1], rcond=1e-13)[0] if alpha == 0 \
            else np.linalg.solve(penalized, centred[:-1, -1])
        return Line(float(means[-1] - means[:-1] @ weights), weights.tolist())

    def squared_error(self, line: Line) -> float:
        signed = np.array([line.intercept, *line.weights, -1.0])
        return max(float(signed @ self.sums @ signed), 0.0)

    def rmse(self, line: Line) -> float:
        return math.sqrt(self.squared_error(line) / self.sums[0, 0])


@dataclass
class Line:
    """A linear model of a feature vector."""

    intercept: float
    weights: list[float]


def grams(vectors: DataFrame, label: str, block: Column | None = None, features: str = "features") -> dict[int, Gram]:
    """The sums of each block of rows, in one pass; all rows are block 0 without ``block``.

    ``features`` is an MLlib vector column.  Rows with a null block are left out.
    """
    array = F.concat(F.array(F.lit(1.0)), vector_to_array(features), F.array(F.col(label).cast("double")))
    rows = vectors.select((F.lit(0) if block is None else block).cast("int").alias("block"), array.alias("z")).where(
        "block is not null")
    first = rows.select(F.size("z").alias("n")).first()
    if first is None:
        return {}
    size = first["n"]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    if len(pairs) <= SUMS_IN_ROW:
        # All sums of a short vector are one aggregate row, so rows are not copied for each entry.
        found = {}
        sums = rows.groupBy("block").agg(*[
            F.sum(F.get("z", F.lit(i)) * F.get("z", F.lit(j))).alias(f"s{k}") for k, (i, j) in enumerate(pairs)])
        for row in sums.collect():
            matrix = found.setdefault(row["block"], np.zeros((size, size)))
            for k, (i, j) in enumerate(pairs):
                matrix[i, j] = matrix[j, i] = row[f"s{k}"] or 0.0
        return {b: Gram(m) for b, m in sorted(found.items())}
    parts = -(-size // SUMS_IN_ROW)
    # One row for each entry that is not zero, and for each stretch of entries it is multiplied with.
    entries = rows.select("block", "z", F.posexplode("z").alias("i", "v")).where("v <> 0").select(
        "block", "z", "i", "v", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    start = F.col("part") * SUMS_IN_ROW
    sums = entries.groupBy("block", "i", "part").agg(*[
        F.sum(F.col("v") * F.get("z", start + k)).alias(f"s{k}") for k in range(min(SUMS_IN_ROW, size))])
    found: dict[int, np.ndarray] = {}
    for row in sums.collect():
        matrix = found.setdefault(row["block"], np.zeros((size, size)))
        begin = row["part"] * SUMS_IN_ROW
        end = min(begin + SUMS_IN_ROW, size)
        matrix[row["i"], begin:end] = [row[f"s{k}"] or 0.0 for k in range(end - begin)]
    # Both halves hold the same sums, added up in other orders.
    return {b: Gram((m + m.T) / 2) for b, m in sorted(found.items())}


def block_of(position: Column, bounds: Sequence[tuple[int, int]]) -> Column:
    """0 for rows that are only learned from, k for those that fold k - 1 is scored on."""
    out = F.lit(0)
    for k, (start, _) in enumerate(bounds, 1):
        out = F.when(position >= start, k).otherwise(out)
    return out


@dataclass
class Trial:
    """One penalty on one forward fold."""

    alpha: float
    fold: int
    learned: int
    scored: int
    rmse: float


def trials(blocks: dict[int, Gram], alphas: Sequence[float]) -> list[Trial]:
    """Every penalty on every forward fold, from the sums of the blocks."""
    out = []
    before = blocks[0] if 0 in blocks else Gram(np.zeros_like(next(iter(blocks.values())).sums))
    for fold, block in enumerate(b for b in blocks if b > 0):
        for alpha in alphas:
            out.append(Trial(alpha, fold, before.rows, blocks[block].rows, blocks[block].rmse(before.ridge(alpha))))
        before = before + blocks[block]
    return out


def best_alpha(found: Sequence[Trial], alphas: Sequence[float]) -> float:
    """The penalty with the least mean error over the folds, of equal ones the first."""
    def mean(alpha: float) -> float:
        errors = [t.rmse for t in found if t.alpha == alpha]
        return sum(errors) / len(errors)
    return min(alphas, key=mean)
