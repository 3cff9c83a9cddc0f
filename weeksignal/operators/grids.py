"""Whole parameter grids from one fit.

A greedy tree of some depth is the top of a deeper one, so the deepest tree of a grid holds all
others: it is cut at a depth, and children that predict the same are folded into their parent as
the learner folds them. A forest of fewer trees is a part of a larger one; trees are independent
draws, so the first n trees of a forest of N are a forest of n, though not the one that a fit of
its own would draw with the same seed. Regressions of one grid share their passes over the rows:
each pass adds up gradient and curvature at all points, and a Newton step follows.

Models are as large as their learner makes them (a tree has no more leaves than training rows);
rows are scored at all points of a grid in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weeksignal.session import scratch_path, ship_package


def node_table(model) -> DataFrame:
    """tree, id, feature, threshold, below, above, weights, gain of a fitted tree or forest, read from its files.

    ``below`` holds the node for values up to the threshold; leaves have -1 for both.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "model")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    if "nodeData" in rows.columns:
        rows = rows.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        rows = rows.withColumn("tree", F.lit(0))
    return rows.select(
        "tree", "id", F.col("split.featureIndex").alias("feature"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("below"), F.col("rightChild").alias("above"), F.col("impurityStats").alias("weights"), "gain",
    )


@dataclass
class Nodes:
    """The nodes of some trees, one tree after the other; children are positions in these arrays."""

    tree: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray
    weights: np.ndarray
    gain: np.ndarray
    depth: np.ndarray
    roots: np.ndarray

    @classmethod
    def of(cls, table: DataFrame) -> Nodes:
        found = table.orderBy("tree", "id").toPandas()
        tree, ids = found["tree"].to_numpy(np.int64), found["id"].to_numpy(np.int64)
        first = np.searchsorted(tree, np.arange(tree.max() + 1))
        inner = found["below"].to_numpy(np.int64) >= 0
        child = lambda name: np.where(inner, found[name].to_numpy(np.int64) + first[tree], -1)
        below, above = child("below"), child("above")
        depth = np.zeros(len(ids), np.int64)
        level = first
        while len(level):
            level = level[inner[level]]
            for side in (below, above):
                depth[side[level]] = depth[level] + 1
            level = np.concatenate((below[level], above[level]))
        weights = np.vstack(found["weights"].to_list()).astype(float)
        if weights.shape[1] == 1:  # no row of class 1
            weights = np.column_stack((weights, np.zeros(len(weights))))
        return cls(
            tree, np.where(inner, found["feature"], 0).astype(np.int64), np.where(inner, found["threshold"], 0.0).astype(float),
            below, above, weights, found["gain"].to_numpy(float), depth, first,
        )

    @property
    def share(self) -> np.ndarray:
        """The share of class 1 in each node."""
        total = self.weights.sum(axis=1)
        return np.divide(self.weights[:, 1], total, out=np.zeros(len(total)), where=total > 0)

    @property
    def says(self) -> np.ndarray:
        """The class of each node; equal weights say 0."""
        return self.weights.argmax(axis=1)

    def ends(self, depth: int | None) -> np.ndarray:
        """The nodes at which trees of that depth end."""
        ends = (self.below < 0) | (depth is not None and self.depth >= depth)
        says = self.says
        for level in range(int(self.depth.max()) - 1, -1, -1):
            at = np.flatnonzero((self.depth == level) & ~ends)
            low, high = self.below[at], self.above[at]
            ends[at[ends[low] & ends[high] & (says[low] == says[high])]] = True
        return ends

    def scores(self, x: np.ndarray, points: list[tuple[int, int | None]], ends: dict[int | None, np.ndarray]) -> np.ndarray:
        """Per row and point (trees, depth) the mean share of the leaves, given where trees of each depth end."""
        depths, share = list(ends), self.share
        ends = np.stack(list(ends.values()))
        most = max(trees for trees, _ in points)
        sums, out = np.zeros((len(depths), len(x))), np.empty((len(x), len(points)))
        for k in range(most):
            node = np.full(len(x), self.roots[k])
            left = np.ones((len(depths), len(x)), bool)
            while left.any():
                stops = left & ends[:, node]
                sums += np.where(stops, share[node], 0.0)
                left &= ~stops
                goes = self.below[node] >= 0
                low = x[np.arange(len(x)), self.feature[node]] <= self.threshold[node]
                node = np.where(goes, np.where(low, self.below[node], self.above[node]), node)
            for at, (trees, depth) in enumerate(points):
                if trees == k + 1:
                    out[:, at] = sums[depths.index(depth)] / trees
        return out

    def importances(self, trees: int, depth: int | None, n_features: int) -> np.ndarray:
        """Gain times weight by feature, a sum of one for each tree and for all."""
        ends = self.ends(depth)
        total = np.zeros(n_features)
        reached = np.zeros(len(ends), bool)
        reached[self.roots[:trees]] = True
        for level in range(int(self.depth.max()) + 1):
            at = np.flatnonzero(reached & (self.depth == level) & ~ends)
            reached[self.below[at]] = reached[self.above[at]] = True
        for k in range(trees):
            at = np.flatnonzero(reached & ~ends & (self.tree == k))
            own = np.bincount(self.feature[at], self.gain[at] * self.weights[at].sum(axis=1), n_features)
            total += own / own.sum() if own.sum() > 0 else own
        return total / total.sum() if total.sum() > 0 else total


class Trees:
    """The points (trees, depth) of a grid, all within one set of nodes."""

    def __init__(self, nodes: Nodes, points: list[tuple[int, int | None]], n_features: int):
        self.nodes, self.points, self.n_features = nodes, points, n_features

    def scores(self, features: Column) -> Column:
        """An array of each row's score at every point."""
        spark, points = SparkSession.active(), self.points
        ship_package(spark)
        shared = spark.sparkContext.broadcast((self.nodes, {depth: self.nodes.ends(depth) for _, depth in points}))

        @F.pandas_udf("array<double>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            nodes, ends = shared.value
            for batch in batches:
                yield pd.Series(list(nodes.scores(np.vstack(batch.to_list()), points, ends)) if len(batch) else [])

        return run(vector_to_array(features))

    def add_scores(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("scores", self.scores(F.col("features")))

    def at(self, position: int) -> Trees:
        return Trees(self.nodes, [self.points[position]], self.n_features)

    def weights(self) -> np.ndarray:
        return self.nodes.importances(*self.points[0], self.n_features)


class Lines:
    """The regressions of a grid: a row of coefficients for each point, the intercept last."""

    def __init__(self, coefficients: np.ndarray):
        self.coefficients = coefficients

    def add_scores(self, rows: DataFrame) -> DataFrame:
        x = vector_to_array("scaled")
        each = []
        for *slopes, intercept in self.coefficients.tolist():
            product = F.zip_with(x, F.array(*map(F.lit, slopes)), lambda a, b: a * b)
            each.append(1 / (1 + F.exp(-F.aggregate(product, F.lit(float(intercept)), lambda s, v: s + v))))
        return rows.withColumn("scores", F.array(*each))

    def at(self, position: int) -> Lines:
        return Lines(self.coefficients[position : position + 1])

    def weights(self) -> np.ndarray:
        return self.coefficients[0, :-1]


def _derivatives(rows: DataFrame, label: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted loss, gradient and curvature of the logistic loss at each point, in one pass."""
    points, width = at.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loss, slope, curve = np.zeros(points), np.zeros((points, width)), np.zeros((points, width, width))
        for batch in batches:
            if not len(batch):
                continue
            x = np.column_stack((np.vstack(batch["x"].to_list()), np.ones(len(batch))))
            y, w = batch["y"].to_numpy(float), batch["w"].to_numpy(float)
            for k in range(points):
                z = x @ at[k]
                p = 0.5 * (1 + np.tanh(z / 2))
                loss[k] += w @ (np.logaddexp(0, z) - y * z)
                slope[k] += x.T @ (w * (p - y))
                curve[k] += (x * (w * p * (1 - p))[:, None]).T @ x
        yield pd.DataFrame({"v": [np.concatenate((loss, slope.ravel(), curve.ravel()))]})

    x = rows.select(vector_to_array("scaled").alias("x"), F.col(label).cast("double").alias("y"), F.col("weight").alias("w"))
    parts = x.mapInPandas(run, "v array<double>").collect()  # one row a partition of the fit
    total = np.sum([r["v"] for r in parts], axis=0)
    return total[:points], total[points : points * (1 + width)].reshape(points, width), total[points * (1 + width) :].reshape(points, width, width)


def fit_lines(train: DataFrame, strengths: list[float], n_features: int, label: str, rounds: int = 100) -> Lines:
    """L2 regressions that minimise c times the weighted loss plus half the squared slopes, for every c."""
    c = np.array(strengths, float)
    ridge = np.diag([1.0] * n_features + [0.0])
    now = np.zeros((len(c), n_features + 1))
    step, last = np.zeros_like(now), np.full(len(c), np.inf)
    for _ in range(rounds):
        loss, slope, curve = _derivatives(train, label, now)
        value = c * loss + 0.5 * (now[:, :-1] ** 2).sum(axis=1)
        worse = value > last + 1e-12 * np.abs(last)
        # a step that went too far is halved, others go on
        step[worse] /= 2
        now[worse] -= step[worse]
        last[~worse] = value[~worse]
        gradient = c[:, None] * slope + now @ ridge
        for k in np.flatnonzero(~worse):
            step[k] = -np.linalg.lstsq(c[k] * curve[k] + ridge, gradient[k], rcond=None)[0]
            now[k] += step[k]
        if np.abs(step).max() <= 1e-10 * (1 + np.abs(now).max()):
            break
    return Lines(now)
