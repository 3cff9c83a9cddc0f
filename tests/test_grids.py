"""Whole grids from one fit against separate fits."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.test_models import matrix  # noqa: F401
from weeksignal.operators import grids, models

DEPTHS = [1, 2, 3, 5, 8, None]


@pytest.fixture(scope="module")
def data(matrix):  # noqa: F811
    found = models.prepare(matrix)
    found.train = models.dealt(found.part("train")).cache()
    return found


def walk(below, above, feature, threshold, weights, ends, node=0):
    """A tree as nested tuples."""
    if ends[node]:
        return ("leaf", tuple(np.round(weights[node], 9)))
    parts = [walk(below, above, feature, threshold, weights, ends, int(side[node])) for side in (below, above)]
    return (int(feature[node]), float(threshold[node]), *parts)


def own(model):
    n = grids.Nodes.of(grids.node_table(model))
    return n, walk(n.below, n.above, n.feature, n.threshold, n.weights, n.below < 0)


def scored(rows, column):
    return np.array([r["s"] for r in rows.withColumn("s", column).orderBy("canonical_topic", "week").collect()])


def test_cut_trees_equal_separate_fits_node_by_node(spark, data):
    deep = models.tree_grid(data.train, DEPTHS)
    val = data.part("val")
    together = scored(deep.add_scores(val), F.col("scores"))
    for k, depth in enumerate(DEPTHS):
        model = models.fit_tree(data.train, depth)
        n, want = own(model)
        whole = deep.nodes
        assert walk(whole.below, whole.above, whole.feature, whole.threshold, whole.weights, whole.ends(deep.points[k][1])) == want
        assert np.allclose(together[:, k], scored(models.score(model, val), F.col("score")), atol=1e-12)
        assert np.allclose(deep.at(k).weights(), model.featureImportances.toArray(), atol=1e-12)


def test_the_largest_point_is_the_fitted_forest(spark, data):
    points = [(3, 2), (3, 4), (7, 2), (7, 4)]
    whole = models.forest_grid(data.train, points)
    forest = models.fit_forest(data.train, 7, 4)
    val = data.part("val")
    together = scored(whole.add_scores(val), F.col("scores"))
    assert np.allclose(together[:, 3], scored(models.score(forest, val), F.col("score")), atol=1e-12)
    assert np.allclose(whole.at(3).weights(), forest.featureImportances.toArray(), atol=1e-12)
    # the first trees of the forest, each as its learner would score it
    first = [scored(tree.transform(val), vector_to_array("probability")[1]) for tree in forest.trees[:3]]
    assert np.allclose(together[:, 1], np.mean(first, axis=0), atol=1e-12)
    assert [round(w, 9) for w in whole.at(0).weights()] != [round(w, 9) for w in whole.at(2).weights()]


def test_lines_equal_separate_fits(spark, data):
    strengths = [0.01, 0.1, 10.0]
    lines = models.logistic_grid(data.train, strengths)
    val = data.part("val")
    together = scored(lines.add_scores(val), F.col("scores"))
    for k, c in enumerate(strengths):
        model = models.fit_logistic(data.train, c)
        assert np.allclose(lines.at(k).weights(), model.coefficients.toArray(), atol=1e-4)
        assert np.allclose(together[:, k], scored(models.score(model, val), F.col("score")), atol=1e-4)
    x = np.array([r.scaled.toArray() for r in data.train.select("scaled").collect()])
    rows = data.train.select("label_next2wk", "weight").collect()
    y, w = (np.array([r[k] for r in rows]) for k in (0, 1))
    for c, row in zip(strengths, lines.coefficients, strict=True):
        p = 1 / (1 + np.exp(-(x @ row[:-1] + row[-1])))
        assert np.abs(row[:-1] + c * x.T @ (w * (p - y))).max() < 1e-6 and abs((w * (p - y)).sum()) < 1e-6


def test_a_step_that_goes_too_far_is_halved(spark):
    """Far from the optimum the curvature vanishes; separable rows end where the ridge holds them."""
    rows = [(float(x), int(x > 0), 1.0) for x in (-60, -50, -1, 1, 50, 60)] * 3
    df = spark.createDataFrame(rows, "x double, y int, weight double")
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["x"], outputCol="scaled").transform(df)
    slope, intercept = grids.fit_lines(df, [1000.0], 1, "y").coefficients[0]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    p = 1 / (1 + np.exp(-(x * slope + intercept)))
    assert abs(slope + 1000 * (x * (p - y)).sum()) < 1e-4 and abs(intercept) < 1e-6


def test_both_ways_of_tuning_agree(spark, data):
    one = models.tune(data, [1, 3, None], models.fit_tree)[1].orderBy("grid_pos").collect()
    each = models.tune(data, [1, 3, None], models.fit_tree, whole=False)[1].orderBy("grid_pos").collect()
    for a, b in zip(one, each, strict=True):
        assert a.params == b.params and a.f1 == pytest.approx(b.f1) and a.roc_auc == pytest.approx(b.roc_auc)


def test_a_single_leaf(spark, data):
    none = data.train.withColumn("label_next2wk", F.lit(0))
    whole = models.tree_grid(none, [2, None])
    assert len(whole.nodes.tree) == 1 and set(scored(whole.add_scores(data.part("val")), F.col("scores")).ravel()) == {0.0}
    assert whole.at(0).weights().sum() == 0
