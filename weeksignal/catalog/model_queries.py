"""Fitted models; their numbers depend on the learner, so there is no SQL twin."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from weeksignal.catalog.common import Registry, feature_table, nl_weekly
from weeksignal.operators import distribution, evaluate, models
from weeksignal.session import cut_lineage

reg = Registry()


def prepared(spark, d):
    capped = distribution.cap_quantile(feature_table(spark, d), ["burst_score", "mentions"])
    return models.prepare(capped)


GRIDS = {
    "Decision Tree": (models.TREE_DEPTHS, models.fit_tree, 0),
    "Logistic Regression": (models.REGULARISATION, models.fit_logistic, models.REGULARISATION.index(0.1)),
    "Random Forest": (models.FOREST_GRID, models.fit_forest, 0),
}


def tuned(spark, d, names=tuple(GRIDS)):
    """The prepared rows, and by name the best model of a grid and the grid's scores; each query searches anew.

    The grids of one query are fitted at the same time, as the jobs of each leave cores idle.
    """
    data = prepared(spark, d)
    if len(names) == 1:
        return data, {names[0]: models.tune(data, *GRIDS[names[0]])}
    with models.training_rows(data) as train, ThreadPoolExecutor(len(names)) as pool:
        search = lambda name: models.tune(data, *GRIDS[name], train=train)
        return data, dict(zip(names, pool.map(inheritable_thread_target(spark)(search), names), strict=True))


def grid_scores(spark, d, name):
    return tuned(spark, d, [name])[1][name][1]


@reg.add("decision_tree")
def _tree(spark, d):
    return grid_scores(spark, d, "Decision Tree")


@reg.add("logistic_regression")
def _logistic(spark, d):
    return grid_scores(spark, d, "Logistic Regression")


@reg.add("random_forest")
def _forest(spark, d):
    return grid_scores(spark, d, "Random Forest")


@reg.add("feature_importance")
def _importance(spark, d):
    data, found = tuned(spark, d)
    parts = [models.importance_table(spark, model, data.features, name) for name, (model, _) in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def scored_models(spark, d):
    """The test weeks, scored by the best model of each grid."""
    data, found = tuned(spark, d)
    scored = None
    for name, (model, _) in found.items():
        part = models.score(model, data.part("test")).withColumn("model", F.lit(name))
        scored = part if scored is None else scored.unionByName(part)
    return cut_lineage(scored.drop("features", "scaled"), "scored-models")


@reg.add("model_comparison")
def _comparison(spark, d):
    return evaluate.model_comparison(scored_models(spark, d))


@reg.add("model_rankings")
def _rankings(spark, d):
    return evaluate.precision_recall_at_k(scored_models(spark, d), keys=["model"])


def per_model(spark, d, table):
    """``table`` of each model's scored test rows, under the model's name."""
    scored, found = scored_models(spark, d), None
    for name in GRIDS:
        part = table(scored.where(F.col("model") == name).drop("model")).select(F.lit(name).alias("model"), "*")
        found = part if found is None else found.unionByName(part)
    return found


@reg.add("model_report")
def _report(spark, d):
    return per_model(spark, d, evaluate.classification_report)


@reg.add("model_lead_time")
def _lead_time(spark, d):
    newsletters = nl_weekly(spark, d)
    return per_model(spark, d, lambda test: evaluate.lead_time_stats(cut_lineage(evaluate.lead_times(test, newsletters), "leads")))


@reg.add("model_strata")
def _strata(spark, d):
    return per_model(spark, d, evaluate.stratified_eval)
