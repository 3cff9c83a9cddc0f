import numpy as np
import pytest
from pyspark.sql import functions as F

from weeksignal.operators import models


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(2)
    rows = []
    for w in range(1, 41):
        for t in range(15):
            rate = float(rng.random())
            rows.append((f"t{t}", f"2024-W{w:02d}" if w <= 52 else "", float(rng.normal()), int(rng.integers(1, 9)), rate, rate / 2,
                         int(rng.integers(1, 200)), int(rng.random() < 0.2), int(rng.integers(0, 9)), int(rng.random() < 0.1 + 0.6 * (rate > 0.7))))
    return spark.createDataFrame(
        rows, "canonical_topic string, week string, burst_score double, mentions long, topic_nl_rate_8wk double, topic_nl_rate_alltime double, "
        "weeks_since_last_nl long, is_novel_topic int, past_nl_count long, label_next2wk int"
    )


def test_logistic_regression_minimises_the_summed_loss(spark, matrix):
    data = models.prepare(matrix)
    train = data.part("train")
    model = models.fit_logistic(train, 0.1)
    rows = train.select("scaled", "label_next2wk", "weight").collect()
    x = np.array([r.scaled.toArray() for r in rows]); y = np.array([r.label_next2wk for r in rows]); w = np.array([r.weight for r in rows])
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    gradient = model.coefficients.toArray() + 0.1 * x.T @ (w * (p - y))
    assert np.abs(gradient).max() < 1e-3
    assert abs((w * (p - y)).sum()) < 1e-3


def test_tuning_and_scoring(spark, matrix):
    data = models.prepare(matrix)
    best, table = models.tune(data, [1, 3], models.fit_tree)
    rows = table.orderBy("grid_pos").collect()
    assert [r.params for r in rows] == ["1", "3"] and max(r.f1 for r in rows) > 0
    scored = models.score(best, data.part("test"))
    assert scored.where("score < 0 or score > 1").count() == 0
    forest = models.fit_forest(data.part("train"), 5, 3)
    importance = models.importance_table(spark, forest, data.features, "rf").collect()
    assert sum(r.weight for r in importance) == pytest.approx(1.0) and importance[0].feature in ("topic_nl_rate_8wk", "topic_nl_rate_alltime")


def test_queries_keep_no_models(monkeypatch):
    from types import SimpleNamespace

    from weeksignal.catalog import model_queries

    runs = []
    monkeypatch.setattr(model_queries, "prepared", lambda spark, d: runs.append("rows") or len(runs))
    monkeypatch.setattr(model_queries.models, "tune", lambda data, *_: runs.append("grid") or ("model", data))
    session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="one"))
    first, second = (model_queries._tree(session, "folder") for _ in range(2))
    assert runs == ["rows", "grid"] * 2 and first != second


@pytest.mark.parametrize("label", [0, 1])
def test_grids_over_training_weeks_of_one_class(spark, matrix, label):
    from weeksignal.operators import evaluate

    train = evaluate.temporal_split(matrix).where("split = 'train'").select("week").distinct()
    mixed = matrix.join(train.withColumn("_t", F.lit(True)), "week", "left").withColumn(
        "label_next2wk", F.when(F.col("_t"), F.lit(label)).otherwise(F.col("label_next2wk")).cast("int")
    ).drop("_t")
    data = models.prepare(mixed)
    weights = {(r.label_next2wk, r.weight) for r in data.rows.select("label_next2wk", "weight").distinct().collect()}
    assert weights == {(label, 0.5), (1 - label, None)}
    for grid, fit in (([1, 3], models.fit_tree), ([0.1, 1.0], models.fit_logistic), ([(2, 2)], models.fit_forest)):
        best, table = models.tune(data, grid, fit)
        assert table.count() == len(grid)
        assert models.score(best, data.part("test")).where("prediction <> %d or score is null" % label).count() == 0


def test_fits_at_the_same_time_keep_their_rows_until_the_last(spark, matrix, monkeypatch):
    from threading import Event

    from weeksignal.catalog import model_queries

    first_done, kept = Event(), []

    def tune(data, grid, fit, fallback, **given):
        with models.training_rows(data) if "train" not in given else models.nullcontext(given["train"]) as train:
            if grid == "slow":
                assert first_done.wait(60)
                kept.append(train.storageLevel.useMemory)
        if grid == "quick":
            first_done.set()
        return grid, None

    data = models.prepare(matrix)
    monkeypatch.setattr(model_queries, "prepared", lambda spark, d: data)
    monkeypatch.setattr(model_queries.models, "tune", tune)
    monkeypatch.setattr(model_queries, "GRIDS", {"a": ("quick", None, 0), "b": ("slow", None, 0)})
    model_queries.tuned(spark, "folder", ["a", "b"])
    assert kept == [True]
    assert not models.dealt(data.part("train")).storageLevel.useMemory


def test_threads_ship_the_package_once():
    from concurrent.futures import ThreadPoolExecutor
    from time import sleep
    from types import SimpleNamespace

    from weeksignal import session

    shipped = []
    context = SimpleNamespace(addPyFile=lambda path: (sleep(0.2), shipped.append(path)))
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(session.ship_package, [SimpleNamespace(sparkContext=context)] * 3))
    assert len(shipped) == 1
