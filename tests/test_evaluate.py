import numpy as np
import pytest
from pyspark.sql import functions as F

from weeksignal.operators import evaluate

LABELS, SCORES = [1, 0, 1, 0, 0], [0.9, 0.8, 0.8, 0.3, 0.3]


@pytest.fixture(scope="module")
def five(spark):
    rows = [(t, "2024-W01", y, s) for t, y, s in zip("abcde", LABELS, SCORES)]
    rows += [(t, "2024-W02", 0, 0.5) for t in "ab"]
    df = spark.createDataFrame(rows, "canonical_topic string, week string, label_next2wk int, score double")
    return df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def test_areas_with_ties(five):
    got = evaluate.ranking_areas(five.where("week = '2024-W01'")).first()
    assert got.roc_auc == pytest.approx(0.9166666667)
    assert got.average_precision == pytest.approx(0.8333333333)


def test_one_class_has_no_area(five):
    got = evaluate.ranking_areas(five, ["week"]).where("week = '2024-W02'").first()
    assert got.roc_auc is None and got.average_precision is None


def test_precision_and_recall_at_k(five):
    got = evaluate.precision_recall_at_k(five).first()
    assert got.p_at_3 == pytest.approx(2 / 3) and got.r_at_3 == 1.0
    assert got.p_at_10 == 0.0 and got.r_at_10 == 1.0
    hits = evaluate.weekly_hits(five).collect()
    assert len(hits) == 1


def test_report_and_confusion(five):
    c = evaluate.confusion(five).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (2, 3, 0, 2)
    report = {r["class"]: r for r in evaluate.classification_report(five).collect()}
    assert report["In NL"].f1 == pytest.approx(4 / 7)
    assert report["accuracy"].f1 == pytest.approx(4 / 7)
    assert report["weighted avg"].support == 7


def test_calibration_edges(spark):
    df = spark.createDataFrame([(0.125, 1), (0.0, 0), (1.0, 1), (0.126, 0)], "score double, label_next2wk int")
    got = {r.bin: r.n for r in evaluate.calibration_curve(df).collect()}
    assert got == {0: 2, 1: 1, 7: 1}


def test_temporal_split_cutoffs(spark):
    df = spark.createDataFrame([(f"2024-W{i:02d}", i % 2) for i in range(1, 21)], "week string, label_next2wk int")
    got = {r.split: r.weeks for r in evaluate.split_summary(evaluate.temporal_split(df)).collect()}
    assert got == {"train": 14, "val": 3, "test": 3}


def test_lead_time(spark):
    test = spark.createDataFrame(
        [("T", f"2024-W{w:02d}", s, y) for w, s, y in [(3, 0.4, 0), (7, 0.5, 0), (9, 0.1, 1), (10, 0.9, 0)]]
        + [("U", "2024-W10", 0.9, 0)],
        "canonical_topic string, week string, score double, label_next2wk int",
    )
    nl = spark.createDataFrame([("T", "2024-W10"), ("U", "2024-W10"), ("T", "2025-W30")], "canonical_topic string, week string")
    got = [tuple(r) for r in evaluate.lead_times(test, nl).collect()]
    assert got == [("T", "2024-W10", "2024-W03", 7)]
    by_label = evaluate.lead_times(test, anchor="label").collect()
    assert [r.lead_weeks for r in by_label] == [6]


def test_scaling_uses_training_rows_only(spark):
    df = spark.createDataFrame([("train", 1.0, 5.0), ("train", 3.0, 5.0), ("test", 100.0, 6.0)], "split string, a double, b double")
    out = evaluate.standard_scale(df, df.where("split = 'train'"), ["a", "b"]).where("split = 'test'").first()
    assert (out.a, out.b) == (98.0, 1.0)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "label_next2wk int")
    got = {r.label: r.weight for r in evaluate.balanced_weights(df).collect()}
    assert got == {1: 2.0, 0: pytest.approx(8 / 12)}
    weighted = evaluate.with_class_weight(df, df).agg(F.sum("weight")).first()[0]
    assert weighted == pytest.approx(8.0)


def test_grid_takes_the_first_best(spark):
    rows = [(g, y, p) for g, ps in enumerate([(0, 0), (1, 0), (1, 0)]) for y, p in zip((1, 0), ps)]
    df = spark.createDataFrame(rows, "grid_pos int, label_next2wk int, prediction int")
    assert evaluate.grid_select(df, "grid_pos").first().grid_pos == 1
    assert evaluate.grid_select(df.where("grid_pos = 0"), "grid_pos").count() == 0
