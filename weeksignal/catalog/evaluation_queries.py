"""Split, metrics and rankings on a deterministic score, so that SQL can check them."""

from __future__ import annotations

from pyspark.sql import functions as F

from weeksignal.catalog.common import FEAT, Registry, feature_matrix, feature_table, nl_weekly, sql_week_no
from weeksignal.catalog.eda_queries import rounded
from weeksignal.operators import evaluate, stats
from weeksignal.session import cut_lineage

reg = Registry()
LABEL = stats.LABEL

_SPLIT = """
wks AS (SELECT week, row_number() OVER (ORDER BY week) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT week FROM feat)),
cut AS (SELECT (SELECT week FROM wks WHERE i = floor(n * 0.70::DOUBLE)) AS c1, (SELECT week FROM wks WHERE i = floor(n * 0.85::DOUBLE)) AS c2),
parted AS (SELECT feat.*, CASE WHEN week < c1 THEN 'train' WHEN week < c2 THEN 'val' ELSE 'test' END AS split FROM feat, cut)"""
SPLIT = f"{FEAT}, {_SPLIT}"
_SCORE_SQL = "round_even(least(0.4::DOUBLE * topic_nl_rate_8wk + 1.2::DOUBLE / (1 + weeks_since_last_nl), 1), 6)"
SCORED = f"""{SPLIT}, scored AS (SELECT *, {_SCORE_SQL} AS score, ({_SCORE_SQL} >= 0.5)::INT AS prediction FROM parted),
te AS (SELECT * FROM scored WHERE split = 'test')"""


def with_score(df):
    """A fixed expression that stands in for a model's probability."""
    raw = 0.4 * F.col("topic_nl_rate_8wk") + 1.2 / (1 + F.col("weeks_since_last_nl"))
    score = F.bround(F.least(raw, F.lit(1.0)), 6)
    return df.withColumn("score", score).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def scored(spark, d):
    return with_score(evaluate.temporal_split(feature_table(spark, d)))


def test_rows(spark, d):
    return cut_lineage(scored(spark, d).where(F.col("split") == "test"), "scored")


@reg.add("temporal_split", f"""{SPLIT} SELECT split, count(*) AS rows, sum(label_next2wk)::BIGINT AS positives,
  count(DISTINCT week) AS weeks, min(week) AS first_week, max(week) AS last_week FROM parted GROUP BY 1""")
def _split(spark, d):
    return evaluate.split_summary(evaluate.temporal_split(feature_table(spark, d)))


@reg.add("class_weight_balanced", f"""{SPLIT} SELECT label_next2wk AS label, count(*) AS n,
  round((SELECT count(*) FROM parted WHERE split = 'train') / (2 * count(*)), 9) AS weight FROM parted WHERE split = 'train' GROUP BY 1""")
def _weights(spark, d):
    train = evaluate.temporal_split(feature_table(spark, d)).where(F.col("split") == "train")
    return rounded(evaluate.balanced_weights(train), 9, "weight")


_SCALED = ["burst_score", "mentions", "topic_nl_rate_8wk", "weeks_since_last_nl"]
_SCALE_SQL = ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM tr)) / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END FROM tr), 6) AS {c}"
    for c in _SCALED
)


@reg.add("standard_scale", f"""{SPLIT}, tr AS (SELECT * FROM parted WHERE split = 'train')
  SELECT canonical_topic, week, split, {_SCALE_SQL} FROM parted WHERE split <> 'train'""")
def _scale(spark, d):
    parted = evaluate.temporal_split(feature_table(spark, d))
    train = parted.where(F.col("split") == "train")
    rest = parted.where(F.col("split") != "train")
    out = evaluate.standard_scale(rest, train, _SCALED)
    return rounded(out.select("canonical_topic", "week", "split", *_SCALED), 6, *_SCALED)


_CM = """
cm AS (SELECT count(*) FILTER (label_next2wk = 1 AND prediction = 1) AS tp, count(*) FILTER (label_next2wk = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label_next2wk = 1 AND prediction = 0) AS fn, count(*) FILTER (label_next2wk = 0 AND prediction = 0) AS tn FROM te)"""


@reg.add("confusion_matrix", f"{SCORED}, {_CM} SELECT * FROM cm")
def _confusion(spark, d):
    return evaluate.confusion(test_rows(spark, d))


@reg.add("f1_score", f"{SCORED}, {_CM} SELECT round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM cm")
def _f1(spark, d):
    return rounded(evaluate.f1_score(test_rows(spark, d)), 9, "f1")


@reg.add("accuracy", f"""{SCORED}, {_CM} SELECT round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy,
  round((tn + fp) / (tp + tn + fp + fn), 9) AS all_zeros_accuracy FROM cm""")
def _accuracy(spark, d):
    return rounded(evaluate.accuracy(test_rows(spark, d)), 9, "accuracy", "all_zeros_accuracy")


@reg.add("classification_report", f"""{SCORED}, {_CM},
  c AS (SELECT 'Not in NL' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS s FROM cm
        UNION ALL SELECT 'In NL', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM cm),
  a AS (SELECT (tp + tn) / (tp + tn + fp + fn) AS a, tp + tn + fp + fn AS s FROM cm),
  u AS (SELECT * FROM c UNION ALL SELECT 'accuracy', a, a, a, s FROM a
        UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM c
        UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM c)
  SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, s::BIGINT AS support FROM u""")
def _report(spark, d):
    return rounded(evaluate.classification_report(test_rows(spark, d)), 9, "precision", "recall", "f1")


_CURVE = """
cu AS (SELECT score, sum(sum(label_next2wk)) OVER w AS cp, sum(count(*)) OVER w AS cn, sum(label_next2wk) AS pos, count(*) AS n
       FROM te GROUP BY score WINDOW w AS (ORDER BY score DESC))"""


@reg.add("running_curves", f"""{SCORED}, {_CURVE} SELECT score, n, pos::BIGINT AS pos, cn::BIGINT AS cum_n, cp::BIGINT AS cum_pos FROM cu""")
def _running(spark, d):
    return evaluate.score_curve(test_rows(spark, d))


@reg.add("roc_curve", f"""{SCORED}, {_CURVE} SELECT score AS threshold, cp::BIGINT AS cum_pos, (cn - cp)::BIGINT AS cum_neg,
  round((cn - cp) / (SELECT count(*) - sum(label_next2wk) FROM te), 9) AS fpr, round(cp / (SELECT sum(label_next2wk) FROM te), 9) AS tpr, 0::BIGINT AS unscored FROM cu
  UNION ALL SELECT 'inf'::DOUBLE, 0, 0, 0.0, 0.0, 0""")
def _roc(spark, d):
    return rounded(evaluate.roc_curve(test_rows(spark, d)), 9, "fpr", "tpr")


@reg.add("roc_auc", f"""{SCORED}, rk AS (SELECT label_next2wk AS y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM te),
  s AS (SELECT sum(y)::DOUBLE AS p, (count(*) - sum(y))::DOUBLE AS q, sum(r) FILTER (y = 1) AS sr FROM rk)
  SELECT (p + q)::BIGINT AS n, p::BIGINT AS positives, round((sr - p * (p + 1) / 2) / (p * q), 9) AS roc_auc FROM s""")
def _auc(spark, d):
    areas = evaluate.ranking_areas(test_rows(spark, d)).drop("average_precision")
    return rounded(areas, 9, "roc_auc")


@reg.add("average_precision", f"{SCORED}, {_CURVE} SELECT round(sum(pos * cp / cn) / sum(pos), 9) AS average_precision FROM cu")
def _ap(spark, d):
    return rounded(evaluate.ranking_areas(test_rows(spark, d)).select("average_precision"), 9, "average_precision")


_RANKED = """
rw AS (SELECT *, row_number() OVER (PARTITION BY week ORDER BY score DESC, canonical_topic) AS rk FROM te),
wk_hits AS (SELECT week, count(*) AS n, sum(label_next2wk) AS p, sum(label_next2wk) FILTER (rk <= 3) AS h3,
  sum(label_next2wk) FILTER (rk <= 5) AS h5, sum(label_next2wk) FILTER (rk <= 10) AS h10 FROM rw GROUP BY 1 HAVING sum(label_next2wk) > 0)"""


@reg.add("precision_at_k", f"""{SCORED}, {_RANKED} SELECT round(coalesce(avg(h3 / 3) FILTER (n >= 3), 0), 9) AS p_at_3,
  round(coalesce(avg(h5 / 5) FILTER (n >= 5), 0), 9) AS p_at_5, round(coalesce(avg(h10 / 10) FILTER (n >= 10), 0), 9) AS p_at_10 FROM wk_hits""")
def _patk(spark, d):
    out = evaluate.precision_recall_at_k(test_rows(spark, d)).select("p_at_3", "p_at_5", "p_at_10")
    return rounded(out, 9, *out.columns)


@reg.add("recall_at_k", f"""{SCORED}, {_RANKED} SELECT round(coalesce(avg(h3 / p), 0), 9) AS r_at_3,
  round(coalesce(avg(h5 / p), 0), 9) AS r_at_5, round(coalesce(avg(h10 / p), 0), 9) AS r_at_10 FROM wk_hits""")
def _ratk(spark, d):
    out = evaluate.precision_recall_at_k(test_rows(spark, d)).select("r_at_3", "r_at_5", "r_at_10")
    return rounded(out, 9, *out.columns)


@reg.add("random_baseline", f"{SCORED} SELECT round(avg(label_next2wk), 9) AS baseline, count(*) AS n FROM te")
def _baseline(spark, d):
    return rounded(evaluate.random_baseline(test_rows(spark, d)), 9, "baseline")


_LEADS = f"""
nlt AS (SELECT canonical_topic, week FROM nl_w WHERE week IN (SELECT week FROM te)),
leads AS (SELECT n.canonical_topic, n.week AS covered_week, min(t.week) AS first_week FROM nlt n
          JOIN te t ON t.canonical_topic = n.canonical_topic AND t.week < n.week AND t.score >= 0.3 GROUP BY 1, 2),
ld AS (SELECT *, {sql_week_no('covered_week')} - {sql_week_no('first_week')} AS lead_weeks FROM leads)"""


@reg.add("test_week_semi", f"{SCORED}, {_LEADS} SELECT * FROM nlt")
def _semi(spark, d):
    return evaluate.in_test_weeks(nl_weekly(spark, d), test_rows(spark, d)).select("canonical_topic", "week")


@reg.add("lead_time_join", f"{SCORED}, {_LEADS} SELECT canonical_topic, covered_week, first_week, lead_weeks FROM ld")
def _leads(spark, d):
    return evaluate.lead_times(test_rows(spark, d), nl_weekly(spark, d))


@reg.add("lead_time_join_label", f"""{SCORED}, l AS (SELECT n.canonical_topic, n.week AS covered_week, min(t.week) AS first_week FROM te n
    JOIN te t ON t.canonical_topic = n.canonical_topic AND t.week < n.week AND t.score >= 0.3 WHERE n.label_next2wk = 1 GROUP BY 1, 2)
  SELECT *, {sql_week_no('covered_week')} - {sql_week_no('first_week')} AS lead_weeks FROM l""")
def _leads_label(spark, d):
    return evaluate.lead_times(test_rows(spark, d), anchor="label")


@reg.add("lead_time_stats", f"""{SCORED}, {_LEADS} SELECT count(*) AS detections, round(avg(lead_weeks), 9) AS mean_weeks,
  max(lead_weeks) AS max_weeks, median(lead_weeks)::DOUBLE AS median_weeks FROM ld""")
def _lead_stats(spark, d):
    leads = cut_lineage(evaluate.lead_times(test_rows(spark, d), nl_weekly(spark, d)), "leads")
    return rounded(evaluate.lead_time_stats(leads), 9, "mean_weeks")


@reg.add("first_detection", f"{SCORED} SELECT canonical_topic, min(week) AS first_week FROM te WHERE score >= 0.3 GROUP BY 1")
def _first(spark, d):
    return evaluate.first_detection(test_rows(spark, d))


@reg.add("calibration_curve", f"""{SCORED} SELECT greatest(ceil(score * 8) - 1, 0)::INT AS bin, count(*) AS n,
  round(avg(score), 7) AS mean_score, round(avg(label_next2wk), 7) AS positive_rate FROM te GROUP BY 1""")
def _calibration(spark, d):
    return rounded(evaluate.calibration_curve(test_rows(spark, d)), 7, "mean_score", "positive_rate")


@reg.add("stratified_eval", f"""{SCORED}, st AS (
    SELECT CASE WHEN is_novel_topic = 1 THEN 'novel' ELSE 'established' END AS stratum, label_next2wk AS y, score, burst_score FROM te
    UNION ALL SELECT CASE WHEN weeks_since_last_nl >= 10 THEN 'dormant' ELSE 'recent' END, label_next2wk, score, burst_score FROM te),
  rk AS (SELECT *, rank() OVER (PARTITION BY stratum ORDER BY score) + (count(*) OVER (PARTITION BY stratum, score) - 1) / 2.0::DOUBLE AS r FROM st),
  au AS (SELECT stratum, count(*) AS n, sum(y)::BIGINT AS positives, corr(burst_score, y) AS br,
           (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y)::DOUBLE * (count(*) - sum(y))) AS auc FROM rk GROUP BY 1),
  c AS (SELECT stratum, score, sum(y) AS pos, sum(sum(y)) OVER w AS cp, sum(count(*)) OVER w AS cn FROM st GROUP BY 1, 2
        WINDOW w AS (PARTITION BY stratum ORDER BY score DESC)),
  ap AS (SELECT stratum, sum(pos * cp / cn) / sum(pos) AS ap FROM c GROUP BY 1)
  SELECT stratum, n, positives, round(positives / n, 9) AS positive_rate,
    CASE WHEN positives > 0 AND positives < n THEN round(auc, 9) END AS roc_auc,
    CASE WHEN positives > 0 THEN round(ap, 9) END AS average_precision,
    CASE WHEN positives > 0 THEN round(br, 9) END AS burst_r FROM au JOIN ap USING (stratum)""")
def _strata(spark, d):
    out = evaluate.stratified_eval(test_rows(spark, d))
    return rounded(out, 9, "positive_rate", "roc_auc", "average_precision", "burst_r")


@reg.add("grid_select", f"""{SCORED}, g AS (SELECT i::INT AS grid_pos, 0.1::DOUBLE * (i + 1) AS cutoff FROM range(7) r(i)),
  v AS (SELECT grid_pos, cutoff, label_next2wk AS y, (score >= cutoff) AS p FROM scored, g WHERE split = 'val'),
  f AS (SELECT grid_pos, cutoff, 2 * count(*) FILTER (y = 1 AND p) / (2 * count(*) FILTER (y = 1 AND p) + count(*) FILTER (y = 0 AND p) + count(*) FILTER (y = 1 AND NOT p)) AS f1 FROM v GROUP BY 1, 2)
  SELECT grid_pos, cutoff, round(f1, 9) AS f1 FROM f WHERE f1 > 0 ORDER BY round(f1, 12) DESC, grid_pos LIMIT 1""")
def _grid(spark, d):
    val = scored(spark, d).where(F.col("split") == "val")
    points = F.array(*[F.struct(F.lit(i).alias("grid_pos"), (F.lit(0.1) * (i + 1)).alias("cutoff")) for i in range(7)])
    long = val.select(LABEL, "score", F.inline(points))
    long = long.withColumn("prediction", (F.col("score") >= F.col("cutoff")).cast("int"))
    return rounded(evaluate.grid_select(long, "grid_pos", ["cutoff"]), 9, "f1")


@reg.add("score_comparison", f"""{SCORED}, m AS (
    SELECT 'recency' AS model, label_next2wk AS y, 1.0::DOUBLE / (1 + weeks_since_last_nl) AS s FROM te
    UNION ALL SELECT 'habit', label_next2wk, topic_nl_rate_8wk FROM te UNION ALL SELECT 'mixed', label_next2wk, score FROM te),
  rk AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY s) + (count(*) OVER (PARTITION BY model, s) - 1) / 2.0::DOUBLE AS r FROM m),
  au AS (SELECT model, (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y)::DOUBLE * (count(*) - sum(y))) AS auc,
    2 * count(*) FILTER (y = 1 AND s >= 0.5) / nullif(2 * count(*) FILTER (y = 1 AND s >= 0.5) + count(*) FILTER (y = 0 AND s >= 0.5) + count(*) FILTER (y = 1 AND s < 0.5), 0) AS f1 FROM rk GROUP BY 1),
  c AS (SELECT model, s, sum(y) AS pos, sum(sum(y)) OVER w AS cp, sum(count(*)) OVER w AS cn FROM m GROUP BY 1, 2 WINDOW w AS (PARTITION BY model ORDER BY s DESC)),
  ap AS (SELECT model, sum(pos * cp / cn) / sum(pos) AS ap FROM c GROUP BY 1)
  SELECT model, round(auc, 9) AS roc_auc, round(ap, 9) AS average_precision, round(coalesce(f1, 0), 9) AS f1 FROM au JOIN ap USING (model)""")
def _comparison(spark, d):
    te = test_rows(spark, d)
    models = F.array(
        F.struct(F.lit("recency").alias("model"), (1.0 / (1 + F.col("weeks_since_last_nl"))).alias("score")),
        F.struct(F.lit("habit").alias("model"), F.col("topic_nl_rate_8wk").alias("score")),
        F.struct(F.lit("mixed").alias("model"), F.col("score").alias("score")),
    )
    long = te.select(LABEL, F.inline(models))
    long = long.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return rounded(evaluate.model_comparison(long), 9, "roc_auc", "average_precision", "f1")
