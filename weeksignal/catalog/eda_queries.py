"""Exploratory statistics and dashboard tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from weeksignal.catalog.common import FEAT, Registry, feature_matrix, feature_table, topic_cube
from weeksignal.catalog.feature_queries import ACAD, SRC_BURST, TRAJ, bursts, src_bursts
from weeksignal.operators import distribution, features, stats, weekly
from weeksignal.plans import dashboard, eda
from weeksignal.session import cut_lineage

reg = Registry()
LABEL = stats.LABEL


def rounded(df, digits=9, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def multi(spark, d, cube=None):
    return features.multi_source(src_bursts(spark, d, cube))


def trajectories(feat):
    return features.trajectory(feat.select("canonical_topic", "week", "burst_score"))


def full_matrix(spark, d):
    cube = topic_cube(spark, d)
    feat = feature_table(spark, d, cube=cube)
    return eda.full_feature_matrix(feat, multi(spark, d, cube), trajectories(feat))


_LM = """
lm AS (SELECT f.canonical_topic, f.week, label_next2wk, coalesce(sources_bursting, 0) AS sources_bursting,
         coalesce(max_source_burst, 0.0)::DOUBLE AS max_source_burst
       FROM feat f LEFT JOIN multi m ON f.canonical_topic = m.canonical_topic AND f.week = m.week)"""
_LT = """
lt AS (SELECT f.canonical_topic, f.week, label_next2wk, peak_burst, trend_slope, consistent_weeks, spike_ratio
       FROM feat f JOIN traj t ON f.canonical_topic = t.canonical_topic AND f.week = t.week)"""
_FULL = """
full_f AS (
  SELECT f.canonical_topic, f.week, f.burst_score, f.mentions, f.topic_nl_rate_alltime, f.topic_nl_rate_8wk,
    f.weeks_since_last_nl, f.is_novel_topic, lm.sources_bursting, lm.max_source_burst,
    coalesce(peak_burst, 0.0)::DOUBLE AS peak_burst, coalesce(trend_slope, 0.0)::DOUBLE AS trend_slope,
    coalesce(consistent_weeks, 0) AS consistent_weeks, coalesce(spike_ratio, 0.0)::DOUBLE AS spike_ratio,
    f.label_next2wk
  FROM feat f JOIN lm ON f.canonical_topic = lm.canonical_topic AND f.week = lm.week
  LEFT JOIN traj t ON f.canonical_topic = t.canonical_topic AND f.week = t.week)"""
FULL = f"{FEAT}, {SRC_BURST}, {TRAJ}, {_LM}, {_LT}, {_FULL}"
MATRIX = f"""{FEAT}, {ACAD}, nsrc AS (SELECT canonical_topic, week, count(DISTINCT source) AS n_sources FROM sig GROUP BY 1, 2),
dm AS (
  SELECT f.*, coalesce(academic_n, 0.0)::DOUBLE AS academic_n, coalesce(social_n, 0.0)::DOUBLE AS social_n,
         coalesce(combined, 0.0)::DOUBLE AS combined, coalesce(n_sources, 0) AS n_sources
  FROM feat f LEFT JOIN acad_n a ON f.canonical_topic = a.canonical_topic AND f.week = a.week
  LEFT JOIN nsrc s ON f.canonical_topic = s.canonical_topic AND f.week = s.week),
wk AS (SELECT max(week) AS latest FROM dm),
wk2 AS (SELECT max(week) AS previous FROM dm WHERE week < (SELECT latest FROM wk))"""


def labelled_sources(spark, d):
    cube = topic_cube(spark, d)
    return eda.label_multi_source(feature_matrix(spark, d, cube=cube), multi(spark, d, cube))


def dashboard_rows(spark, d, cube=None):
    cube = topic_cube(spark, d) if cube is None else cube
    return dashboard.dashboard_matrix(feature_matrix(spark, d, cube=cube), weekly.cube_signals(cube))


# --- joins ------------------------------------------------------------------------

@reg.add("label_multi_source", f"{FULL} SELECT * FROM lm")
def _label_multi(spark, d):
    return labelled_sources(spark, d)


@reg.add("label_trajectory", f"{FULL} SELECT * FROM lt")
def _label_traj(spark, d):
    feat = feature_table(spark, d)
    return eda.label_trajectory(feat, trajectories(feat))


@reg.add("full_feature_matrix", f"{FULL} SELECT * FROM full_f")
def _full(spark, d):
    return full_matrix(spark, d)


@reg.add("dashboard_matrix", f"""{MATRIX} SELECT * EXCLUDE (academic_n, social_n, combined),
  round(academic_n, 9) AS academic_n, round(social_n, 9) AS social_n, round(combined, 9) AS combined FROM dm""")
def _dash(spark, d):
    m = dashboard_rows(spark, d)
    return rounded(m, 9, "academic_n", "social_n", "combined")


@reg.add("same_week_label", f"""{FEAT} SELECT f.canonical_topic, f.week, label_next2wk,
  coalesce(in_newsletter, 0) AS label_same_week FROM feat f
  LEFT JOIN nl_w n ON n.canonical_topic = f.canonical_topic AND n.week = f.week""")
def _same_week(spark, d):
    cube = topic_cube(spark, d)
    out = features.same_week_label(feature_matrix(spark, d, cube=cube), weekly.cube_newsletters(cube))
    return out.select("canonical_topic", "week", "label_next2wk", "label_same_week")


# --- statistics -------------------------------------------------------------------

@reg.add("rate_by_sources_bursting", f"""{FULL} SELECT sources_bursting, count(*) AS n,
  round(avg(label_next2wk) * 100, 9) AS rate_percent FROM lm WHERE sources_bursting BETWEEN 0 AND 3 GROUP BY 1""")
def _rate(spark, d):
    return rounded(stats.rate_by_sources(labelled_sources(spark, d)), 9, "rate_percent")


@reg.add("class_balance", f"""{FEAT}, c AS (SELECT count(*) AS total, sum(label_next2wk)::BIGINT AS positive FROM feat)
  SELECT total, positive, total - positive AS negative, (total - positive) // greatest(positive, 1) AS ratio,
         round((total - positive) / total, 9) AS all_zeros_accuracy FROM c""")
def _balance(spark, d):
    return rounded(stats.class_balance(feature_matrix(spark, d)), 9, "all_zeros_accuracy")


@reg.add("threshold_sweep", f"""{FEAT}, t AS (SELECT -1 + 0.25::DOUBLE * i AS threshold FROM range(28) r(i))
  SELECT threshold, count(*) AS n, round(coalesce(avg(label_next2wk), 0), 9) AS precision,
         round(count(*) / (SELECT count(*) FROM feat), 9) AS coverage
  FROM t JOIN feat ON burst_score >= threshold GROUP BY 1
  UNION ALL SELECT threshold, 0, 0.0, 0.0 FROM t WHERE threshold > (SELECT max(burst_score) FROM feat)""")
def _sweep(spark, d):
    out = stats.threshold_sweep(feature_matrix(spark, d), "burst_score", -1.0, 0.25, 28)
    return rounded(out, 9, "precision", "coverage")


@reg.add("source_precision_curve", f"""{FULL}, t AS (SELECT -1 + 0.5::DOUBLE * i AS threshold FROM range(12) r(i)),
  sb AS (SELECT s.source_type, source_burst, label_next2wk FROM src_burst s
         JOIN feat f ON f.canonical_topic = s.canonical_topic AND f.week = s.week),
  ty AS (SELECT source_type, count(*) AS total FROM sb GROUP BY 1)
  SELECT ty.source_type, threshold, count(label_next2wk) AS n,
         CASE WHEN count(label_next2wk) > 10 THEN round(avg(label_next2wk), 9) ELSE 0.0 END AS precision,
         round(count(label_next2wk) / any_value(total), 9) AS coverage
  FROM ty CROSS JOIN t LEFT JOIN sb ON sb.source_type = ty.source_type AND source_burst >= threshold GROUP BY 1, 2""")
def _source_curve(spark, d):
    cube = topic_cube(spark, d)
    out = stats.source_precision_curve(src_bursts(spark, d, cube), feature_matrix(spark, d, cube=cube))
    return rounded(out, 9, "precision", "coverage")


_EDA_FEATURES = ["burst_score", "topic_nl_rate_alltime", "topic_nl_rate_8wk", "weeks_since_last_nl"]
_TRAJ_FEATURES = ["peak_burst", "trend_slope", "consistent_weeks", "spike_ratio"]


def _long_sql(columns, source, keep="label_next2wk"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, {keep} FROM {source}" for c in columns
    )


_MWU = """
ranks AS (SELECT feature, label_next2wk, rank() OVER (PARTITION BY feature ORDER BY value)
            + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE AS r FROM long_f),
tie AS (SELECT feature, sum(t * t * t - t) AS ties FROM
         (SELECT feature, value, count(*)::DOUBLE AS t FROM long_f GROUP BY 1, 2) GROUP BY 1),
us AS (SELECT feature, sum(label_next2wk)::BIGINT AS n1, (count(*) - sum(label_next2wk))::BIGINT AS n0,
         sum(r) FILTER (label_next2wk = 1) - sum(label_next2wk) * (sum(label_next2wk) + 1) / 2 AS u
       FROM ranks GROUP BY 1)"""


@reg.add("mann_whitney_u", f"""{FULL}, long_f AS (SELECT * FROM ({_long_sql(_EDA_FEATURES, 'feat')} UNION ALL {_long_sql(_TRAJ_FEATURES, 'lt')}) WHERE value IS NOT NULL), {_MWU}
  SELECT feature, n1, n0, u::DOUBLE AS u, round((greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5)
     / sqrt(n1 * n0 / 12 * (n1 + n0 + 1 - ties / ((n1 + n0)::DOUBLE * (n1 + n0 - 1)))), 6) AS z
  FROM us JOIN tie USING (feature)""")
def _mwu(spark, d):
    feat = feature_table(spark, d)
    traj = eda.label_trajectory(feat, trajectories(feat))
    both = stats.mann_whitney(feat, _EDA_FEATURES).unionByName(stats.mann_whitney(traj, _TRAJ_FEATURES))
    return rounded(both, 6, "z")


@reg.add("mann_whitney_greater")
def _mwu_greater(spark, d):
    test = stats.mann_whitney(feature_table(spark, d), ["burst_score"], alternative="greater")
    return stats.with_normal_p(test, "greater")


_PB = ["burst_score", "mentions", "topic_nl_rate_8wk", "topic_nl_rate_alltime", "weeks_since_last_nl"]


@reg.add("point_biserial", f"""{FEAT}, long_f AS ({_long_sql(_PB, 'feat')})
  SELECT feature, round(corr(value, label_next2wk), 9) AS r, count(*) AS n FROM long_f GROUP BY 1""")
def _pb(spark, d):
    return rounded(stats.point_biserial(feature_matrix(spark, d), _PB), 9, "r")


@reg.add("point_biserial_p")
def _pb_p(spark, d):
    return stats.with_correlation_p(stats.point_biserial(feature_matrix(spark, d), _PB))


def _corr_sql(columns, source):
    parts = []
    for a, b in combinations(columns, 2):
        for x, y in ((a, b), (b, a)):
            parts.append(f"SELECT '{x}' AS feature_a, '{y}' AS feature_b, round(corr({a}, {b}), 9) AS r FROM {source}")
    parts += [f"SELECT '{c}', '{c}', 1.0" for c in columns]
    return " UNION ALL ".join(parts)


@reg.add("correlation_matrix", f"{FULL.replace('full_f AS (', 'full_f AS MATERIALIZED (')} {_corr_sql(eda.FULL_FEATURES, 'full_f')}")
def _corr(spark, d):
    return rounded(stats.correlation_matrix(full_matrix(spark, d), eda.FULL_FEATURES), 9, "r")


@reg.add("label_correlations", MATRIX + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, label_next2wk), 9) AS r FROM dm" for c in dashboard.CORRELATED))
def _label_corr(spark, d):
    m = dashboard_rows(spark, d)
    return rounded(stats.label_correlations(m, dashboard.CORRELATED), 9, "r")


@reg.add("split_medians", f"""{FEAT}, long_f AS ({_long_sql(_EDA_FEATURES, 'feat')})
  SELECT feature, label_next2wk, round(quantile_cont(value, 0.5), 9) AS median FROM long_f GROUP BY 1, 2""")
def _medians(spark, d):
    return rounded(stats.split_medians(feature_table(spark, d), _EDA_FEATURES), 9, "median")


@reg.add("label_group_means", f"""{FULL}, long_f AS (SELECT * FROM ({_long_sql(_EDA_FEATURES, 'feat')} UNION ALL {_long_sql(_TRAJ_FEATURES, 'lt')}) WHERE value IS NOT NULL)
  SELECT feature, label_next2wk, round(avg(value), 9) AS mean, count(*) AS n FROM long_f GROUP BY 1, 2""")
def _means(spark, d):
    feat = feature_table(spark, d)
    traj = eda.label_trajectory(feat, trajectories(feat))
    both = stats.label_means(feat, _EDA_FEATURES).unionByName(stats.label_means(traj, _TRAJ_FEATURES))
    return rounded(both, 9, "mean")


@reg.add("histogram_density", f"""{FEAT}, b AS (SELECT label_next2wk,
    least(floor((burst_score - -3.0::DOUBLE) / (13.0::DOUBLE / 50)), 49)::INT AS bin FROM feat WHERE burst_score BETWEEN -3 AND 10),
  n AS (SELECT label_next2wk, bin, count(*) AS n FROM b GROUP BY 1, 2)
  SELECT label_next2wk, bin, round(-3.0::DOUBLE + bin * (13.0::DOUBLE / 50), 9) AS bin_start, n,
         round(n / (sum(n) OVER (PARTITION BY label_next2wk) * (13.0::DOUBLE / 50)), 9) AS density FROM n""")
def _hist(spark, d):
    out = distribution.histogram_density(feature_matrix(spark, d), "burst_score", -3.0, 10.0, 50, [LABEL])
    return rounded(out, 9, "bin_start", "density")


@reg.add("trajectory_histogram", f"""{FULL}, p AS (SELECT quantile_cont(trend_slope, 0.05) AS lo, quantile_cont(trend_slope, 0.95) AS hi FROM lt),
  v AS (SELECT label_next2wk, least(greatest(trend_slope, lo), hi) AS v FROM lt, p),
  s AS (SELECT label_next2wk, min(v) AS lo, max(v) AS hi, count(*) AS n FROM v GROUP BY 1),
  b AS (SELECT v.label_next2wk, least(floor((v - lo) / ((hi - lo) / 30)), 29)::INT AS bin, lo, hi, s.n AS total
        FROM v JOIN s USING (label_next2wk))
  SELECT label_next2wk, bin, round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 30), 9) AS bin_start, count(*) AS n,
         round(count(*) / (any_value(total) * ((any_value(hi) - any_value(lo)) / 30)), 6) AS density FROM b GROUP BY 1, 2""")
def _traj_hist(spark, d):
    feat = feature_table(spark, d)
    lt = cut_lineage(eda.label_trajectory(feat, trajectories(feat)), "trajectory")
    edges = distribution.quantiles(lt, "trend_slope", {"lo": 0.05, "hi": 0.95})
    edges = edges.select(F.struct("lo", "hi")).scalar()
    out = distribution.range_histogram_density(
        lt, "trend_slope", 30, [LABEL], edges.getField("lo"), edges.getField("hi")
    )
    return rounded(rounded(out, 9, "bin_start"), 6, "density")


# --- dashboard ----------------------------------------------------------------------

def _matrix(spark, d, cube=None):
    return cut_lineage(dashboard_rows(spark, d, cube), "dashboard")


@reg.add("top_bursts", f"""{MATRIX} SELECT row_number() OVER (ORDER BY burst_score DESC, canonical_topic)::INT AS rank, canonical_topic, week,
  CASE WHEN label_next2wk = 1 THEN '★ ' ELSE '' END || upper(substr(canonical_topic, 1, 1)) || lower(substr(split_part(canonical_topic, ' ', 1), 2))
    || ' ' || upper(substr(split_part(canonical_topic, ' ', 2), 1, 1)) || lower(substr(split_part(canonical_topic, ' ', 2), 2)) AS label,
  burst_score, mentions, label_next2wk FROM feat WHERE week = (SELECT latest FROM wk) ORDER BY burst_score DESC, canonical_topic LIMIT 10""")
def _top(spark, d):
    return dashboard.top_bursts(feature_table(spark, d))


@reg.add("momentum_delta", f"""{MATRIX} SELECT a.canonical_topic, a.week, a.mentions, a.burst_score, coalesce(b.burst_score, 0.0)::DOUBLE AS prev_burst,
  round_even(a.burst_score - coalesce(b.burst_score, 0), 3) AS delta
  FROM (SELECT * FROM burst WHERE week = (SELECT latest FROM wk) ORDER BY burst_score DESC, canonical_topic LIMIT 10) a
  LEFT JOIN (SELECT * FROM burst WHERE week = (SELECT previous FROM wk2)) b USING (canonical_topic)""")
def _momentum(spark, d):
    return dashboard.momentum(bursts(spark, d))


@reg.add("bubble_quadrant", f"""{MATRIX} SELECT canonical_topic, burst_score, round(academic_n, 9) AS academic_n, round(social_n, 9) AS social_n,
  round(least(greatest(combined, 0), 1), 9) AS combined, round(greatest(burst_score, 0) * 22 + 12, 6) AS size,
  CASE WHEN academic_n >= 0.5 AND social_n >= 0.5 THEN 'Trending Everywhere' WHEN social_n >= 0.5 THEN 'Social Hype'
       WHEN academic_n >= 0.5 THEN 'Academic Focus' ELSE 'Emerging' END AS quadrant
  FROM dm WHERE week = (SELECT latest FROM wk) ORDER BY burst_score DESC, canonical_topic LIMIT 22""")
def _scatter(spark, d):
    out = dashboard.source_scatter(_matrix(spark, d))
    return rounded(rounded(out, 9, "academic_n", "social_n", "combined"), 6, "size")


_SAMPLED = """
sw AS (SELECT week FROM (SELECT week, row_number() OVER (ORDER BY week) AS rn FROM (SELECT DISTINCT week FROM feat)) WHERE rn % 2 = 1)"""
_CELLS = """
  SELECT t.canonical_topic, substr(t.canonical_topic, 1, 42) AS label, w.week,
         least(greatest(coalesce(burst_score, 0.0), -1), 8)::DOUBLE AS burst, coalesce(label_next2wk, 0) AS starred
  FROM tt t CROSS JOIN ww w LEFT JOIN feat f ON f.canonical_topic = t.canonical_topic AND f.week = w.week"""


@reg.add("grid_lookup", f"""{FEAT}, {_SAMPLED}, ww AS (SELECT week FROM sw),
  tt AS (SELECT canonical_topic FROM feat GROUP BY 1 ORDER BY count(*) DESC, canonical_topic LIMIT 20) {_CELLS}""")
def _grid(spark, d):
    return dashboard.burst_heatmap(feature_table(spark, d), "weeks")


@reg.add("burst_heatmap", f"""{FEAT}, {_SAMPLED}, ww AS (SELECT week FROM sw ORDER BY week DESC LIMIT 60),
  tt AS (SELECT canonical_topic FROM feat GROUP BY 1 ORDER BY max(burst_score) DESC, canonical_topic LIMIT 20) {_CELLS}""")
def _heatmap(spark, d):
    return dashboard.burst_heatmap(feature_table(spark, d), "burst", last=60)


@reg.add("best_row_per_topic", f"""{FEAT} SELECT canonical_topic, max(burst_score) AS measure FROM feat GROUP BY 1
  ORDER BY measure DESC, canonical_topic LIMIT 20""")
def _best_rows(spark, d):
    return dashboard.top_topics(feature_matrix(spark, d), "burst")


@reg.add("sampled_weeks", f"""{FEAT}, {_SAMPLED}, l AS (SELECT week FROM sw ORDER BY week DESC LIMIT 60)
  SELECT (row_number() OVER (ORDER BY week) - 1)::INT AS position, week FROM l""")
def _sampled(spark, d):
    return dashboard.sampled_weeks(bursts(spark, d), last=60)


@reg.add("week_rank_topk", f"""{FEAT}, l AS (SELECT DISTINCT week FROM feat ORDER BY week DESC LIMIT 12)
  SELECT week, rank, canonical_topic, burst_score, label_next2wk FROM (
    SELECT *, row_number() OVER (PARTITION BY week ORDER BY burst_score DESC, canonical_topic)::INT AS rank
    FROM feat WHERE week IN (SELECT week FROM l)) WHERE rank <= 5""")
def _week_rank(spark, d):
    return dashboard.week_rank_topk(feature_table(spark, d))


@reg.add("trend_series", f"""{MATRIX}, t AS (SELECT canonical_topic FROM feat WHERE week = (SELECT latest FROM wk)
    ORDER BY burst_score DESC, canonical_topic LIMIT 5)
  SELECT canonical_topic, week, burst_score FROM feat WHERE canonical_topic IN (SELECT canonical_topic FROM t)""")
def _trend(spark, d):
    return dashboard.trend_series(feature_table(spark, d))


@reg.add("set_membership", f"""{FEAT} SELECT canonical_topic, week, burst_score FROM feat
  WHERE canonical_topic IN ('Brand#1 ECONOMY', 'Brand#2 STANDARD', 'Brand#3 PROMO')""")
def _chosen(spark, d):
    return dashboard.trend_series(feature_table(spark, d), ["Brand#1 ECONOMY", "Brand#2 STANDARD", "Brand#3 PROMO"])


_HABIT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, label_next2wk, {lo}::DOUBLE AS lo, {hi}::DOUBLE AS hi, (least(greatest({c}::DOUBLE, {lo}::DOUBLE), {hi}::DOUBLE) - {lo}::DOUBLE) / {hi - lo}::DOUBLE AS u FROM feat"
    for c, (lo, hi) in dashboard.HABITS.items()
)


@reg.add("habit_distributions", f"""{FEAT}, h AS ({_HABIT_SQL}),
  b AS (SELECT feature, label_next2wk, least(floor(u / (1.0::DOUBLE / 30)), 29)::INT AS bin, any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS n FROM h GROUP BY 1, 2, 3)
  SELECT feature, label_next2wk, bin, round(lo + bin * (1.0::DOUBLE / 30) * (hi - lo), 9) AS bin_start, n,
     round(n / (sum(n) OVER (PARTITION BY feature, label_next2wk) * (1.0::DOUBLE / 30)) / (hi - lo), 9) AS density FROM b""")
def _habits(spark, d):
    return rounded(dashboard.habit_distributions(feature_matrix(spark, d)), 9, "bin_start", "density")


_KPI_CORR = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, label_next2wk)) AS r FROM dm" for c in dashboard.CORRELATED
)


@reg.add("kpi_row", f"""{MATRIX}, cc AS ({_KPI_CORR}),
  tb AS (SELECT canonical_topic, burst_score FROM feat WHERE week = (SELECT latest FROM wk) ORDER BY burst_score DESC, canonical_topic LIMIT 1),
  best AS (SELECT feature, r FROM cc WHERE r IS NOT NULL ORDER BY r DESC, feature LIMIT 1)
  SELECT (SELECT count(DISTINCT canonical_topic) FROM sig_w) AS topics, sum(label_next2wk)::BIGINT AS newsletter_labels, count(*) AS active_rows,
    (count(*) - sum(label_next2wk)::BIGINT) // greatest(sum(label_next2wk)::BIGINT, 1) AS class_ratio,
    (SELECT feature FROM best) AS top_predictor, round((SELECT r FROM best), 6) AS top_predictor_r,
    (SELECT canonical_topic FROM tb) AS top_topic, (SELECT burst_score FROM tb) AS top_burst FROM dm""")
def _kpi(spark, d):
    cube = topic_cube(spark, d)
    return dashboard.kpi_row(_matrix(spark, d, cube), weekly.weekly_mentions(weekly.cube_signals(cube)))


@reg.add("similarity_stats", f"""{FEAT} SELECT round(avg(similarity), 9) AS mean, round(quantile_cont(similarity, 0.5), 9) AS median,
  round(min(similarity), 9) AS min, round(quantile_cont(similarity, 0.25), 9) AS p25, round(quantile_cont(similarity, 0.75), 9) AS p75 FROM nl""")
def _similarity(spark, d):
    from weeksignal.catalog.common import newsletters

    return rounded(stats.similarity_stats(newsletters(spark, d)), 9, "mean", "median", "min", "p25", "p75")
