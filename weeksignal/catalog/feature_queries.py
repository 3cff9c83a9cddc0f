"""Weekly aggregates, windows and the feature matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from weeksignal.catalog.common import (
    BURST, FEAT, HIST, SIG, WEEKLY, Registry, feature_matrix, feature_table, newsletters, nl_weekly, sig_weekly, signals,
    sql_burst, topic_cube,
)
from weeksignal.functions.text import source_type
from weeksignal.operators import distribution, features, weekly

reg = Registry()

_FEAT_COLS = """canonical_topic, week, mentions, rolling_mean, burst_score, label_next2wk, topic_nl_rate_8wk,
  topic_nl_rate_alltime, weeks_since_last_nl, is_novel_topic, past_nl_count"""

# Source-type bursts over the same weekly counts.
SRC_BURST = f"""
typed AS (SELECT canonical_topic, week, CASE WHEN source IN ('arxiv', 'semantic_scholar') THEN 'research'
            WHEN source = 'github' THEN 'developer' ELSE 'discussion' END AS source_type FROM sig),
typed_w AS (SELECT canonical_topic, week, source_type, count(*) AS mentions FROM typed GROUP BY 1, 2, 3),
src_burst AS (
  SELECT canonical_topic, week, source_type, round_even(raw_burst, 3) AS source_burst,
         (raw_burst > 0.5)::INT AS is_active
  FROM ({sql_burst('typed_w', 'canonical_topic, source_type')}) WHERE n_weeks >= 3 AND pn >= 2),
multi AS (SELECT canonical_topic, week, sum(is_active)::BIGINT AS sources_bursting,
                 max(source_burst) AS max_source_burst FROM src_burst GROUP BY 1, 2)"""

TRAJ = """
traj AS (
  SELECT canonical_topic, week, round_even(peak, 3) AS peak_burst,
         round_even((-3 * k1 - k2 + k3 + 3 * k4) / 10000, 3) AS trend_slope,
         ((s1 > 0.5)::BIGINT + (s2 > 0.5)::BIGINT + (s3 > 0.5)::BIGINT + (s4 > 0.5)::BIGINT) AS consistent_weeks,
         round_even(peak / nullif((k1 + k2 + k3 + k4) / 4000 + 0.01::DOUBLE, 0), 3) AS spike_ratio
  FROM (SELECT *, round(s1 * 1000)::BIGINT AS k1, round(s2 * 1000)::BIGINT AS k2, round(s3 * 1000)::BIGINT AS k3,
               round(s4 * 1000)::BIGINT AS k4 FROM (
        SELECT *, lag(burst_score, 3) OVER o AS s1, lag(burst_score, 2) OVER o AS s2,
               lag(burst_score, 1) OVER o AS s3, burst_score AS s4, row_number() OVER o AS rn,
               max(burst_score) OVER (PARTITION BY canonical_topic ORDER BY week
                                      ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS peak,
               count(*) OVER (PARTITION BY canonical_topic) AS n
        FROM burst WINDOW o AS (PARTITION BY canonical_topic ORDER BY week)))
  WHERE n >= 5 AND rn >= 4)"""


def src_bursts(spark, d, cube=None):
    cube = topic_cube(spark, d) if cube is None else cube
    return features.source_bursts(weekly.weekly_mentions_by_type(weekly.cube_signals(cube)))


def bursts(spark, d):
    return features.burst_scores(sig_weekly(spark, d))


# --- counts per topic and week ----------------------------------------------

reg.add("weekly_mentions", f"{WEEKLY} SELECT canonical_topic, week, mentions FROM sig_w")(sig_weekly)

reg.add("newsletter_weekly", f"{WEEKLY} SELECT * FROM nl_w")(nl_weekly)


@reg.add("weekly_mentions_by_type", f"{FEAT}, {SRC_BURST} SELECT * FROM typed_w")
def _by_type(spark, d):
    return weekly.weekly_mentions_by_type(signals(spark, d))


@reg.add("mentions_or_rows", f"""{SIG},
  raw AS (SELECT canonical_topic, week, source, count(*) AS mentions FROM sig GROUP BY 1, 2, 3)
  SELECT 'counted' AS input, canonical_topic, week, sum(mentions)::BIGINT AS mentions FROM raw GROUP BY 1, 2, 3
  UNION ALL SELECT 'rows', canonical_topic, week, count(*) FROM sig GROUP BY 1, 2, 3""")
def _mentions_or_rows(spark, d):
    rows = weekly.ensure_week(signals(spark, d).drop("week"))
    counted = weekly.mentions_by(rows, ["canonical_topic", "week", "source"])
    keys = ["canonical_topic", "week"]
    return (
        weekly.mentions_by(counted, keys).withColumn("input", F.lit("counted"))
        .unionByName(weekly.mentions_by(rows, keys).withColumn("input", F.lit("rows")))
    )


@reg.add("count_by_key_desc", f"{SIG} SELECT source, count(*) AS count FROM sig GROUP BY 1")
def _count_by_key(spark, d):
    return weekly.count_by_key(signals(spark, d), "source")


@reg.add("top_groups", f"""{SIG} SELECT canonical_topic, count(*) AS count FROM nl GROUP BY 1
  ORDER BY count DESC, canonical_topic LIMIT 15""")
def _top_groups(spark, d):
    return weekly.top_groups(newsletters(spark, d), "canonical_topic", 15)


@reg.add("total_mentions_top15", f"""{WEEKLY} SELECT canonical_topic, sum(mentions)::BIGINT AS mentions FROM sig_w
  GROUP BY 1 ORDER BY mentions DESC, canonical_topic LIMIT 15""")
def _total_top(spark, d):
    return weekly.total_mentions_top(sig_weekly(spark, d), 15)


@reg.add("n_sources", f"""{SIG} SELECT canonical_topic, week, count(DISTINCT source) AS n_sources FROM sig GROUP BY 1, 2""")
def _n_sources(spark, d):
    return weekly.distinct_sources(signals(spark, d))


@reg.add("distinct_count", f"""{SIG} SELECT count(*) AS phrases, count(DISTINCT phrase) AS unique_phrases,
  min(date) AS first_date, max(date) AS last_date FROM sig""")
def _distinct_count(spark, d):
    return weekly.phrase_overview(signals(spark, d))


@reg.add("dataset_overview", f"""{HIST} SELECT (SELECT count(*) FROM sig_w) AS rows,
  (SELECT count(DISTINCT canonical_topic) FROM sig_w) AS topics, (SELECT count(DISTINCT week) FROM sig_w) AS weeks,
  (SELECT min(week) FROM sig_w) AS first_week, (SELECT max(week) FROM sig_w) AS last_week,
  (SELECT sum(is_novel_topic)::BIGINT FROM hist) AS novel_rows""")
def _overview(spark, d):
    cube = topic_cube(spark, d)
    sig = weekly.weekly_mentions(weekly.cube_signals(cube))
    history = features.history_features(sig, weekly.cube_newsletters(cube))
    novel = history.agg(F.sum("is_novel_topic")).scalar()
    return weekly.dataset_overview(sig).withColumn("novel_rows", novel)


@reg.add("topic_count_compare", f"""{SIG}, a AS (SELECT canonical_topic, count(*) AS newsletter_mentions FROM nl GROUP BY 1),
  b AS (SELECT canonical_topic, count(*) AS signal_mentions FROM sig GROUP BY 1)
  SELECT canonical_topic, newsletter_mentions, coalesce(signal_mentions, 0) AS signal_mentions
  FROM a LEFT JOIN b USING (canonical_topic) WHERE coalesce(signal_mentions, 0) < 400
  ORDER BY newsletter_mentions DESC, canonical_topic LIMIT 20""")
def _compare(spark, d):
    return weekly.topic_count_compare(newsletters(spark, d), signals(spark, d), max_signal=400)


@reg.add("all_weeks", f"""{WEEKLY} SELECT week FROM sig_w UNION SELECT week FROM nl_w""")
def _all_weeks(spark, d):
    return weekly.all_weeks(sig_weekly(spark, d), nl_weekly(spark, d))


@reg.add("distinct_topics", f"{WEEKLY} SELECT DISTINCT canonical_topic FROM sig_w")
def _topics(spark, d):
    return sig_weekly(spark, d).select("canonical_topic").distinct()


@reg.add("latest_previous_week", f"""{WEEKLY}, wk AS (SELECT DISTINCT week FROM sig_w ORDER BY week DESC LIMIT 2)
  SELECT max(week) AS latest, min(week) AS previous FROM wk""")
def _latest(spark, d):
    return weekly.latest_weeks(sig_weekly(spark, d))


@reg.add("source_type_map", f"""{SIG} SELECT source, CASE WHEN source IN ('arxiv', 'semantic_scholar') THEN 'research'
  WHEN source = 'github' THEN 'developer' WHEN source IN ('reddit', 'hackernews') THEN 'discussion' ELSE 'other' END
  AS source_type, count(*) AS n FROM (SELECT source FROM sig UNION ALL SELECT source FROM nl) GROUP BY 1, 2""")
def _source_type(spark, d):
    both = signals(spark, d).select("source").unionByName(newsletters(spark, d).select("source"))
    return both.withColumn("source_type", source_type("source")).groupBy("source", "source_type").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- windows ------------------------------------------------------------------

@reg.add("burst_score", f"{BURST} SELECT * FROM burst")
def _burst(spark, d):
    return features.burst_scores(sig_weekly(spark, d), with_std=True)


@reg.add("nl_rate_8wk", f"{HIST} SELECT canonical_topic, week, topic_nl_rate_8wk FROM hist")
def _rate8(spark, d):
    history = features.history_features(sig_weekly(spark, d), nl_weekly(spark, d))
    return history.select("canonical_topic", "week", "topic_nl_rate_8wk")


@reg.add("nl_rate_alltime", f"""{HIST} SELECT canonical_topic, week, topic_nl_rate_alltime AS rate_active,
  rate_alltime_all AS rate_all FROM hist""")
def _rate_all(spark, d):
    timeline = features.topic_timeline(sig_weekly(spark, d), nl_weekly(spark, d))
    keys = ["canonical_topic", "week"]
    active = features.add_history(timeline, "active").select(*keys, F.col("topic_nl_rate_alltime").alias("rate_active"))
    every = features.add_history(timeline, "all").select(*keys, F.col("topic_nl_rate_alltime").alias("rate_all"))
    return active.join(every, keys)


@reg.add("past_nl_count", f"{HIST} SELECT canonical_topic, week, past_nl_count, is_novel_topic FROM hist")
def _past_count(spark, d):
    history = features.history_features(sig_weekly(spark, d), nl_weekly(spark, d))
    return history.select("canonical_topic", "week", "past_nl_count", "is_novel_topic")


@reg.add("weeks_since_last_nl", f"""{WEEKLY}, n AS (SELECT canonical_topic, {{mon}} AS monday FROM nl_w)
  SELECT s.canonical_topic, s.week, least(coalesce((s.monday - max(n.monday)) // 7, 999), 200)::BIGINT AS weeks_since_last_nl
  FROM (SELECT canonical_topic, week, {{mon}} AS monday FROM sig_w) s
  LEFT JOIN n ON n.canonical_topic = s.canonical_topic AND n.monday < s.monday GROUP BY ALL""".replace(
    "{mon}", "CAST(date_trunc('week', make_date(CAST(substr(week, 1, 4) AS INT), 1, 4)) AS DATE) + 7 * (CAST(substr(week, 7, 2) AS INT) - 1)"
).replace("GROUP BY ALL", "GROUP BY s.canonical_topic, s.week, s.monday"))
def _since(spark, d):
    history = features.history_features(sig_weekly(spark, d), nl_weekly(spark, d))
    return history.select("canonical_topic", "week", "weeks_since_last_nl")


@reg.add("forward_label", f"""{WEEKLY}, n AS (SELECT canonical_topic, {{mon}} AS monday FROM nl_w),
  s AS (SELECT canonical_topic, week, {{mon}} AS monday FROM sig_w)
  SELECT canonical_topic, week, (EXISTS (SELECT 1 FROM n WHERE n.canonical_topic = s.canonical_topic
     AND n.monday IN (s.monday + 7, s.monday + 14)))::INT AS label_next2wk FROM s""".replace(
    "{mon}", "CAST(date_trunc('week', make_date(CAST(substr(week, 1, 4) AS INT), 1, 4)) AS DATE) + 7 * (CAST(substr(week, 7, 2) AS INT) - 1)"
))
def _label(spark, d):
    return features.forward_label(sig_weekly(spark, d), nl_weekly(spark, d))


@reg.add("burst_hist_join", f"{FEAT} SELECT {_FEAT_COLS} FROM feat")
def _burst_hist(spark, d):
    sig, nl = sig_weekly(spark, d), nl_weekly(spark, d)
    labelled = bursts(spark, d).join(features.forward_label(sig, nl), ["canonical_topic", "week"])
    return features.join_history(labelled, features.history_features(sig, nl))


@reg.add("topic_week_features", f"{FEAT} SELECT {_FEAT_COLS} FROM feat")
def _features(spark, d):
    return feature_matrix(spark, d)


CAPPED = """
caps AS (
  SELECT (SELECT burst_score FROM feat ORDER BY burst_score LIMIT 1
            OFFSET (SELECT floor((count(*) - 1) * 0.99::DOUBLE + 0.5)::BIGINT FROM feat)) AS b,
         (SELECT mentions FROM feat ORDER BY mentions LIMIT 1
            OFFSET (SELECT floor((count(*) - 1) * 0.99::DOUBLE + 0.5)::BIGINT FROM feat)) AS m),
capped AS (
  SELECT * EXCLUDE (burst_score, mentions), least(burst_score, (SELECT b FROM caps)) AS burst_score,
         least(mentions, (SELECT m FROM caps))::BIGINT AS mentions FROM feat)"""


@reg.add("cap_quantile", f"{FEAT}, {CAPPED} SELECT {_FEAT_COLS} FROM capped")
def _capped(spark, d):
    return distribution.cap_quantile(feature_table(spark, d), ["burst_score", "mentions"])


# --- source types and trajectories --------------------------------------------

@reg.add("source_burst", f"{FEAT}, {SRC_BURST} SELECT * FROM src_burst")
def _source_burst(spark, d):
    return src_bursts(spark, d)


@reg.add("multi_source", f"{FEAT}, {SRC_BURST} SELECT * FROM multi")
def _multi(spark, d):
    return features.multi_source(src_bursts(spark, d))


@reg.add("trajectory", f"{BURST}, {TRAJ} SELECT * FROM traj")
def _traj(spark, d):
    return features.trajectory(bursts(spark, d))


# --- per-source tables ---------------------------------------------------------

ACAD = """
acad AS (
  SELECT canonical_topic, week, sum((source IN ('arxiv', 'semantic_scholar'))::INT)::BIGINT AS academic,
         sum((source IN ('reddit', 'hackernews', 'github'))::INT)::BIGINT AS social FROM sig GROUP BY 1, 2),
acad_n AS (
  SELECT *, 0.4::DOUBLE * academic_n + 0.6::DOUBLE * social_n AS combined FROM (
    SELECT *, academic / (SELECT CASE max(academic) WHEN 0 THEN 1 ELSE max(academic) END FROM acad) AS academic_n,
           social / (SELECT CASE max(social) WHEN 0 THEN 1 ELSE max(social) END FROM acad) AS social_n FROM acad))"""


@reg.add("academic_social", f"{SIG}, {ACAD} SELECT canonical_topic, week, academic, social, round(academic_n, 9) AS academic_n, round(social_n, 9) AS social_n, round(combined, 9) AS combined FROM acad_n")
def _acad(spark, d):
    scored = weekly.academic_social(weekly.cube_signals(topic_cube(spark, d)))
    return scored.select(
        "canonical_topic", "week", "academic", "social",
        *[F.round(c, 9).alias(c) for c in ("academic_n", "social_n", "combined")],
    )


@reg.add("source_mix", f"""{SIG}, l AS (SELECT source, count(*) AS mentions FROM sig WHERE week = (SELECT max(week) FROM sig) GROUP BY 1)
  SELECT source, mentions, mentions / (SELECT sum(mentions) FROM l) AS share FROM l""")
def _mix(spark, d):
    return weekly.source_mix(weekly.cube_signals(topic_cube(spark, d)))


@reg.add("source_timeline", f"{SIG} SELECT week, source, count(*) AS mentions FROM sig GROUP BY 1, 2")
def _timeline(spark, d):
    return weekly.source_timeline(weekly.cube_signals(topic_cube(spark, d)))
