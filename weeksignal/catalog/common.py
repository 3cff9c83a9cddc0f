"""Shared inputs of the registered queries, and the SQL that mirrors them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weeksignal.operators import features, weekly
from weeksignal.session import cut_lineage
from weeksignal.sources import adapters


def signals(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.signal_topic_map(spark, folder)


def newsletters(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.newsletter_topic_map(spark, folder)


def sig_weekly(spark, folder) -> DataFrame:
    return weekly.weekly_mentions(signals(spark, folder))


def nl_weekly(spark, folder) -> DataFrame:
    return weekly.newsletter_weekly(newsletters(spark, folder))


def topic_cube(spark, folder) -> DataFrame:
    """Counts per topic, week and source, written once: the raw mentions are read here and nowhere else."""
    return cut_lineage(weekly.topic_cube(adapters.covered_mentions(spark, folder)), "cube")


def feature_matrix(spark, folder, numerator: str = "active", cube: DataFrame | None = None) -> DataFrame:
    """The matrix from a given cube, or from one of its own."""
    cube = topic_cube(spark, folder) if cube is None else cube
    return features.topic_week_features(weekly.weekly_mentions(weekly.cube_signals(cube)), weekly.cube_newsletters(cube), numerator)


def feature_table(spark, folder, numerator: str = "active", cube: DataFrame | None = None) -> DataFrame:
    """The matrix written once to the shared folder.

    For queries that use it several times: windows run once, however many branches follow.
    """
    return cut_lineage(feature_matrix(spark, folder, numerator, cube), "features")


# --- SQL fragments -----------------------------------------------------------

_LINES = """
lines AS (
  SELECT p_name AS phrase, 0.5::DOUBLE + l_discount AS score,
         CASE l_suppkey % 5 WHEN 0 THEN 'arxiv' WHEN 1 THEN 'semantic_scholar' WHEN 2 THEN 'github'
                            WHEN 3 THEN 'reddit' ELSE 'hackernews' END AS source,
         strftime(l_shipdate, '%Y-%m-%d') AS date, strftime(l_shipdate, '%G-W%V') AS week,
         p_brand || ' ' || p_type AS canonical_topic, 0.72::DOUBLE + l_discount AS similarity,
         l_quantity, l_returnflag
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

_SIG = """
sig AS (SELECT phrase, score, source, date, week, canonical_topic, similarity FROM lines),
nl AS (SELECT phrase, score, 'tldr_ai' AS source, date, week, canonical_topic, similarity
       FROM lines WHERE l_quantity >= 48 AND l_returnflag = 'R')"""

_WEEKLY = """
sig_w AS (SELECT canonical_topic, week, count(*) AS mentions FROM sig GROUP BY 1, 2),
nl_w AS (SELECT canonical_topic, week, count(*) AS nl_mentions, 1 AS in_newsletter FROM nl GROUP BY 1, 2)"""


def sql_monday(week: str) -> str:
    return (
        f"CAST(date_trunc('week', make_date(CAST(substr({week}, 1, 4) AS INT), 1, 4)) AS DATE)"
        f" + 7 * (CAST(substr({week}, 7, 2) AS INT) - 1)"
    )


def sql_week_no(week: str) -> str:
    return f"CAST(floor((({sql_monday(week)}) - DATE '1970-01-05') / 7.0) AS INT)"


_TIMELINE = f"""
tl AS (
  SELECT canonical_topic, week, coalesce(mentions, 0) AS mentions, coalesce(in_newsletter, 0) AS in_nl,
         {sql_week_no('week')} AS week_no
  FROM sig_w FULL JOIN nl_w USING (canonical_topic, week))"""


def sql_burst(relation: str, keys: str, extra: str = "") -> str:
    """Burst columns over ``relation``; std and mean follow from exact integer sums."""
    return f"""
  SELECT *, (mentions - m) / (sd + 1) AS raw_burst FROM (
    SELECT *, CASE WHEN pn >= 2 THEN ps / pn ELSE mentions::DOUBLE END AS m,
           CASE WHEN pn >= 2 THEN sqrt((pn * pq - ps * ps)::DOUBLE / (pn * pn)::DOUBLE) ELSE 1.0 END AS sd
    FROM (
      SELECT *, count(*) OVER w AS pn, CAST(sum(mentions) OVER w AS BIGINT) AS ps,
             CAST(sum(mentions * mentions) OVER w AS BIGINT) AS pq,
             count(*) OVER (PARTITION BY {keys}) AS n_weeks
      FROM {relation}
      WINDOW w AS (PARTITION BY {keys} ORDER BY week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)))"""


_BURST = f"""
burst AS (
  SELECT canonical_topic, week, mentions, round_even(m, 2) AS rolling_mean, round_even(sd, 2) AS rolling_std,
         round_even(raw_burst, 3) AS burst_score
  FROM ({sql_burst('sig_w', 'canonical_topic')}) WHERE n_weeks >= 4)"""

_HIST = """
seen AS (
  SELECT *, coalesce(sum(in_nl) OVER b, 0)::BIGINT AS past_nl_count,
         max(CASE WHEN in_nl = 1 THEN week_no END) OVER b AS last_nl,
         coalesce(max(in_nl) OVER (PARTITION BY canonical_topic ORDER BY week_no
                                   RANGE BETWEEN 1 FOLLOWING AND 2 FOLLOWING), 0)::INT AS label_next2wk
  FROM tl WINDOW b AS (PARTITION BY canonical_topic ORDER BY week_no
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
act AS (
  SELECT *, coalesce(sum(in_nl) OVER a, 0) AS h_all, count(*) OVER a AS r_all,
         coalesce(sum(in_nl) OVER e, 0) AS h8, count(*) OVER e AS r8
  FROM seen WHERE mentions > 0
  WINDOW a AS (PARTITION BY canonical_topic ORDER BY week_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         e AS (PARTITION BY canonical_topic ORDER BY week_no ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
hist AS (
  SELECT canonical_topic, week, label_next2wk,
         CASE WHEN r8 = 0 THEN 0.0 ELSE round_even(h8 / r8, 4) END::DOUBLE AS topic_nl_rate_8wk,
         CASE WHEN r_all = 0 THEN 0.0 ELSE round_even(h_all / r_all, 4) END::DOUBLE AS topic_nl_rate_alltime,
         CASE WHEN r_all = 0 THEN 0.0 ELSE round_even(past_nl_count / r_all, 4) END::DOUBLE AS rate_alltime_all,
         least(coalesce(week_no - last_nl, 999), 200)::BIGINT AS weeks_since_last_nl,
         (past_nl_count = 0)::INT AS is_novel_topic, past_nl_count
  FROM act)"""

_MATRIX = """
feat AS (
  SELECT b.canonical_topic, b.week, mentions, rolling_mean, burst_score, label_next2wk, topic_nl_rate_8wk,
         topic_nl_rate_alltime, weeks_since_last_nl, is_novel_topic, past_nl_count
  FROM burst b JOIN hist h ON b.canonical_topic = h.canonical_topic AND b.week = h.week)"""


def ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)


SIG = ctes(_LINES, _SIG)
WEEKLY = ctes(_LINES, _SIG, _WEEKLY)
BURST = ctes(_LINES, _SIG, _WEEKLY, _BURST)
HIST = ctes(_LINES, _SIG, _WEEKLY, _TIMELINE, _HIST)
FEAT = ctes(_LINES, _SIG, _WEEKLY, _TIMELINE, _BURST, _HIST, _MATRIX)


class Registry:
    """Named queries with their optional SQL counterpart."""

    def __init__(self):
        self.queries = {}
        self.sql = {}

    def add(self, name: str, sql: str | None = None):
        def register(fn):
            if name in self.queries:
                raise ValueError(f"query {name!r} registered twice")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register
