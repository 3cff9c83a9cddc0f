"""Causal features per active topic-week.

Inputs are the weekly aggregates, so a topic owns at most one row per week and a
window over one topic is bounded by the length of the calendar, however many raw
mentions that topic has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weeksignal.functions.weeks import week_number
from weeksignal.operators.weekly import TOPIC_WEEK

NEVER = 999
RECENCY_CAP = 200
LOOKBACK = 8
MIN_ACTIVE_WEEKS = 4


def _baseline(keys: list[str], order: str, rows: int = LOOKBACK) -> tuple[Column, Column, Column]:
    """(count, mean, population std) of the mentions in the preceding rows.

    Built from integer sums, so the result does not depend on summation order.
    """
    past = Window.partitionBy(*keys).orderBy(order).rowsBetween(-rows, -1)
    x = F.col("mentions").cast("long")
    n = F.count(F.lit(1)).over(past)
    total = F.coalesce(F.sum(x).over(past), F.lit(0)).cast("long")
    squares = F.coalesce(F.sum(x * x).over(past), F.lit(0)).cast("long")
    mean = F.try_divide(total.cast("double"), n)
    std = F.sqrt(F.try_divide((n * squares - total * total).cast("double"), n * n))
    return n, mean, std


def _burst_columns(df: DataFrame, keys: list[str], order: str = "week") -> DataFrame:
    n, mean, std = _baseline(keys, order)
    df = df.withColumns({"_past": n, "_mean": mean, "_std": std})
    known = F.col("_past") >= 2
    return df.withColumns(
        {
            "_mean": F.when(known, F.col("_mean")).otherwise(F.col("mentions").cast("double")),
            "_std": F.when(known, F.col("_std")).otherwise(F.lit(1.0)),
        }
    ).withColumn("_burst", (F.col("mentions") - F.col("_mean")) / (F.col("_std") + 1))


def burst_scores(weekly: DataFrame, with_std: bool = False, min_weeks: int = MIN_ACTIVE_WEEKS) -> DataFrame:
    """How far each week stands above the topic's own trailing active weeks."""
    keys = ["canonical_topic"]
    enough = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    scored = _burst_columns(weekly, keys).withColumn("_weeks", enough)
    scored = scored.where(F.col("_weeks") >= min_weeks)
    columns = [*TOPIC_WEEK, "mentions", F.bround("_mean", 2).alias("rolling_mean")]
    if with_std:
        columns.append(F.bround("_std", 2).alias("rolling_std"))
    return scored.select(*columns, F.bround("_burst", 3).alias("burst_score"))


def source_bursts(weekly_by_type: DataFrame, types=("research", "developer", "discussion"), threshold: float = 0.5) -> DataFrame:
    """Burst per topic and source type; rows with fewer than two past rows are left out."""
    keys = ["canonical_topic", "source_type"]
    rows = weekly_by_type.where(F.col("source_type").isin(*types))
    rows = rows.groupBy(*keys, "week").agg(F.sum("mentions").alias("mentions"))
    scored = _burst_columns(rows, keys).withColumn(
        "_weeks", F.count(F.lit(1)).over(Window.partitionBy(*keys))
    )
    scored = scored.where((F.col("_weeks") >= 3) & (F.col("_past") >= 2))
    return scored.select(
        *TOPIC_WEEK,
        "source_type",
        F.bround("_burst", 3).alias("source_burst"),
        (F.col("_burst") > threshold).cast("int").alias("is_active"),
    )


def multi_source(bursts: DataFrame) -> DataFrame:
    return bursts.groupBy(*TOPIC_WEEK).agg(
        F.sum("is_active").alias("sources_bursting"),
        F.max("source_burst").alias("max_source_burst"),
    )


def trajectory(bursts: DataFrame, window: int = 4, min_rows: int = 5, threshold: float = 0.5) -> DataFrame:
    """Shape of the last four burst scores, the current one included."""
    by_topic = Window.partitionBy("canonical_topic").orderBy("week")
    last = by_topic.rowsBetween(-(window - 1), 0)
    recent = F.collect_list("burst_score").over(last)
    rows = bursts.withColumns(
        {
            "_rn": F.row_number().over(by_topic),
            "_n": F.count(F.lit(1)).over(Window.partitionBy("canonical_topic")),
            "_w": recent,
        }
    )
    rows = rows.where((F.col("_n") >= min_rows) & (F.col("_rn") >= window))
    # Scores carry three decimals; whole thousandths keep sums free of rounding noise.
    parts = [F.round(F.element_at("_w", i + 1) * 1000).cast("long") for i in range(window)]
    spread = sum((2 * i - (window - 1)) ** 2 for i in range(window)) // 2
    tilt = sum(((2 * i - (window - 1)) * part for i, part in enumerate(parts)), F.lit(0))
    slope = tilt / F.lit(1000 * spread)
    mean = sum(parts, F.lit(0)) / F.lit(1000 * window)
    peak = F.array_max("_w")
    return rows.select(
        *TOPIC_WEEK,
        F.bround(peak, 3).alias("peak_burst"),
        F.bround(slope, 3).alias("trend_slope"),
        F.size(F.filter("_w", lambda s: s > threshold)).cast("long").alias("consistent_weeks"),
        # NULL where the mean is exactly -0.01 and the ratio has no value.
        F.bround(F.try_divide(peak, mean + 0.01), 3).alias("spike_ratio"),
    )


def topic_timeline(signals_weekly: DataFrame, newsletters_weekly: DataFrame) -> DataFrame:
    """One row per topic and week that has a signal or a newsletter mention.

    Grouping the union of both aggregates needs one shuffle where a full outer
    join would need two.
    """
    sig = signals_weekly.select(*TOPIC_WEEK, "mentions", F.lit(0).alias("in_nl"))
    nl = newsletters_weekly.select(*TOPIC_WEEK, F.lit(0).cast("long").alias("mentions"), F.lit(1).alias("in_nl"))
    both = sig.unionByName(nl).groupBy(*TOPIC_WEEK).agg(
        F.sum("mentions").alias("mentions"), F.max("in_nl").alias("in_nl")
    )
    return both.withColumn("week_no", week_number("week"))


def add_history(timeline: DataFrame, numerator: str = "active", window: int = 2) -> DataFrame:
    """Label and editorial history for the active rows of a timeline.

    Recency, counts and the label see every newsletter week; the rates look at
    active weeks only. ``numerator`` decides whether the all-time rate counts
    newsletter weeks without a signal as well (``all``) or not (``active``).
    """
    by_topic = Window.partitionBy("canonical_topic").orderBy("week_no")
    before = by_topic.rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_topic.rangeBetween(1, window)
    hit_week = F.when(F.col("in_nl") == 1, F.col("week_no"))
    seen = timeline.withColumns(
        {
            "past_nl_count": F.coalesce(F.sum("in_nl").over(before), F.lit(0)).cast("long"),
            "_last_nl": F.last(hit_week, ignorenulls=True).over(before),
            "label_next2wk": F.coalesce(F.max("in_nl").over(ahead), F.lit(0)).cast("int"),
        }
    )
    active = seen.where(F.col("mentions") > 0)
    past_rows = F.row_number().over(by_topic) - 1
    if numerator == "active":
        hits = F.coalesce(F.sum("in_nl").over(before), F.lit(0))
    elif numerator == "all":
        hits = F.col("past_nl_count")
    else:
        raise ValueError(f"numerator must be 'active' or 'all', not {numerator!r}")
    last8 = by_topic.rowsBetween(-LOOKBACK, -1)
    hits8 = F.coalesce(F.sum("in_nl").over(last8), F.lit(0))
    rows8 = F.count(F.lit(1)).over(last8)
    active = active.withColumns(
        {"_hits": hits, "_rows": past_rows, "_hits8": hits8, "_rows8": rows8}
    )
    rate = lambda num, den: F.when(F.col(den) == 0, F.lit(0.0)).otherwise(F.bround(F.try_divide(F.col(num).cast("double"), F.col(den)), 4))
    since = F.coalesce(F.col("week_no") - F.col("_last_nl"), F.lit(NEVER))
    return active.withColumns(
        {
            "topic_nl_rate_8wk": rate("_hits8", "_rows8"),
            "topic_nl_rate_alltime": rate("_hits", "_rows"),
            "weeks_since_last_nl": F.least(since, F.lit(RECENCY_CAP)).cast("long"),
            "is_novel_topic": (F.col("past_nl_count") == 0).cast("int"),
        }
    ).drop("_hits", "_rows", "_hits8", "_rows8", "_last_nl")


HISTORY_COLUMNS = [
    "topic_nl_rate_8wk",
    "topic_nl_rate_alltime",
    "weeks_since_last_nl",
    "is_novel_topic",
    "past_nl_count",
]


def history_features(signals_weekly: DataFrame, newsletters_weekly: DataFrame, numerator: str = "active") -> DataFrame:
    history = add_history(topic_timeline(signals_weekly, newsletters_weekly), numerator)
    return history.select(*TOPIC_WEEK, *HISTORY_COLUMNS)


def forward_label(signals_weekly: DataFrame, newsletters_weekly: DataFrame, window: int = 2) -> DataFrame:
    """1 where the topic reaches a newsletter in one of the next ``window`` weeks."""
    history = add_history(topic_timeline(signals_weekly, newsletters_weekly), window=window)
    return history.select(*TOPIC_WEEK, "label_next2wk")


def join_history(bursts: DataFrame, history: DataFrame) -> DataFrame:
    return bursts.join(history, TOPIC_WEEK, "left").fillna(0)


def topic_week_features(
    signals_weekly: DataFrame,
    newsletters_weekly: DataFrame,
    numerator: str = "active",
    with_std: bool = False,
) -> DataFrame:
    """Burst, history and label in one pass over one partitioning by topic."""
    active = add_history(topic_timeline(signals_weekly, newsletters_weekly), numerator)
    by_topic = Window.partitionBy("canonical_topic")
    scored = _burst_columns(active, ["canonical_topic"], "week_no")
    scored = scored.withColumn("_weeks", F.count(F.lit(1)).over(by_topic))
    scored = scored.where(F.col("_weeks") >= MIN_ACTIVE_WEEKS)
    std = [F.bround("_std", 2).alias("rolling_std")] if with_std else []
    return scored.select(
        *TOPIC_WEEK,
        "mentions",
        F.bround("_mean", 2).alias("rolling_mean"),
        *std,
        F.bround("_burst", 3).alias("burst_score"),
        "label_next2wk",
        *HISTORY_COLUMNS,
    )


def same_week_label(features: DataFrame, newsletters_weekly: DataFrame) -> DataFrame:
    """Label of the earlier study: covered in the very same week."""
    hits = newsletters_weekly.select(*TOPIC_WEEK, F.lit(1).alias("label_same_week"))
    return features.join(hits, TOPIC_WEEK, "left").fillna(0, ["label_same_week"])
