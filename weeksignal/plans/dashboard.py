"""Tables behind the analyst's charts, each a small query over the feature matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weeksignal.functions import scalars, text
from weeksignal.functions.weeks import valid_week
from weeksignal.operators import distribution, stats, weekly
from weeksignal.operators.stats import LABEL
from weeksignal.operators.weekly import TOPIC_WEEK

CORRELATED = [
    "burst_score", "mentions", "topic_nl_rate_alltime", "topic_nl_rate_8wk",
    "weeks_since_last_nl", "is_novel_topic", "n_sources", "past_nl_count",
]

HABITS = {
    "topic_nl_rate_alltime": (0.0, 1.5),
    "topic_nl_rate_8wk": (0.0, 0.6),
    "weeks_since_last_nl": (0.0, 100.0),
}


def dashboard_matrix(features: DataFrame, signals: DataFrame) -> DataFrame:
    """Features with the academic/social scores and the number of sources, gaps as 0.

    Rows without a well-formed week are no part of any table or scale.
    """
    features, signals = weekly.ensure_week(features), weekly.ensure_week(signals)
    scores = weekly.academic_social(signals).select(*TOPIC_WEEK, "academic_n", "social_n", "combined")
    sources = weekly.distinct_sources(signals)
    return features.join(scores, TOPIC_WEEK, "left").join(sources, TOPIC_WEEK, "left").fillna(0)


def _weeks(df: DataFrame) -> Column:
    """The latest two well-formed weeks as a scalar struct (latest, previous)."""
    return weekly.latest_weeks(df).select(F.struct("latest", "previous")).scalar()


def top_of_week(df: DataFrame, week: Column, limit: int) -> DataFrame:
    ranked = df.where(F.col("week") == week)
    return ranked.orderBy(F.col("burst_score").desc(), "canonical_topic").limit(limit)


def top_bursts(matrix: DataFrame, limit: int = 10) -> DataFrame:
    """The latest week's strongest bursts with display labels."""
    top = top_of_week(matrix, _weeks(matrix).getField("latest"), limit)
    label = text.star_flag(text.title_case("canonical_topic"), LABEL)
    rank = F.row_number().over(
        Window.partitionBy("week").orderBy(F.col("burst_score").desc(), "canonical_topic")
    )
    return top.select(
        rank.alias("rank"), *TOPIC_WEEK, label.alias("label"), "burst_score", "mentions", LABEL
    )


def momentum(bursts: DataFrame, limit: int = 10) -> DataFrame:
    """Top of the latest week against the calendar's previous week, absent = 0."""
    weeks = _weeks(bursts)
    top = top_of_week(bursts, weeks.getField("latest"), limit)
    before = bursts.where(F.col("week") == weeks.getField("previous")).select(
        "canonical_topic", F.col("burst_score").alias("prev_burst")
    )
    joined = top.join(before, "canonical_topic", "left").fillna(0.0, ["prev_burst"])
    return joined.select(
        "canonical_topic", "week", "mentions", "burst_score", "prev_burst",
        F.bround(F.col("burst_score") - F.col("prev_burst"), 3).alias("delta"),
    )


def source_scatter(matrix: DataFrame, limit: int = 22) -> DataFrame:
    """Bubble chart rows of the latest week."""
    top = top_of_week(matrix, _weeks(matrix).getField("latest"), limit)
    return top.select(
        "canonical_topic", "burst_score", "academic_n", "social_n",
        scalars.clip("combined", 0.0, 1.0).alias("combined"),
        scalars.bubble_size("burst_score").alias("size"),
        scalars.quadrant("academic_n", "social_n").alias("quadrant"),
    )


def sampled_weeks(df: DataFrame, step: int = 2, last: int | None = None) -> DataFrame:
    """Every ``step``-th week from the first on, optionally the last ``last`` of these.

    The calendar is short, so it is handled as one sorted array.
    """
    weeks = df.select("week").where(valid_week("week")).distinct()
    calendar = weeks.agg(F.array_sort(F.collect_list("week")).alias("w"))
    picked = calendar.select(F.filter("w", lambda _, i: i % step == 0).alias("w"))
    if last is not None:
        picked = picked.select(F.slice("w", F.greatest(F.size("w") - last + 1, F.lit(1)), F.lit(last)).alias("w"))
    return picked.select(F.posexplode("w").alias("position", "week"))


def top_topics(matrix: DataFrame, mode: str = "weeks", limit: int = 20) -> DataFrame:
    """Topics with the most active weeks (``weeks``) or the highest single burst (``burst``)."""
    measure = {"weeks": F.count(F.lit(1)), "burst": F.max("burst_score")}[mode]
    ranked = matrix.groupBy("canonical_topic").agg(measure.alias("measure"))
    return ranked.orderBy(F.col("measure").desc(), "canonical_topic").limit(limit)


def week_grid(topics: DataFrame, weeks: DataFrame) -> DataFrame:
    """Every given topic with every given week.

    The weeks come as one array, exploded next to each topic.
    """
    calendar = weeks.agg(F.array_sort(F.collect_list("week"))).scalar()
    return topics.select("canonical_topic", calendar.alias("_weeks")).select(
        "canonical_topic", F.explode("_weeks").alias("week")
    )


def burst_heatmap(matrix: DataFrame, mode: str = "weeks", limit: int = 20, last: int | None = None) -> DataFrame:
    """Clipped burst and star flag for each cell of topics x sampled weeks, gaps as 0."""
    topics = top_topics(matrix, mode, limit).select("canonical_topic")
    cells = week_grid(topics, sampled_weeks(matrix, last=last))
    joined = cells.join(matrix.select(*TOPIC_WEEK, "burst_score", LABEL), TOPIC_WEEK, "left")
    return joined.select(
        "canonical_topic",
        text.truncate_label("canonical_topic").alias("label"),
        "week",
        scalars.clip(F.coalesce("burst_score", F.lit(0.0)), -1.0, 8.0).alias("burst"),
        F.coalesce(LABEL, F.lit(0)).alias("starred"),
    )


def week_rank_topk(matrix: DataFrame, weeks: int = 12, k: int = 5) -> DataFrame:
    """The k strongest bursts of each of the last weeks."""
    recent = matrix.select("week").distinct().orderBy(F.col("week").desc()).limit(weeks)
    order = Window.partitionBy("week").orderBy(F.col("burst_score").desc(), "canonical_topic")
    rows = matrix.join(recent, "week", "left_semi").withColumn("rank", F.row_number().over(order))
    return rows.where(F.col("rank") <= k).select("week", "rank", "canonical_topic", "burst_score", LABEL)


def trend_series(matrix: DataFrame, topics: list[str] | None = None, default: int = 5) -> DataFrame:
    """Burst over time of the chosen topics, by default the latest week's top."""
    if topics:
        chosen = matrix.where(F.col("canonical_topic").isin(topics))
    else:
        top = top_of_week(matrix, _weeks(matrix).getField("latest"), default)
        chosen = matrix.join(top.select("canonical_topic"), "canonical_topic", "left_semi")
    return chosen.select("canonical_topic", "week", "burst_score").orderBy("canonical_topic", "week")


def habit_distributions(matrix: DataFrame, bins: int = 30) -> DataFrame:
    """Density histograms of the editorial features by label, one job for all."""
    long = distribution.unpivot(matrix, list(HABITS), [LABEL])
    scaled = F.lit(None).cast("double")
    for feature, (low, high) in HABITS.items():
        unit = (F.least(F.greatest(F.col("value"), F.lit(low)), F.lit(high)) - low) / (high - low)
        scaled = F.when(F.col("feature") == feature, unit).otherwise(scaled)
    unit_rows = long.withColumn("value", scaled)
    hist = distribution.histogram_density(unit_rows, "value", 0.0, 1.0, bins, ["feature", LABEL])
    low, width = F.lit(0.0), F.lit(1.0)
    for feature, (lo, hi) in HABITS.items():
        low = F.when(F.col("feature") == feature, F.lit(lo)).otherwise(low)
        width = F.when(F.col("feature") == feature, F.lit(hi - lo)).otherwise(width)
    return hist.select(
        "feature", LABEL, "bin",
        (low + F.col("bin_start") * width).alias("bin_start"),
        "n",
        (F.col("density") / width).alias("density"),
    )


def kpi_row(matrix: DataFrame, weekly_counts: DataFrame) -> DataFrame:
    """Headline figures in one row.

    Topics are counted before the minimum-history rule of the burst score applies.
    """
    topics = weekly_counts.agg(F.countDistinct("canonical_topic")).scalar()
    top = top_of_week(matrix, _weeks(matrix).getField("latest"), 1)
    best = top.select(F.struct("canonical_topic", "burst_score")).scalar()
    corr = stats.label_correlations(matrix, CORRELATED).where(F.col("r").isNotNull())
    strongest = corr.orderBy(F.abs("r").desc(), "feature").limit(1)
    strongest = strongest.select(F.struct("feature", F.abs("r").alias("r"))).scalar()
    balance = stats.class_balance(matrix)
    return balance.select(
        topics.alias("topics"),
        F.col("positive").alias("newsletter_labels"),
        F.col("total").alias("active_rows"),
        F.col("ratio").alias("class_ratio"),
        strongest.getField("feature").alias("top_predictor"),
        F.round(strongest.getField("r"), 6).alias("top_predictor_r"),
        best.getField("canonical_topic").alias("top_topic"),
        best.getField("burst_score").alias("top_burst"),
    )
