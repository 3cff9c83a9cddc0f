"""Counts per topic and week, and other plain aggregates over the mapped phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weeksignal.functions.scalars import safe_ratio
from weeksignal.functions.text import source_type
from weeksignal.functions.weeks import iso_week, valid_week

TOPIC_WEEK = ["canonical_topic", "week"]


def with_known_week(df: DataFrame) -> DataFrame:
    return df.where(F.col("week").isNotNull() & (F.col("week") != ""))


def ensure_week(df: DataFrame) -> DataFrame:
    """Derive ``week`` from ``date`` where it is missing, then keep well-formed weeks."""
    if "week" not in df.columns and "date" in df.columns:
        df = df.withColumn("week", iso_week("date"))
    return df.where(F.coalesce(valid_week("week"), F.lit(False)))


def mention_count(df: DataFrame) -> Column:
    """Sum of ``mentions`` where the table has that column, else the row count."""
    if "mentions" in df.columns:
        return F.sum("mentions").cast("long").alias("mentions")
    return F.count(F.lit(1)).alias("mentions")


def mentions_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(mention_count(df))


def topic_cube(signals: DataFrame, newsletters: DataFrame | None = None, covered: str = "covered") -> DataFrame:
    """Mentions and newsletter mentions per topic, week and source, counted in one pass.

    Every weekly table follows from this small one, so the raw rows are read once however many
    tables are wanted. Editorial coverage is a table of its own, a boolean column ``covered`` of
    the signals (NULL: not covered), or both. Rows without a topic, week or source keep their NULLs.
    """
    hit = F.coalesce(F.col(covered), F.lit(False)) if covered in signals.columns else F.lit(False)
    keys = [*TOPIC_WEEK, "source"]
    rows = signals.select(*keys, F.lit(1).alias("signal"), hit.cast("int").alias("letter"))
    if newsletters is not None:
        rows = rows.unionByName(newsletters.select(*keys, F.lit(0).alias("signal"), F.lit(1).alias("letter")))
    return rows.groupBy(*keys).agg(F.sum("signal").alias("mentions"), F.sum("letter").alias("nl_mentions"))


def cube_signals(cube: DataFrame) -> DataFrame:
    """The signal side of a cube: stands for the raw signals wherever only topic, week and source count."""
    return cube.where(F.col("mentions") > 0).drop("nl_mentions")


def cube_newsletters(cube: DataFrame) -> DataFrame:
    """The newsletter weeks of a cube, as ``newsletter_weekly`` gives them."""
    counted = with_known_week(cube.where(F.col("nl_mentions") > 0)).groupBy(*TOPIC_WEEK)
    return counted.agg(F.sum("nl_mentions").alias("nl_mentions")).withColumn("in_newsletter", F.lit(1))


def weekly_mentions(signals: DataFrame) -> DataFrame:
    return mentions_by(with_known_week(signals), TOPIC_WEEK)


def weekly_mentions_by_type(signals: DataFrame) -> DataFrame:
    typed = with_known_week(signals)
    if "source_type" not in typed.columns:
        typed = typed.withColumn("source_type", source_type("source"))
    return mentions_by(typed, [*TOPIC_WEEK, "source_type"])


def newsletter_weekly(newsletters: DataFrame) -> DataFrame:
    counted = with_known_week(newsletters).groupBy(*TOPIC_WEEK)
    return counted.agg(F.count(F.lit(1)).alias("nl_mentions")).withColumn("in_newsletter", F.lit(1))


def count_by_key(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Group sizes, largest first, ties by key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.col(name).desc(), F.col(key).asc())


def top_groups(df: DataFrame, key: str, limit: int, name: str = "count") -> DataFrame:
    return count_by_key(df, key, name).limit(limit)


def total_mentions_top(weekly: DataFrame, limit: int = 15) -> DataFrame:
    totals = weekly.groupBy("canonical_topic").agg(F.sum("mentions").alias("mentions"))
    return totals.orderBy(F.col("mentions").desc(), "canonical_topic").limit(limit)


def distinct_sources(signals: DataFrame) -> DataFrame:
    return signals.groupBy(*TOPIC_WEEK).agg(F.countDistinct("source").alias("n_sources"))


def topic_count_compare(newsletters: DataFrame, signals: DataFrame, max_signal: int = 50, limit: int = 20) -> DataFrame:
    """Topics editors cover although the signal sources barely mention them."""
    nl = newsletters.groupBy("canonical_topic").agg(F.count(F.lit(1)).alias("newsletter_mentions"))
    sig = signals.groupBy("canonical_topic").agg(F.count(F.lit(1)).alias("signal_mentions"))
    joined = nl.join(sig, "canonical_topic", "left").fillna(0, ["signal_mentions"])
    low = joined.where(F.col("signal_mentions") < max_signal)
    return low.orderBy(F.col("newsletter_mentions").desc(), "canonical_topic").limit(limit)


def phrase_overview(phrases: DataFrame) -> DataFrame:
    return phrases.agg(
        F.count(F.lit(1)).alias("phrases"),
        F.countDistinct("phrase").alias("unique_phrases"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def dataset_overview(weekly: DataFrame) -> DataFrame:
    return weekly.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("canonical_topic").alias("topics"),
        F.countDistinct("week").alias("weeks"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
    )


def all_weeks(signals_weekly: DataFrame, newsletters_weekly: DataFrame) -> DataFrame:
    """Well-formed weeks that occur in either table."""
    weeks = signals_weekly.select("week").union(newsletters_weekly.select("week")).distinct()
    return weeks.where(valid_week("week"))


def latest_weeks(weekly: DataFrame) -> DataFrame:
    """One row: the latest week of the table and the one before it."""
    weeks = weekly.select("week").where(valid_week("week")).distinct()
    newest = weeks.orderBy(F.col("week").desc()).limit(2)
    return newest.agg(
        F.max("week").alias("latest"),
        F.when(F.count(F.lit(1)) > 1, F.min("week")).alias("previous"),
    )


def academic_social(signals: DataFrame, academic=("arxiv", "semantic_scholar"), social=("reddit", "hackernews", "github")) -> DataFrame:
    """Scaled mention counts of two groups of sources and their weighted mean.

    One conditional aggregation in place of two aggregates and a full outer join.
    """
    size = F.col("mentions") if "mentions" in signals.columns else F.lit(1)
    counted = (
        signals.where(F.col("source").isin(*academic, *social))
        .groupBy(*TOPIC_WEEK)
        .agg(
            F.sum(F.when(F.col("source").isin(*academic), size).otherwise(0)).alias("academic"),
            F.sum(F.when(F.col("source").isin(*social), size).otherwise(0)).alias("social"),
        )
    )
    tops = counted.agg(F.struct(F.max("academic").alias("a"), F.max("social").alias("s"))).scalar()

    def scaled(name: str, field: str) -> Column:
        top = tops.getField(field)
        return F.col(name) / F.when(top == 0, F.lit(1)).otherwise(top)

    scored = counted.withColumn("academic_n", scaled("academic", "a"))
    scored = scored.withColumn("social_n", scaled("social", "s"))
    return scored.withColumn("combined", 0.4 * F.col("academic_n") + 0.6 * F.col("social_n"))


def source_mix(signals: DataFrame, week: Column | None = None) -> DataFrame:
    """Mentions per source in one week (the latest well-formed one by default) and their share."""
    if week is None:
        week = latest_weeks(signals).select("latest").scalar()
    counts = mentions_by(signals.where(F.col("week") == week), ["source"])
    total = counts.agg(F.sum("mentions")).scalar()
    mix = counts.withColumn("share", safe_ratio("mentions", total))
    return mix.orderBy(F.col("mentions").desc(), "source")


def source_timeline(signals: DataFrame) -> DataFrame:
    return mentions_by(signals, ["week", "source"])


def link_coverage(mapped: DataFrame, topic: str = "canonical_topic") -> DataFrame:
    return mapped.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(topic).alias("mapped"),
        safe_ratio(F.count(topic) * 100, F.count(F.lit(1))).alias("percent"),
    )
