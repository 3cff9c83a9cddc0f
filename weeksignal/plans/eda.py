"""Joins that assemble the exploratory tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weeksignal.operators.stats import LABEL
from weeksignal.operators.weekly import TOPIC_WEEK

FULL_FEATURES = [
    "burst_score", "mentions", "topic_nl_rate_alltime", "topic_nl_rate_8wk",
    "weeks_since_last_nl", "is_novel_topic", "sources_bursting", "max_source_burst",
    "peak_burst", "trend_slope", "consistent_weeks", "spike_ratio", LABEL,
]


def label_multi_source(features: DataFrame, multi: DataFrame) -> DataFrame:
    labelled = features.select(*TOPIC_WEEK, LABEL).join(multi, TOPIC_WEEK, "left")
    return labelled.fillna(0)


def label_trajectory(features: DataFrame, trajectories: DataFrame) -> DataFrame:
    return features.select(*TOPIC_WEEK, LABEL).join(trajectories, TOPIC_WEEK)


def full_feature_matrix(features: DataFrame, multi: DataFrame, trajectories: DataFrame) -> DataFrame:
    base = features.select(*TOPIC_WEEK, *[c for c in FULL_FEATURES if c in features.columns])
    joined = base.join(multi, TOPIC_WEEK, "left").join(trajectories, TOPIC_WEEK, "left")
    return joined.fillna(0).select(*TOPIC_WEEK, *FULL_FEATURES)
