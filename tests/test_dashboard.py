"""Rows without a well-formed week take no part in dashboard tables."""

from weeksignal.operators import weekly
from weeksignal.plans import dashboard


def test_malformed_weeks_change_nothing(spark):
    good = [("t", "2024-W01", "arxiv"), ("t", "2024-W01", "arxiv"), ("t", "2024-W01", "reddit")]
    bad = [("t", week, "arxiv") for week in ("", None, "n/a", "2024-1", "zzzz-W01") for _ in range(4)]
    schema = "canonical_topic string, week string, source string"
    features = spark.createDataFrame([("t", "2024-W01", 3), ("t", "n/a", 9)], "canonical_topic string, week string, mentions long")
    clean, mixed = spark.createDataFrame(good, schema), spark.createDataFrame(good + bad, schema)
    for signals in (clean, mixed):
        rows = dashboard.dashboard_matrix(features, signals).collect()
        assert [(r["week"], r["academic_n"], r["social_n"], r["n_sources"]) for r in rows] == [("2024-W01", 1.0, 1.0, 2)]
        mix = {r["source"]: r["mentions"] for r in weekly.source_mix(signals).collect()}
        assert mix == {"arxiv": 2, "reddit": 1}
