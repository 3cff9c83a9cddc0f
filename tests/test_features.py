import numpy as np
import pytest
from pyspark.sql import functions as F

from weeksignal.operators import features, weekly
from weeksignal.functions.weeks import week_offset


def week(n):
    from datetime import date, timedelta

    iso = (date(2024, 1, 1) + timedelta(weeks=n)).isocalendar()
    return f"{iso[0]}-W{iso[1]:02d}"


def frames(spark, sig, nl):
    s = spark.createDataFrame([(t, week(w), m) for t, w, m in sig], "canonical_topic string, week string, mentions long")
    n = spark.createDataFrame(
        [(t, week(w), 1, 1) for t, w in nl], "canonical_topic string, week string, nl_mentions long, in_newsletter int"
    )
    return s, n


def test_burst_hand_case(spark):
    for gap in (0, 20):
        weeks_ = [0, 1, 2 + gap, 3 + gap, 4 + gap]
        s, _ = frames(spark, list(zip("TTTTT", weeks_, [2, 4, 4, 10, 3])), [])
        rows = features.burst_scores(s).orderBy("week").collect()
        assert [r.rolling_mean for r in rows] == [2.0, 4.0, 3.0, 3.33, 5.0]
        assert [r.burst_score for r in rows] == [0.0, 0.0, 0.5, 3.431, -0.5]
        traj = features.trajectory(features.burst_scores(s)).orderBy("week").collect()
        got = [(r.peak_burst, r.trend_slope, r.consistent_weeks, r.spike_ratio) for r in traj]
        assert got == [(3.431, 1.079, 1, 3.456), (3.431, 0.143, 1, 3.954)]


def test_short_topics(spark):
    s, _ = frames(spark, [("A", i, 1) for i in range(3)] + [("B", i, 1) for i in range(4)], [])
    bursts = features.burst_scores(s)
    assert {r.canonical_topic for r in bursts.collect()} == {"B"}
    assert bursts.count() == 4 and features.trajectory(bursts).count() == 0


def test_history_hand_case(spark):
    s, n = frames(spark, [("T", i, 1) for i in (1, 2, 3, 5)], [("T", 2), ("T", 4)])
    timeline = features.topic_timeline(s, n)
    act = features.add_history(timeline, "active").orderBy("week").collect()
    every = features.add_history(timeline, "all").orderBy("week").collect()
    assert [r.topic_nl_rate_8wk for r in act] == [0.0, 0.0, 0.5, 0.3333]
    assert [r.topic_nl_rate_alltime for r in act] == [0.0, 0.0, 0.5, 0.3333]
    assert [r.topic_nl_rate_alltime for r in every] == [0.0, 0.0, 0.5, 0.6667]
    assert [r.weeks_since_last_nl for r in act] == [200, 200, 1, 1]
    assert [r.is_novel_topic for r in act] == [1, 1, 0, 0]
    assert [r.past_nl_count for r in act] == [0, 0, 1, 2]
    assert [r.label_next2wk for r in act] == [1, 1, 1, 0]


def brute(sig, nl):
    """Features straight from their definitions, one topic-week at a time."""
    out = {}
    covered = set(nl)
    topics = {t for t, _, _ in sig}
    for t in topics:
        active = sorted((w, m) for tt, w, m in sig if tt == t)
        if len(active) < 4:
            continue
        for i, (w, m) in enumerate(active):
            past = np.array([x for _, x in active[max(0, i - 8) : i]], dtype=float)
            mean, std = (past.mean(), past.std()) if len(past) >= 2 else (float(m), 1.0)
            before = [x for x, _ in active[:i]]
            hits = [x for x in before if (t, x) in covered]
            last8 = before[-8:]
            every = sorted(x for tt, x in covered if tt == t and x < w)
            out[t, week(w)] = (
                round((m - mean) / (std + 1), 3),
                round(sum((t, x) in covered for x in last8) / len(last8), 4) if last8 else 0.0,
                round(len(hits) / len(before), 4) if before else 0.0,
                min(w - every[-1], 200) if every else 200,
                int(not every),
                len(every),
                int((t, w + 1) in covered or (t, w + 2) in covered),
            )
    return out


def random_case(seed):
    rng = np.random.default_rng(seed)
    sig = [(f"t{t}", w, int(rng.integers(1, 30))) for t in range(8) for w in range(60) if rng.random() < 0.1 + 0.1 * t]
    nl = [(f"t{t}", w) for t in range(8) for w in range(60) if rng.random() < 0.12]
    return sig, nl


def collect(spark, sig, nl):
    s, n = frames(spark, sig, nl)
    rows = features.topic_week_features(s, n).collect()
    return {
        (r.canonical_topic, r.week): (
            r.burst_score, r.topic_nl_rate_8wk, r.topic_nl_rate_alltime, r.weeks_since_last_nl,
            r.is_novel_topic, r.past_nl_count, r.label_next2wk,
        )
        for r in rows
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_features_match_brute_force(spark, seed):
    sig, nl = random_case(seed)
    got, want = collect(spark, sig, nl), brute(sig, nl)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9), k


def test_future_rows_never_change_past_features(spark):
    sig, nl = random_case(7)
    full = collect(spark, sig, nl)
    cut = collect(spark, [r for r in sig if r[1] < 40], [r for r in nl if r[1] < 40])
    for k, v in cut.items():
        assert full[k][:-1] == v[:-1]


def test_separate_and_fused_paths_agree(spark):
    s, n = frames(spark, *random_case(5))
    fused = features.topic_week_features(s, n)
    labelled = features.burst_scores(s).join(features.forward_label(s, n), ["canonical_topic", "week"])
    apart = features.join_history(labelled, features.history_features(s, n)).select(fused.columns)
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, apart.collect()))


def test_source_bursts_drop_short_history(spark):
    rows = [("T", week(i), "research", m) for i, m in enumerate([1, 1, 9, 1])] + [("T", week(0), "other", 5)]
    df = spark.createDataFrame(rows, "canonical_topic string, week string, source_type string, mentions long")
    got = features.source_bursts(df).orderBy("week").collect()
    assert [(r.week, r.source_burst, r.is_active) for r in got] == [(week(2), 8.0, 1), (week(3), round((1 - 11 / 3) / (np.std([1, 1, 9]) + 1), 3), 0)]


def test_weekly_counts_skip_unknown_weeks(spark):
    df = spark.createDataFrame([("T", "2024-W01"), ("T", ""), ("T", None), ("T", "2024-W01")], "canonical_topic string, week string")
    assert [tuple(r) for r in weekly.weekly_mentions(df).collect()] == [("T", "2024-W01", 2)]


def test_cube_from_two_tables_or_one_column(spark):
    rows = [("a", "2024-W01", "arxiv"), ("a", "2024-W01", "arxiv"), ("a", "2024-W02", "reddit"), ("b", None, "arxiv"), ("b", "2024-W01", None)]
    signals = spark.createDataFrame(rows, "canonical_topic string, week string, source string")
    letters = spark.createDataFrame([("a", "2024-W03", "tldr"), ("a", "2024-W03", "tldr"), ("c", "", "tldr")], signals.schema)
    cube = weekly.topic_cube(signals, letters)
    got = {tuple(r) for r in weekly.weekly_mentions(weekly.cube_signals(cube)).collect()}
    assert got == {tuple(r) for r in weekly.weekly_mentions(signals).collect()} == {("a", "2024-W01", 2), ("a", "2024-W02", 1), ("b", "2024-W01", 1)}
    assert [tuple(r) for r in weekly.cube_newsletters(cube).collect()] == [("a", "2024-W03", 2, 1)]
    flagged = signals.withColumn("covered", F.when(F.col("source") == "reddit", True))
    cube = weekly.topic_cube(flagged)
    assert [tuple(r) for r in weekly.cube_newsletters(cube).collect()] == [("a", "2024-W02", 1, 1)]
    assert weekly.cube_signals(cube).agg(F.sum("mentions")).first()[0] == 5
    assert weekly.topic_cube(signals.limit(0), letters.limit(0)).count() == 0
