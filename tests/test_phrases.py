import hashlib
import re

import pytest
from pyspark.sql import functions as F

from weeksignal import schemas
from weeksignal.functions import scalars, text
from weeksignal.operators import phrases

CASES = [
    ("quantum error correction", 0.7, "2024-03-01", True, True),
    ("subscribe now today", 0.7, "2024-03-01", False, True),
    ("rippling payroll tool", 0.7, "2024-03-01", False, False),
    ("trampoline park robots", 0.7, "2024-03-01", False, False),
    ("robotics", 0.7, "2024-03-01", False, True),
    ("a b c d e", 0.7, "2024-03-01", True, False),
    ("gpu", 0.7, "2024-03-01", False, False),
    ("edge inference chips", 0.7, "2022-12-31", False, False),
    ("edge inference chips", 0.49, "2024-03-01", False, False),
    ("save 2k now", 0.7, "2024-03-01", False, True),
    ("fly io hosting", 0.7, "2024-03-01", True, True),
    ("no date here", 0.7, None, False, False),
]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(p, s, "reddit", d, "2024-W09") for p, s, d, _, _ in CASES]
    return spark.createDataFrame(data, schemas.PHRASES)


def test_newsletter_filter(rows):
    got = sorted(r.phrase for r in phrases.filter_newsletter_phrases(rows).collect())
    assert got == sorted(p for p, _, _, keep, _ in CASES if keep)


def test_signal_filter(rows):
    got = sorted(r.phrase for r in phrases.filter_signal_phrases(rows.unionByName(rows)).collect())
    assert got == sorted(p for p, _, _, _, keep in CASES if keep)


def test_fixed_lists():
    assert len(text.SPONSOR_BRANDS) == 62
    assert len(text.JUNK_PATTERNS) == 14


def test_dedup_keeps_best_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("a", 2, 0.9), ("a", 3, 0.9), ("b", 4, 0.1)], "k string, i int, s double")
    out = phrases.dedup(df, ["k"], [F.col("s").desc()])
    assert sorted((r.k, r.i) for r in out.collect()) == [("a", 2), ("b", 4)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("n", [1, 37, 499, 500, 900])
def test_sample_rows_is_exact(spark, n):
    df = spark.range(500).withColumnRenamed("id", "k")
    got = sorted(r.k for r in phrases.sample_rows(df, n, F.col("k")).collect())
    order = sorted(range(500), key=lambda k: hashlib.md5(f"{k}|42".encode()).hexdigest())
    assert got == sorted(order[:n])


def test_text_columns(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, "")], "x string, y string, z string")
    assert [r[0] for r in df.select(text.concat_text(["x", "y", "z"])).collect()] == ["a  c", "  "]
    words = spark.createDataFrame([("a  b",), (" x ",), ("",)], "t string")
    got = [tuple(r) for r in words.select(text.spaced_words("t"), text.whitespace_words("t")).collect()]
    assert got == [(3, 2), (3, 1), (1, 0)]


def test_source_type_and_clip(spark):
    df = spark.createDataFrame([("github", 5.0), ("blog", -1.0), (None, None)], "s string, v double")
    rows = df.select(text.source_type("s").alias("t"), scalars.clip("v", 0.0, 3.0).alias("c")).collect()
    assert [(r.t, r.c) for r in rows] == [("developer", 3.0), ("other", 0.0), ("other", None)]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (0.03125,)], "v double")
    rows = df.select(scalars.half_even("v", 2).alias("a"), scalars.half_even("v", 4).alias("b")).collect()
    assert [r.a for r in rows] == [0.12, 0.38, 0.03]
    assert rows[2].b == 0.0312


def test_trie_patterns_equal_the_plain_alternations(spark):
    parts = [p.replace("\\d", "7").strip("^$") for p in text.JUNK_REGEX.split("|")] + text.SPONSOR_BRANDS
    cases = [c for p in parts for c in (p, p.upper(), f"x{p}y", f"some {p}\n", p[:-1], p[1:])] + ["", None, "ai\n", "an ai", "flyxio"]
    df = spark.createDataFrame([(c,) for c in cases], "phrase string")
    low = F.lower("phrase")
    same = df.select(
        text.junk_match("phrase").eqNullSafe(low.rlike(text.JUNK_REGEX)).alias("junk"), text.sponsor_match("phrase").eqNullSafe(low.rlike(text.SPONSOR_REGEX)).alias("sponsor")
    )
    assert all(r.junk and r.sponsor for r in same.collect())


def test_matches_are_asked_once_a_phrase(spark, small):
    from weeksignal.catalog import text_queries

    for query in (text_queries._junk, text_queries._sponsor):
        plan = query(spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"Aggregate \[phrase#\d+\],", plan)


def test_hashing_phrases_shuffles_nothing(spark):
    from weeksignal.functions import vectors

    df = spark.createDataFrame([(1, "solar sails"), (2, "solar sails"), (3, ""), (4, None)], "id int, phrase string")
    out = vectors.embed_phrases(df, "phrase")
    assert out.columns == ["phrase", "id", "embedding"]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = {r.id: r.embedding for r in out.collect()}
    assert rows[1] == rows[2] and abs(sum(x * x for x in rows[1]) - 1) < 1e-12
    assert set(rows[3]) == {0.0} and rows[4] is None
