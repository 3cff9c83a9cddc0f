"""Counting the wordings of phrases, and the patterns they are searched for."""

import random
import re

import pytest
from pyspark.sql import functions as F

from weeksignal.catalog import text_queries
from weeksignal.functions import text


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("documents"))
    texts = ["solar sails drift past the quiet harbour"] * 30 + ["chips subscribe gpu", "subscribe gpu chips", "gpu", "", None]
    rows = [(6 * i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)] + [(1, "subscribe gpu chips chips", "en", "web", 25)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    return at


def test_equal_phrases_are_counted_before_they_are_worded(spark, folder):
    counted = text_queries.counted_variants(spark, folder)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Aggregate|Generate|Sort", plan) == ["Aggregate", "Generate", "Sort", "Aggregate", "Generate"]
    want = text_queries.variant_phrases(spark, folder).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    got = sorted(map(tuple, counted.collect()))
    assert got == sorted(map(tuple, want.collect())) and dict(got)["solar chips"] == 30


def test_queries_return_a_row_for_each_wording(spark, folder):
    for query, column, pattern in ((text_queries._junk, "junk", text.JUNK_REGEX), (text_queries._sponsor, "sponsor", text.SPONSOR_REGEX)):
        rows = query(spark, folder).collect()
        assert len({r["phrase"] for r in rows}) == len(rows) > 20
        assert all(r[column] == bool(re.search(pattern, r["phrase"])) for r in rows)


def test_searches_look_ahead_and_find_the_same():
    rng = random.Random(7)
    words = [w for p in text.JUNK_PATTERNS for w in p.split("|") if text._plain(w)] + text.SPONSOR_BRANDS + ["save 3k", "ai", "tech"]
    cases = [w[rng.randrange(2) :][: rng.randrange(2, 20)] for w in words for _ in range(6)]
    cases += [rng.choice(["", "x", "é ", "sub", "20"]) + c + rng.choice(["", "s", " end", "\n", "日"]) for c in cases + words]
    for search, plain in ((text.JUNK_SEARCH, [p for p in text._JUNK if not p.startswith("^")]), (text.SPONSOR_SEARCH, map(re.escape, text.SPONSOR_BRANDS))):
        assert search.startswith("(?=[")
        regex = "|".join(plain)
        assert [c for c in cases if bool(re.search(search, c)) != bool(re.search(regex, c))] == []
    assert re.search(text.search_pattern(["a", "bcd"]), "a") and not re.search(text.search_pattern(["ab", "cd"]), "ad")
