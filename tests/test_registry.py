"""Every registered query against its SQL on the smallest tables, and plan checks."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from tools.check_oracle import TABLES, compare
from weeksignal.sources import adapters

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, small, name):
    text, good = compare(spark, duck, small, name, QUERIES[name], SQL[name])
    assert good, text


def test_entry_runs(spark):
    assert entry.entry(spark).limit(5).count() == 5


@pytest.mark.parametrize("name", ["weekly_mentions", "topic_week_features", "source_burst", "dedup_phrases", "threshold_sweep", "week_rank_topk"])
def test_plans_stay_in_the_jvm_without_cartesian_products(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in plan


@pytest.mark.parametrize("name", [
    "topic_week_features", "dashboard_matrix", "label_multi_source", "full_feature_matrix", "source_precision_curve", "multi_source",
    "academic_social", "source_mix", "source_timeline", "label_correlations", "kpi_row", "same_week_label", "dataset_overview",
])
def test_raw_mentions_are_read_once(spark, small, name, monkeypatch):
    """One pass over the line items, which writes the cube; what the query returns reads none."""
    read, table = [], adapters.table
    monkeypatch.setattr(adapters, "table", lambda session, folder, which: read.append(which) or table(session, folder, which))
    out = QUERIES[name](spark, small)
    assert read.count("lineitem") == 1
    assert "lineitem.parquet" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("lineitem" in path for path in out.inputFiles())
