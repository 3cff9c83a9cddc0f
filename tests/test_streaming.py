"""Any order and number of files, any batch size: the same result as one batch."""

import datetime
import os
import random

import pytest

from weeksignal.session import scratch_path
from weeksignal.streaming import jobs

SCHEMA = "event_id long, event_type string, ts timestamp"


def rows(n=120):
    start = datetime.datetime(2024, 1, 1)
    return [(k, f"t{k % 3}", start + datetime.timedelta(days=3 * k)) for k in range(n)]


def land(spark, parts):
    path = scratch_path(spark, "landed-test")
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("order, max_files", [("newest", 1), ("mixed", 2), ("one", 50)])
def test_weekly_mentions_and_ingest(spark, order, max_files):
    data = rows()
    if order == "newest":
        data = data[::-1]
    elif order == "mixed":
        random.Random(1).shuffle(data)
    size = len(data) if order == "one" else 24
    path = land(spark, [data[at : at + size] for at in range(0, len(data), size)] + [data[:30]])
    schema = spark.createDataFrame([], SCHEMA).schema

    target = scratch_path(spark, "weekly-test")
    stream = jobs.read_landed(spark, path, schema, max_files=max_files)
    jobs.streaming_weekly_mentions(stream, target, scratch_path(spark, "state"), "event_type")
    got = {(r["canonical_topic"], r["week"]): r["mentions"] for r in jobs.current_weekly_mentions(spark, target).collect()}
    want = jobs.weekly_counts(spark.read.schema(schema).parquet(path), "event_type").collect()
    assert got == {(r["canonical_topic"], r["week"]): r["mentions"] for r in want} and sum(got.values()) == 150

    target = scratch_path(spark, "ingest-test")
    stream = jobs.read_landed(spark, path, schema, max_files=max_files)
    state = scratch_path(spark, "state")
    jobs.incremental_ingest(stream, target, state, "event_id")
    ids = [r["event_id"] for r in spark.read.parquet(target).collect()]
    assert sorted(ids) == list(range(120))

    spark.createDataFrame([(5, "t1", None), (500, "t1", None), (None, "t2", None)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    jobs.incremental_ingest(jobs.read_landed(spark, path, schema), target, state, "event_id")
    ids = [r["event_id"] for r in spark.read.parquet(target).collect()]
    assert sorted(ids, key=lambda k: -1 if k is None else k) == [None, *range(120), 500]


def counts_of(df):
    return {(r["canonical_topic"], r["week"]): r["mentions"] for r in df.collect()}


def parts_of(path):
    return sorted(int(name.split("=")[1]) for name in os.listdir(path.removeprefix("file:")) if "=" in name)


def test_folds_of_counts_survive_a_crash(spark, monkeypatch):
    """Twelve batches, a fold after each three; the first fold breaks off between base and manifest."""
    data = rows()
    path = land(spark, [data[at : at + 10] for at in range(0, 120, 10)])
    schema = spark.createDataFrame([], SCHEMA).schema
    target, state = scratch_path(spark, "weekly-test"), scratch_path(spark, "state")
    finish = jobs._finish_fold

    def run():
        stream = jobs.read_landed(spark, path, schema, max_files=1)
        jobs.streaming_weekly_mentions(stream, target, state, "event_type", fold_every=3)

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "_finish_fold", broken)
    with pytest.raises(Exception, match="lost"):
        run()
    assert parts_of(f"{target}_base") == [2] and sum(counts_of(jobs.current_weekly_mentions(spark, target)).values()) == 30
    monkeypatch.setattr(jobs, "_finish_fold", finish)
    run()
    want = counts_of(jobs.weekly_counts(spark.read.schema(schema).parquet(path), "event_type"))
    assert counts_of(jobs.current_weekly_mentions(spark, target)) == want
    assert parts_of(f"{target}_base") == [5, 8] and parts_of(target) == [6, 7, 8, 9, 10, 11]


def test_ingest_reads_touched_buckets(spark, monkeypatch):
    """Every key twice in twelve batches; one fold breaks off, and a batch looks into its own buckets only."""
    data = rows(60)
    path = land(spark, [data[at : at + 10] for at in range(0, 60, 10)] * 2)
    schema = spark.createDataFrame([], SCHEMA).schema
    target, state = scratch_path(spark, "ingest-test"), scratch_path(spark, "state")
    finish = jobs._finish_fold

    def broken(session, folder, upto):
        if upto == 5:
            raise RuntimeError("lost")
        finish(session, folder, upto)

    def run():
        jobs.incremental_ingest(jobs.read_landed(spark, path, schema, max_files=1), target, state, "event_id", fold_every=3)

    monkeypatch.setattr(jobs, "_finish_fold", broken)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(jobs, "_finish_fold", finish)
    run()
    stored = spark.read.parquet(target)
    assert sorted(r["event_id"] for r in stored.collect()) == list(range(60))
    assert parts_of(f"{target}_index") == [2, 5, 8]

    wanted = spark.createDataFrame([(7,), (8,)], "event_id long")
    keys = jobs.indexed_keys(spark, target, wanted, 8)
    found = [r["event_id"] for r in keys.collect()]
    buckets = {r[0] for r in wanted.select(jobs._bucket("event_id")).collect()}
    everything = {r["event_id"]: r["b"] for r in stored.select("event_id", jobs._bucket("event_id").alias("b")).collect()}
    assert sorted(found) == sorted(k for k, b in everything.items() if b in buckets) and {7, 8} <= set(found)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
