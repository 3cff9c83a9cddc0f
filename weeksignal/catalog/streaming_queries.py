"""Streaming jobs run to the end of the landed files and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weeksignal.catalog.common import Registry
from weeksignal.session import scratch_path
from weeksignal.sources import adapters
from weeksignal.streaming import jobs

reg = Registry()


def landed_events(spark, d, files: int = 24, max_files: int = 12):
    """Every event twice, in files of a fresh landing folder: first the newest, then in mixed order."""
    events = adapters.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path = scratch_path(spark, "landed")
    events.repartitionByRange(files, F.col("ts").desc()).write.parquet(path)
    events.repartition(files, F.xxhash64("event_id")).write.mode("append").parquet(path)
    return jobs.read_landed(spark, path, events.schema, max_files=max_files)


@reg.add("incremental_ingest", "SELECT event_id, event_type, user_id, value FROM events")
def _ingest(spark, d):
    stream = landed_events(spark, d)
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-state")
    jobs.incremental_ingest(stream, target, checkpoint, "event_id")
    return spark.read.schema(stream.schema).parquet(target).select("event_id", "event_type", "user_id", "value")


@reg.add("streaming_weekly_mentions", """SELECT event_type AS canonical_topic, strftime(ts, '%G-W%V') AS week, 2 * count(*) AS mentions FROM events GROUP BY 1, 2""")
def _weekly(spark, d):
    target, checkpoint = scratch_path(spark, "weekly"), scratch_path(spark, "weekly-state")
    jobs.streaming_weekly_mentions(landed_events(spark, d), target, checkpoint, "event_type")
    return jobs.current_weekly_mentions(spark, target)
