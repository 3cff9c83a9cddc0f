"""Incremental jobs: deduplicated ingest and running weekly mentions.

Both keep no state in the stream and know no watermark: what a batch adds is written to a
folder of its own, which a repeated batch overwrites. So no row is lost, whatever the order
and the number of files, and rows of any age count.

Every ``fold_every`` batches the batches before are folded: keys into an index by hash buckets,
counts into one base. A fold counts from the moment its row stands in the manifest, a table
beside the target; before that nobody reads it, and the batch that was folding repeats it. Readers
see what the manifest names plus the batches behind it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weeksignal.functions.weeks import week_of_date

FOLD_EVERY = 50
BUCKETS = 256  # of the key index
_COUNTS = T.StructType([
    T.StructField("canonical_topic", T.StringType()), T.StructField("week", T.StringType()), T.StructField("mentions", T.LongType()),
])


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int = 1000) -> DataFrame:
    """Files as they land in a folder, a bounded number per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(path)


def _drain(stream: DataFrame, checkpoint: str, save: Callable[[DataFrame, int], None]) -> None:
    """Run all batches that the input holds."""
    query = (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _parts(spark: SparkSession, folder: str, schema: T.StructType, number: str, after: int, upto: int) -> DataFrame:
    """The parts of a folder, as ``batch=3``, with numbers behind ``after`` up to ``upto``; no folder, no rows."""
    whole = T.StructType([*schema.fields, T.StructField(number, T.LongType())])
    try:
        found = spark.read.schema(whole).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)
    return found.where((F.col(number) > after) & (F.col(number) <= upto))


def _last_fold(spark: SparkSession, target: str) -> int:
    """The last batch that a finished fold holds, -1 before the first."""
    schema = T.StructType([T.StructField("upto", T.LongType())])
    try:
        last = spark.read.schema(schema).parquet(f"{target}_manifest").agg(F.max("upto")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    return -1 if last is None else last


def _finish_fold(spark: SparkSession, target: str, upto: int) -> None:
    """Make a fold count: one small file, which appears as a whole when its write commits."""
    spark.createDataFrame([(upto,)], "upto long").coalesce(1).write.mode("append").parquet(f"{target}_manifest")


def _remove_parts(spark: SparkSession, folder: str, number: str, upto: int) -> None:
    """Delete the parts of a folder with numbers up to ``upto``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path) if files.exists(path) else []:
        name, _, value = status.getPath().getName().partition("=")
        if name == number and int(value) <= upto:
            files.delete(status.getPath(), True)


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def indexed_keys(spark: SparkSession, target: str, keys: DataFrame, upto: int) -> DataFrame:
    """The keys of finished folds in the buckets that ``keys``, a table with one column, touches."""
    field = keys.schema.fields[0]
    touched = [r[0] for r in keys.select(_bucket(field.name)).distinct().collect()]  # BUCKETS numbers at most
    schema = T.StructType([field, T.StructField("bucket", T.IntegerType())])
    return _parts(spark, f"{target}_index", schema, "upto", -1, upto).where(F.col("bucket").isin(touched)).select(field.name)


def incremental_ingest(stream: DataFrame, target: str, checkpoint: str, key: str, fold_every: int = FOLD_EVERY) -> None:
    """Append records whose key was not seen before, in any earlier batch, and stop when the input is drained.

    A record is never dropped for its age. Keys of folded batches are looked up in those buckets of
    the index only which the batch touches, keys of the few batches behind the last fold in their
    key column; what is compared with the batch is no larger than the batch. A fold is
    written once and never again. A null key is no key: such records are all kept.
    """

    def fold(spark: SparkSession, stored: DataFrame, upto: int) -> None:
        keys = stored.select(key).where(F.col(key).isNotNull()).withColumn("bucket", _bucket(key))
        keys.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}_index/upto={upto}")
        _finish_fold(spark, target, upto)

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = _last_fold(spark, target)
        recent = _parts(spark, target, batch.schema, "batch", last, batch_id - 1)
        if batch_id - 1 - last >= fold_every:
            fold(spark, recent, batch_id - 1)
            last, recent = batch_id - 1, recent.limit(0)
        named = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        stored = recent.select(key)
        if last >= 0:
            stored = stored.union(indexed_keys(spark, target, named.select(key), last))
        seen = stored.join(named.select(key), key, "left_semi").distinct()
        fresh = named.join(seen, key, "left_anti").select(*batch.columns)
        fresh = fresh.unionByName(batch.where(F.col(key).isNull()))
        fresh.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _drain(stream, checkpoint, save)


def weekly_counts(events: DataFrame, topic: str, event_time: str = "ts") -> DataFrame:
    """Mentions per topic and ISO week."""
    week = week_of_date(F.col(event_time).cast("date"))
    return events.groupBy(F.col(topic).alias("canonical_topic"), week.alias("week")).agg(F.count(F.lit(1)).alias("mentions"))


def streaming_weekly_mentions(
    stream: DataFrame, target: str, checkpoint: str, topic: str, event_time: str = "ts", fold_every: int = FOLD_EVERY
) -> None:
    """Write each batch's own counts; counts are additive, so no batch needs another one.

    Folds merge the counts of a base and of the batches behind it into a new base. What a fold
    replaces stays until the next one, for readers that began before; then it is deleted, so there are
    never more than about two times ``fold_every`` folders.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = _last_fold(spark, target)
        if batch_id - 1 - last >= fold_every:
            merged = _mentions(spark, target, last, batch_id - 1)
            merged.write.mode("overwrite").parquet(f"{target}_base/upto={batch_id - 1}")
            _finish_fold(spark, target, batch_id - 1)
            _remove_parts(spark, target, "batch", last)
            _remove_parts(spark, f"{target}_base", "upto", last - 1)
        weekly_counts(batch, topic, event_time).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _drain(stream, checkpoint, save)


def _mentions(spark: SparkSession, target: str, last: int, upto: int) -> DataFrame:
    """Counts of the base of fold ``last`` and of the batches behind it."""
    base = _parts(spark, f"{target}_base", _COUNTS, "upto", last - 1, last).drop("upto")
    behind = _parts(spark, target, _COUNTS, "batch", last, upto).drop("batch")
    return base.unionByName(behind).groupBy("canonical_topic", "week").agg(F.sum("mentions").cast("long").alias("mentions"))


def current_weekly_mentions(spark: SparkSession, target: str) -> DataFrame:
    """The mentions of every topic and week over all batches so far."""
    return _mentions(spark, target, _last_fold(spark, target), 2**62)
