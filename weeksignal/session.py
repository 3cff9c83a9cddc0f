"""Session helpers: local defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weeksignal")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    Spark refuses a second file of one name, so threads that come at the same time wait for the first.
    """
    context = spark.sparkContext
    with _SHIPPING:
        if getattr(context, "_weeksignal_shipped", False):
            return
        root = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="weeksignal-package-")
        archive = os.path.join(folder, "weeksignal.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for base, _, files in os.walk(root):
                for name in files:
                    if name.endswith(".py"):
                        path = os.path.join(base, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(root)))
        context.addPyFile(archive)
        context._weeksignal_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where neither the setting nor a checkpoint folder is given, a temporary folder stands in
    on a local master, as in tests; on a cluster that is an error, since executors would each
    write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    existing = spark.sparkContext._jsc.sc().getCheckpointDir()
    if existing.isDefined():
        return existing.get()
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="weeksignal-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for an intermediate table."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name: str):
    """Write ``df`` to the shared folder and read it back.

    Iterative jobs call this once per round: the plan stays short, and a lost
    executor costs a re-read of files instead of a replay of all rounds.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, tables: list) -> None:
    """Delete tables of ``cut_lineage`` that nothing reads any more, so that rounds do not pile them up."""
    for folder in sorted({os.path.dirname(name) for table in tables for name in table.inputFiles()}):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df):
    """Give compute-heavy steps enough tasks when the input is small.

    A table of a few files may arrive in one task. Where the estimated size already
    yields two tasks per core, as for any large table, nothing is shuffled.
    """
    spark = df.sparkSession
    wanted = 2 * spark.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    return df.repartition(wanted) if int(str(size)) < wanted * split else df
