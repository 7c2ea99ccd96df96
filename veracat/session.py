"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Runtime re-planning splits a hot join partition, so one key holding a third of the rows does not
# become one task; coalescing keeps small inputs from paying for large shuffle settings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


# A shuffle starts from so many partitions, put together to the size named, that a task's rows, and with them its memory,
# do not follow the input until far beyond the few hundred partitions of Spark's default. A task that reads files reads
# less than Spark's 128 MB too: its rows are many times as large in its hash map or in what it writes to a shuffle.
SIZES = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


# Files of a few lines: opening one costs what reading so many bytes does, not 4 MB, so a task reads hundreds of them; and
# their folders are listed by so many tasks at most, not by one each.
MANY_FILES = {
    "spark.sql.files.openCostInBytes": "64k",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "400",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """These settings for the jobs that run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def configure(spark: SparkSession, sizes: dict[str, str] = SIZES) -> SparkSession:
    for key, value in {**SETTINGS, **sizes}.items():
        spark.conf.set(key, value)
    # Workers look for this package where the driver found it, whatever folder the session was started in.
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, known)])
    return spark


@cache
def _local_scratch(application: str) -> str:
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; a local master without one may use /tmp."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _local_scratch(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: the lineage ends, and a lost executor
    costs a re-read instead of a re-computation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.scratch_path = path
    return written


def materialise_in_buckets(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """As ``materialise``, with the rows of a value of ``by`` in one of so many buckets: a join on that column alone
    brings the other side to where these rows lie, and moves none of them. A task should hold few values."""
    spark, path, table = df.sparkSession, scratch_dir(df.sparkSession, name), f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, by).option("path", path).format("parquet").saveAsTable(table)
    written = spark.table(table)
    written.schema  # resolved while it has a name; an external table leaves its files when it loses it
    spark.sql(f"DROP TABLE {table}")
    written.scratch_path = path
    return written


def release(spark: SparkSession) -> None:
    """Free the shuffle files of jobs that have ended. Spark deletes them once the driver has collected the frames they
    belong to, which by itself it does when its memory fills, however full the disks are."""
    spark._jvm.System.gc()


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these frames, after the last job that reads them."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
