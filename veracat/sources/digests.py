"""Digests of files of any size: a file is read by ranges, in as many tasks as it has ranges."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a range. A file of at most one range has the plain sha256 of its content.
PART = 64 << 20
#: Line in front of a digest over ranges, so that it is never taken for that of the content.
TREE = "tree/1"
_STEP = 4 << 20


def _open(name: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name) if ":" in name else f"file://{name}")
    return system.open_input_file(path)


def range_digests(files: DataFrame, part: int) -> DataFrame:
    """(path, size_bytes, at, sha256) of each range of ``part`` bytes, from (path, size_bytes); a task holds a few
    megabytes of one range at a time."""
    last = F.greatest(F.ceil(F.col("size_bytes") / part) - 1, F.lit(0))
    ranges = files.select("path", "size_bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("at"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, at in zip(batch.column("path").to_pylist(), batch.column("at").to_pylist()):
                sha, left = hashlib.sha256(), part
                with _open(path) as source:
                    source.seek(at * part)
                    while left and (block := source.read(min(left, _STEP))):
                        sha.update(block)
                        left -= len(block)
                found.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "sha256"])

    return ranges.repartition("path", "at").mapInArrow(digest, "path string, size_bytes bigint, at bigint, sha256 string")


def file_digests(spark: SparkSession, paths: str | list[str], part: int = PART, whole: bool = False) -> DataFrame:
    """(path, size_bytes, sha256). A file larger than ``part`` has a digest over its ranges' digests in order, behind a
    version line with the size of a range, unless the ``whole`` content is asked for: that is one stream through one
    task. Only files of one range are held in memory, by Spark's reader."""
    listed = spark.read.format("binaryFile").load(paths)
    small = listed.where(F.col("length") <= part).select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    large = listed.where(F.col("length") > part).select("path", F.col("length").alias("size_bytes"))
    if whole:
        return small.unionByName(range_digests(large, 1 << 62).select("path", "size_bytes", "sha256"))
    # A digest a range: a file of a terabyte has a megabyte of them.
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "sha256"))), lambda x: x["sha256"]), "\n")
    tree = range_digests(large, part).groupBy("path", "size_bytes").agg(lines.alias("lines"))
    head = f"{TREE}/{part}"
    return small.unionByName(tree.select("path", "size_bytes", F.concat(F.lit(f"{head}:"), F.sha2(F.concat(F.lit(f"{head}\n"), "lines"), 256)).alias("sha256")))
