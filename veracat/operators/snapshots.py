"""Snapshot identity, choice and writing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veracat.operators.identification import first_wins
from veracat.operators.quality import enforce
from veracat.schema import SCHEMA_VERSION

def declaration_digest(declarations: DataFrame, key: Sequence[str], content: Sequence[str]) -> DataFrame:
    """(key, sha256) of the content fields, in name order whatever order they are given in."""
    body = F.to_json(F.struct(*[F.col(c).alias(c) for c in sorted(content)]), {"ignoreNullFields": "false"})
    return declarations.select(*key, F.sha2(body, 256).alias("sha256"))


def snapshot_id(sources: DataFrame, key: Sequence[str], header: Sequence[Column | str], role: str = "role", sha: str = "sha256", order: Sequence[str] = ("role", "path"),
                prefix: str = "") -> DataFrame:
    """(key, snapshot_id): the first 16 hex digits of sha256 over the header lines and the sorted
    ``role TAB digest`` lines. Sorting happens inside the hash input, so neither partitioning nor row
    order can move an id. A snapshot has as many sources as it read files."""
    line = F.concat(F.lit(prefix), F.col(role), F.lit("\t"), F.col(sha), F.lit("\n"))
    heads = [F.concat(h if isinstance(h, Column) else F.lit(h), F.lit("\n")) for h in header]
    grouped = sources.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("_line")))).alias("_lines"))
    body = F.concat(*heads, F.array_join(F.transform("_lines", lambda x: x["_line"]), ""))
    return grouped.select(*key, F.substr(F.sha2(body, 256), F.lit(1), F.lit(16)).alias("snapshot_id"))


def latest_snapshot(candidates: DataFrame, key: str, snapshot: str, order: str | Column, pins: Mapping[str, str] | None = None,
                    latest: bool = False, release: bool = False) -> tuple[DataFrame, DataFrame]:
    """(chosen snapshots, refusals). One snapshot per key: the one a pin names by a unique prefix, the
    only one there is, or the newest when ``latest`` allows it. Anything else is refused with a
    reason. A release needs every key pinned.
    """
    spark = candidates.sparkSession
    if release and latest:
        raise ValueError("a release names exact snapshots; it cannot take the newest")
    pin_rows = spark.createDataFrame(list((pins or {}).items()), f"{key} string, _pin string")
    o = F.col(order) if isinstance(order, str) else order
    matched = candidates.join(pin_rows, key, "left").withColumn("_match", F.startswith(snapshot, "_pin"))
    per_key = matched.groupBy(key).agg(
        F.count("*").alias("n"), F.max("_pin").alias("_pin"), F.count_if("_match").alias("_matches"),
        F.min(F.when(F.col("_match"), F.col(snapshot))).alias("_pinned"), F.max_by(snapshot, o).alias("_newest"),
    )
    pinned = F.col("_pin").isNotNull()
    chosen = F.when(pinned, F.when(F.col("_matches") == 1, F.col("_pinned"))).when(F.lit(release), F.lit(None)) \
        .when((F.col("n") == 1) | F.lit(latest), F.col("_newest"))
    reason = F.when(pinned, F.format_string("the pin matches %d of %d snapshots", "_matches", "n")) \
        .when(F.lit(release), F.lit("a release needs a pin")).otherwise(F.format_string("%d snapshots and no pin", "n"))
    decided = per_key.withColumn(snapshot, chosen)
    refused = decided.filter(F.col(snapshot).isNull()).select(key, reason.alias("reason"))
    missing = pin_rows.join(candidates.select(key).distinct(), key, "left_anti").select(key, F.lit("no snapshot").alias("reason"))
    return decided.filter(F.col(snapshot).isNotNull()).select(key, snapshot), refused.unionByName(missing)


def newest_row(rows: DataFrame, key: Sequence[str], order: str | Column) -> DataFrame:
    """The newest row of each key, by aggregate."""
    return first_wins(rows, key, order, last=True)


def union_snapshots(parts: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """The union by name of several parts, each behind its own provenance columns. Those are
    re-stated from the manifest: what a row says about its own origin is dropped. A column that a
    part lacks is NULL there."""
    out = None
    for df, provenance in parts:
        own = [c for c in df.columns if c not in provenance]
        part = df.select(*[F.lit(v).alias(k) for k, v in provenance.items()], *own)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_snapshots(spark: SparkSession, table: str, snapshots: Sequence[tuple[str, str, str]], schema) -> DataFrame | None:
    """One table of many snapshots in one scan: (dataset_id, bundle_id, path) per snapshot.

    A union with one branch per dataset makes a plan as long as the catalog; one multi-path read is
    one scan, and the provenance columns come from the file's folder.
    """
    paths = [f"{path}/{table}.parquet" for _, _, path in snapshots]
    if not paths:
        return None
    rows = spark.read.schema(schema).parquet(*paths)
    origin = spark.createDataFrame([(d, b) for d, b, _ in snapshots], "dataset_id string, bundle_id string")
    own = [c for c in rows.columns if c != "dataset_id"]
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
    return rows.select(folder.alias("bundle_id"), *own).join(origin, "bundle_id").select("dataset_id", "bundle_id", *own)


def write_snapshot(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, snapshot: str, manifest: Mapping[str, str],
                   checks: DataFrame | None = None, sort_keys: Mapping[str, Sequence[str]] = {}, lists: Mapping[str, DataFrame] = {}) -> bool:
    """Write the non-empty tables and, last, the manifest. False when the snapshot is already there.

    Counts are observed while writing, so no table is read twice. Nothing is written when a check
    fails; a folder without a manifest is an unfinished write and not a snapshot. ``lists`` are short tables,
    such as sources and databases, that become lists of records in the manifest.
    """
    target = f"{folder}/{snapshot}"
    if path_exists(spark, f"{target}/bundle.json"):
        return False
    if checks is not None:
        enforce(checks)
    counts: dict[str, int] = {}
    for name, df in tables.items():
        seen = Observation(f"rows {name}")
        observed = df.observe(seen, F.count(F.lit(1)).alias("n"))
        if name in sort_keys:
            observed = observed.sortWithinPartitions(*sort_keys[name])
        observed.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/{name}.parquet")
        if seen.get["n"]:
            counts[name] = seen.get["n"]
        else:
            delete_path(spark, f"{target}/{name}.parquet")
    body = {"bundle_id": snapshot, "schema_version": SCHEMA_VERSION, **manifest}
    doc = spark.createDataFrame([(counts, *body.values())], "tables map<string,bigint>, " + ", ".join(f"{k} string" for k in body))
    for name, df in lists.items():
        doc = doc.join(df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name)))  # one row beside one row
    write_json_file(doc, f"{target}/bundle.json")
    return True


def write_json_file(doc: DataFrame, path: str) -> None:
    """One document as one file, moved into place after it is complete."""
    spark = doc.sparkSession
    staging = path + ".staging"
    doc.coalesce(1).write.mode("overwrite").json(staging)
    fs, jpath = _fs(spark, path)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    part = fs.globStatus(Path(staging + "/part-*"))[0].getPath()
    if not fs.rename(part, jpath):
        raise OSError(f"{path} could not be moved into place")
    fs.delete(Path(staging), True)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def path_bytes(spark: SparkSession, path: str) -> int:
    fs, jpath = _fs(spark, path)
    return fs.getContentSummary(jpath).getLength()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def self_description(meta: Mapping[str, str], spark: SparkSession, checks: DataFrame, tables: DataFrame, bundles: DataFrame) -> dict[str, DataFrame]:
    """The catalog's account of itself, as tables written beside the others."""
    row = spark.createDataFrame([tuple(meta.values())], ", ".join(f"{k} string" for k in meta))
    return {"catalog_meta": row, "catalog_bundles": bundles, "catalog_tables": tables, "catalog_checks": checks}

