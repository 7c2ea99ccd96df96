"""Choose what a catalog is built of: one snapshot a dataset, deliveries of study layers, artefacts of engines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracat import schema as S
from veracat.functions.cells import file_name
from veracat.functions.rules import database_role
from veracat.operators.filters import available_only
from veracat.operators.quality import GateRefused, acceptance_checks, engine_coverage
from veracat.operators.snapshots import latest_snapshot
from veracat.sources.files import discover_snapshots

Part = tuple[str, str, str, Mapping[str, int]]


def _refuse(refused: DataFrame, key: str) -> None:
    rows = refused.orderBy(key).collect()  # a row for each dataset, layer or database at most
    if rows:
        raise GateRefused("; ".join(f"{r[key]}: {r['reason']}" for r in rows))


@dataclass
class Choice:
    """``chosen``: (dataset_id, bundle_id, manifest). ``refused``: (dataset_id, reason)."""
    chosen: DataFrame
    refused: DataFrame

    def manifests(self) -> list[str]:
        """The manifests to build of; anything refused refuses all."""
        _refuse(self.refused, "dataset_id")
        return [r["manifest"] for r in self.chosen.orderBy("dataset_id").collect()]


def choose_snapshots(spark: SparkSession, store: str, datasets: Sequence[str] | None = None, pins: Mapping[str, str] | None = None,
                     latest: bool = False, release: str | None = None, held: Mapping[str, str] | None = None) -> Choice:
    """One snapshot for each dataset: the one that a pin names by a unique beginning, the only one, or the newest where
    ``latest`` allows it. A release needs a pin for each. ``held`` datasets are refused with the producer's reason, as
    are those without a snapshot; no ``datasets`` means all that the store holds and the producer does not hold."""
    if release and latest:
        raise ValueError(f"the release {release} names exact snapshots; it cannot take the newest")
    held = dict(held or {})
    found = discover_snapshots(spark, f"{store}/*/*/bundle.json").select("dataset_id", "bundle_id", "age_order", F.concat("path", F.lit("/bundle.json")).alias("manifest"))
    kept = spark.createDataFrame(list(held.items()), "dataset_id string, reason string")
    asked = found.select("dataset_id").distinct().join(kept, "dataset_id", "left_anti") if datasets is None else spark.createDataFrame([(d,) for d in datasets], "dataset_id string").distinct()
    wanted, missing = available_only(asked, found, "dataset_id")
    free = wanted.join(kept, "dataset_id", "left_anti")
    candidates = found.join(free, "dataset_id", "left_semi")
    names = None if datasets is None else set(datasets)
    chosen, refused = latest_snapshot(candidates, "dataset_id", "bundle_id", "age_order", {k: v for k, v in (pins or {}).items() if (names is None or k in names) and k not in held}, latest, bool(release))
    gone = missing.join(kept, "dataset_id", "left_anti").select("dataset_id", F.lit("no snapshot").alias("reason"))
    refused = refused.unionByName(gone).unionByName(kept.join(asked, "dataset_id", "left_semi")).distinct()
    return Choice(chosen.join(found, ["dataset_id", "bundle_id"]).select("dataset_id", "bundle_id", "manifest"), refused)


_STUDY = "bundle_id string, layer string, layer_version string, written_utc string, tables map<string,bigint>"


def choose_studies(spark: SparkSession, store: str, pins: Mapping[str, str] | None = None, latest: Sequence[str] = (), release: str | None = None) -> list[Part]:
    """At most one delivery of each layer, and none unless asked: by a pin, or the newest. Layers that this code does
    not carry, and deliveries of another version of a layer, are refused."""
    pins = dict(pins or {})
    if both := sorted(set(pins) & set(latest)):
        raise ValueError(f"study layer {', '.join(both)} is both pinned and asked for by age")
    if release and latest:
        raise ValueError(f"the release {release} names exact deliveries; it cannot take the newest")
    layers = sorted({*pins, *latest})
    if unknown := [x for x in layers if x not in S.STUDY_VERSIONS]:
        raise ValueError(f"study layer {', '.join(unknown)} is not carried; layers are {', '.join(S.STUDY_VERSIONS)}")
    if not layers:
        return []
    docs = spark.read.option("multiLine", True).schema(_STUDY).json(f"{store}/study/*/*/bundle.json")
    found = docs.select("*", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("path")).withColumn("age_order", F.struct("written_utc", "bundle_id"))
    asked = found.filter(F.col("layer").isin(layers))
    chosen, refused = latest_snapshot(asked, "layer", "bundle_id", "age_order", pins, bool(latest))
    have = spark.createDataFrame([(x,) for x in layers], "layer string").join(found, "layer", "left_anti").select("layer", F.lit("no delivery").alias("reason"))
    _refuse(refused.unionByName(have).distinct(), "layer")
    rows = chosen.join(found, ["layer", "bundle_id"]).collect()
    if stale := [r for r in rows if r["layer_version"] != S.STUDY_VERSIONS[r["layer"]]]:
        raise GateRefused("; ".join(f"{r['layer']} {r['bundle_id']} was written as version {r['layer_version']}, and this code carries {S.STUDY_VERSIONS[r['layer']]}" for r in stale))
    return sorted((r["layer"], r["bundle_id"], r["path"], r["tables"] or {}) for r in rows)


_ARTEFACT = "bundle_id string, engine string, schema_version string, search_database string, tables map<string,bigint>"


def choose_artefacts(spark: SparkSession, store: str, manifests: Sequence[str]) -> tuple[list[Part], DataFrame]:
    """(artefacts, coverage checks): what engines have made of the target databases that the snapshots searched.

    Two of one engine for one database refuse the build, as does one whose rows are not what its record says: of
    another database, of an outcome that nobody knows, with columns that have no place, or without rows. A database
    without an artefact, and artefacts of another schema version, are named by the check, which always passes.
    """
    docs = spark.read.option("multiLine", True).schema("dataset_id string, databases array<struct<path:string,sha256:string,entries:bigint>>").json(list(manifests))
    searched = docs.select("dataset_id", F.explode("databases").alias("d")).select("dataset_id", F.col("d.sha256").alias("sha256"), database_role("d.path").alias("role"), file_name("d.path").alias("database"))
    targets = searched.filter("role = 'target'")
    parts: list[Part] = []
    checks = []
    for engine in sorted(set(S.ENGINE_TABLES.values())):
        try:
            found = spark.read.option("multiLine", True).schema(_ARTEFACT).json(f"{store}/engine/{engine}/*/bundle.json")
            known = found.select(F.col("bundle_id").alias("artefact_id"), "search_database", "schema_version", "tables", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("path"))
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = spark.createDataFrame([], "artefact_id string, search_database string, schema_version string, tables map<string,bigint>, path string")
        coverage = engine_coverage(targets, known, S.SCHEMA_VERSION)
        several = coverage.filter("status = 'ambiguous'").select("sha256", F.format_string(f"{engine} has %d artefacts for this database; a catalog serves one", "n_artefacts").alias("reason"))
        _refuse(several, "sha256")
        rows = coverage.filter("status = 'covered'").join(known, "artefact_id").select("artefact_id", "path", "tables", "search_database").collect()  # one a database
        for r in rows:
            for table in (t for t, of in S.ENGINE_TABLES.items() if of == engine and (r["tables"] or {}).get(t)):
                kind = S.struct_type(table)
                told = acceptance_checks(spark.read.parquet(f"{r['path']}/{table}.parquet"), {"search_database_sha256": r["search_database"]}, "outcome", S.RESOLUTION_OUTCOMES, kind.fieldNames())
                _refuse(told.filter("n > 0").select(F.lit(f"{engine} {r['artefact_id']} {table}").alias("name"), F.concat("rule", F.lit(": "), F.col("n").cast("string")).alias("reason")), "name")
        parts += [(engine, r["artefact_id"], r["path"], r["tables"] or {}) for r in rows]
        lacking = F.concat(F.lit("no artefact for "), F.array_join(F.array_sort(F.collect_list(F.when(F.col("status") == "uncovered", F.substr("sha256", F.lit(1), F.lit(12))))), ", "))
        stale = F.concat(F.lit("skipped, other schema: "), F.sum("n_stale").cast("string"))
        checks.append(coverage.agg(
            F.lit(f"{engine} coverage").alias("name"), F.lit("engine-coverage").alias("kind"), F.lit(True).alias("ok"), F.count_if(F.col("status") == "covered").alias("observed"), F.count("*").alias("expected"),
            F.nullif(F.concat_ws("; ", F.when(F.count_if(F.col("status") == "uncovered") > 0, lacking), F.when(F.sum("n_stale") > 0, stale)), F.lit("")).alias("detail")))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return sorted(parts), out
