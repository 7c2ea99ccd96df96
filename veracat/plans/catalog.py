"""Build one catalog from snapshots: union, views, derived tables, checks, gate, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracat import schema as S
from veracat.functions.rules import database_role
from veracat.operators import derive, filters
from veracat.operators.quality import (
    Rule, checked, enforce, nullsafe_rule, reference_rule, row_count_check, typed_rule, union_all, unique_rule, version_gate,
)
from veracat.operators.samples import sample_names
from veracat.operators.search import table_list
from veracat.operators.search_index import SearchIndex, write_search_index
from veracat.operators.snapshots import path_exists, read_snapshots, snapshot_id, write_json_file
from veracat.functions.cells import file_name
from veracat.sources.files import discover_snapshots

# The sheet headers that name what a term column of the samples holds, best first.
SAMPLE_NAMES = {
    "sex_name": ["characteristics[sex]", "factor value[sex]"],
    "organism_part_name": ["characteristics[organism part]", "factor value[organism part]"],
    "cell_type_name": ["characteristics[cell type]", "factor value[cell type]"],
    "disease_name": ["characteristics[disease]", "factor value[disease]"],
}

CATALOG_FORMAT = "1"
DERIVED = ["dataset_overview", "protein_datasets", "protein_index", "peptide_index", "search_modifications_placed", "dataset_databases", "protein_genes"]
VIEWS = ["psms_1pct", "peptidoforms_1pct", "protein_groups_1pct", "ptm_sites_by_chemistry"]

OVERVIEW_COLUMNS = [
    "dataset_id", "bundle_id", "title", "organisms", "acquisition", "quant_method", "labelling", "enrichment", "enrichment_mixed",
    "instrument_vendor", "search_engine", "search_engine_version",
]


# What keyword searches look into, by table: columns whose texts are stored by their grams.
INDEXED = {
    "dataset_overview": ["dataset_id", "title", "organisms"], "protein_index": ["protein_accession", "gene"], "peptide_index": ["base_sequence"],
    "search_modifications_declared": ["name", "modification"], "samples": ["organism_part", "cell_type", "disease", "condition", "cell_line", "source_name", "organism"],
    "runs": ["run_id", "file_name", "instrument_model"], "definitions": ["definition_id", "text"],
}


@dataclass
class Catalog:
    """The tables of one catalog as DataFrames, by name."""

    tables: dict[str, DataFrame]
    path: str | None = None
    checks: DataFrame | None = None
    kinds: dict[str, str] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def rows(self, name: str, query: str) -> DataFrame:
        """The rows of a table that may contain a text, from the stored index where the table is in it."""
        if name in INDEXED and self.path:
            return SearchIndex(self.tables[name].sparkSession, f"{self.path}/search").candidates(name, query)
        return self.tables[name]

    def register(self) -> None:
        """Make every table a temporary view, so SQL can name it."""
        for name, df in self.tables.items():
            df.createOrReplaceTempView(name)


def acceptance_views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "psms_1pct": filters.accepted_matches(tables["psms"]),
        "peptidoforms_1pct": filters.accepted_forms(tables["peptidoforms"]),
        "protein_groups_1pct": filters.accepted_groups(tables["protein_groups"]),
        "ptm_sites_by_chemistry": derive.chemistry_view(tables["ptm_sites"]),
    }


def derived_tables(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Everything below counts through the accepted views, so no two numbers can disagree."""
    measured = t["quant_values"].select("assay_id").join(
        # An assay belongs to one run and a run to one dataset.
        t["assays"].select("assay_id", "run_id").distinct(), "assay_id"
    ).join(t["runs"].select("run_id", F.col("dataset_id")).distinct(), "run_id")
    overview = derive.per_dataset_counts(t["datasets"].select(*OVERVIEW_COLUMNS), {
        "n_runs": t["runs"], "n_samples": t["samples"], "n_psms_1pct": t["psms_1pct"], "n_peptidoforms_1pct": t["peptidoforms_1pct"],
        "n_protein_groups_1pct": t["protein_groups_1pct"], "n_psms_all": t["psms"], "n_ptm_sites": t["ptm_sites"],
        "n_quant_values": measured, "n_open_findings": t["findings"].filter("severity IN ('warning', 'error')"),
    })
    presence = derive.entity_datasets(t["proteins"], t["protein_groups_1pct"], t["peptidoforms_1pct"])
    return {
        "dataset_overview": overview,
        "protein_datasets": presence,
        "protein_index": derive.entity_index(t["proteins"], presence),
        "peptide_index": derive.sequence_index(t["peptidoforms_1pct"]),
        "search_modifications_placed": derive.placed_tags(t["peptidoforms_1pct"]),
        "protein_genes": derive.entity_resolutions(t["proteins"], t["dataset_databases"], t["gene_resolutions"]),
    }


def dataset_databases(manifests: DataFrame) -> DataFrame:
    """(dataset_id, bundle_id, database, role, sha256, entries) from manifests' database records."""
    return manifests.select("dataset_id", "bundle_id", F.explode("databases").alias("d")).select(
        "dataset_id", "bundle_id", file_name("d.path").alias("database"), database_role("d.path").alias("role"),
        F.col("d.sha256").alias("sha256"), F.col("d.entries").alias("entries"),
    )


def _typed(have: Mapping[str, DataFrame], scope: Sequence[str] = ("dataset_id",)) -> list[Rule]:
    if "quant_values" not in have:
        return []
    return [typed_rule("quant_values", "feature_type", "feature_id", {k: (n, c) for k, (n, c) in S.FEATURE_TARGETS.items() if n in have}, scope)]


def integrity_rules(t: Mapping[str, DataFrame], studies: bool = False) -> list[Rule]:
    """Keys, references, the typed reference, study rules and engine keys."""
    out = [unique_rule(table, cols) for table, cols in S.IDENTIFIERS.items()]
    out += [reference_rule(c, col, p, pc) for c, col, p, pc in S.REFERENCES]
    out += _typed(t)
    if studies:
        out += [unique_rule(table, cols, [], "study-unique") for table, cols in S.STUDY_KEYS.items()]
        out += [reference_rule(c, col, p, pc, [], "study-reference") for c, col, p, pc in S.STUDY_REFERENCES]
    return out + [nullsafe_rule(table, cols, "accession") for table, cols in S.ENGINE_KEYS.items()]


def integrity_checks(t: Mapping[str, DataFrame], studies: Sequence[str] = ()) -> DataFrame:
    """All rules of a build, in one read of every table."""
    return checked(t, integrity_rules(t, bool(studies)))


def bundle_checks(t: Mapping[str, DataFrame]) -> DataFrame:
    """What a snapshot is checked for before it is written: keys with their composites, and references."""
    out = [unique_rule(n, cols, []) for n, cols in {**S.IDENTIFIERS, **S.COMPOSITE_KEYS}.items() if n in t]
    out += [reference_rule(c, col, p, pc, []) for c, col, p, pc in S.REFERENCES if c in t and p in t]
    return checked(t, out + _typed(t, []))


def load_tables(spark: SparkSession, snapshots: Sequence[tuple[str, str, str, Mapping[str, int]]],
                studies: Sequence[tuple[str, str, str, Mapping[str, int]]] = (),
                artefacts: Sequence[tuple[str, str, str, Mapping[str, int]]] = ()) -> dict[str, DataFrame]:
    """Every schema table, as the union of what holds it; a table nobody fills is empty and present.

    A snapshot is (dataset_id or layer or engine, id, path, row counts).
    """
    tables: dict[str, DataFrame] = {}
    for name in S.CORE_COLUMNS:
        source = artefacts if name in S.ENGINE_TABLES else snapshots
        parts = [(d, b, p) for d, b, p, counts in source if counts.get(name)]
        lead = S.ENGINE_PROVENANCE if name in S.ENGINE_TABLES else S.TABLE_PROVENANCE
        df = read_snapshots(spark, name, parts, S.struct_type(name))
        tables[name] = df.withColumnsRenamed(dict(zip(S.TABLE_PROVENANCE, lead))) if df is not None \
            else S.empty_like(spark, S.catalog_type(name))
    for name in S.STUDY_COLUMNS:
        parts = [(d, b, p) for d, b, p, counts in studies if counts.get(name)]
        if not parts:
            tables[name] = S.empty_like(spark, S.catalog_type(name))
            continue
        own = [f.name for f in S.struct_type(name)]
        tables[name] = union_all([
            spark.read.schema(S.struct_type(name)).parquet(f"{path}/{name}.parquet").select(F.lit(layer).alias("study_layer"), F.lit(bundle).alias("study_bundle_id"), *own)
            for layer, bundle, path in parts
        ])
    return tables


def count_checks(t: Mapping[str, DataFrame], spark: SparkSession, snapshots: Sequence[tuple[str, str, str, Mapping[str, int]]]) -> DataFrame:
    expected = spark.createDataFrame(
        [(b, n, c) for _, b, _, counts in snapshots for n, c in counts.items()], "bundle_id string, table string, expected bigint"
    )
    named = {n for _, _, _, counts in snapshots for n in counts if n in S.CORE_COLUMNS and n not in S.ENGINE_TABLES}
    rows = union_all([t[n].select("bundle_id", F.lit(n).alias("table")) for n in sorted(named)])
    return row_count_check(rows, expected, ["bundle_id", "table"], list(S.CORE_COLUMNS), "table")


_MANIFEST = "tables map<string,bigint>, databases array<struct<path:string,sha256:string,entries:bigint>>"


def build_catalog(spark: SparkSession, manifests: Sequence[str], out: str, meta: Mapping[str, str] = {},
                  studies: Sequence[tuple[str, str, str, Mapping[str, int]]] = (),
                  artefacts: Sequence[tuple[str, str, str, Mapping[str, int]]] = (), coverage: DataFrame | None = None) -> str:
    """Build and publish a catalog; returns its folder. The same snapshots give the same folder, and a
    folder that is there already is not built again. Any failed check refuses the build.

    ``manifests`` are the chosen snapshots' manifest files, one per dataset; ``coverage`` are checks of the choice that
    are published beside those of the build. See ``choose``.
    """
    for what, given in (("study layer", studies), ("artefact engine", artefacts)):
        if len({name for name, *_ in given}) < len(given):
            raise ValueError(f"a {what} is given twice")
    found = discover_snapshots(spark, list(manifests))
    enforce(version_gate(found, "dataset_id", {"schema_version": S.SCHEMA_VERSION}).select(
        F.col("dataset_id").alias("name"), F.lit("version").alias("kind"), F.lit(False).alias("ok"),
        F.lit(None).cast("bigint").alias("observed"), F.lit(None).cast("bigint").alias("expected"), F.col("problem").alias("detail")))
    # Manifests are one small document per dataset, and the plan needs their paths.
    rows = found.select("dataset_id", "bundle_id", "path", "tables", "written_utc", "schema_version").collect()
    snapshots = [(r["dataset_id"], r["bundle_id"], r["path"], r["tables"] or {}) for r in rows]
    ids = [(d, b) for d, b, *_ in snapshots] + [(f"study:{d}", b) for d, b, *_ in studies] + [(f"artefact:{d}", b) for d, b, *_ in artefacts]
    identity = snapshot_id(
        spark.createDataFrame(ids, "role string, sha256 string").withColumn("one", F.lit(1)), ["one"],
        [f"catalog/{CATALOG_FORMAT}", f"schema/{S.SCHEMA_VERSION}", *[f"study/{k}/{v}" for k, v in S.STUDY_VERSIONS.items()]], order=["role"],
    ).first()["snapshot_id"]
    folder = f"{out}/{identity}"
    if path_exists(spark, f"{folder}/catalog.json"):
        return folder

    tables = load_tables(spark, snapshots, studies, artefacts)
    tables["samples"] = sample_names(tables["samples"], tables["sample_characteristics"], SAMPLE_NAMES)
    docs = spark.read.option("multiLine", True).schema(f"dataset_id string, bundle_id string, {_MANIFEST}").json(list(manifests))
    tables["dataset_databases"] = dataset_databases(docs)
    checks = count_checks(tables, spark, snapshots).unionByName(integrity_checks(tables, [s[0] for s in studies]))
    if coverage is not None:
        checks = checks.unionByName(coverage)
    checks.write.mode("overwrite").parquet(f"{folder}/catalog_checks")
    enforce(spark.read.parquet(f"{folder}/catalog_checks"))

    # The base tables are written once, sorted for range pruning, and everything derived reads them back.
    for name in list(tables):
        lead = [c for c in ("dataset_id", "study_layer", "engine") if c in tables[name].columns][:1]
        tables[name].sortWithinPartitions(*lead).write.mode("overwrite").parquet(f"{folder}/{name}")
        tables[name] = spark.read.schema(tables[name].schema).parquet(f"{folder}/{name}")
    tables.update(acceptance_views(tables))
    for name, df in derived_tables(tables).items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        tables[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    write_search_index(spark, {n: (tables[n], columns) for n, columns in INDEXED.items()}, f"{folder}/search")
    kinds = {n: ("derived" if n in DERIVED else "view" if n in VIEWS else "study" if n in S.STUDY_COLUMNS else "engine" if n in S.ENGINE_TABLES else "bundle") for n in tables}
    table_list({n: (df, kinds[n]) for n, df in tables.items()}).write.mode("overwrite").parquet(f"{folder}/catalog_tables")
    found.select("dataset_id", "bundle_id", "path", "written_utc", "schema_version").write.mode("overwrite").parquet(f"{folder}/catalog_bundles")
    # What else the catalog is made of, one row each.
    loaded = spark.createDataFrame([(layer, b, S.STUDY_VERSIONS.get(layer), p) for layer, b, p, _ in studies], "layer string, bundle_id string, layer_version string, path string")
    loaded.write.mode("overwrite").parquet(f"{folder}/catalog_study_bundles")
    made = spark.createDataFrame([(e, b, p, dict(counts)) for e, b, p, counts in artefacts], "engine string, artefact_id string, path string, tables map<string,bigint>")
    made.write.mode("overwrite").parquet(f"{folder}/catalog_engine_artefacts")
    body = {"catalog_id": identity, "catalog_version": CATALOG_FORMAT, "schema_version": S.SCHEMA_VERSION, **meta}
    write_json_file(spark.createDataFrame([tuple(body.values())], ", ".join(f"{k} string" for k in body)), f"{folder}/catalog.json")
    return folder


def open_catalog(spark: SparkSession, folder: str) -> Catalog:
    names = [*S.CORE_COLUMNS, *S.STUDY_COLUMNS, *DERIVED, "catalog_tables", "catalog_bundles", "catalog_checks", "catalog_study_bundles", "catalog_engine_artefacts"]
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in names}
    tables["catalog_meta"] = spark.read.json(f"{folder}/catalog.json")
    tables.update(acceptance_views(tables))
    return Catalog(tables, folder)
