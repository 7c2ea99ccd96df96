"""Publish a catalog as files that need no engine: figures, documents in shards, a symbol index and file descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracat.operators import export, figures
from veracat.operators.snapshots import write_json_file
from veracat.plans.catalog import Catalog
from veracat.session import materialise

#: Tables whose files are described for readers.
DESCRIBED = ["datasets", "psms", "peptidoforms", "protein_groups", "proteins", "ptm_sites", "quant_values"]


def documents(catalog: Catalog) -> DataFrame:
    """One document per dataset."""
    facts = catalog["datasets"].select("dataset_id", "search_database", "sdrf_status")
    bundles = catalog["catalog_bundles"].select("dataset_id", "written_utc")
    metrics = catalog["metrics"].filter("scope = 'dataset'").select("dataset_id", "name", "value", "definition_id")
    mods = figures.modification_counts(catalog["ptm_sites"].select("dataset_id", "modification_name", "modification", "target_decoy"))
    return figures.dataset_documents(catalog["dataset_overview"], facts, bundles, catalog["findings"], mods, metrics)


def entries(catalog: Catalog) -> DataFrame:
    """One document per entity with accepted evidence: where it was seen, and how often."""
    return figures.presence_join(catalog["protein_datasets"], catalog["protein_index"])


def figure_rows(catalog: Catalog) -> DataFrame:
    """(figure, value as JSON) of every figure: each is a few rows, whatever the catalog holds."""
    presence = materialise(catalog["protein_datasets"], "presence")
    spread = materialise(figures.presence_spread(presence), "spread")
    found = {
        "spread": spread, "shared_threshold": figures.shared_threshold(spread),
        "findings": figures.finding_summary(catalog["findings"]),
        "totals": catalog["dataset_overview"].agg(F.count("*").alias("datasets"), *[F.sum(c).alias(c) for c in ("n_runs", "n_samples", "n_psms_1pct", "n_protein_groups_1pct")]),
    }
    out = None
    for name, df in found.items():
        part = df.select(F.lit(name).alias("figure"), F.to_json(F.struct("*")).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def publish(catalog: Catalog, folder: str, cap: int = export.MAX_SHARD_BYTES) -> dict[str, int]:
    """Write everything under ``folder`` and return how many shards each kind of document has.

    Documents go into shards of at most ``cap`` bytes by the beginning of their key; a figure is a row of one file.
    """
    spark = catalog["datasets"].sparkSession
    shards = {}
    for name, df, key in (("datasets", documents(catalog), "dataset_id"), ("proteins", entries(catalog), "protein_accession")):
        told = df.select(key, F.to_json(F.struct("*")).alias("document"))
        shards[name] = export.write_sharded_json(told, key, "document", f"{folder}/{name}", cap).count()
    export.write_symbol_index(catalog["protein_index"], "gene", "protein_accession", f"{folder}/symbols")
    # A figure has few rows, so its list is short.
    lists = figure_rows(catalog).groupBy("figure").agg(F.array_sort(F.collect_list("value")).alias("rows"))
    write_json_file(lists.orderBy("figure"), f"{folder}/figures.json")
    if catalog.path:
        described = export.column_catalog(spark, [f"{catalog.path}/{n}" for n in DESCRIBED])
        described.coalesce(1).write.mode("overwrite").json(f"{folder}/files")  # a row for each column of a file
    return shards
