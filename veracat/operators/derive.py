"""Cross-dataset tables derived from the catalog's own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.functions.cells import extract_tags, null_if_empty
from veracat.functions.rules import is_decoy, tag_class


def per_dataset_counts(base: DataFrame, counts: Mapping[str, DataFrame], key: str = "dataset_id") -> DataFrame:
    """``base`` with one count per table, 0 where a dataset has no row.

    All tables are counted in one aggregate over their union of keys, so the base is joined once
    however many counts there are.
    """
    tagged = None
    for name, df in counts.items():
        part = df.groupBy(key).agg(F.count("*").alias("n")).withColumn("t", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    wide = tagged.groupBy(key).agg(*[F.sum(F.when(F.col("t") == name, F.col("n"))).alias(name) for name in counts])
    zero = F.lit(0).cast("bigint")
    joined = base.join(wide, key, "left")
    return joined.select(*base.columns, *[F.coalesce(name, zero).alias(name) for name in counts])


def entity_datasets(entities: DataFrame, groups: DataFrame, forms: DataFrame, entity: str = "protein_accession",
                    members: str = "protein_accessions", group_id: str = "protein_group_id", form_id: str = "peptidoform_id",
                    q: str = "q_value", label: str = "is_contaminant", dataset: str = "dataset_id") -> DataFrame:
    """Per (dataset, entity, label): accepted groups and forms and the best group q.

    Each side is exploded and reduced to (dataset, entity) before the join, so no entity ever meets
    its groups times its forms.
    """
    observed = entities.select(dataset, entity, label).distinct()
    in_groups = groups.select(dataset, F.explode(members).alias(entity), group_id, q) \
        .groupBy(dataset, entity, group_id).agg(F.min(q).alias(q)) \
        .groupBy(dataset, entity).agg(F.count(group_id).alias("n_protein_groups"), F.min(q).alias("best_q_value"))
    in_forms = forms.select(dataset, F.explode(members).alias(entity), form_id).distinct() \
        .groupBy(dataset, entity).agg(F.count(form_id).alias("n_peptidoforms"))
    zero = F.lit(0).cast("bigint")
    return observed.join(in_groups, [dataset, entity], "left").join(in_forms, [dataset, entity], "left").select(
        dataset, entity, label, F.coalesce("n_protein_groups", zero).alias("n_protein_groups"),
        F.coalesce("n_peptidoforms", zero).alias("n_peptidoforms"), "best_q_value",
    )


def entity_index(entities: DataFrame, presence: DataFrame, entity: str = "protein_accession", attributes: Sequence[str] = ("gene", "organism"),
                 label: str = "is_contaminant", dataset: str = "dataset_id") -> DataFrame:
    """One row per entity over all datasets. ``n_datasets`` counts where it is listed at all,
    ``n_datasets_1pct`` where evidence passed. The lists hold dataset ids, so a hot entity's list is
    as long as the catalog has datasets."""
    listed = entities.groupBy(dataset, entity).agg(
        *[F.max(a).alias(a) for a in attributes], F.max(F.coalesce(label, F.lit(False))).alias("_contaminant")
    )
    passed = presence.groupBy(dataset, entity).agg(
        F.max((F.col("n_protein_groups") > 0) | (F.col("n_peptidoforms") > 0)).alias("_passed"), F.min("best_q_value").alias("best_q_value")
    )
    ok = F.coalesce("_passed", F.lit(False))
    # (dataset, entity) is unique by now, so counting rows counts datasets.
    return listed.join(passed, [dataset, entity], "left").groupBy(entity).agg(
        *[F.max(a).alias(a) for a in attributes],
        F.count_if("_contaminant").alias("n_datasets_contaminant"), F.count("*").alias("n_datasets"),
        F.count_if(ok).alias("n_datasets_1pct"), F.array_sort(F.collect_list(dataset)).alias("dataset_ids"),
        null_if_empty(F.array_sort(F.collect_list(F.when(ok, F.col(dataset))))).alias("dataset_ids_1pct"),
        F.min("best_q_value").alias("best_q_value"),
    )


def sequence_index(forms: DataFrame, sequence: str = "base_sequence", q: str = "best_q_value", dataset: str = "dataset_id") -> DataFrame:
    per_dataset = forms.groupBy(sequence, dataset).agg(F.count("*").alias("_n"), F.min(q).alias("_q"))
    return per_dataset.groupBy(sequence).agg(
        F.count("*").alias("n_datasets"), F.array_sort(F.collect_list(dataset)).alias("dataset_ids"),
        F.sum("_n").alias("n_peptidoforms"), F.min("_q").alias("best_q_value"),
    )


def placed_tags(forms: DataFrame, notation: str = "peptidoform", form_id: str = "peptidoform_id", keys: Sequence[str] = ("dataset_id", "bundle_id")) -> DataFrame:
    """Per (keys, tag): placements and distinct forms, the tag told apart as accession, mass or name."""
    tags = forms.select(*keys, form_id, F.explode(extract_tags(notation)).alias("tag"))
    per_form = tags.groupBy(*keys, "tag", form_id).agg(F.count("*").alias("_n"))
    counted = per_form.groupBy(*keys, "tag").agg(F.sum("_n").alias("n_placements"), F.count(form_id).alias("n_peptidoforms"))
    accession, mass, name = tag_class("tag")
    return counted.select(*keys, "tag", accession.alias("modification"), mass.alias("mass_shift"), name.alias("unresolved_name"), "n_placements", "n_peptidoforms")


def chemistry_view(sites: DataFrame, keys: Sequence[str] = ("dataset_id", "protein_accession", "position", "residue"),
                   term: str = "modification", name: str = "modification_name") -> DataFrame:
    """Sites regrouped by accession, or by name where there is none. Two unmapped chemistries on one
    residue stay two rows."""
    chemistry = F.coalesce(F.col(term), F.col(name)).alias("chemistry_key")
    per_name = sites.groupBy(*keys, term, chemistry, name).agg(
        F.count("*").alias("_rows"), F.sum("n_psms").alias("_n"), F.min("best_q_value").alias("_q"),
        F.min("best_ambiguity_level").alias("_level"), F.max("target_decoy").alias("_label"),
    )
    return per_name.groupBy(*keys, term, "chemistry_key").agg(
        F.sum("_rows").alias("n_names"), F.array_sort(F.collect_set(name)).alias("modification_names"), F.sum("_n").alias("n_psms"),
        F.min("_q").alias("best_q_value"), F.min("_level").alias("best_ambiguity_level"), F.max("_label").alias("target_decoy"),
    )


def entity_resolutions(entities: DataFrame, databases: DataFrame, resolutions: DataFrame, entity: str = "protein_accession") -> DataFrame:
    """Entities joined through the target databases of their dataset to what resolved them. A
    contaminant, an entity with an unknown label and a decoy are left out."""
    own = entities.filter((~F.col("is_contaminant")) & ~is_decoy(entity))
    targets = databases.filter("role = 'target'").select("dataset_id", "database", F.col("sha256").alias("search_database_sha256"))
    # A few databases per dataset; the planner may broadcast them when their size allows it.
    found = resolutions.withColumnRenamed("accession", entity)
    return own.select("dataset_id", "bundle_id", entity).join(targets, "dataset_id").join(found, [entity, "search_database_sha256"]).select(
        "dataset_id", "bundle_id", entity, "database", "outcome", "n_genes", "gene_id", "gene_symbol", "gene_biotype", "source",
        "ensembl_xref_agrees", "gene_set_release", "search_database_sha256", "definition_id", "artefact_id",
    )
