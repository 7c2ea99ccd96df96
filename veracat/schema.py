"""Table schemas, keys and references, as data.

A column list is written ``name type!`` where ``!`` marks a required column. ``struct_type`` turns a
list into a Spark ``StructType``; nothing else in the package spells out a table's columns.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA_VERSION = "0.0.13"
STUDY_VERSIONS = {"aging": "0.5.0"}

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<long>": T.ArrayType(T.LongType()),
}

# The columns of every core table and of every study table.
CORE_COLUMNS = {
    "releases": (
        "release_id string!, date date!, doi string, schema_version string!, qpx_version string!, notes "
        "string"
    ),
    "release_changes": (
        "release_id string!, dataset_id string!, change_type string!, reason string!"
    ),
    "dataset_candidates": (
        "census_version string!, accession string!, included boolean!, exclusion_reason string, "
        "definition_id string"
    ),
    "datasets": (
        "dataset_id string!, title string, organisms array<string>!, acquisition string!, quant_method "
        "string!, labelling string!, labelling_plex long, enrichment array<string>!, enrichment_mixed "
        "boolean!, instrument_vendor string, instruments array<string>, permitted_responses "
        "array<string>, axis_source string!, submission_type string, search_engine string!, "
        "search_engine_version string!, search_database string, search_database_sha256 string, "
        "sdrf_status string, pipeline_repo string, pipeline_commit string, searches array<string>, "
        "first_release_id string, latest_release_id string"
    ),
    "samples": (
        "sample_id string!, dataset_id string!, source_name string!, organism string!, sex string, "
        "organism_part string, cell_type string, disease string, condition string, material_type string, "
        "cell_line string, individual_id string, biological_replicate long, timepoint string"
    ),
    "sample_characteristics": (
        "sample_id string!, name string!, value string!, value_reserved boolean!, term string, source "
        "string, source_reference string, source_method string"
    ),
    "runs": (
        "run_id string!, dataset_id string!, file_name string!, sha256 string, pride_checksum_sha1 "
        "string, fraction long, fraction_source string, technical_replicate long, "
        "technical_replicate_source string, fragmentation array<string>, ms2_spectra long, run_minutes "
        "double, qc_pass boolean, instrument_model string, acquisition_datetime timestamp, enrichment "
        "array<string>, enrichment_source string"
    ),
    "assays": (
        "assay_id string!, run_id string!, channel string!, sample_id string!"
    ),
    "psms": (
        "psm_id string!, run_id string!, scan long!, usi string!, peptidoform string!, base_sequence "
        "string!, precursor_charge long!, precursor_mz double, retention_time_min double, score double, "
        "delta_score double, q_value double!, q_value_notch double, notch string, notch_ambiguous "
        "boolean, pep double, pep_q_value double, mass_error_ppm double, target_decoy string!, "
        "protein_accessions array<string>, ambiguity_level string, localization_score double, search "
        "string, missed_cleavages long, nonspecific_termini long, start_residue long, end_residue long, "
        "matched_ion_series string, matched_ion_count long"
    ),
    "peptidoforms": (
        "peptidoform_id string!, dataset_id string!, peptidoform string!, base_sequence string!, "
        "best_q_value double, best_q_value_notch double, best_pep double, target_decoy string!, n_psms "
        "long, protein_group_id string, protein_accessions array<string>, is_unique boolean, "
        "is_isoform_specific boolean, engine_full_sequences array<string>"
    ),
    "protein_groups": (
        "protein_group_id string!, dataset_id string!, protein_accessions array<string>!, genes "
        "array<string>, target_decoy string, q_value double, sequence_coverage double, unique_peptides "
        "long, shared_peptides long"
    ),
    "proteins": (
        "protein_accession string!, canonical_accession string, gene string, organism string, "
        "organism_name string, length long, source_db string!, uniprot_release string, is_contaminant "
        "boolean"
    ),
    "ptm_sites": (
        "ptm_site_id string!, dataset_id string!, protein_accession string!, position long!, residue "
        "string, site_type string!, modification string, modification_name string!, target_decoy string, "
        "best_ambiguity_level string, localization_score double, n_psms long, best_q_value double"
    ),
    "ptm_stoichiometry": (
        "ptm_site_id string!, assay_id string!, denominator_grouping string!, sample_label string!, "
        "protein_group_id string!, mm_position long!, mm_modification string!, occupancy_state string!, "
        "modified_fraction_count double, n_modified_psms long, n_covering_psms long, count_is_ceiling "
        "boolean, modified_fraction_intensity double, intensity_modified double, intensity_total double, "
        "intensity_is_floor boolean, intensity_is_ceiling boolean, definition_id string!"
    ),
    "glycopeptides": (
        "glycopeptide_id string!, dataset_id string!, peptidoform string!, protein_accession string!, "
        "glycosite_positions array<long>, glycan_type string!, glycan_composition string!, "
        "localization_level string, q_value double, n_psms long"
    ),
    "proteoform_inferences": (
        "proteoform_id string!, dataset_id string!, protein_accession string!, proforma string!, "
        "supporting_peptidoforms array<string>!, sites_on_one_peptide boolean!, inference_confidence "
        "double!, definition_id string!"
    ),
    "quant_values": (
        "assay_id string!, feature_type string!, feature_id string!, value double, detection_type string, "
        "pip_q_value double, mbr_kept boolean, definition_id string!"
    ),
    "annotation_sources": (
        "source_id string!, owner_project string!, version string!, doi string"
    ),
    "protein_localizations": (
        "protein_accession string!, compartment string!, go_release string!, evidence string, source_id "
        "string!, protein_group string, q_value double, n_members long, n_with long, inherited boolean, "
        "propagated boolean"
    ),
    "organelle_term_categories": (
        "compartment string!, category_map_name string!, organelle_map_version string!, go_release "
        "string!, organelle_category string!, organelle_subcategory string, source_id string!"
    ),
    "gene_resolutions": (
        "definition_id string!, accession string!, entry_accession string, isoform long, namespace "
        "string!, outcome string!, n_genes long!, gene_id string, versioned_gene_id string, gene_symbol "
        "string, gene_biotype string, off_primary_genes long!, uniprot_gene_name string, source string!, "
        "search_database_sha256 string!, gene_set_release string, gene_set_sha256 string!, "
        "ensembl_xref_agrees boolean, ensembl_xref_info_type string, ensembl_xref_sha256 string!"
    ),
    "protein_annotations": (
        "protein_accession string!, key string!, value string!, position long, qualifier string, "
        "source_id string!"
    ),
    "feature_sets": (
        "feature_set_id string!, name string!, version string!, owner_project string!, doi string, "
        "description string"
    ),
    "feature_set_members": (
        "feature_set_id string!, feature_type string!, feature_id string!, role string"
    ),
    "definitions": (
        "definition_id string!, version string!, owner_project string!, text string!, url string"
    ),
    "provenance_records": (
        "dataset_id string!, stage string!, provenance_schema string!, started_utc timestamp, "
        "finished_utc timestamp, pipeline_repo string, pipeline_commit string, params_sha256 string, "
        "tools_json string, params_json string, wall_seconds double, peak_rss_gib double, resources_json "
        "string, original_path string!, original_sha256 string!"
    ),
    "findings": (
        "finding_id string!, dataset_id string!, run_id string, code string!, severity string!, status "
        "string!, message string!, source string!"
    ),
    "trait_effects": (
        "feature_type string!, feature_key string!, feature_key_unimod string, protein_accessions "
        "array<string>!, trait_id string!, response string!, scope string!, beta_detect double, se_detect "
        "double, p_detect double, beta_int double, se_int double, p_int double, p_combined double, q "
        "double, fdr_family string!, n_detected long!, n_absent_protein_present long!, n_protein_present "
        "long!, estimable_detect boolean!, estimable_int boolean!, mbr_dependent boolean!, mod_class "
        "string!, ambiguity_level string, definition_id string!"
    ),
    "ptm_pairs": (
        "result_type string!, scope string!, feature_type string!, datasets array<string>, n_datasets "
        "long, n_datasets_agreeing long, feature_key_a string!, protein_accessions_a array<string>!, "
        "feature_key_b string!, protein_accessions_b array<string>!, same_protein boolean!, flags "
        "array<string>, class_pair string!, trait_id string, stratum string, sign string, statistic "
        "string!, value double, n long, p double, q double, fdr_family string, definition_id string!"
    ),
    "metrics": (
        "scope string!, scope_id string!, name string!, value double, definition_id string!, source "
        "string!"
    ),
    "search_modifications_declared": (
        "dataset_id string!, modification string, name string!, residues string!, usage string!"
    ),
}

STUDY_COLUMNS = {
    "sample_ages": (
        "sample_id string!, age_raw string!, age_years double, age_is_lower_bound boolean, age_is_range "
        "boolean, age_source string!, age_source_reference string, normalizer_version string"
    ),
    "curated_sample_characteristics": (
        "sample_id string!, name string!, value string!, value_reserved boolean!, term string, "
        "source_reference string!, evidence string, confidence string, curation_version string!"
    ),
    "age_effects": (
        "dataset_id string!, organism string!, age_centre_years double!, feature_type string!, feature_id "
        "string!, response string!, estimator string!, quant_basis string!, model_form string!, stratum "
        "string!, beta double!, se double!, ci_low double, ci_high double, p_value double, q_value "
        "double, n_samples long!, n_observed long, n_missing long, age_min double, age_max double, "
        "age_span_years double!, n_age_lower_bound long, covariates string!, normalization string!, "
        "method string!, method_version string!, n_covering_psms_median double, intensity_is_floor_frac "
        "double, mbr_kept_frac double, definition_id string!"
    ),
    "age_effect_refusals": (
        "dataset_id string!, organism string!, feature_type string, feature_id string, response string!, "
        "estimator string!, quant_basis string!, model_form string!, stratum string!, fit_refused "
        "string!, n_samples long, n_observed long, n_distinct_ages long, age_span_years double, "
        "definition_id string!"
    ),
    "age_effect_meta": (
        "organism string!, feature_type string!, feature_id string!, response string!, estimator string!, "
        "quant_basis string!, stratum string!, tissue string!, acquisition string!, quant_method string!, "
        "beta_meta double!, se_meta double!, ci_low double, ci_high double, q_meta double, n_datasets "
        "long!, dataset_ids array<string>!, i_squared double, tau2 double, n_direction_agree long, "
        "n_direction_disagree long, leave_one_out_max_delta double, definition_id string!"
    ),
    "organelle_age_summaries": (
        "compartment string!, organism string!, organism_part string, response string!, definition_id "
        "string!, n_datasets long!, n_proteins long, estimate double, standard_error double, q_value "
        "double, heterogeneity_i2 double"
    ),
    "clock_models": (
        "clock_id string!, definition_id string!, feature_level string, training_datasets array<string>, "
        "cv_mae_years double, heldout_mae_years double, heldout_datasets array<string>"
    ),
    "clock_features": (
        "clock_id string!, feature_type string!, feature_id string!, weight double!"
    ),
    "age_mappings": (
        "organism string!, age_from double!, age_to double!, age_unit string!, life_stage string!, "
        "human_equivalent_years double, definition_id string!"
    ),
}

# The column that identifies a row of a table, within one dataset.
IDENTIFIERS = {
    "datasets": ["dataset_id"],
    "samples": ["sample_id"],
    "runs": ["run_id"],
    "assays": ["assay_id"],
    "psms": ["psm_id"],
    "peptidoforms": ["peptidoform_id"],
    "protein_groups": ["protein_group_id"],
    "proteins": ["protein_accession"],
    "ptm_sites": ["ptm_site_id"],
    "definitions": ["definition_id"],
    "findings": ["finding_id"],
}

# Natural keys of tables that have no identifier column.
COMPOSITE_KEYS = {
    "quant_values": ["assay_id", "feature_type", "feature_id", "definition_id"],
    "ptm_stoichiometry": ["ptm_site_id", "assay_id"],
    "organelle_term_categories": [
        "compartment", "category_map_name", "organelle_map_version", "go_release",
        "organelle_category", "organelle_subcategory",
    ],
    "trait_effects": ["feature_type", "feature_key", "trait_id", "response", "scope", "definition_id"],
    "ptm_pairs": [
        "result_type", "scope", "feature_type", "feature_key_a", "feature_key_b", "trait_id",
        "stratum", "statistic", "definition_id",
    ],
}

STUDY_KEYS = {
    "sample_ages": ["sample_id"],
    "curated_sample_characteristics": ["sample_id", "name"],
    "age_effects": [
        "dataset_id", "feature_id", "response", "estimator", "quant_basis", "model_form", "stratum",
    ],
    "age_effect_refusals": [
        "dataset_id", "feature_id", "response", "estimator", "quant_basis", "model_form", "stratum",
    ],
    "age_effect_meta": [
        "organism", "feature_id", "response", "estimator", "quant_basis", "stratum", "tissue",
        "acquisition", "quant_method",
    ],
    "organelle_age_summaries": ["compartment", "organism", "organism_part", "response"],
    "clock_features": ["clock_id", "feature_type", "feature_id"],
    "age_mappings": ["organism", "age_from", "age_to"],
}

# An engine table's key, over which NULL is a value.
ENGINE_KEYS = {
    "gene_resolutions": [
        "search_database_sha256", "gene_set_sha256", "gene_set_release", "accession", "gene_id",
    ],
}

# Child table, child column ("[]" marks an array), parent table, parent column.
REFERENCES = [
    ("samples", "dataset_id", "datasets", "dataset_id"),
    ("sample_characteristics", "sample_id", "samples", "sample_id"),
    ("runs", "dataset_id", "datasets", "dataset_id"),
    ("assays", "run_id", "runs", "run_id"),
    ("assays", "sample_id", "samples", "sample_id"),
    ("psms", "run_id", "runs", "run_id"),
    ("psms", "protein_accessions[]", "proteins", "protein_accession"),
    ("peptidoforms", "dataset_id", "datasets", "dataset_id"),
    ("peptidoforms", "protein_group_id", "protein_groups", "protein_group_id"),
    ("peptidoforms", "protein_accessions[]", "proteins", "protein_accession"),
    ("protein_groups", "dataset_id", "datasets", "dataset_id"),
    ("protein_groups", "protein_accessions[]", "proteins", "protein_accession"),
    ("ptm_sites", "dataset_id", "datasets", "dataset_id"),
    ("ptm_sites", "protein_accession", "proteins", "protein_accession"),
    ("ptm_stoichiometry", "ptm_site_id", "ptm_sites", "ptm_site_id"),
    ("ptm_stoichiometry", "assay_id", "assays", "assay_id"),
    ("ptm_stoichiometry", "protein_group_id", "protein_groups", "protein_group_id"),
    ("ptm_stoichiometry", "definition_id", "definitions", "definition_id"),
    ("quant_values", "assay_id", "assays", "assay_id"),
    ("quant_values", "definition_id", "definitions", "definition_id"),
    ("metrics", "definition_id", "definitions", "definition_id"),
    ("findings", "dataset_id", "datasets", "dataset_id"),
    ("findings", "run_id", "runs", "run_id"),
    ("provenance_records", "dataset_id", "datasets", "dataset_id"),
    ("search_modifications_declared", "dataset_id", "datasets", "dataset_id"),
]

STUDY_REFERENCES = [
    ("sample_ages", "sample_id", "samples", "sample_id"),
    ("curated_sample_characteristics", "sample_id", "samples", "sample_id"),
    ("age_effects", "dataset_id", "datasets", "dataset_id"),
    ("age_effect_refusals", "dataset_id", "datasets", "dataset_id"),
    ("clock_features", "clock_id", "clock_models", "clock_id"),
]

# Where a typed feature reference points.
FEATURE_TARGETS = {
    "peptidoform": ("peptidoforms", "peptidoform_id"),
    "protein_group": ("protein_groups", "protein_group_id"),
    "ptm_site": ("ptm_sites", "ptm_site_id"),
    "glycopeptide": ("glycopeptides", "glycopeptide_id"),
    "proteoform": ("proteoform_inferences", "proteoform_id"),
    "protein": ("proteins", "protein_accession"),
}

# Vocabularies that an operator checks against.
ENRICHMENTS = [
    "none", "phospho", "acetyl", "ubiquitin_GG", "succinyl", "glyco", "immunoprecipitation",
    "proximity_labelling", "affinity_purification", "chemical_probe", "other",
]
RESOLUTION_OUTCOMES = [
    "resolved", "multi_gene", "off_primary_only", "not_in_source", "unrecognized_accession",
    "contaminant_not_mapped",
]

ENGINE_TABLES = {"gene_resolutions": "logs.resolve_genes"}

TABLE_PROVENANCE = ["dataset_id", "bundle_id"]
STUDY_PROVENANCE = ["study_layer", "study_bundle_id"]
ENGINE_PROVENANCE = ["engine", "artefact_id"]


def parse_columns(text: str) -> T.StructType:
    """``"a string!, b long"`` as a StructType; ``!`` means not nullable."""
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


@cache
def struct_type(table: str) -> T.StructType:
    return parse_columns(CORE_COLUMNS.get(table) or STUDY_COLUMNS[table])


def catalog_type(table: str) -> T.StructType:
    """The table's columns behind the provenance columns the catalog prepends."""
    if table in STUDY_COLUMNS:
        lead = STUDY_PROVENANCE
    elif table in ENGINE_TABLES:
        lead = ENGINE_PROVENANCE
    else:
        lead = TABLE_PROVENANCE
    own = [f for f in struct_type(table) if f.name not in lead]
    return T.StructType([T.StructField(c, T.StringType()) for c in lead] + own)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, the right columns: an empty table is a different fact from a missing one."""
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame([], loose)


def required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]
