"""Ingest one search: its output files to checked tables in a snapshot."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracat import schema as S
from veracat.functions.cells import delete_extensions, file_name, file_stem, first_alternative, lenient_float, map_key_suffixes, split_list, strip, verbatim
from veracat.functions.rules import ambiguous_flag, canonical_key, database_role, worst_label
from veracat.operators import identification as ident
from veracat.operators import quality, quant, samples, sites
from veracat.operators.coerce import coerce, coercion_violations
from veracat.operators.notation import lookup_with_preference, translate_notation
from veracat.operators.snapshots import declaration_digest, path_exists, snapshot_id, write_snapshot
from veracat.plans import presets as P
from veracat.plans.catalog import bundle_checks
from veracat.session import materialise
from veracat.sources import files


@dataclass
class Search:
    """Where one search's files are, and what its producer declared about the dataset."""

    dataset_id: str
    matches: str
    peptides: str | None = None
    groups: str | None = None
    peptide_quant: str | None = None
    peaks: str | None = None
    report: str | None = None
    sheet: str | None = None
    fetch: str | None = None
    qc: str | None = None
    provenance: str | None = None
    databases: Sequence[str] = ()
    modification_lists: Sequence[str] = ()
    # (usage, packed list) of every task that ran.
    declared_lists: Sequence[tuple[str, str]] = ()
    title: str | None = None
    organism: str | None = None
    acquisition: str = "DDA"
    quant_method: str = "label-free"
    labelling: str = "none"
    enrichment: Sequence[str] = ("none",)
    mixed_enrichment: bool = False
    run_enrichment: Mapping[str, str] = field(default_factory=dict)
    expected_files: int | None = None
    engine: str = "search engine"
    engine_version: str | None = None
    regime: str | None = None
    policy: str | None = "RemoveContaminant"
    search_label: str = "standard"
    threshold: float = 0.01
    # Provenance files of earlier stages, whose digests the search recorded among its inputs.
    upstream: Sequence[str] = ()
    # Remarks for the manifest.
    notes: Sequence[str] = ()
    # sha256 by path, for inputs whose digest is known or that are too large for one row.
    recorded_digests: Mapping[str, str] = field(default_factory=dict)


def read_databases(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(accession, sequence, role, database) of every searched database."""
    parts = []
    for path in paths:
        read = files.read_protein_xml if path.lower().endswith(".xml") else files.read_fasta
        parts.append(read(spark, path).select("accession", "sequence", database_role(F.lit(path)).alias("role"), file_name(F.lit(path)).alias("database")))
    empty = spark.createDataFrame([], "accession string, sequence string, role string, database string")
    return quality.union_all(parts) if parts else empty


def _frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def _metric(df: DataFrame, scope: Column, scope_id: Column, name: Column, value: Column, definition: Column, source: Column) -> DataFrame:
    return df.select(scope.alias("scope"), scope_id.alias("scope_id"), name.alias("name"), value.cast("double").alias("value"),
                     definition.alias("definition_id"), source.alias("source")).filter("value IS NOT NULL")


def ingest_tables(spark: SparkSession, s: Search) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables in their declared types, reconciliation). Every table is materialised once in the
    shared folder, so what is checked is what is written."""
    d = F.lit(s.dataset_id)

    # Provenance, samples and runs.
    docs = files.read_json_documents(spark, s.provenance, P.PROVENANCE_SCHEMA) if s.provenance else None
    sheet = files.read_sample_sheet(spark, s.sheet) if s.sheet else None
    fetched = files.read_json_documents(spark, s.fetch, P.FETCH_SCHEMA).select(F.explode("files").alias("f")).select("f.*") if s.fetch else \
        _frame(spark, [], "name string, pride_checksum string, sha256 string, category string")
    qc = files.read_json_map(spark, s.qc, P.QC_VALUE).select(
        F.col("key").alias("name"), F.col("value.ms2").alias("ms2"), F.col("value.run_minutes").alias("run_minutes"), F.col("value.pass").alias("pass"),
        map_key_suffixes("value.ms2_analyzer_dissociation").alias("fragmentation")) if s.qc else \
        _frame(spark, [], "name string, ms2 bigint, run_minutes double, pass boolean, fragmentation array<string>")
    facts = samples.run_facts(sheet) if sheet is not None else _frame(
        spark, [], "run string, instrument_model string, instrument_term string, fraction bigint, technical_replicate bigint, fraction_source string, technical_replicate_source string, acquisition string")
    excluded = docs.select(F.explode("excluded_files.files").alias("name"), F.col("excluded_files.reason").alias("reason")) if docs is not None else \
        _frame(spark, [], "name string, reason string")
    runs = samples.build_runs(fetched, qc, facts, s.dataset_id, excluded)
    stems = runs.withColumn("_stem", file_stem("file_name"))
    given = _frame(spark, s.run_enrichment.items(), "run string, value string") if s.run_enrichment else None
    runs, problems = samples.assign_run_attribute(stems, "_stem", list(s.enrichment), s.mixed_enrichment, given)
    bad = problems.collect()
    if bad:
        raise ValueError("run enrichment: " + "; ".join(f"{r['problem']} ({r['n']}, e.g. {r['example']})" for r in bad))
    runs = materialise(runs.drop("_stem"), "runs")
    names = materialise(runs.select(file_stem("file_name").alias("name")), "run-names")

    if sheet is not None:
        all_samples, characteristics = samples.sheet_samples(sheet, s.dataset_id, s.organism), samples.melt_sheet(sheet, s.dataset_id)
        assays, unsearched, unnamed, status = samples.scope_gate(samples.sheet_assays(sheet, s.dataset_id), runs, "run_id")
        sheet_status = status.first()["status"]
        used = assays.select("sample_id").distinct()
        all_samples, characteristics = all_samples.join(used, "sample_id", "left_semi"), characteristics.join(used, "sample_id", "left_semi")
        lonely = unnamed.select(F.substr("run_id", F.lit(len(s.dataset_id) + 2)).alias("base"))
    else:
        sheet_status, unsearched = "absent", runs.select("run_id").limit(0)
        all_samples, characteristics = S.empty_like(spark, S.struct_type("samples")), S.empty_like(spark, S.struct_type("sample_characteristics"))
        assays, lonely = S.empty_like(spark, S.struct_type("assays")), names.select(F.col("name").alias("base"))
    made = samples.synthetic_samples(lonely, "base", all_samples, s.dataset_id, s.organism)
    all_samples = all_samples.unionByName(made, allowMissingColumns=True)
    assays = assays.select("assay_id", "run_id", "channel", "sample_id").unionByName(samples.synthetic_assays(made))

    # Identifications.
    raw = files.read_match_table(spark, s.matches).withColumn("File Name", delete_extensions("File Name"))
    peptides = files.read_match_table(spark, s.peptides) if s.peptides else raw
    wide = files.read_wide_tsv(spark, s.groups).withColumn("row_order", files.file_row_order()) if s.groups else None
    registry = files.read_modification_list(spark, s.modification_lists) if s.modification_lists else \
        _frame(spark, [], "name string, targets array<string>, unimod bigint, mass double, entry_order int")
    sequence = lambda df: df.select(first_alternative("Full Sequence").alias("notation"))
    quantified = files.read_wide_tsv(spark, s.peptide_quant) if s.peptide_quant else None
    notations = [sequence(raw), sequence(peptides)] + ([quantified.select(quant.peptide_notation(quantified).alias("notation"))] if quantified is not None else [])
    # A notation is translated once however many rows use it.
    forms = materialise(translate_notation(quality.union_all(notations), "notation", registry), "forms")
    databases = read_databases(spark, s.databases)
    sequences = materialise(databases.select("accession", "sequence", "role", "database"), "sequences")

    psms = materialise(ident.match_rows(raw, P.MATCH_COLUMNS, s.dataset_id, names, "name", forms, s.search_label), "psms")
    groups = ident.group_rows(wide, P.GROUP_COLUMNS, s.dataset_id) if wide is not None else S.empty_like(spark, S.struct_type("protein_groups"))
    counts = ident.count_by_key(psms.select("peptidoform"), ["peptidoform"], "n_psms")
    peptidoforms = ident.form_rows(peptides, P.MATCH_COLUMNS, s.dataset_id, forms, counts, groups)
    columns = {r: P.MATCH_COLUMNS[r][0] for r in ("accession", "gene", "organism_name", "label")}
    both = ident.concat_matches([raw, peptides] if s.peptides else [raw], list(columns.values()))
    status_of = ident.database_status(sequences, "accession", "role")
    found = ident.entity_table(both, columns, "at", s.organism, status_of, s.policy)
    if wide is not None:
        at_groups = groups.join(wide.select(canonical_key(F.array_sort(split_list(P.GROUP_COLUMNS["accession"])), d).alias("protein_group_id"), "row_order")
                                .groupBy("protein_group_id").agg(F.min("row_order").alias("row_order")), "protein_group_id")
        found = ident.expand_members(found, at_groups, "protein_accessions", "genes", "target_decoy", "row_order", s.organism)
    found = materialise(found, "proteins")
    matches = raw.select(
        "row_order", first_alternative("Full Sequence").alias("notation"), lenient_float("QValue").alias("q_value"),
        worst_label(P.MATCH_COLUMNS["label"][0]).alias("target_decoy"), verbatim("Ambiguity Level").alias("ambiguity_level"),
        split_list("Accession").alias("accessions"), ident.any_column(raw, *P.MATCH_COLUMNS["ranges"]).alias("ranges"),
        ident.any_column(raw, *P.MATCH_COLUMNS["previous"]).alias("previous"))
    site_table, unplaced = sites.site_rows(matches, forms, sequences, s.dataset_id, s.threshold)
    site_table, unplaced = materialise(site_table, "sites"), materialise(unplaced, "unplaced")
    unsafe = sites.unsafe_names(site_table).select("modification_name").first()
    if unsafe:
        raise ValueError(f"modification name {unsafe[0]!r} holds the key separator: its token did not parse")

    # Quantities.
    parts = []
    head = docs.select(F.col("mbr.mbr_fdr_threshold").alias("t"), F.get_json_object("tools", f"$.{s.engine}.release").alias("release")).first() if docs is not None else None
    mbr_threshold = head["t"] if head and head["t"] is not None else 0.01
    release = (head["release"] if head else None) or s.engine_version
    run_of = lambda df, c: ident.resolve_names(df, c, names, "name", "_run").withColumn("_run", F.coalesce("_run", c))
    if wide is not None:
        gid = canonical_key(F.array_sort(split_list(P.GROUP_COLUMNS["accession"])), d)
        ids = wide.withColumn("feature_id", gid).filter(F.size(split_list(P.GROUP_COLUMNS["accession"])) > 0)
        long = run_of(quant.melt_measures(ids, ["feature_id"], {"Intensity": False, "SpectralCount": True}), "run")
        definition = F.when(F.col("measure") == "Intensity", F.lit("QuantProject:DEF-PROT-INT")).otherwise(F.lit("QuantProject:DEF-PROT-SPC"))
        parts.append(quant.quant_rows(long, d, F.col("_run"), "protein_group", F.col("feature_id"), definition))
    if quantified is not None:
        own = quantified.withColumn("notation", quant.peptide_notation(quantified)).join(forms.select("notation", "proforma"), "notation").filter("proforma <> ''")
        long = run_of(quant.melt_with_detection(own, ["notation", "proforma"]), "run")
        if s.peaks:
            peaks = run_of(files.read_wide_tsv(spark, s.peaks).select(F.col("File Name").alias("file"), F.col("Full Sequence").alias("notation"), F.col("PIP Q-Value").alias("q")), "file")
            best = quant.best_quality(peaks.filter("notation <> ''"), ["_run", "notation"], "q", mbr_threshold)
            long = quant.attach_quality(long, best, ["_run", "notation"])
        parts.append(quant.quant_rows(long, d, F.col("_run"), "peptidoform", F.concat(d, F.lit(":"), "proforma"), F.lit("QuantProject:DEF-PEP-INT")))
    quantities = quality.union_all(parts) if parts else S.empty_like(spark, S.struct_type("quant_values"))

    # Exact copies collapse before anything counts the rows.
    tables: dict[str, DataFrame] = {"samples": all_samples, "assays": assays, "runs": runs, "peptidoforms": peptidoforms, "protein_groups": groups,
                                    "proteins": found.drop("label_fallback"), "ptm_sites": site_table, "quant_values": quantities}
    reports = []
    for name, df in tables.items():
        key = S.IDENTIFIERS.get(name) or S.COMPOSITE_KEYS[name]
        df = materialise(df, f"{name}-raw")
        refuse_violations(df, name)
        typed = coerce(df, S.struct_type(name))
        kept, report = quality.collapse_exact_duplicates(typed, key)
        tables[name] = materialise(kept, name)
        reports.append(report.agg(F.count("*").alias("n"), F.sum("dropped").alias("dropped")).filter("n > 0").select(F.lit(name).alias("table"), "n", "dropped"))

    stoichiometry, lost = _stoichiometry(spark, s, wide, tables, sequences, names) if wide is not None and s.quant_method == "label-free" else (
        S.empty_like(spark, S.struct_type("ptm_stoichiometry")), _frame(spark, [], "reason string, n bigint"))

    # Metrics and reconciliation.
    metrics = [
        _metric(tables["runs"], F.lit("run"), F.col("run_id"), F.lit("ms2"), F.col("ms2_spectra"), F.lit("aging:DEF-MS2"), F.lit("quality report")),
        _metric(tables["runs"], F.lit("run"), F.col("run_id"), F.lit("run_minutes"), F.col("run_minutes"), F.lit("aging:DEF-RUN-MINUTES"), F.lit("quality report")),
    ]
    if docs is not None:
        layout = samples.layout_of("schema", P.LAYOUTS)
        if docs.filter(layout.isNull()).count():
            raise ValueError("a provenance document has a schema this plan was not taught")
        rate = docs.select(d.alias("dataset_id"), layout.alias("layout"), F.col("id_rate.*"), F.col("mbr.*"))
        fields = {"psms_1pct": "psms_1pct", "ms2": "ms2", "id_rate": "rate",
                  "psms_fdr_engine_1pct": F.when(F.col("layout") == 2, F.col("psms_1pct")).otherwise(F.col("psms_fdr_engine_1pct")),
                  **{c: c for c in ("mbr_rows", "mbr_kept", "msms_peaks", "kept_over_msms", "mbr_fdr_threshold")}}
        known = _frame(spark, P.PROVENANCE_METRICS, "name string, layout int, definition_id string, source string")
        found_metrics = samples.metric_rows(rate, ["dataset_id"], fields, known)
        metrics.append(_metric(found_metrics, F.lit("dataset"), F.col("dataset_id"), F.col("name"), F.col("value"), F.col("definition_id"), F.col("source")))
        per_file = run_of(docs.select(F.explode("contamination.intensity_share_per_file").alias("file", "value")), "file")
        metrics.append(_metric(per_file.join(names, F.col("_run") == F.col("name"), "left_semi"), F.lit("run"), F.concat(d, F.lit(":"), "_run"), F.lit("contamination_intensity_share"),
                               F.col("value"), F.lit("QuantProject:DEF-QC-9"), F.lit("contamination.intensity_share_per_file")))
        share = docs.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"contamination.{c}").alias("value"), F.lit(x).alias("definition")) for n, c, x in (
            ("contamination_psm_share", "psm_share", "aging:DEF-CONTAM-PSM"), ("contaminant_psms", "contaminant_psms", "aging:DEF-CONTAM-PSM"),
            ("target_plus_contaminant_psms", "target_plus_contaminant_psms", "aging:DEF-CONTAM-PSM"), ("contamination_intensity_share_median", "intensity_share_median", "QuantProject:DEF-QC-9"),
            ("contamination_intensity_share_min", "intensity_share_min", "QuantProject:DEF-QC-9"), ("contamination_intensity_share_max", "intensity_share_max", "QuantProject:DEF-QC-9"))])).alias("m"))
        metrics.append(_metric(share, F.lit("dataset"), d, F.col("m.name"), F.col("m.value"), F.col("m.definition"), F.lit("contamination")))
    totals = _frame(spark, [], "scope string, name string, count bigint")
    if s.report:
        totals = materialise(files.read_report_counts(spark, s.report), "report")
        scoped = run_of(totals, "scope")
        known = _frame(spark, [(k, n, x) for k, (n, x) in P.REPORT_METRICS.items()], "name string, stored string, definition_id string")
        usable = scoped.join(known, "name").join(names.withColumnRenamed("name", "_known"), F.col("_run") == F.col("_known"), "left").filter("scope = '' OR _known IS NOT NULL")
        total = F.col("scope") == ""
        metrics.append(_metric(usable, F.when(total, F.lit("dataset")).otherwise(F.lit("run")), F.when(total, d).otherwise(F.concat(d, F.lit(":"), "_run")), F.col("stored"),
                               F.col("count"), F.col("definition_id"), F.lit("report")))
    told = materialise(quality.union_all(metrics), "metrics-raw")
    refuse_violations(told, "metrics")
    tables["metrics"] = materialise(coerce(told, S.struct_type("metrics")), "metrics")

    label_is_t = strip(F.coalesce(F.col(P.MATCH_COLUMNS["label"][0]), F.lit(""))) == "T"
    q, qn = lenient_float("QValue"), lenient_float(ident.any_column(raw, "QValue Notch"))
    notch = ambiguous_flag(ident.any_column(raw, "Notch"))
    observed = quality.union_all([
        ident.accepted_counts(raw, q, label_is_t, qn, notch, s.threshold, "value").withColumn("name", F.lit("psms")),
        ident.accepted_counts(peptides, q, label_is_t, lenient_float(ident.any_column(peptides, "QValue Notch")), None, s.threshold, "value").withColumn("name", F.lit("peptides")),
        ident.accepted_group_count(tables["protein_groups"]).withColumnRenamed("n_accepted", "value").withColumn("name", F.lit("protein_groups")),
        tables["runs"].agg(F.count("*").alias("value")).withColumn("name", F.lit("runs")),
        tables["runs"].agg(F.sum("ms2_spectra").alias("value")).withColumn("name", F.lit("ms2_scans")),
    ])
    expected = totals.filter("scope = '' AND name IN ('psms', 'peptides', 'protein_groups', 'ms2_scans')").select("name", F.col("count").alias("value"))
    if s.expected_files is not None:
        expected = expected.unionByName(_frame(spark, [("runs", s.expected_files)], "name string, value bigint"))
    checks = materialise(quality.reconcile(observed, expected, ["name"]).withColumn("dataset_id", d), "checks")

    # Declared modifications, definitions, the dataset row, provenance, findings.
    packed = samples_of_lists(spark, s)
    pairs = ident.unpack_pairs(packed, "packed", ["at", "usage"])
    hits = lookup_with_preference(pairs.select("name", F.lit(None).cast("string").alias("residue")), registry)
    accession = hits.select("name", F.concat(F.lit("UNIMOD:"), F.col("unimod").cast("string")).alias("accession"))
    declared_mods = ident.declared_modifications(pairs, accession, F.struct("at", "pair_position")).withColumn("dataset_id", d)
    definitions = _frame(spark, [(i, f"{s.engine} {release or 'release not recorded'}; regime {s.regime or 'not recorded'}" if i == "pep:DEF-PEP" else v, o, x, None) for i, v, o, x in P.DEFINITIONS], "definition_id string, version string, owner_project string, text string, url string")
    implied = ["aging:DEF-PSM-NOTCH-AMBIGUOUS", "pep:DEF-PEP"]
    inputs = docs.select(F.posexplode("inputs").alias("at", "i")).select(d.alias("dataset_id"), "at", "i.*") if docs is not None else _frame(spark, [], "dataset_id string, at int, path string, sha256 string")
    declared = _frame(spark, [(s.dataset_id, s.title, s.acquisition, s.quant_method, s.labelling, None, release, s.mixed_enrichment or len(set(s.run_enrichment.values())) > 1, sheet_status)],
                      "dataset_id string, title string, acquisition string, quant_method string, labelling string, recorded_version string, declared_version string, enrichment_mixed boolean, sdrf_status string")
    row = samples.dataset_row(declared, facts.select(d.alias("dataset_id"), "instrument_model"), files.first_matching_input(inputs, ["dataset_id"], "path", "sha256", "at"), F.lit(s.search_label), s.engine) \
        .withColumn("organisms", F.array(*([F.lit(s.organism)] if s.organism else [])).cast("array<string>")).withColumn("enrichment", F.array(*[F.lit(v) for v in s.enrichment])).withColumn("axis_source", F.lit("provenance"))
    tables.update({
        "datasets": row, "sample_characteristics": characteristics, "psms": psms, "ptm_stoichiometry": stoichiometry, "search_modifications_declared": declared_mods,
        "definitions": samples.definitions_used(definitions, [tables["metrics"], tables["quant_values"], stoichiometry], implied),
    })
    if docs is not None:
        sha = files.file_digests(spark, s.provenance).select(files.plain_path("path").alias("document_path"), "sha256")
        keyed = docs.withColumn("document_path", files.plain_path("document_path")).join(sha, "document_path")
        tables["provenance_records"] = samples.provenance_record(keyed, F.lit("search"), s.dataset_id)
    changed = None
    if docs is not None and s.upstream:
        # An earlier stage's record counts only while it is the file that the search recorded.
        earlier = files.read_json_documents(spark, list(s.upstream), P.PROVENANCE_SCHEMA)
        earlier = earlier.withColumn("document_path", files.plain_path("document_path"))
        held = files.file_digests(spark, list(s.upstream)).select(files.plain_path("path").alias("document_path"), "sha256")
        noted = inputs.select(files.plain_path("path").alias("path"), F.col("sha256").alias("recorded"))
        kept, changed = samples.unchanged_lineage(noted, "path", "recorded", held, "document_path", "sha256")
        staged = earlier.join(kept.select(F.col("path").alias("document_path")).distinct(), "document_path", "left_semi").join(held, "document_path")
        tables["provenance_records"] = tables["provenance_records"].unionByName(samples.provenance_record(staged, F.coalesce("stage", F.lit("unknown")), s.dataset_id))
        changed = changed.join(earlier.select(F.col("document_path").alias("path"), F.coalesce("stage", F.lit("unknown")).alias("stage")), "path")
    tables["findings"] = _findings(spark, s, tables, checks, docs, excluded, unsearched, sheet_status, found, unplaced, forms, raw, names, lost, quality.union_all(reports), changed)
    for name in ("datasets", "sample_characteristics", "psms", "ptm_stoichiometry", "search_modifications_declared", "definitions", "provenance_records", "findings"):
        if name in tables:
            violations = coercion_violations(tables[name], S.struct_type(name)).collect()
            if violations:
                raise ValueError(f"{name}: " + "; ".join(f"{v['column']} {v['rule']} {v['n']}" for v in violations))
            tables[name] = materialise(coerce(tables[name], S.struct_type(name)), name)
    return tables, checks


UNPARSED = "unparsed text"
# Fixed value: what a producer writes in place of a cell that is too long for a spreadsheet.
CUT_CELL = "Output too long for Excel"
CUT = "cell cut by the producer"


def refuse_violations(df: DataFrame, table: str) -> None:
    """Raise where a required value is missing or text is no value of its column's type."""
    bad = coercion_violations(df, S.struct_type(table)).collect()  # a row for a column at most
    if bad:
        raise ValueError(f"{table}: " + "; ".join(f"{r['column']} {r['rule']} in {r['n']} row(s)" for r in bad))


def samples_of_lists(spark: SparkSession, s: Search) -> DataFrame:
    return _frame(spark, [(i, u, p) for i, (u, p) in enumerate(s.declared_lists)], "at int, usage string, packed string")


def _stoichiometry(spark: SparkSession, s: Search, wide: DataFrame, tables: Mapping[str, DataFrame], sequences: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ptm_stoichiometry rows, (reason, n) of the entries not stored)."""
    d = F.lit(s.dataset_id)
    cells = []
    for basis, prefix in (("count", "CountOccupancy"), ("intensity", "IntensityOccupancy")):
        for label, column in quant.wide_columns(wide, prefix).items():
            cells.append(F.struct(F.lit(basis).alias("basis"), F.lit(label).alias("label"), F.col(f"`{column}`").alias("cell")))
    if not cells:
        return S.empty_like(spark, S.struct_type("ptm_stoichiometry")), _frame(spark, [], "reason string, n bigint")
    accs = split_list(P.GROUP_COLUMNS["accession"])
    long = wide.select(canonical_key(accs, d).alias("group"), accs.alias("accs"), "row_order", F.explode(F.array(*cells)).alias("c")).select("group", "accs", "row_order", "c.*")
    is_cut = F.contains(F.coalesce("cell", F.lit("")), F.lit(CUT_CELL))
    entries, unparsed = sites.occupancy_cell(long.filter(~is_cut), "cell", ["group", "accs", "row_order", "basis", "label"])
    entries = materialise(entries.withColumn("o", F.struct("group", "label", "basis", "segment", "entry")), "occupancy")
    decoy = F.forall("accs", lambda a: F.startswith(a, F.lit("DECOY_")))
    named = ident.resolve_names(entries, "label", names, "name", "_run")
    reason = F.when(decoy, F.lit("decoy group")).when(F.col("_run").isNull(), F.lit("label is not a deposited run"))
    marked = named.withColumn("reason", reason)
    usable = marked.filter("reason IS NULL").drop("reason")
    members = wide.select(canonical_key(accs, d).alias("group"), F.posexplode(accs).alias("member", "accession")).distinct()
    # One sequence per accession decides a fit; of several the smallest, so the choice is stable.
    one = sequences.groupBy("accession").agg(F.min("sequence").alias("sequence"))
    assigned = sites.assign_segments(usable, ["label", "basis"], "group", members, one)
    joined = usable.join(assigned, ["label", "basis", "group", "segment"]).join(one, "accession", "left")
    joined = joined.withColumn("ptm_site_id", sites.occupancy_site_key(d, F.col("accession"), F.col("sequence"), F.col("position"), F.col("modification"))) \
        .withColumn("assay_id", F.concat(d, F.lit(":"), "_run", F.lit(":label_free"))).drop("sequence")
    joined = materialise(joined, "occupancy-assigned")
    free = joined.filter("accession IS NOT NULL")
    with_assay, no_assay = sites.site_key_join(free, "assay_id", tables["assays"], "assay_id")
    stored, no_site = sites.site_key_join(with_assay.filter("ptm_site_id IS NOT NULL"), "ptm_site_id", tables["ptm_sites"], "ptm_site_id")
    rows, duplicates = sites.merge_two_bases(stored, ["ptm_site_id", "assay_id"], "basis", "group", "o", ["label", "position", "modification"])
    unassigned = joined.filter("accession IS NULL AND basis = 'intensity'")
    out = sites.with_state(rows, unassigned, "group", "label").select(
        "*", F.lit("run").alias("denominator_grouping"), F.col("label").alias("sample_label"), F.col("group").alias("protein_group_id"), F.col("position").alias("mm_position"),
        F.col("modification").alias("mm_modification"), F.lit("QuantProject:DEF-OCC-CELL").alias("definition_id")).drop("group", "label", "position", "modification")
    count = lambda df, why: df.agg(F.count("*").alias("n")).select(F.lit(why).alias("reason"), "n")
    lost = quality.union_all([
        unparsed.agg(F.coalesce(F.sum("n_unparsed"), F.lit(0)).alias("n")).select(F.lit(UNPARSED).alias("reason"), "n"), count(long.filter(is_cut), CUT),
        marked.filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n")), count(joined.filter("accession IS NULL"), "segment's accession not determinable"),
        count(no_assay, "run has no label-free assay"), count(no_site.unionByName(with_assay.filter("ptm_site_id IS NULL")), "site not in ptm_sites"),
        duplicates.select(F.concat(F.lit("duplicate entry ("), "what", F.lit("; "), "where", F.lit(")")).alias("reason"), "n"),
    ]).filter("n > 0")
    return out, lost


def _findings(spark, s, tables, checks, docs, excluded, unsearched, sheet_status, found, unplaced, forms, raw, names, lost, collapsed, changed=None) -> DataFrame:
    """Everything the ingest noticed, as rows."""
    d = F.lit(s.dataset_id)
    tag = lambda df: df.withColumn("dataset_id", d)
    listed = lambda df, c: df.agg(F.count("*").alias("n"), F.min(c).alias("e")).filter("n > 0")
    text = lambda what: F.concat(F.col("n").cast("string"), F.lit(f" {what}, e.g. "), F.col("e"))
    n_text = lambda what: F.concat(F.col("n").cast("string"), F.lit(" "), F.lit(what))
    out = [quality.mismatch_findings(checks)]
    if changed is not None:
        told = F.format_string("the search recorded this stage's provenance (%s) with sha256 %s, and the file there now has %s", "path", "recorded", "actual")
        out.append(quality.findings(tag(changed), "upstream_provenance_changed", "warning", told, "ingest", suffix=F.col("stage")))
    conflicts = quality.metric_conflicts(tables["metrics"], ["scope", "scope_id", "name", "definition_id"])
    out.append(quality.findings(tag(conflicts), "metric_conflict", "warning", F.concat(F.lit("sources differ, from "), F.col("lowest").cast("string"), F.lit(" to "), F.col("highest").cast("string")),
                                "reconciliation", run=F.when(F.col("scope") == "run", F.col("scope_id")), suffix=F.concat_ws(":", "scope", "scope_id", "name")))
    if docs is not None:
        out.append(samples.flags_to_findings(tag(docs.filter("flags IS NOT NULL")), "flags", "dataset_id", "provenance flags"))
    out.append(quality.findings(tag(excluded), "excluded_from_search", "info", F.concat(F.lit("left out of the search: "), F.coalesce("reason", F.lit("no reason given"))), "provenance", suffix=F.col("name")))
    names_of = ident.unmatched_names(raw.select(F.col("File Name").alias("f")), "f", names, "name")
    out.append(quality.findings(tag(listed(names_of, "reported")), "unmatched_runs", "warning", text("reported run name(s) match no deposited file"), "ingest"))
    unresolved = ident.unresolved_counts(raw.select(first_alternative("Full Sequence").alias("q")), "q", forms)
    out.append(quality.findings(tag(listed(unresolved, "name")), "unresolved_modifications", "warning", text("modification name(s) have neither accession nor mass"), "ingest"))
    out.append(quality.findings(tag(listed(found.filter("label_fallback"), "protein_accession")), "contaminant_label_unresolved", "warning", text("protein(s) took their row's label"), "ingest"))
    if sheet_status == "absent":
        out.append(quality.findings(_frame(spark, [(s.dataset_id,)], "dataset_id string"), "no_sdrf", "warning", F.lit("no sample sheet: every sample is synthetic"), "ingest"))
    elif sheet_status in ("partial", "unmatched"):
        seen = unsearched.agg(F.count("*").alias("n"), F.coalesce(F.min("run_id"), F.lit("none")).alias("e"))
        out.append(quality.findings(tag(seen), f"sdrf_{sheet_status}", "warning", text("file(s) of the sheet were not searched"), "ingest"))
    if sheet_status in ("trusted", "partial"):
        curated = tables["samples"].agg(F.max(F.coalesce("organism_part", "cell_type", "disease", "individual_id").isNotNull()).alias("any")).filter("NOT any")
        uncoded = samples.uncoded_annotation(tables["sample_characteristics"].withColumn("dataset_id", d), ["dataset_id"], P.ANNOTATION_CHARACTERISTICS) \
            .groupBy("dataset_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat("characteristic", F.lit(": "), F.array_join("examples", ", ")))), "; ").alias("text"))
        told = tag(curated).join(uncoded, "dataset_id", "left")
        code = F.when(F.col("text").isNull(), F.lit("sdrf_skeleton")).otherwise(F.lit("sdrf_uncoded"))
        out.append(quality.findings(told, code, "warning", F.coalesce("text", F.lit("the sheet holds no biological annotation")), "ingest"))
    if s.mixed_enrichment or len(set(s.run_enrichment.values())) > 1:
        split = samples.enrichment_split(tables["runs"], ["dataset_id"]).groupBy("dataset_id").agg(
            F.array_join(F.array_sort(F.collect_list(F.concat(F.coalesce("value", F.lit("unknown")), F.lit(": "), F.col("n_runs").cast("string")))), "; ").alias("text"))
        out.append(quality.findings(split, "mixed_enrichment", "warning", F.col("text"), "ingest"))
    out.append(quality.findings(tag(unplaced.groupBy().agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_list("reason")), ", ").alias("e")).filter("n > 0")),
                                "unplaced_ptm_sites", "warning", text("match and protein pair(s) could not be placed"), "ingest"))
    verified = sites.verify_positions(tables["ptm_sites"], "protein_accession", "position", "residue", _sequences_of(spark, s)).filter("outcome IN ('wrong_residue', 'beyond_length')") if s.databases else None
    if verified is not None:
        out.append(quality.findings(tag(verified.agg(F.sum("n").alias("n")).filter("n > 0")), "ptm_site_residue_mismatch", "warning", n_text("site(s) name a residue that is not there"), "ingest"))
    total = collapsed.agg(F.sum("n").alias("n"), F.sum("dropped").alias("dropped")).filter("n > 0")
    out.append(quality.findings(tag(total), "collapsed_duplicate_rows", "info", F.concat(F.col("n").cast("string"), F.lit(" identifier(s) were written more than once, alike in every column")), "integrity"))
    decoys, others = lost.filter("reason = 'decoy group'"), lost.filter(~F.col("reason").isin("decoy group", UNPARSED, CUT))
    out.append(quality.findings(tag(decoys), "occupancy_decoy_groups", "info", n_text("entries of decoy groups"), "ingest"))
    text_left = lost.filter((F.col("reason") == UNPARSED) & (F.col("n") > 0))
    out.append(quality.findings(tag(text_left), "occupancy_cells_unparsed", "warning", n_text("cell segment(s) hold text that is no entry"), "ingest"))
    cut = lost.filter((F.col("reason") == CUT) & (F.col("n") > 0))
    out.append(quality.findings(tag(cut), "occupancy_cells_truncated", "error", n_text("occupancy cell(s) were cut by the producer, and every site in them is missing"), "ingest"))
    why = others.agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_list(F.concat(F.col("n").cast("string"), F.lit(" "), "reason"))), "; ").alias("e")).filter("n > 0")
    out.append(quality.findings(tag(why), "occupancy_not_stored", "warning", F.col("e"), "ingest"))
    if s.quant_method != "label-free" and s.groups:
        out.append(quality.findings(_frame(spark, [(s.dataset_id,)], "dataset_id string"), "occupancy_not_ingested", "info", F.lit("occupancy is stored for label-free searches only"), "ingest"))
    return quality.union_all(out)


def _sequences_of(spark: SparkSession, s: Search) -> DataFrame:
    return read_databases(spark, s.databases).select("accession", "sequence")


def verify_databases(spark: SparkSession, s: Search) -> None:
    """Stop where a database is not the one that the search recorded: its sites would be placed in sequences that the
    engine never saw. A database that the record does not name, or names without a digest, passes."""
    if not s.provenance or not s.databases:
        return
    inputs = files.read_json_documents(spark, s.provenance, P.PROVENANCE_SCHEMA).select(F.explode("inputs").alias("i")).select("i.*")
    recorded = files.searched_databases(inputs, [], "path", "sha256")
    known = _frame(spark, [(p, s.recorded_digests[p]) for p in s.databases if p in s.recorded_digests], "path string, sha256 string")
    if unread := [p for p in s.databases if p not in s.recorded_digests]:
        known = known.unionByName(files.file_digests(spark, unread, whole=True).select("path", "sha256"))
    _, changed = samples.unchanged_lineage(recorded, "database", "sha256", known.withColumn("name", file_name("path")), "name", "sha256")
    if rows := changed.orderBy("database").collect():  # a few databases a search
        raise quality.GateRefused("; ".join(f"{r['database']} is not the database that was searched: recorded {r['sha256']}, found {r['actual']}" for r in rows))


def ingest(spark: SparkSession, s: Search, store: str) -> str:
    """Write the search's snapshot under ``store`` and return its folder. Unchanged inputs give the
    snapshot that is already there; a failed check, or another database than the searched one, writes nothing."""
    paths = [("matches", s.matches), ("peptides", s.peptides), ("groups", s.groups), ("peptide_quant", s.peptide_quant), ("peaks", s.peaks), ("report", s.report), ("sheet", s.sheet),
             ("fetch", s.fetch), ("qc", s.qc), ("provenance", s.provenance), *(("database", p) for p in s.databases), *(("modifications", p) for p in s.modification_lists),
             *(("upstream", p) for p in s.upstream)]
    inputs = sorted({(role, p) for role, p in paths if p})
    digests = materialise(files.role_digests(spark, inputs, s.recorded_digests), "digests")
    found = {(r["role"], r["path"]) for r in digests.select("role", "path").collect()}  # one row an input
    if missing := [f"{role} {p}" for role, p in inputs if (role, p) not in found]:
        raise ValueError(f"no file to take a digest of: {', '.join(missing)}")
    prose = ("title", "organism", "acquisition", "quant_method", "labelling", "enrichment", "mixed_enrichment", "run_enrichment", "expected_files", "engine", "engine_version", "regime", "policy", "search_label", "declared_lists", "notes")
    stated = _frame(spark, [(s.dataset_id, *(json.dumps(getattr(s, k), sort_keys=True, default=list) for k in prose))], "dataset_id string, " + ", ".join(f"{k} string" for k in prose))
    content = declaration_digest(stated, ["dataset_id"], prose).select(F.lit("declaration").alias("role"), F.lit("").alias("path"), "sha256")
    sources = digests.unionByName(content).withColumn("dataset_id", F.lit(s.dataset_id))
    identity = snapshot_id(sources, ["dataset_id"], ["ingest/2", f"schema/{S.SCHEMA_VERSION}", s.dataset_id], order=["role", "path"]).first()["snapshot_id"]
    folder = f"{store}/{s.dataset_id}"
    if path_exists(spark, f"{folder}/{identity}/bundle.json"):
        return f"{folder}/{identity}"
    verify_databases(spark, s)
    tables, _ = ingest_tables(spark, s)
    manifest = {"dataset_id": s.dataset_id, "written_utc": spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss\") AS t").first()["t"]}
    entries = read_databases(spark, s.databases).groupBy(F.col("database").alias("name")).agg(F.count("*").alias("entries")) if s.databases else _frame(spark, [], "name string, entries bigint")
    databases = digests.where("role = 'database'").join(entries, files.file_name("path") == F.col("name"), "left").select("path", "sha256", F.coalesce("entries", F.lit(0).cast("bigint")).alias("entries"))
    lists = {"sources": sources.select("role", "path", "sha256"), "databases": databases, "notes": _frame(spark, [(n,) for n in s.notes], "note string")}
    write_snapshot(spark, tables, folder, identity, manifest, bundle_checks(tables), {n: cols for n, cols in S.IDENTIFIERS.items()}, lists)
    return f"{folder}/{identity}"
