"""Ranks, first-wins, name resolution and the identification tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracat.functions.cells import (
    align_list, col, delete_extensions, first_alternative, lenient_float, lenient_int, number,
    primary_symbol, quote, residue_range, split_list, strip, strip_run_suffixes, verbatim,
)
from veracat.functions.rules import (
    allowed_taxon, ambiguous_flag, canonical_accession, canonical_key, classify_source, level_rank,
    mint_identifier, worst_label, worst_label_or_null,
)
from veracat.operators.ordering import ranked
from veracat.operators.quality import union_all
from veracat.session import materialise


def occurrence_rank(df: DataFrame, keys: Sequence[str], order: str | Column, name: str = "rank") -> DataFrame:
    """The nth row of a key in order. A key that holds a third of the table, or all of it, is ranked by as many tasks
    as it has ranges; see ``ordering.ranked``."""
    return ranked(df, keys, [order], name)


def first_wins(df: DataFrame, keys: Sequence[str], order: str | Column, last: bool = False) -> DataFrame:
    """The first (or last) row of each key. An aggregate and not a window: it combines per task, so
    one row per key and task is shuffled. ``order`` must not tie within a key."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    won = df.groupBy(*keys).agg(pick(F.struct(*rest), col(order)).alias("_row"))
    return won.select(*keys, "_row.*").select(*df.columns)


def count_by_key(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias(name))


def best_per_key(df: DataFrame, keys: Sequence[str], order: str | Column, minimums: Mapping[str, str] = {},
                 sets: Mapping[str, str] = {}, label: str | None = None, first: Sequence[str] = ()) -> DataFrame:
    """One row per key: minima, sets of distinct values, a label that is ``target`` when any row's is
    and the first row's otherwise, and the remaining attributes of the first row."""
    o = col(order)
    aggs = [F.min(c).alias(out) for out, c in minimums.items()]
    aggs += [F.array_sort(F.collect_set(c)).alias(out) for out, c in sets.items()]
    if label:
        aggs.append(
            F.when(F.max(F.col(label) == "target"), F.lit("target")).otherwise(F.min_by(label, o)).alias(label)
        )
    aggs += [F.min_by(c, o).alias(c) for c in first]
    return df.groupBy(*keys).agg(*aggs)


def site_rollup(df: DataFrame, keys: Sequence[str], q: str, label: str, level: str, order: str | Column,
                levels: Sequence[str] | None = None) -> DataFrame:
    """Matches per site: count, best q, ``target`` when any match is, and the best level. An unknown
    level ranks last; between two of one rank the first stays."""
    rank = level_rank(level) if levels is None else level_rank(level, levels)
    o = col(order)
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_matches"),
        F.min(q).alias("best_q_value"),
        F.when(F.max(F.col(label) == "target"), F.lit("target")).otherwise(F.min_by(label, o)).alias("target_decoy"),
        F.min_by(level, F.when(F.col(level).isNotNull(), F.struct(rank.alias("k"), o.alias("o")))).alias("best_level"),
    )


def stable_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A total order for reading out. When writing, prefer sorting inside partitions."""
    return df.orderBy(*keys)


def examples(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """The first ``n`` distinct values of each key in order, and how many more there are. The rank
    filter is applied before the shuffle as well, so no task gathers a whole group."""
    distinct = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    total = distinct.groupBy(*keys).agg(F.count("*").alias("_total"))
    w = Window.partitionBy(*keys).orderBy(value)
    top = distinct.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    shown = top.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("examples"))
    return shown.join(total, list(keys)).select(
        *keys, "examples", F.greatest(F.col("_total") - n, F.lit(0).cast("bigint")).alias("n_more")
    )


# ---------------------------------------------------------------- names

def name_map(reported: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """(reported, resolved) over the distinct names: the exact name, the name without calibration
    suffixes, then either as a match reader would mangle a known one. Two known names that mangle to
    one are left out, because a match there would be a guess. NULL where nothing matches."""
    names = known.select(F.col(known_column).alias("name")).filter("name IS NOT NULL").distinct()
    exact = names.groupBy(F.lower("name").alias("key")).agg(F.max("name").alias("name")).withColumn("kind", F.lit(0))
    mangled = (
        names.groupBy(F.lower(delete_extensions("name")).alias("key"))
        .agg(F.max("name").alias("name"), F.count("*").alias("n"))
        .filter("n = 1").drop("n").withColumn("kind", F.lit(1))
    )
    distinct = reported.select(F.col(column).alias("reported")).filter("reported IS NOT NULL").distinct()
    tries = F.array(*[
        F.struct(F.lit(i).alias("priority"), F.lit(kind).alias("kind"), F.lower(key).alias("key"))
        for i, (kind, key) in enumerate(
            [(0, F.col("reported")), (0, strip_run_suffixes("reported")),
             (1, F.col("reported")), (1, strip_run_suffixes("reported"))]
        )
    ])
    candidates = distinct.select("reported", F.explode(tries).alias("t")).select("reported", "t.*")
    return (
        candidates.join(exact.unionByName(mangled), ["kind", "key"], "left")
        .groupBy("reported")
        .agg(F.min_by("name", F.when(F.col("name").isNotNull(), F.col("priority"))).alias("resolved"))
    )


def resolve_names(rows: DataFrame, column: str, known: DataFrame, known_column: str, alias: str = "resolved") -> DataFrame:
    """The rows with what the name in ``column`` resolves to. The names are written before, so that their size is known
    when the join is planned, and the rows are not shuffled to meet a few."""
    mapping = materialise(name_map(rows, column, known, known_column).withColumnRenamed("resolved", alias), "names")
    return rows.join(mapping, rows[column] == mapping["reported"], "left").drop("reported")


def unmatched_names(rows: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """(reported, uses) of names nothing matched."""
    misses = name_map(rows, column, known, known_column).filter("resolved IS NULL").select("reported")
    uses = rows.groupBy(F.col(column).alias("reported")).agg(F.count("*").alias("uses"))
    return uses.join(misses, "reported", "left_semi")


# ---------------------------------------------------------------- entities

def database_status(entries: DataFrame, accession: str, role: str) -> DataFrame:
    """(accession, status): target, contaminant, or both."""
    has_c = F.max(F.col(role) == "contaminant")
    has_t = F.max(F.col(role) == "target")
    return entries.groupBy(F.col(accession).alias("accession")).agg(
        F.when(has_c & has_t, F.lit("both")).when(has_c, F.lit("contaminant")).otherwise(F.lit("target")).alias("status")
    )


# What each ambiguity policy makes of an accession in both kinds of database.
BOTH_POLICY = {"RemoveContaminant": False, "RemoveTarget": True}


def contaminant_by_database(status: Column, policy: str | None) -> Column:
    settled = F.lit(BOTH_POLICY.get(policy or "")).cast("boolean")
    return F.when(status == "both", settled).when(status == "contaminant", True).when(status == "target", False)


def entity_table(matches: DataFrame, columns: Mapping[str, str], order: str | Column, organism: str | Column,
                 databases: DataFrame | None = None, policy: str | None = None) -> DataFrame:
    """One row per accession at its first appearance.

    ``columns`` names accession, gene, organism_name and label. One label letter holds for every
    accession of the row; several are settled by the databases, and where those cannot say the row's
    worst letter is kept and ``label_fallback`` is set.
    """
    accs = split_list(columns["accession"])
    n = F.size(accs)
    letters = F.array_distinct(F.transform(split_list(columns["label"]), F.upper))
    rows = matches.select(
        col(order).alias("_o"),
        (worst_label(columns["label"]) == "contaminant").alias("_row_contaminant"),
        (F.size(letters) > 1).alias("_mixed"),
        F.posexplode(F.arrays_zip(
            accs.alias("acc"), align_list(columns["gene"], n).alias("gene"),
            align_list(columns["organism_name"], n).alias("organism_name"),
        )).alias("_pos", "_m"),
    ).select(
        "_o", "_row_contaminant", "_mixed", "_pos", F.col("_m.acc").alias("protein_accession"),
        F.col("_m.gene").alias("_gene"), F.col("_m.organism_name").alias("_organism_name"),
    )
    first = first_wins(rows.withColumn("_at", F.struct("_o", "_pos")).drop("_o", "_pos"), ["protein_accession"], "_at")
    if databases is None:
        first = first.withColumn("_decided", F.lit(None).cast("boolean")).withColumn("_mixed", F.lit(False))
    else:
        decided = databases.select(
            F.col("accession").alias("protein_accession"), contaminant_by_database(F.col("status"), policy).alias("_decided")
        )
        first = first.join(decided, "protein_accession", "left")
    decoy = classify_source("protein_accession", F.lit(False)) == "decoy"
    by_database = F.when(decoy, False).otherwise(F.coalesce("_decided", "_row_contaminant"))
    contaminant = F.when(F.col("_mixed"), by_database).otherwise(F.col("_row_contaminant"))
    source = classify_source("protein_accession", contaminant)
    return first.select(
        "protein_accession", canonical_accession("protein_accession").alias("canonical_accession"),
        primary_symbol("_gene").alias("gene"), allowed_taxon(source, _as_col(organism)).alias("organism"),
        F.when(source != "decoy", verbatim("_organism_name")).alias("organism_name"),
        source.alias("source_db"), contaminant.alias("is_contaminant"),
        (F.col("_mixed") & ~decoy & F.col("_decided").isNull()).alias("label_fallback"),
    )


def _as_col(value: str | Column | None) -> Column:
    return F.lit(value) if value is None or isinstance(value, str) else value


def expand_members(entities: DataFrame, groups: DataFrame, members: str, genes: str, label: str, order: str | Column,
                   organism: str | Column) -> DataFrame:
    """The entity table with every group member it lacks, at the member's first group."""
    accs = F.col(members)
    aligned = align_list(F.array_join(F.coalesce(genes, F.array()), "|", ""), F.size(accs))
    rows = groups.select(
        col(order).alias("_o"), (F.col(label) == "contaminant").alias("is_contaminant"),
        F.posexplode(F.arrays_zip(accs.alias("acc"), aligned.alias("gene"))).alias("_pos", "_m"),
    ).select("_o", "_pos", F.coalesce("is_contaminant", F.lit(False)).alias("is_contaminant"),
             F.col("_m.acc").alias("protein_accession"), F.col("_m.gene").alias("gene"))
    missing = rows.join(entities.select("protein_accession"), "protein_accession", "left_anti")
    first = first_wins(missing.withColumn("_at", F.struct("_o", "_pos")).drop("_o", "_pos"), ["protein_accession"], "_at")
    source = classify_source("protein_accession", "is_contaminant")
    added = first.select(
        "protein_accession", canonical_accession("protein_accession").alias("canonical_accession"), "gene",
        allowed_taxon(source, _as_col(organism)).alias("organism"), F.lit(None).cast("string").alias("organism_name"),
        source.alias("source_db"), "is_contaminant", F.lit(False).alias("label_fallback"),
    )
    return entities.unionByName(added)


# ---------------------------------------------------------------- row projections

def any_column(df: DataFrame, *names: str) -> Column:
    """The first of the named columns the file has, NULL when it has none."""
    for name in names:
        if name in df.columns:
            return F.col(f"`{name}`")
    return F.lit(None).cast("string")


def match_rows(matches: DataFrame, columns: Mapping[str, Sequence[str]], dataset_id: str | Column, runs: DataFrame,
               run_column: str, forms: DataFrame, search: str, order: str = "row_order") -> DataFrame:
    """The match table: one row per line of the match file, in its stored types.

    ``columns`` gives the names a role may have in the file. ``forms`` is the translation of distinct
    notations (notation, proforma, base_sequence). The rank of a row within (run, scan) is part of
    its identifier.
    """
    def get(role: str) -> Column:
        return any_column(matches, *columns[role])

    dataset = _as_col(dataset_id)
    span = residue_range(get("ranges"))
    typed = matches.select(
        F.col(order),
        F.coalesce(get("file"), F.lit("")).alias("_file"), lenient_int(get("scan")).alias("scan"),
        first_alternative(F.coalesce(get("full_sequence"), F.lit(""))).alias("notation"),
        lenient_int(get("charge")).alias("precursor_charge"), lenient_float(get("mz")).alias("precursor_mz"),
        lenient_float(get("retention_time")).alias("retention_time_min"), lenient_float(get("score")).alias("score"),
        lenient_float(get("delta_score")).alias("delta_score"), lenient_float(get("q_value")).alias("q_value"),
        lenient_float(get("q_value_notch")).alias("q_value_notch"), verbatim(get("notch")).alias("notch"),
        ambiguous_flag(get("notch")).alias("notch_ambiguous"), lenient_float(get("pep")).alias("pep"),
        lenient_float(get("pep_q_value")).alias("pep_q_value"), lenient_float(get("mass_diff_ppm")).alias("mass_error_ppm"),
        worst_label(get("label")).alias("target_decoy"), split_list(get("accession")).alias("protein_accessions"),
        F.nullif(first_alternative(get("ambiguity_level")), F.lit("")).alias("ambiguity_level"),
        lenient_int(get("missed_cleavages")).alias("missed_cleavages"),
        span["start"].alias("start_residue"), span["end"].alias("end_residue"),
    )
    named = resolve_names(typed, "_file", runs, run_column, "_run")
    keyed = named.withColumn("run_id", F.concat(dataset, F.lit(":"), F.coalesce("_run", "_file")))
    ranked = occurrence_rank(keyed, ["run_id", "scan"], order, "_rank")
    full = ranked.join(forms.select("notation", "proforma", "base_sequence"), "notation", "left")
    scan_text = F.coalesce(F.col("scan").cast("string"), F.lit("None"))
    return full.select(
        F.concat_ws(":", "run_id", scan_text, F.col("_rank").cast("string")).alias("psm_id"), "run_id", "scan",
        mint_identifier(dataset, F.col("_run"), F.col("scan"), F.col("proforma"), F.col("precursor_charge")).alias("usi"),
        F.col("proforma").alias("peptidoform"), "base_sequence", "precursor_charge", "precursor_mz", "retention_time_min",
        "score", "delta_score", "q_value", "q_value_notch", "notch", "notch_ambiguous", "pep", "pep_q_value",
        "mass_error_ppm", "target_decoy", "protein_accessions", "ambiguity_level",
        F.lit(None).cast("double").alias("localization_score"), F.lit(search).alias("search"), "missed_cleavages",
        F.lit(None).cast("bigint").alias("nonspecific_termini"), "start_residue", "end_residue",
        F.lit(None).cast("string").alias("matched_ion_series"), F.lit(None).cast("bigint").alias("matched_ion_count"),
    )


def link_to_existing_group(rows: DataFrame, members: str, groups: DataFrame, group_key: str, prefix: Column,
                           alias: str = "protein_group_id") -> DataFrame:
    """The group whose member set is this row's, when it exists. A link is never invented."""
    candidate = F.when(F.size(members) > 0, canonical_key(members, prefix))
    known = groups.select(F.col(group_key).alias(alias)).distinct()
    marked = rows.withColumn("_candidate", candidate)
    return marked.join(known, F.col("_candidate") == F.col(alias), "left").drop("_candidate")


def form_rows(peptides: DataFrame, columns: Mapping[str, Sequence[str]], dataset_id: str | Column, forms: DataFrame,
              match_counts: DataFrame, groups: DataFrame, order: str = "row_order") -> DataFrame:
    """The peptidoform table. ``match_counts`` is (peptidoform, n_psms)."""
    def get(role: str) -> Column:
        return any_column(peptides, *columns[role])

    dataset = _as_col(dataset_id)
    typed = peptides.select(
        F.col(order).alias("_o"), first_alternative(F.coalesce(get("full_sequence"), F.lit(""))).alias("notation"),
        split_list(get("accession")).alias("protein_accessions"), lenient_float(get("q_value")).alias("_q"),
        lenient_float(get("q_value_notch")).alias("_qn"), lenient_float(get("pep")).alias("_pep"),
        worst_label(get("label")).alias("target_decoy"),
    )
    # Lines are reduced to their notations before the join: one that much of the file holds is a row of each task.
    minimums = {c: c for c in ("_o", "_q", "_qn", "_pep")}
    per_notation = best_per_key(typed, ["notation"], "_o", minimums, label="target_decoy", first=["protein_accessions"])
    known = per_notation.join(forms.select("notation", "proforma", "base_sequence"), "notation").filter("proforma <> ''")
    best = best_per_key(
        known, ["proforma"], "_o", {"best_q_value": "_q", "best_q_value_notch": "_qn", "best_pep": "_pep"},
        {"engine_full_sequences": "notation"}, "target_decoy", ["base_sequence", "protein_accessions"],
    ).withColumnRenamed("proforma", "peptidoform")
    linked = link_to_existing_group(best, "protein_accessions", groups, "protein_group_id", dataset)
    return linked.join(match_counts, "peptidoform", "left").select(
        F.concat(dataset, F.lit(":"), "peptidoform").alias("peptidoform_id"), dataset.alias("dataset_id"), "peptidoform",
        "base_sequence", "best_q_value", "best_q_value_notch", "best_pep", "target_decoy",
        F.coalesce("n_psms", F.lit(0).cast("bigint")).alias("n_psms"), "protein_group_id", "protein_accessions",
        F.when(F.size("protein_accessions") > 0, F.size("protein_accessions") == 1).alias("is_unique"),
        F.lit(None).cast("boolean").alias("is_isoform_specific"), "engine_full_sequences",
    )


def group_rows(groups: DataFrame, columns: Mapping[str, str], dataset_id: str | Column) -> DataFrame:
    """The protein group table. Shared = all - unique, NULL when either is missing."""
    dataset = _as_col(dataset_id)
    accs = F.array_sort(split_list(columns["accession"]))
    total, unique = lenient_int(columns["n_peptides"]), lenient_int(columns["n_unique"])
    return groups.select(
        canonical_key(accs, dataset).alias("protein_group_id"), dataset.alias("dataset_id"), accs.alias("protein_accessions"),
        split_list(columns["gene"]).alias("genes"), worst_label_or_null(columns["label"]).alias("target_decoy"),
        number(columns["q_value"]).alias("q_value"), lenient_float(columns["coverage"]).alias("sequence_coverage"),
        unique.alias("unique_peptides"), (total - unique).alias("shared_peptides"),
    ).filter(F.size("protein_accessions") > 0)


def accepted_counts(rows: DataFrame, q: Column, label_is_target: Column, q_notch: Column | None = None,
                    notch_ambiguous: Column | None = None, threshold: float = 0.01, name: str = "n_accepted") -> DataFrame:
    """One number: rows the producer would count. The label cell must be the target letter itself."""
    ok = label_is_target & (q <= threshold)
    if q_notch is not None:
        ok = ok & F.coalesce(q_notch <= threshold, F.lit(True))
    if notch_ambiguous is not None:
        ok = ok & ~F.coalesce(notch_ambiguous, F.lit(False))
    return rows.agg(F.count_if(ok).alias(name))


def accepted_group_count(groups: DataFrame, label: str = "target_decoy", q: str = "q_value", threshold: float = 0.01) -> DataFrame:
    """As the accepted-group view, but a group without a label counts."""
    ok = ~F.coalesce(F.col(label) == "decoy", F.lit(False)) & (F.col(q) <= threshold)
    return groups.agg(F.count_if(ok).alias("n_accepted"))


def unpack_pairs(df: DataFrame, packed: str, keep: Sequence[str]) -> DataFrame:
    """``category TAB name`` pairs joined by double tabs, one row each with its residues."""
    rows = df.select(*keep, F.posexplode(F.split(packed, "\t\t")).alias("pair_position", "_pair")).filter(strip("_pair") != "")
    name = strip(F.substr("_pair", F.instr("_pair", "\t") + F.lit(1)))
    has_name = F.contains("_pair", F.lit("\t"))
    return rows.select(
        *keep, "pair_position", strip(F.split_part("_pair", F.lit("\t"), F.lit(1))).alias("category"),
        F.when(has_name, name).otherwise(F.lit("")).alias("name"),
    ).withColumn(
        "residues", F.coalesce(
            F.nullif(F.when(F.contains("name", F.lit(" on ")), F.element_at(F.split("name", quote(" on ")), -1)).otherwise(F.col("name")), F.lit("")),
            F.lit("unspecified"))
    ).filter("name <> ''")


def declared_modifications(pairs: DataFrame, registry_hits: DataFrame, order: str | Column) -> DataFrame:
    """First per (name, usage). ``registry_hits``: (name, accession)."""
    first = first_wins(pairs.withColumn("_o", col(order)).select("name", "usage", "residues", "_o"), ["name", "usage"], "_o")
    return first.join(registry_hits, "name", "left").select(F.col("accession").alias("modification"), "name", "residues", "usage")


def unresolved_counts(rows: DataFrame, notation: str, translation: DataFrame) -> DataFrame:
    """(name, uses): how often a row uses a name nothing resolved. The notation is counted before the
    join, so rows are not moved."""
    uses = rows.groupBy(F.col(notation).alias("notation")).agg(F.count("*").alias("n"))
    names = translation.select("notation", F.explode("unresolved").alias("name"))
    return uses.join(names, "notation").groupBy("name").agg(F.sum("n").alias("uses"))


def concat_matches(parts: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Several identification files as one, the first file's rows first: adds ``at``."""
    return union_all([
        p.select(*[any_column(p, c).alias(c) for c in columns], F.struct(F.lit(i).alias("part"), F.col("row_order").alias("row")).alias("at"))
        for i, p in enumerate(parts)
    ])
