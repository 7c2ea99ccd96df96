"""Sample sheets, runs and the rules that tie them together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.functions.cells import (
    cell_name, cell_term, clean, digits, file_name, file_stem, reserved_word, strip, strip_run_suffixes, verbatim,
)
from veracat.functions.rules import (
    FLAG_SEVERITY, ORGANISM_TERMS, QUANT_METHODS, SEX_TERMS, channel_label, literal_map, lookup_term, vendor_of,
)
from veracat.operators.identification import _as_col, examples, first_wins
from veracat.operators.quality import findings, union_all
from veracat.schema import ENRICHMENTS
from veracat.sources.files import sheet_cell


def _cell(name: str) -> Column:
    return F.coalesce(sheet_cell(name), F.lit(""))


def _usable(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_source", strip(_cell("source name"))).filter("_source <> ''")


def _sample_id(dataset: Column) -> Column:
    return F.concat(dataset, F.lit(":"), F.col("_source"))


def sheet_samples(rows: DataFrame, dataset_id: str | Column, default_organism: str | None = None) -> DataFrame:
    """One sample per source name, from its first row."""
    dataset = _as_col(dataset_id)

    def char(name: str) -> Column:
        return _cell(f"characteristics[{name}]")

    organism = F.coalesce(
        cell_term(char("organism")), lookup_term(cell_name(char("organism")), ORGANISM_TERMS), F.lit(default_organism)
    )
    sex = F.coalesce(cell_term(char("sex")), lookup_term(cell_name(char("sex")), SEX_TERMS))
    typed = _usable(rows).select(
        _sample_id(dataset).alias("sample_id"), dataset.alias("dataset_id"), F.col("_source").alias("source_name"),
        organism.alias("organism"), sex.alias("sex"), cell_term(char("organism part")).alias("organism_part"),
        cell_term(char("cell type")).alias("cell_type"), cell_term(char("disease")).alias("disease"),
        cell_name(char("disease")).alias("condition"),
        F.coalesce(cell_name(_cell("material type")), cell_name(char("material type"))).alias("material_type"),
        cell_name(char("cell line")).alias("cell_line"), cell_name(char("individual")).alias("individual_id"),
        digits(char("biological replicate")).alias("biological_replicate"), cell_name(char("time")).alias("timepoint"),
        "row_order",
    )
    return first_wins(typed, ["sample_id"], "row_order").drop("row_order")


def melt_sheet(rows: DataFrame, dataset_id: str | Column) -> DataFrame:
    """Every characteristic and factor cell of a sample's first row, verbatim. A column's own source
    column overrides the row's; a reserved word is kept and flagged."""
    dataset = _as_col(dataset_id)
    first = first_wins(
        _usable(rows).select(_sample_id(dataset).alias("sample_id"), "header", "cells", "row_order"), ["sample_id"], "row_order"
    )
    sources = F.map_from_entries(F.filter(
        F.transform(F.array_distinct("header"), lambda h: F.struct(h.alias("k"), F.get(
            F.reverse("cells"), F.array_position(F.reverse("header"), h) - 1).alias("v"))),
        lambda e: F.startswith(e["k"], F.lit("comment[")),
    ))
    pattern = r"(?i)^(?:characteristics|factor value)\[(.+)\]$"
    long = first.withColumn("_sources", sources).select(
        "sample_id", "_sources", F.explode(F.arrays_zip(F.col("header").alias("h"), F.col("cells").alias("c"))).alias("_p")
    ).select("sample_id", "_sources", strip("_p.h").alias("name"), strip("_p.c").alias("value")).filter(
        F.col("name").rlike(pattern) & (F.col("value") != "")
    )
    inner = strip(F.regexp_extract("name", pattern, 1))

    def beside(tail: str) -> Column:
        key = F.concat(F.lit("comment["), inner, F.lit(tail))
        return verbatim(F.try_element_at(F.col("_sources"), key))

    default = verbatim(F.try_element_at(F.col("_sources"), F.lit("comment[characteristics source]")))
    return long.select(
        "sample_id", "name", "value", reserved_word("value").alias("value_reserved"), cell_term("value").alias("term"),
        F.coalesce(beside(" source]"), default).alias("source"), beside(" source reference]").alias("source_reference"),
        beside(" source method]").alias("source_method"),
    )


def _run_name() -> Column:
    data_file = F.coalesce(clean(_cell("comment[data file]")), clean(_cell("assay name")))
    return strip_run_suffixes(file_stem(data_file))


def sheet_assays(rows: DataFrame, dataset_id: str | Column) -> DataFrame:
    dataset = _as_col(dataset_id)
    named = _usable(rows).withColumn("_run", _run_name()).filter("_run IS NOT NULL")
    channel = channel_label(_cell("comment[label]"))
    return named.select(
        F.concat(dataset, F.lit(":"), "_run", F.lit(":"), channel).alias("assay_id"),
        F.concat(dataset, F.lit(":"), "_run").alias("run_id"), channel.alias("channel"), _sample_id(dataset).alias("sample_id"),
    )


def run_facts(rows: DataFrame) -> DataFrame:
    """Facts a sheet states about a run; its last row wins."""
    named = _usable(rows).withColumn("run", _run_name()).filter("run IS NOT NULL")
    facts = named.select(
        "run", cell_name(_cell("comment[instrument]")).alias("instrument_model"),
        cell_term(_cell("comment[instrument]")).alias("instrument_term"),
        digits(_cell("comment[fraction identifier]")).alias("fraction"),
        digits(_cell("comment[technical replicate]")).alias("technical_replicate"),
        verbatim(_cell("comment[fraction identifier source]")).alias("fraction_source"),
        verbatim(_cell("comment[technical replicate source]")).alias("technical_replicate_source"),
        cell_name(_cell("comment[proteomics data acquisition method]")).alias("acquisition"), "row_order",
    )
    return first_wins(facts, ["run"], "row_order", last=True).drop("row_order")


def excluded_inputs(files: DataFrame, name: str, excluded: DataFrame, excluded_name: str) -> DataFrame:
    """Files that are not excluded, by name or by stem."""
    gone = excluded.select(file_name(excluded_name).alias("_gone")).filter("_gone <> ''").distinct()
    kept = files.join(gone, files[name] == gone["_gone"], "left_anti")
    stems = gone.select(file_stem("_gone").alias("_stem")).distinct()
    return kept.join(stems, file_stem(kept[name]) == stems["_stem"], "left_anti")


def build_runs(fetched: DataFrame, qc: DataFrame, facts: DataFrame, dataset_id: str | Column, excluded: DataFrame | None = None) -> DataFrame:
    """One run per file either list names.

    ``fetched``: (name, sha256, pride_checksum, category). ``qc``: (name, ms2, run_minutes, pass,
    fragmentation). ``facts``: see ``run_facts``. Facts are keyed on the stem.
    """
    dataset = _as_col(dataset_id)
    raw = fetched.filter(F.upper(F.coalesce("category", F.lit("RAW"))) == "RAW").select(
        file_name("name").alias("file_name"), "sha256", F.col("pride_checksum").alias("pride_checksum_sha1")
    )
    raw = raw.groupBy("file_name").agg(F.max("sha256").alias("sha256"), F.max("pride_checksum_sha1").alias("pride_checksum_sha1"))
    report = qc.select(F.col("name").alias("file_name"), F.col("ms2").alias("ms2_spectra"), "run_minutes",
                       F.col("pass").alias("qc_pass"), "fragmentation")
    runs = raw.join(report, "file_name", "full").filter("file_name <> ''")
    if excluded is not None:
        runs = excluded_inputs(runs, "file_name", excluded, "name")
    based = runs.withColumn("_base", file_stem("file_name"))
    return based.join(facts, based["_base"] == facts["run"], "left").select(
        F.concat(dataset, F.lit(":"), "_base").alias("run_id"), dataset.alias("dataset_id"), "file_name", "sha256",
        "pride_checksum_sha1", "fraction", "fraction_source", "technical_replicate", "technical_replicate_source",
        "fragmentation", "ms2_spectra", "run_minutes", "qc_pass", "instrument_model",
        F.lit(None).cast("timestamp").alias("acquisition_datetime"),
    )


def assign_run_attribute(runs: DataFrame, run: str, declared: Sequence[str], mixed: bool, given: DataFrame | None,
                         vocabulary: Sequence[str] = ENRICHMENTS) -> tuple[DataFrame, DataFrame]:
    """(runs with enrichment and enrichment_source, problems).

    ``given``: (run, value), or None when there is no map. Any problem refuses the assignment: a map
    must name every run and no other, with known and declared values, and may not contradict
    ``mixed``. Without a map the declaration holds for every run, unless the dataset is mixed.
    """
    text = "problem string, example string, n bigint"
    if given is None:
        value = F.lit(None).cast("array<string>") if mixed else F.array(*[F.lit(v) for v in declared]).cast("array<string>")
        source = F.lit(None).cast("string") if mixed else F.lit("dataset_declaration")
        return (runs.withColumn("enrichment", value).withColumn("enrichment_source", source),
                runs.sparkSession.createDataFrame([], text))
    pairs = given.select(F.col("run").alias("_run"), F.col("value").alias("_value"))
    joined = runs.join(pairs, runs[run] == pairs["_run"], "left")
    out = joined.withColumn("enrichment", F.when(F.col("_value").isNotNull(), F.array("_value"))) \
        .withColumn("enrichment_source", F.when(F.col("_value").isNotNull(), F.lit("manifest_run_enrichment"))).drop("_run", "_value")

    def report(bad: DataFrame, column: str, problem: str) -> DataFrame:
        return bad.agg(F.min(F.col(column).cast("string")).alias("example"), F.count("*").alias("n")).filter("n > 0") \
            .select(F.lit(problem).alias("problem"), "example", "n")

    names = runs.select(F.col(run).alias("_run")).distinct()
    problems = report(pairs.filter(~F.col("_value").isin(list(vocabulary))), "_value", "unknown value")
    problems = problems.unionByName(report(pairs.join(names, "_run", "left_anti"), "_run", "not a run"))
    problems = problems.unionByName(report(names.join(pairs, "_run", "left_anti"), "_run", "run without a value"))
    problems = problems.unionByName(report(pairs.filter(~F.col("_value").isin(["none", *declared])), "_value", "undeclared value"))
    if mixed:
        one = pairs.agg(F.count_distinct("_value").alias("n"), F.min("_value").alias("example")).filter("n = 1")
        problems = problems.unionByName(one.select(F.lit("mixed, but one value").alias("problem"), "example", "n"))
    return out, problems


def enrichment_split(runs: DataFrame, keys: Sequence[str], value: str = "enrichment") -> DataFrame:
    """(keys, value, n_runs); an unknown value is one row with NULL."""
    text = F.when(F.col(value).isNotNull(), F.concat_ws(", ", value))
    return runs.groupBy(*keys, text.alias("value")).agg(F.count("*").alias("n_runs"))


def scope_gate(assays: DataFrame, runs: DataFrame, key: str, sheet_present: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(kept assays, named but not searched, searched but not named, status row).

    Status is trusted, partial, unmatched or absent, from three counts.
    """
    searched = runs.select(key).distinct()
    named = assays.select(key).distinct()
    kept = assays.join(searched, key, "left_semi")
    unsearched = named.join(searched, key, "left_anti")
    unnamed = searched.join(named, key, "left_anti")
    kinds = union_all([f.select(F.lit(k).alias("kind")) for k, f in (("kept", kept), ("extra", unsearched), ("missing", unnamed))])
    counts = kinds.agg(
        F.count_if(F.col("kind") == "kept").alias("n_kept"), F.count_if(F.col("kind") == "extra").alias("n_unsearched"),
        F.count_if(F.col("kind") == "missing").alias("n_unnamed"),
    )
    status = (
        F.when(F.lit(not sheet_present), F.lit("absent")).when(F.col("n_kept") == 0, F.lit("unmatched"))
        .when((F.col("n_unsearched") > 0) | (F.col("n_unnamed") > 0), F.lit("partial")).otherwise(F.lit("trusted"))
    )
    return kept, unsearched, unnamed, counts.withColumn("status", status)


def synthetic_samples(unnamed: DataFrame, base: str, samples: DataFrame, dataset_id: str | Column, organism: str | None) -> DataFrame:
    """A sample per run without one; a taken identifier gets ``#run``. Nothing biological is invented."""
    dataset = _as_col(dataset_id)
    wanted = unnamed.select(F.col(base).alias("source_name"), F.concat(dataset, F.lit(":"), F.col(base)).alias("_id"))
    taken = samples.select(F.col("sample_id").alias("_taken")).distinct()
    marked = wanted.join(taken, F.col("_id") == F.col("_taken"), "left")
    return marked.select(
        F.when(F.col("_taken").isNotNull(), F.concat("_id", F.lit("#run"))).otherwise(F.col("_id")).alias("sample_id"),
        dataset.alias("dataset_id"), "source_name", F.lit(organism).cast("string").alias("organism"),
    )


def synthetic_assays(samples: DataFrame) -> DataFrame:
    run = F.concat("dataset_id", F.lit(":"), "source_name")
    return samples.select(F.concat(run, F.lit(":label_free")).alias("assay_id"), run.alias("run_id"), F.lit("label_free").alias("channel"), "sample_id")


def difference(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What only the left holds and what only the right holds, counting repeats."""
    return left.exceptAll(right), right.exceptAll(left)


def uncoded_annotation(characteristics: DataFrame, keys: Sequence[str], names: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` distinct usable values of each wanted characteristic."""
    name = F.lower(strip("name"))
    wanted = characteristics.filter(name.isin(list(names)) & ~reserved_word("value")).select(
        *keys, F.regexp_extract(name, r"\[(.+)\]$", 1).alias("characteristic"), strip("value").alias("value")
    )
    return examples(wanted, [*keys, "characteristic"], "value", n)


def sample_names(samples: DataFrame, characteristics: DataFrame, columns: Mapping[str, Sequence[str]], key: str = "sample_id") -> DataFrame:
    """Adds one name column per term column: the names under the best-ranked header that has any,
    joined with ``; ``. Two names under one header are both kept."""
    header = F.lower(strip("name"))
    ranks = [(h, column, i) for column, headers in columns.items() for i, h in enumerate(headers)]
    spec = F.create_map(*[x for h, column, i in ranks for x in (F.lit(h), F.struct(F.lit(column).alias("column"), F.lit(i).alias("rank")))])
    named = characteristics.withColumn("_h", F.try_element_at(spec, header)).filter("_h IS NOT NULL") \
        .select(key, F.col("_h.column").alias("column"), F.col("_h.rank").alias("rank"), cell_name("value").alias("_name")) \
        .filter("_name IS NOT NULL").distinct()
    per_rank = named.groupBy(key, "column", "rank").agg(F.array_join(F.array_sort(F.collect_set("_name")), "; ").alias("_names"))
    best = per_rank.groupBy(key).agg(*[
        F.min_by("_names", F.when(F.col("column") == c, F.col("rank"))).alias(c) for c in columns
    ])
    return samples.join(best, key, "left")


# ---------------------------------------------------------------- provenance

def provenance_record(docs: DataFrame, stage_fallback: Column, dataset_id: str | Column) -> DataFrame:
    """Flat columns of a provenance document, its heavy blocks as JSON text. A block may be read as
    text, which keeps it as written, or with a type."""
    text_blocks = {f.name for f in docs.schema if f.dataType.simpleString() == "string"}

    def block(name: str) -> Column:
        text = F.col(name) if name in text_blocks else F.to_json(name)
        return F.when(F.col(name).isNotNull() & (text != "{}"), text)

    def resource(key: str) -> Column:
        value = F.get_json_object("resources", f"$.{key}") if "resources" in text_blocks else F.col(f"resources.{key}")
        return value.try_cast("double")

    return docs.select(
        _as_col(dataset_id).alias("dataset_id"), F.coalesce(F.nullif("stage", F.lit("")), stage_fallback).alias("stage"),
        F.coalesce("schema", F.lit("")).alias("provenance_schema"), F.col("started_utc").try_cast("timestamp").alias("started_utc"),
        F.col("finished_utc").try_cast("timestamp").alias("finished_utc"), F.col("pipeline.repo").alias("pipeline_repo"),
        F.col("pipeline.commit").alias("pipeline_commit"), F.col("params_file.sha256").alias("params_sha256"),
        block("tools").alias("tools_json"), block("params").alias("params_json"),
        resource("wall_s").alias("wall_seconds"),
        resource("peak_rss_gib").alias("peak_rss_gib"), block("resources").alias("resources_json"),
        F.col("document_path").alias("original_path"), F.col("sha256").alias("original_sha256"),
    )


def layout_of(schema: str | Column, layouts: Mapping[str, int]) -> Column:
    """The field layout a provenance schema name stands for; NULL when it is not known, to be refused."""
    return F.try_element_at(literal_map(layouts), F.col(schema) if isinstance(schema, str) else schema)


def metric_rows(docs: DataFrame, ids: Sequence[str], fields: Mapping[str, Column | str], definitions: DataFrame) -> DataFrame:
    """(ids, name, value, definition_id, source): one row per field that has a value.

    ``definitions``: (name, layout, definition_id, source). The definition of a name may depend on
    the document's layout; a NULL layout there means any.
    """
    cells = F.array(*[
        F.struct(F.lit(name).alias("name"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("value")) for name, c in fields.items()
    ])
    has_layout = "layout" in docs.columns
    layout = F.col("layout") if has_layout else F.lit(None).cast("int")
    long = docs.select(*ids, layout.alias("_layout"), F.explode(cells).alias("_m")).filter("_m.value IS NOT NULL") \
        .select(*ids, "_layout", F.col("_m.name").alias("_name"), F.col("_m.value").alias("value"))
    match = (F.col("_name") == F.col("name")) & (F.col("layout").isNull() | (F.col("layout") == F.col("_layout")))
    return long.join(definitions, match).select(*ids, "name", "value", "definition_id", "source")


def flags_to_findings(docs: DataFrame, flags: str, dataset: str, source: str) -> DataFrame:
    """One finding per ``code: detail`` flag."""
    rows = docs.select(dataset, F.explode(flags).alias("_flag"))
    code = strip(F.split_part("_flag", F.lit(":"), F.lit(1)))
    detail = strip(F.substr("_flag", F.length(F.split_part("_flag", F.lit(":"), F.lit(1))) + F.lit(2)))
    marked = rows.withColumn("_code", code).withColumn("_detail", detail)
    severity = F.coalesce(F.try_element_at(literal_map(FLAG_SEVERITY), F.col("_code")), F.lit("warning"))
    message = F.coalesce(F.nullif("_detail", F.lit("")), F.col("_flag"))
    return findings(marked, F.col("_code"), severity, message, source, dataset)


def definitions_used(definitions: DataFrame, users: Sequence[DataFrame], implied: Sequence[str] = ()) -> DataFrame:
    """Definitions some written row names, and the implied ones."""
    used = union_all([u.select("definition_id").distinct() for u in users])
    wanted = F.col("definition_id").isin(list(implied)) if implied else F.lit(False)
    return definitions.join(used.distinct().withColumn("_used", F.lit(True)), "definition_id", "left") \
        .filter(F.coalesce("_used", F.lit(False)) | wanted).drop("_used")


def unchanged_lineage(recorded: DataFrame, key: str, recorded_sha: str, actual: DataFrame, actual_key: str, actual_sha: str) -> tuple[DataFrame, DataFrame]:
    """(records whose file is still the recorded one, records whose file changed). A record without a
    digest is kept; a file that is gone is in neither."""
    on_disk = actual.select(F.col(actual_key).alias("_key"), F.col(actual_sha).alias("_sha"))
    joined = recorded.join(on_disk, recorded[key] == on_disk["_key"])
    same = F.coalesce(F.col(recorded_sha) == F.col("_sha"), F.lit(True))
    return joined.filter(same).select(*recorded.columns), joined.filter(~same).select(*recorded.columns, F.col("_sha").alias("actual"))


def dataset_row(declared: DataFrame, facts: DataFrame, inputs: DataFrame, label: Column, engine: str) -> DataFrame:
    """The dataset table's row: declared axes, what the sheets and the search recorded, and fallbacks.

    ``declared`` is keyed by dataset_id; ``facts``: (dataset_id, instrument_model); ``inputs``:
    (dataset_id, database, sha256).
    """
    instruments = facts.groupBy("dataset_id").agg(F.array_sort(F.collect_set("instrument_model")).alias("instruments"))
    first = inputs.select("dataset_id", F.col("database").alias("search_database"), F.col("sha256").alias("search_database_sha256"))
    joined = declared.join(instruments, "dataset_id", "left").join(first, "dataset_id", "left")
    return joined.withColumn("instrument_vendor", vendor_of(F.coalesce("instruments", F.array().cast("array<string>")))) \
        .withColumn("quant_method", lookup_term("quant_method", QUANT_METHODS, F.col("quant_method"))) \
        .withColumn("search_engine", F.lit(engine)) \
        .withColumn("search_engine_version", F.coalesce("recorded_version", "declared_version")) \
        .withColumn("searches", F.array(label)).drop("recorded_version", "declared_version")

