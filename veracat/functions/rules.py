"""Expressions that decide something: labels, ranks, types and identifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracat.functions.cells import cell_name, col, strip

# Ambiguity levels, best first.
AMBIGUITY_LEVELS = ["1", "2A", "2B", "2C", "2D", "3", "4", "5"]

# Detection labels of the quantity tables.
DETECTION_TYPES = {
    "MSMS": "MSMS",
    "MBR": "MBR",
    "MSMSAmbiguousPeakfinding": "MSMS",
    "MSMSIdentifiedButNotQuantified": "not_detected",
    "NotDetected": "not_detected",
}

# Terms for the organisms and sexes a sheet may name without an accession.
ORGANISM_TERMS = {
    "homo sapiens": "NCBITaxon:9606",
    "mus musculus": "NCBITaxon:10090",
    "rattus norvegicus": "NCBITaxon:10116",
}
SEX_TERMS = {"male": "PATO:0000384", "female": "PATO:0000383"}

# Quantification spellings, and instrument name fragments by vendor, tried in order.
QUANT_METHODS = {
    "label-free": "label_free",
    "label free": "label_free",
    "labelfree": "label_free",
    "lfq": "label_free",
    "tmt": "isobaric",
    "itraq": "isobaric",
    "silac": "metabolic",
}
VENDOR_FRAGMENTS = [
    ("Thermo", ["q exactive", "orbitrap", "lumos", "eclipse", "astral", "exploris", "velos", "elite", "ltq"]),
    ("Bruker", ["timstof", "maxis", "impact"]),
    ("SCIEX", ["triple tof", "tripletof", "qtrap", "zenotof"]),
    ("Waters", ["synapt", "xevo"]),
]

# How far a pipeline flag lowers trust; any other flag is a warning.
FLAG_SEVERITY = {
    "low_id_rate": "warning",
    "no_design_file": "warning",
    "no_output_sdrf": "info",
    "old_provenance_schema": "error",
}

DECOY_PREFIX = "DECOY_"

# File suffixes of protein databases.
DATABASE_SUFFIXES = [".xml", ".xml.gz", ".fasta", ".fasta.gz", ".fa"]


def literal_map(pairs: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def lookup_term(c: str | Column, pairs: Mapping[str, object], default: Column | None = None) -> Column:
    """A small literal dictionary; keys are lower case."""
    found = F.try_element_at(literal_map(pairs), F.lower(strip(c)))
    return found if default is None else F.coalesce(found, default)


def first_fragment(c: str | Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The first rule one of whose fragments the text contains."""
    out = F.lit(None).cast("string")
    for value, fragments in reversed(rules):
        hit = F.lit(False)
        for fragment in fragments:
            hit = hit | F.contains(F.lower(col(c)), F.lit(fragment))
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def vendor_of(instruments: Column) -> Column:
    """The vendor of the first instrument any rule knows."""
    vendors = F.transform(instruments, lambda x: first_fragment(x, VENDOR_FRAGMENTS))
    return F.get(F.filter(vendors, lambda v: v.isNotNull()), F.lit(0))


def channel_label(c: str | Column) -> Column:
    name = cell_name(c)
    free = name.isNull() | F.contains(F.lower(name), F.lit("label free"))
    return F.when(free, F.lit("label_free")).otherwise(F.replace(name, F.lit(" "), F.lit("")))


def worst_label(c: str | Column) -> Column:
    """Decoy wins over contaminant, contaminant over target; blank reads as target."""
    text = F.upper(F.coalesce(col(c), F.lit("")))
    return (
        F.when(F.contains(text, F.lit("D")), F.lit("decoy"))
        .when(F.contains(text, F.lit("C")), F.lit("contaminant"))
        .otherwise(F.lit("target"))
    )


def worst_label_or_null(c: str | Column) -> Column:
    return F.when(F.length(col(c)) > 0, worst_label(c))


def is_decoy(accession: str | Column) -> Column:
    return F.startswith(col(accession), F.lit(DECOY_PREFIX))


def classify_source(accession: str | Column, contaminant: str | Column) -> Column:
    return (
        F.when(F.startswith(F.upper(col(accession)), F.lit(DECOY_PREFIX)), F.lit("decoy"))
        .when(F.coalesce(col(contaminant), F.lit(False)), F.lit("contaminants"))
        .otherwise(F.lit("uniprot"))
    )


def allowed_taxon(source: Column, organism: str | Column) -> Column:
    """The searched organism is evidence about the searched proteome and about nothing else."""
    return F.when(source == "uniprot", col(organism))


def canonical_accession(accession: str | Column) -> Column:
    return F.split_part(col(accession), F.lit("-"), F.lit(1))


def ambiguous_flag(c: str | Column, sep: str = "|") -> Column:
    text = strip(c)
    return F.when(text != "", F.contains(text, F.lit(sep)))


def level_rank(c: str | Column, levels: Sequence[str] = AMBIGUITY_LEVELS) -> Column:
    """Position in the ordered levels; an unknown level ranks last."""
    ranks = F.create_map(*[F.lit(x) for i, level in enumerate(levels) for x in (level, i)])
    return F.coalesce(F.try_element_at(ranks, col(c)), F.lit(len(levels)))


def site_type(
    n_terminal: Column, c_terminal: Column, start: Column, previous: Column, position: Column, length: Column
) -> Column:
    """What a modification sits on. A start of 2 behind an excised M is the protein's N-terminus; a
    C-terminal placement needs the protein's length and is NULL without it."""
    after_met = (start == 2) & (F.upper(strip(F.coalesce(previous, F.lit("")))) == "M")
    at_n = F.when((start == 1) | after_met, F.lit("protein_n_term")).otherwise(F.lit("peptide_n_term"))
    at_c = F.when(position == length, F.lit("protein_c_term")).when(
        length.isNotNull(), F.lit("peptide_c_term")
    )
    return F.when(n_terminal, at_n).when(c_terminal, at_c).otherwise(F.lit("residue"))


def tag_class(tag: str | Column) -> tuple[Column, Column, Column]:
    """A bracket tag as (accession, mass shift, unresolved name); at most one is not NULL."""
    t = col(tag)
    return (
        F.when(F.startswith(t, F.lit("UNIMOD:")), t),
        F.when(t.rlike("^[+-][0-9]"), t.try_cast("double")),
        F.when(F.startswith(t, F.lit("Info:")), F.substr(t, F.lit(6))),
    )


def detection_type(c: str | Column) -> Column:
    return F.try_element_at(literal_map(DETECTION_TYPES), strip(c))


def database_role(path: str | Column) -> Column:
    """A property of the file: a contaminant panel says so in its path."""
    return F.when(col(path).rlike("(?i)contaminant|crap"), F.lit("contaminant")).otherwise(F.lit("target"))


def is_database(path: str | Column) -> Column:
    hit = F.lit(False)
    for suffix in DATABASE_SUFFIXES:
        hit = hit | F.endswith(F.lower(col(path)), F.lit(suffix))
    return hit


def canonical_key(members: str | Column, prefix: Column | None = None) -> Column:
    joined = F.concat_ws(";", F.array_sort(col(members)))
    return joined if prefix is None else F.concat(prefix, F.lit(":"), joined)


def mint_identifier(dataset: Column, run: Column, scan: Column, form: Column, charge: Column) -> Column:
    """A spectrum identifier, NULL when any part is missing; ``concat`` spreads the NULL."""
    return F.when(
        form != "",
        F.concat(
            F.lit("mzspec:"), dataset, F.lit(":"), run, F.lit(":scan:"), scan.cast("string"),
            F.lit(":"), form, F.lit("/"), charge.cast("string"),
        ),
    )


def stoichiometry_state(
    intensity_total: Column, is_floor: Column, intensity_cell_unassigned: Column
) -> Column:
    """Nothing quantified, an intensity nobody could assign, a measured zero, or a number."""
    return (
        F.when(
            intensity_total.isNull(),
            F.when(F.coalesce(intensity_cell_unassigned, F.lit(False)), F.lit("intensity_unassigned"))
            .otherwise(F.lit("count_only")),
        )
        .when(is_floor, F.lit("floor"))
        .otherwise(F.lit("quantified"))
    )


def count_is_ceiling(numerator: Column, denominator: Column) -> Column:
    return numerator == denominator


def intensity_is_floor(fraction: Column, numerator: Column) -> Column:
    return (fraction == 0.0) & (numerator == 0.0)


def intensity_is_ceiling(fraction: Column) -> Column:
    return fraction == 1.0
