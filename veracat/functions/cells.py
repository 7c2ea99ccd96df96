"""Expressions that read one producer cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What "absent" looks like in a sample sheet.
RESERVED_WORDS = ["", "not available", "not applicable", "na", "n/a", "unknown", "none"]

# What calibration appends to a run name, and the spectra extensions a match reader
# deletes wherever they stand in the name, in the order it deletes them.
RUN_SUFFIXES = ["-calib", "-averaged", "-calibrated"]
SPECTRA_EXTENSIONS = [".raw", ".mzML", ".mgf", ".d", "ms1.msalign", "ms2.msalign"]

_BLANKS = " \t\n\r\x0b\x0c"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    return F.btrim(col(c), F.lit(_BLANKS))


def quote(literal: str) -> str:
    """A literal as a Java regular expression."""
    return "\\Q" + literal + "\\E"


def verbatim(c: str | Column) -> Column:
    """The cell as written, NULL when blank."""
    return F.nullif(strip(c), F.lit(""))


def null_if_empty(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def first_alternative(c: str | Column, sep: str = "|") -> Column:
    return strip(_first_part(col(c), sep))


def _first_part(c: Column, sep: str) -> Column:
    """Most cells hold one alternative, and to look for a separator is cheaper than to split."""
    return F.when(F.contains(c, F.lit(sep)), F.split_part(c, F.lit(sep), F.lit(1))).otherwise(c)


def lenient_float(c: str | Column) -> Column:
    """The first alternative as a number; unparsable text and NaN are absent. A cast passes over blanks itself, so only
    what it cannot read is stripped."""
    first = _first_part(col(c), "|")
    return F.nanvl(F.coalesce(first.try_cast("double"), strip(first).try_cast("double")), F.lit(None).cast("double"))


def lenient_int(c: str | Column) -> Column:
    """As ``lenient_float``, truncated: a direct cast of "3.0" to BIGINT would be NULL."""
    return lenient_float(c).try_cast("bigint")


def number(c: str | Column) -> Column:
    """A whole cell as a number, where zero is a value."""
    value = strip(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def measured(c: str | Column) -> Column:
    """A whole cell as a number, where zero means it was not measured."""
    return F.nullif(number(c), F.lit(0.0))


def split_list(c: str | Column, sep: str = "|") -> Column:
    """Trimmed entries, blanks dropped; an empty array for a blank or NULL cell."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), quote(sep)), strip)
    return F.filter(parts, lambda x: x != "")


def align_list(c: str | Column, n: Column, sep: str = "|") -> Column:
    """One value per entry of a list of ``n``: paired when the counts agree, repeated when the cell
    holds one value, all NULL otherwise. An alignment is never guessed."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), quote(sep)), verbatim)
    nulls = F.array_repeat(F.lit(None).cast("string"), n.cast("int"))
    return (
        F.when(F.size(parts) == n, parts)
        .when(F.size(parts) == 1, F.array_repeat(F.get(parts, F.lit(0)), n.cast("int")))
        .otherwise(nulls)
    )


def primary_symbol(c: str | Column) -> Column:
    """``primary:A, synonym:B`` to ``A``."""
    head = F.split_part(col(c), F.lit(","), F.lit(1))
    return verbatim(F.replace(head, F.lit("primary:"), F.lit("")))


def _pieces(c: Column) -> Column:
    return F.split(c, ";")


def _value_of(piece: Column) -> Column:
    return strip(F.substr(piece, F.instr(piece, "=") + F.lit(1)))


def _key_of(piece: Column) -> Column:
    return F.upper(strip(F.split_part(piece, F.lit("="), F.lit(1))))


def cell_value(c: str | Column, key: str) -> Column:
    """The last ``KEY=value`` of a cell; a plain cell, or a bare piece, is its ``NT``."""
    text = strip(F.coalesce(col(c), F.lit("")))
    pairs = F.filter(_pieces(text), lambda p: F.contains(p, F.lit("=")) & (_key_of(p) == key))
    found = F.when(F.size(pairs) > 0, _value_of(F.get(pairs, F.size(pairs) - 1)))
    if key != "NT":
        return found
    bare = F.filter(_pieces(text), lambda p: ~F.contains(p, F.lit("=")) & (strip(p) != ""))
    return F.when(~F.contains(text, F.lit("=")), text).otherwise(
        F.coalesce(found, strip(F.get(bare, F.lit(0))))
    )


def parse_key_value_cell(c: str | Column) -> Column:
    """``NT=..;AC=..`` as a map. A repeated key keeps its last value, a bare piece fills NT."""
    text = strip(F.coalesce(col(c), F.lit("")))
    keyed = F.filter(_pieces(text), lambda p: F.contains(p, F.lit("=")))
    # str_to_map refuses repeated keys, so an earlier entry makes room for a later one.
    pairs = F.aggregate(
        keyed,
        F.create_map().cast("map<string,string>"),
        lambda m, p: F.map_concat(
            F.map_filter(m, lambda k, _: k != _key_of(p)), F.create_map(_key_of(p), _value_of(p))
        ),
    )
    name = cell_value(text, "NT")
    rest = F.map_filter(pairs, lambda k, _: k != "NT")
    return F.when(name.isNull(), pairs).otherwise(F.map_concat(F.create_map(F.lit("NT"), name), rest))


def reserved_word(c: str | Column) -> Column:
    return F.lower(strip(F.coalesce(col(c), F.lit("")))).isin(RESERVED_WORDS)


def clean(c: str | Column) -> Column:
    """The trimmed cell, NULL when it is a reserved word or blank."""
    return F.when(~reserved_word(c), strip(c))


def cell_name(c: str | Column) -> Column:
    return clean(cell_value(c, "NT"))


def cell_term(c: str | Column) -> Column:
    """The accession of a cell; a reserved word there is no accession."""
    return clean(cell_value(c, "AC"))


def digits(c: str | Column) -> Column:
    """A cleaned cell as a number, only when it holds nothing but digits."""
    text = clean(c)
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def strip_run_suffixes(c: str | Column) -> Column:
    any_suffix = "|".join(quote(s) for s in RUN_SUFFIXES)
    return F.regexp_replace(col(c), f"(?:{any_suffix})+$", "")


def delete_extensions(c: str | Column) -> Column:
    """A run name as a match reader reports it: extensions deleted anywhere, then the last path part."""
    out = col(c)
    for extension in SPECTRA_EXTENSIONS:
        out = F.regexp_replace(out, "(?i)" + quote(extension), "")
        out = F.regexp_replace(out, r"(?s)^.*[\\/]", "")
    return out


def file_name(c: str | Column) -> Column:
    return F.regexp_replace(col(c), r"(?s)^.*[\\/]", "")


def file_stem(c: str | Column) -> Column:
    """The file name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(file_name(c), r"(?<=.)\.[^.]*$", "")


_RANGE = r"\[(\d+)\s+to\s+(\d+)\]"


def residue_range(c: str | Column) -> Column:
    """The first ``[a to b]`` as a struct (start, end)."""
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(F.coalesce(col(c), F.lit("")), _RANGE, i), F.lit("")).cast("bigint")

    return F.struct(part(1).alias("start"), part(2).alias("end"))


def all_starts(c: str | Column) -> Column:
    """Every range's start, in order. It is not aligned with any other list of the row."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(_RANGE), F.lit(1))
    return F.transform(found, lambda x: x.cast("bigint"))


def extract_tags(c: str | Column) -> Column:
    return F.regexp_extract_all(col(c), F.lit(r"\[([^\]]*)\]"), F.lit(1))


def after_last(c: str | Column, sep: str) -> Column:
    """The text after the last ``sep``, NULL when the separator is missing."""
    return F.when(F.contains(col(c), F.lit(sep)), F.split_part(col(c), F.lit(sep), F.lit(-1)))


def map_key_suffixes(m: str | Column) -> Column:
    """Distinct text after the last ``/`` of each map key, in key order."""
    def suffix(k: Column) -> Column:
        tail = F.split_part(k, F.lit("/"), F.lit(-1))
        return strip(F.when(tail == "", k).otherwise(tail))

    keys = F.map_keys(F.coalesce(col(m), F.create_map().cast("map<string,bigint>")))
    return F.array_distinct(F.filter(F.transform(keys, suffix), lambda x: x != ""))


def tri_state(c: str | Column) -> Column:
    """``true``/``false``; blank is unknown. Use ``tri_state_bad`` to refuse other text."""
    return F.when(col(c) == "true", True).when(col(c) == "false", False)


def tri_state_bad(c: str | Column) -> Column:
    return F.coalesce(~col(c).isin("", "true", "false"), F.lit(False))


def cell_count(line: str | Column, sep: str = "\t") -> Column:
    return F.size(F.split(col(line), quote(sep)))
