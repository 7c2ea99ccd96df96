"""Readers for producer files.

Where a rule says "the first row wins", a reader adds ``row_order``: (file, block start, id). The id
rises inside a block and blocks are ordered by their offset, so the struct sorts as the file does
however the file was split. Compare it; never join on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracat.functions.cells import cell_count, file_name, split_list, strip
from veracat.functions.rules import database_role, is_database
from veracat.session import MANY_FILES, materialise, settings
from veracat.sources.digests import file_digests

ROW_ORDER = "row_order"


def file_row_order() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )


def plain_path(c: str) -> Column:
    """A local file's path without its scheme, which readers spell differently."""
    return F.regexp_replace(c, "^file:/*", "/")


def read_wide_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A TSV without quoting, every column text. Short rows are padded with NULL. A header of any width is read: its
    columns are counted first, from one line."""
    first = spark.read.text(path).limit(1).select(F.length(F.regexp_replace("value", "[^\t]", "")) + 1).first()
    reader = spark.read.option("sep", "\t").option("quote", "").option("header", True)
    reader = reader.option("mode", "PERMISSIVE").option("enforceSchema", False)
    return reader.option("maxColumns", max(20_480, first[0] if first else 0) + 1).csv(path)


def read_match_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """An identification file with its row order."""
    return read_wide_tsv(spark, path).withColumn(ROW_ORDER, file_row_order())


def read_lines(spark: SparkSession, path: str | list[str], line_sep: str | None = None) -> DataFrame:
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(path).select("value", file_row_order().alias(ROW_ORDER))


# Fixed formats: the counted lines of a search report. Groups: scope, name, count.
_REPORT_PATTERNS = [
    r"^(\S+) - Target (\w+(?: \w+)*) with q-value <= 0\.01.*?:\s*(\d+)",
    r"^()All target (\w+(?: \w+)*) with q-value <= 0\.01.*?:\s*(\d+)",
    r"^(\S+) - (MS2 Scans|Precursors):\s*(\d+)",
    r"^(?:(\S+) - )?All (MS2 Scans|Precursors):\s*(\d+)",
]


def report_counts(lines: DataFrame, value: str = "value", order: str = ROW_ORDER) -> DataFrame:
    """(scope, name, count) from report lines. The first pattern that matches a line reads it; the
    last line wins per (scope, name). Scope is "" for a total."""
    text = strip(value)

    def hit(pattern: str) -> Column:
        parts = [F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]
        return F.when(
            text.rlike(pattern),
            F.struct(parts[0].alias("scope"), parts[1].alias("what"), parts[2].alias("n")),
        )

    found = lines.select(F.col(order), F.coalesce(*[hit(p) for p in _REPORT_PATTERNS]).alias("h"))
    return (
        found.filter("h IS NOT NULL")
        .groupBy(
            F.col("h.scope").alias("scope"),
            F.replace(F.lower("h.what"), F.lit(" "), F.lit("_")).alias("name"),
        )
        .agg(F.max_by(F.col("h.n").cast("bigint"), F.col(order)).alias("count"))
    )


def read_report_counts(spark: SparkSession, path: str) -> DataFrame:
    return report_counts(read_lines(spark, path))


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(accession, sequence, row_order). ``sp|X|..`` and ``tr|X|..`` name X, else the first token."""
    records = read_lines(spark, path, line_sep="\n>")
    text = F.regexp_replace("value", r"^\s*>", "")
    header = F.split_part(text, F.lit("\n"), F.lit(1))
    token = F.regexp_extract(strip(header), r"^(\S*)", 1)
    parts = F.split(token, r"\|")
    accession = F.when(
        (F.size(parts) >= 3) & F.get(parts, F.lit(0)).isin("sp", "tr"), F.get(parts, F.lit(1))
    ).otherwise(token)
    body = F.substr(text, F.length(header) + F.lit(1))
    return (
        # Text in front of the first header is no record.
        records.filter(F.col("value").rlike(r"^\s*>") | (F.col("row_order.block") > 0) | (F.col("row_order.id") > 0))
        .select(
            accession.alias("accession"),
            F.upper(F.regexp_replace(body, r"\s+", "")).alias("sequence"),
            ROW_ORDER,
        )
        .filter("accession <> '' AND sequence <> ''")
    )


_ENTRY = T.StructType([
    T.StructField("accession", T.ArrayType(T.StringType())),
    T.StructField("sequence", T.StringType()),
])


def read_protein_xml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(accession, sequence) per ``<entry>``: its first accession and its direct sequence child.

    Spark reads an XML file in one task. Here it is text that ends a record at ``</entry>``, which any number of tasks
    read, and an entry is parsed by itself. Where a comment or a quoted section holds an end of an entry, Spark's reader
    is taken.
    """
    pieces = read_lines(spark, path, line_sep="</entry>").select(F.regexp_replace("value", r"(?s)<!--.*?-->", "").alias("value"))
    unquoted = F.regexp_replace("value", r"(?s)<!\[CDATA\[.*?\]\]>", "")
    if pieces.filter(F.contains(unquoted, F.lit("<!--")) | F.contains(unquoted, F.lit("<![CDATA["))).isEmpty():
        entry = F.nullif(F.regexp_extract("value", r"(?s)<entry(?:\s(?:[^>]*[^>/])?)?>.*", 0), F.lit(""))
        entries = pieces.select(F.from_xml(F.concat(entry, F.lit("</entry>")), _ENTRY.simpleString(), {"rowTag": "entry"}).alias("e")).select("e.*")
    else:
        entries = spark.read.format("xml").option("rowTag", "entry").schema(_ENTRY).load(path)
    return entries.select(
        strip(F.get("accession", F.lit(0))).alias("accession"),
        F.upper(F.regexp_replace("sequence", r"\s+", "")).alias("sequence"),
    ).filter("accession <> '' AND sequence <> ''")


# Residue words of the modification lists.
RESIDUE_WORDS = {
    "alanine": "A", "arginine": "R", "asparagine": "N", "aspartate": "D", "aspartic acid": "D",
    "cysteine": "C", "glutamate": "E", "glutamic acid": "E", "glutamine": "Q", "glycine": "G",
    "histidine": "H", "isoleucine": "I", "leucine": "L", "lysine": "K", "methionine": "M",
    "phenylalanine": "F", "proline": "P", "pyrrolysine": "O", "selenocysteine": "U", "serine": "S",
    "threonine": "T", "tryptophan": "W", "tyrosine": "Y", "valine": "V",
}


def residue_targets(c: Column) -> Column:
    """``K or N``, ``Methionine.`` or a motif to distinct one-letter residues."""
    words = F.create_map(*[F.lit(x) for kv in RESIDUE_WORDS.items() for x in kv])
    parts = F.transform(F.split(F.regexp_replace(strip(c), r"\.+$", ""), r"\s+or\s+|,"), strip)
    letters = F.transform(
        parts,
        lambda p: F.coalesce(
            F.try_element_at(words, F.lower(p)),
            F.when(p.rlike(r"^\p{L}+$"), F.upper(F.substr(p, F.lit(1), F.lit(1)))),
        ),
    )
    return F.array_sort(F.array_distinct(F.filter(letters, lambda x: x.isNotNull())))


def modification_entries(blocks: DataFrame, value: str = "value", order: str = ROW_ORDER) -> DataFrame:
    """(name, targets, unimod, mass, entry_order) from ``ID/TG/MM/DR`` blocks already cut at ``//``.

    A second ``ID`` line inside a block ends the entry before it.
    """
    pieces = F.split(F.col(value), r"(?m)^ID   ")
    lead = F.get(pieces, F.lit(0))
    entries = blocks.select(
        F.col(order).alias("_order"), lead.alias("_lead"),
        F.posexplode(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))).alias("_pos", "_entry"),
    )
    # Lines in front of a block's first ID still describe that entry.
    text = F.when(F.col("_pos") == 0, F.concat("_lead", F.lit("\n"), F.substr("_entry", F.instr("_entry", "\n") + 1))) \
        .otherwise(F.col("_entry"))

    def last(pattern: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        return F.get(found, F.size(found) - 1)

    return entries.select(
        strip(F.split_part("_entry", F.lit("\n"), F.lit(1))).alias("name"),
        residue_targets(F.coalesce(last(r"(?m)^TG   (.*)$"), F.lit(""))).alias("targets"),
        last(r"(?mi)^DR\s+Unimod;\s*(\d+)").cast("bigint").alias("unimod"),
        strip(last(r"(?m)^MM   (.*)$")).try_cast("double").alias("mass"),
        F.struct("_order", "_pos").alias("entry_order"),
    ).filter("name <> ''")


def read_modification_list(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every entry of the files, with ``file_rank`` first in the entry order as the files are listed."""
    out = None
    for rank, path in enumerate(paths):
        # A record after slashes begins with the rest of their line, which belongs to no block. A file's first
        # record has none before it and begins with an entry, whichever file of the folder it is.
        blocks = read_lines(spark, path, line_sep="\n//").withColumn(
            "value", F.when(F.col("value").rlike("^\ufeff?ID   "), F.regexp_replace("value", "^\ufeff", "")).otherwise(
                F.regexp_replace("value", r"^[^\n]*\n?", ""))
        )
        part = modification_entries(blocks).withColumn(
            "entry_order", F.struct(F.lit(rank).alias("rank"), F.col("entry_order").alias("at"))
        )
        out = part if out is None else out.unionByName(part)
    return out


def sheet_rows(lines: DataFrame, value: str = "value", order: str = ROW_ORDER) -> DataFrame:
    """(file, row_order, header, cells): a sheet by position, because a header may repeat."""
    cells = lines.filter(strip(value) != "").select(
        F.col(f"{order}.file").alias("file"), F.col(order).alias(ROW_ORDER),
        F.split(F.regexp_replace(value, "^﻿|\r$", ""), "\t").alias("cells"),
    )
    header = cells.groupBy("file").agg(
        F.min_by("cells", ROW_ORDER).alias("header"), F.min(ROW_ORDER).alias("_first")
    )
    padding = F.array_repeat(F.lit(""), F.greatest(F.size("header") - F.size("cells"), F.lit(0)))
    return (
        cells.join(header, "file")
        .filter(F.col(ROW_ORDER) > F.col("_first"))
        .select("file", ROW_ORDER, "header", F.concat("cells", padding).alias("cells"))
    )


def read_sample_sheet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return sheet_rows(read_lines(spark, path))


def sheet_cell(name: str) -> Column:
    """The row's cell under a header; the last column of that name, NULL when there is none."""
    at = F.array_position(F.reverse("header"), F.lit(name))
    return F.get(F.reverse("cells"), at - 1)


def read_json_documents(spark: SparkSession, path: str | list[str], schema: T.StructType | str, per_line: bool = False) -> DataFrame:
    """One row per document, with its path. A file is one document, or holds one per line."""
    docs = spark.read.option("multiLine", not per_line).schema(schema).json(path)
    return docs.select("*", F.col("_metadata.file_path").alias("document_path"))


def read_json_map(spark: SparkSession, path: str | list[str], value_type: str, per_line: bool = False) -> DataFrame:
    """(key, value) of documents whose top level is a map, such as a report keyed by file name."""
    docs = spark.read.option("wholetext", not per_line).text(path)
    body = F.from_json(F.regexp_replace("value", "^﻿", ""), f"map<string,{value_type}>")
    return docs.select(F.explode(body).alias("key", "value"))


def headered_lines(lines: DataFrame, value: str = "value", order: str = ROW_ORDER) -> tuple[DataFrame, DataFrame]:
    """Split ``#!key value`` lines from the body. Header: (file, key, value, n_seen); body: rows of
    (file, row_order, line), the column line included."""
    is_header = F.startswith(F.col(value), F.lit("#!"))
    file = F.col(f"{order}.file").alias("file")
    text = F.substr(F.col(value), F.lit(3))
    key = F.split_part(text, F.lit(" "), F.lit(1))
    header = (
        lines.filter(is_header)
        .select(file, key.alias("key"), strip(F.substr(text, F.length(key) + F.lit(1))).alias("value"), F.col(order).alias("_o"))
        .groupBy("file", "key")
        .agg(F.min_by("value", "_o").alias("value"), F.count("*").alias("n_seen"), F.min("_o").alias("first_seen"))
    )
    body = lines.filter(~is_header & (F.col(value) != "")).select(
        file, F.col(order).alias(ROW_ORDER), F.col(value).alias("line")
    )
    return header, body


def read_headered_annotation(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], format_key: str, format_version: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(header, rows, problems) of files with ``#!`` lines and an exact column list.

    Problems: a header key seen twice, a wrong first key or version, a wrong column line, and every
    line whose cell count is not the column count. The files are read here, once: there may be very many, and every result
    looks at their lines again.
    """
    with settings(spark, MANY_FILES):
        lines = materialise(read_lines(spark, path), "lines")
    header, body = headered_lines(lines)
    first = header.groupBy("file").agg(F.min_by("key", "first_seen").alias("first_key"))
    version = header.filter(F.col("key") == format_key).select("file", F.col("value").alias("version"))
    column_line = body.groupBy("file").agg(F.min(ROW_ORDER).alias("_first"), F.min_by("line", ROW_ORDER).alias("_names"))
    rows = body.join(column_line, "file").filter(F.col(ROW_ORDER) > F.col("_first"))
    names = "\t".join(columns)
    problems = (
        header.filter("n_seen > 1").select("file", F.concat(F.lit("header key twice: "), "key").alias("problem"))
        .unionByName(first.filter(F.col("first_key") != format_key).select("file", F.lit("wrong first key").alias("problem")))
        .unionByName(
            first.join(version, "file", "left").filter(~F.col("version").eqNullSafe(format_version))
            .select("file", F.lit("unknown format version").alias("problem"))
        )
        .unionByName(column_line.filter(F.col("_names") != names).select("file", F.lit("wrong columns").alias("problem")))
        .unionByName(
            cell_shape_check(rows, "line", len(columns)).select("file", F.lit("wrong cell count").alias("problem"))
        )
    )
    cells = F.split("line", "\t")
    parsed = rows.select(
        "file", ROW_ORDER, *[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(columns)]
    )
    return header, parsed, problems


def cell_shape_check(rows: DataFrame, line: str, n: int, sep: str = "\t") -> DataFrame:
    """The lines that do not hold exactly ``n`` cells."""
    return rows.withColumn("n_cells", cell_count(line, sep)).filter(F.col("n_cells") != n)


def read_delivery(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A delivered table. The extension names the format, nothing is sniffed; ``;`` separates the
    entries of a list column in text."""
    suffix = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix not in ("tsv", "csv"):
        raise ValueError(f"{path}: a delivered table is .parquet, .tsv or .csv")
    sep = "\t" if suffix == "tsv" else ","
    text = spark.read.option("sep", sep).option("header", True).option("enforceSchema", False).csv(path)
    lists = {f.name for f in schema if isinstance(f.dataType, T.ArrayType)}
    return text.select(*[
        split_list(c, ";").alias(c) if c in lists else F.col(f"`{c}`") for c in text.columns
    ])


_MANIFEST = (
    "bundle_id string, dataset_id string, schema_version string, written_utc string, "
    "tables map<string,bigint>, sources array<struct<role:string,path:string,sha256:string>>, "
    "licence string, credit string, layer string, layer_version string"
)


def discover_snapshots(spark: SparkSession, manifests: str | list[str]) -> DataFrame:
    """One row per manifest with its rank in age: written time, then file time, then id."""
    docs = spark.read.option("multiLine", True).schema(_MANIFEST).json(manifests)
    found = docs.select(
        "*",
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("path"),
    )
    return found.withColumn("age_order", F.struct("written_utc", "file_time", "bundle_id"))


def role_digests(spark: SparkSession, inputs: Sequence[tuple[str, str]], recorded: Mapping[str, str] | None = None) -> DataFrame:
    """(role, path, sha256), one row for each (role, path), however the path spells its scheme and whether it is a
    file or a folder. A folder's digest is over the names and digests of its files. ``recorded`` digests, by
    path, are taken as they are, and their files are not read."""
    recorded = recorded or {}
    given = [(role, path, recorded[path]) for role, path in inputs if path in recorded]
    out = spark.createDataFrame(given, "role string, path string, sha256 string")
    for role, path in inputs:
        if path in recorded:
            continue
        read = file_digests(spark, path).select(F.struct(file_name("path").alias("name"), "sha256").alias("f"))
        listed = read.agg(F.array_sort(F.collect_list("f")).alias("fs")).where(F.size("fs") > 0)  # the files of one input
        lines = F.array_join(F.transform("fs", lambda f: F.concat_ws("\t", f["name"], f["sha256"])), "\n")
        one = F.when(F.size("fs") == 1, F.get("fs", F.lit(0))["sha256"]).otherwise(F.sha2(lines, 256))
        out = out.unionByName(listed.select(F.lit(role).alias("role"), F.lit(path).alias("path"), one.alias("sha256")))
    return out


def first_matching_input(inputs: DataFrame, keys: Sequence[str], path: str, sha: str, position: str) -> DataFrame:
    """The first recorded input that is a protein database: (keys, database, sha256)."""
    return (
        inputs.filter(is_database(path))
        .groupBy(*keys)
        .agg(F.min_by(F.struct(F.col(path).alias("p"), F.col(sha).alias("s")), F.col(position)).alias("_f"))
        .select(*keys, file_name("_f.p").alias("database"), F.col("_f.s").alias("sha256"))
    )


def searched_databases(inputs: DataFrame, keys: Sequence[str], path: str, sha: str) -> DataFrame:
    """Every recorded protein database with its role and digest."""
    return inputs.filter(is_database(path)).select(
        *keys, file_name(path).alias("database"), database_role(path).alias("role"), F.col(sha).alias("sha256")
    )
