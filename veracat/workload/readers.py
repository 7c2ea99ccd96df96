"""Round trips: the benchmark tables as producer files, read back by each reader."""

from pyspark.sql import functions as F

from veracat.functions.cells import map_key_suffixes
from veracat.operators.export import write_texts
from veracat.operators.identification import occurrence_rank
from veracat.operators.snapshots import newest_row
from veracat.schema import parse_columns
from veracat.session import scratch_dir
from veracat.sources import files
from veracat.workload.registry import joined, query, text


def _tsv(df, path):
    df.write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def _lines(df, path):
    df.write.text(path)


@query("SELECT l_orderkey::VARCHAR AS \"Order\", l_partkey::VARCHAR AS \"Part Key\", l_returnflag AS \"Flag\", CAST(NULL AS VARCHAR) AS \"Blank\" FROM lineitem")
def read_match_table(t):
    path = scratch_dir(t.spark, "matches")
    s = lambda c: F.col(c).cast("string")
    _tsv(t.lineitem.select(s("l_orderkey").alias("Order"), s("l_partkey").alias("Part Key"), F.col("l_returnflag").alias("Flag"), F.lit("").alias("Blank")), path)
    return files.read_match_table(t.spark, path).drop("row_order")


@query("SELECT l_returnflag AS \"Flag\", count(*) AS n, count(*) AS top FROM lineitem GROUP BY 1")
def rank_in_file_order(t):
    """Ranks in file order are dense whatever the splits: the highest is the count."""
    path = scratch_dir(t.spark, "matches")
    _tsv(t.lineitem.select(F.col("l_returnflag").alias("Flag"), F.col("l_orderkey").cast("string").alias("Order")), path)
    ranked = occurrence_rank(files.read_match_table(t.spark, path), ["Flag"], "row_order")
    return ranked.groupBy("Flag").agg(F.count_distinct("rank").alias("n"), F.max("rank").alias("top"))


@query("SELECT p_partkey::VARCHAR AS a, p_name AS b, p_type AS c FROM part")
def read_wide_tsv(t):
    path = scratch_dir(t.spark, "wide")
    _tsv(t.part.select(F.col("p_partkey").cast("string").alias("a"), F.col("p_name").alias("b"), F.col("p_type").alias("c")), path)
    return files.read_wide_tsv(t.spark, path)


@query("""SELECT CASE o_custkey % 4 WHEN 0 THEN '' ELSE 'r' || o_custkey END AS scope, CASE o_custkey % 4 WHEN 0 THEN 'protein_groups_' || o_custkey WHEN 1 THEN 'psms' WHEN 2 THEN 'ms2_scans' ELSE 'precursors' END AS name, count(*) AS count FROM orders GROUP BY o_custkey""")
def read_report_counts(t):
    n, k = F.col("n").cast("string"), F.col("o_custkey").cast("string")
    r = F.col("o_custkey") % 4
    line = F.when(r == 0, F.concat(F.lit("All target protein groups "), k, F.lit(" with q-value <= 0.01 (1% FDR): "), n)) \
        .when(r == 1, F.concat(F.lit("  r"), k, F.lit(" - Target PSMs with q-value <= 0.01: "), n)) \
        .when(r == 2, F.concat(F.lit("r"), k, F.lit(" - MS2 Scans: "), n)).otherwise(F.concat(F.lit("r"), k, F.lit(" - All Precursors: "), n))
    path = scratch_dir(t.spark, "report")
    counted = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    _lines(counted.select(line).unionByName(t.part.select(F.col("p_name").alias(counted.select(line).columns[0]))), path)
    return files.read_report_counts(t.spark, path)


@query("SELECT CASE WHEN p_size % 2 = 0 THEN 'P' || p_partkey ELSE 'x' || p_partkey || '|y' END AS accession, upper(replace(p_name, ' ', '') || p_type) AS sequence FROM part")
def read_fasta(t):
    header = F.when(F.col("p_size") % 2 == 0, F.concat(text(">sp|P", "p_partkey"), F.lit("|NAME some text"))).otherwise(F.concat(text(">x", "p_partkey"), F.lit("|y more text")))
    path = scratch_dir(t.spark, "fasta")
    _lines(t.part.select(F.concat_ws("\n", header, "p_name", "p_type")), path)
    return files.read_fasta(t.spark, path).drop("row_order")


@query("SELECT 'P' || p_partkey AS accession, upper(replace(p_name, ' ', '')) AS sequence FROM part")
def read_protein_xml(t):
    entries = t.part.select(
        F.array(text("P", "p_partkey"), F.lit("Q1")).alias("accession"), F.struct(F.lit("no").alias("sequence")).alias("comment"),
        F.struct(F.col("p_name").alias("_VALUE"), F.col("p_size").alias("_length")).alias("sequence"))
    path = scratch_dir(t.spark, "xml")
    entries.write.format("xml").option("rootTag", "uniprot xmlns=\"http://uniprot.org/uniprot\"").option("rowTag", "entry").save(path)
    return files.read_protein_xml(t.spark, path)


@query("""SELECT p_name || ' ' || p_partkey AS name, CASE WHEN p_size % 2 = 0 THEN 'K,N' ELSE 'M' END AS targets, CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS BIGINT) END AS unimod, CASE WHEN p_size % 3 = 1 THEN p_retailprice END AS mass FROM part""")
def read_modification_list(t):
    n = F.col("p_size").cast("string")
    block = F.concat(F.lit("ID   "), F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"), F.lit("\nTG   "), F.when(F.col("p_size") % 2 == 0, F.lit("K or N")).otherwise(F.lit("Methionine.")),
                     F.lit("\nPP   Anywhere.\n"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("DR   Unimod; "), n, F.lit(".\n"))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("MM   "), F.col("p_retailprice").cast("string"), F.lit("\n"))).otherwise(F.lit("MM   x\n")),
                     # Every fifth block has no closing slashes: the next ID ends it.
                     F.when(F.col("p_partkey") % 5 == 0, F.lit("CF   O1")).otherwise(F.lit("//")))
    path = scratch_dir(t.spark, "mods")
    _lines(t.part.repartition(4, "p_partkey").select(block), path)
    return files.read_modification_list(t.spark, [path]).select("name", joined("targets").alias("targets"), "unimod", "mass")


@query("SELECT p_partkey::VARCHAR AS source, p_type AS second, p_name AS only_one, CAST(NULL AS VARCHAR) AS absent FROM part")
def read_sample_sheet(t):
    path = scratch_dir(t.spark, "sheet")
    rows = t.part.select(F.col("p_partkey").cast("string").alias("source name"), F.col("p_brand").alias("comment[x] "), F.col("p_type").alias("comment[x]"), F.col("p_name").alias("assay name"))
    _tsv(rows, path)
    lines = files.read_lines(t.spark, path).withColumn("value", F.replace("value", F.lit("comment[x] "), F.lit("comment[x]")))
    sheet = files.sheet_rows(lines)
    return sheet.select(files.sheet_cell("source name").alias("source"), files.sheet_cell("comment[x]").alias("second"), files.sheet_cell("assay name").alias("only_one"), files.sheet_cell("nope").alias("absent"))


@query("SELECT 'nation ' || n_nationkey AS stage, 2 AS n_inputs, n_name AS last FROM nation")
def read_json_files(t):
    """A file is one document here, over several lines."""
    docs = t.nation.select("n_nationkey", F.format_string('{\n "stage": "nation %s",\n "inputs": [\n  {"path": "x"},\n  {"path": "%s"}\n ]\n}', F.col("n_nationkey").cast("string"), "n_name").alias("value"))
    path = scratch_dir(t.spark, "files")
    docs.repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    read = files.read_json_documents(t.spark, f"{path}/*/*.txt", "stage string, inputs array<struct<path:string>>")
    return read.select("stage", F.size("inputs").alias("n_inputs"), F.element_at("inputs", -1)["path"].alias("last"))


@query("SELECT 'doc ' || p_partkey AS stage, 2 AS n_inputs, p_type AS last FROM part")
def read_json_documents(t):
    docs = t.part.select(F.concat(F.lit("doc "), F.col("p_partkey").cast("string")).alias("stage"), F.array(*[F.struct(F.col(c).alias("path")) for c in ("p_name", "p_type")]).alias("inputs"))
    path = scratch_dir(t.spark, "docs")
    docs.write.json(path)
    read = files.read_json_documents(t.spark, path, "stage string, inputs array<struct<path:string>>", per_line=True)
    return read.select("stage", F.size("inputs").alias("n_inputs"), F.element_at("inputs", -1)["path"].alias("last"))


@query("SELECT 'f' || p_partkey || '.raw' AS file, p_size AS ms2, 'HCD' AS modes FROM part UNION ALL SELECT 'g' || p_partkey || '.raw', NULL, '' FROM part")
def read_json_map(t):
    entry = F.struct(F.col("p_size").alias("ms2"), F.create_map(F.lit("Trap/HCD"), F.lit(1)).alias("analyzer"))
    none = F.struct(F.lit(None).cast("int").alias("ms2"), F.lit(None).cast("map<string,int>").alias("analyzer"))
    name = lambda p: F.concat(text(p, "p_partkey"), F.lit(".raw"))
    path = scratch_dir(t.spark, "qc")
    _lines(t.part.select(F.to_json(F.create_map(name("f"), entry, name("g"), none))), path)
    read = files.read_json_map(t.spark, path, "struct<ms2:int,analyzer:map<string,bigint>>", per_line=True)
    return read.select(F.col("key").alias("file"), F.col("value.ms2").alias("ms2"), joined(map_key_suffixes("value.analyzer")).alias("modes"))


def _one_file_each(rows, path):
    """A file a supplier. Its work is files, not bytes, so the number of tasks is named."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_texts(rows.select(F.col("s_suppkey").cast("string"), "value").repartition(tasks, "s_suppkey"), "s_suppkey", path)


def _annotation(t):
    """One annotation file per supplier: two header lines, the column line and the supplier."""
    n = F.col("s_nationkey").cast("string")
    line = F.concat_ws("\t", "s_name", n, F.col("s_acctbal").cast("string"))
    bad = F.when(F.col("s_nationkey") == 7, F.concat(line, F.lit("\textra"))).otherwise(line)
    docs = t.supplier.select("s_suppkey", F.concat(F.lit("#!fmt 1\n#!release r"), n, F.lit("\nname\tnation\tbalance\n"), bad).alias("value"))
    path = scratch_dir(t.spark, "annotation")
    _one_file_each(docs, path)
    return files.read_headered_annotation(t.spark, f"{path}/*", ["name", "nation", "balance"], "fmt", "1")


@query("SELECT 'r' || s_nationkey AS release, s_name AS name, s_nationkey::VARCHAR AS nation, s_acctbal::VARCHAR AS balance FROM supplier")
def read_headered_annotation(t):
    header, rows, _ = _annotation(t)
    release = header.filter("key = 'release'").select("file", F.col("value").alias("release"))
    return rows.join(release, "file").select("release", "name", "nation", "balance")


@query("SELECT 'wrong cell count' AS problem, count(*) AS n FROM supplier WHERE s_nationkey = 7 HAVING count(*) > 0")
def annotation_file_problems(t):
    return _annotation(t)[2].groupBy("problem").agg(F.count("*").alias("n"))


@query("SELECT p_partkey::VARCHAR AS id, p_name AS label, p_type || '|' || p_brand AS tags FROM part")
def read_delivery(t):
    path = scratch_dir(t.spark, "delivery") + ".tsv"
    _tsv(t.part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("label"), F.concat(F.col("p_type"), F.lit(" ; "), F.col("p_brand"), F.lit(";")).alias("tags")), path)
    read = files.read_delivery(t.spark, path, parse_columns("id string!, label string, tags array<string>"))
    return read.withColumn("tags", joined("tags", "|"))


@query("SELECT p_brand AS dataset_id, 'b' || p_type AS bundle_id, count(*) AS n_parts FROM part WHERE p_type = (SELECT max(q.p_type) FROM part q WHERE q.p_brand = part.p_brand) GROUP BY ALL")
def discover_snapshots(t):
    docs = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).select("p_brand", "p_type", F.to_json(F.struct(
        F.concat(F.lit("b"), "p_type").alias("bundle_id"), F.col("p_brand").alias("dataset_id"), F.col("p_type").alias("written_utc"), F.create_map(F.lit("part"), F.col("n")).alias("tables"))).alias("value"))
    path = scratch_dir(t.spark, "manifests")
    docs.write.partitionBy("p_brand", "p_type").text(path)
    found = files.discover_snapshots(t.spark, f"{path}/*/*")
    return newest_row(found.select("dataset_id", "bundle_id", "tables", "age_order"), ["dataset_id"], "age_order").select("dataset_id", "bundle_id", F.try_element_at("tables", F.lit("part")).alias("n_parts"))


@query("SELECT s_suppkey, sha256(s_name || ' ' || s_acctbal || chr(10)) AS sha256, CAST(strlen(s_name || ' ' || s_acctbal) + 1 AS BIGINT) AS size_bytes FROM supplier")
def file_digests(t):
    path = scratch_dir(t.spark, "digests")
    _one_file_each(t.supplier.select("s_suppkey", F.concat_ws(" ", "s_name", F.col("s_acctbal").cast("string")).alias("value")), path)
    key = F.regexp_extract("path", "s_suppkey=([0-9]+)", 1).cast("bigint")
    return files.file_digests(t.spark, f"{path}/*/*.txt").select(key.alias("s_suppkey"), "sha256", "size_bytes")
