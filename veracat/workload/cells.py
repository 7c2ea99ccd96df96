"""Column expressions on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.functions import cells as c
from veracat.functions import rules
from veracat.operators.coerce import coerce as coerce_rows
from veracat.operators.coerce import coercion_violations as count_violations
from veracat.operators.samples import dataset_row as make_dataset_row
from veracat.operators.samples import flags_to_findings
from veracat.operators.samples import provenance_record as make_record
from veracat.operators.sites import occupancy_cell as read_occupancy
from veracat.schema import parse_columns
from veracat.sources.files import first_matching_input as first_input
from veracat.workload.registry import joined, query, text

_RAW_SQL = """SELECT o_orderkey AS k, CASE o_orderkey % 7 WHEN 0 THEN '  ' WHEN 1 THEN 'x' || o_orderkey WHEN 2 THEN 'nan' WHEN 3 THEN o_totalprice::VARCHAR ELSE o_orderkey || '.0' END AS num,
CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN '' WHEN 3 THEN ' T ' ELSE NULL END AS flag, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS word,
CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE '2024-03-0' || (1 + o_orderkey % 9) || 'T10:00:00' END AS stamp FROM orders"""

_TABLE = parse_columns("k long!, num long, flag boolean, word string!, stamp date, extra double")


def _raw(t):
    k = F.col("o_orderkey")
    r7, r5 = k % 7, k % 5
    return t.orders.select(
        k.alias("k"), F.when(r7 == 0, F.lit("  ")).when(r7 == 1, text("x", k)).when(r7 == 2, F.lit("nan")).when(r7 == 3, F.col("o_totalprice").cast("string"))
        .otherwise(F.concat(k.cast("string"), F.lit(".0"))).alias("num"),
        F.when(r5 == 0, F.lit("Yes")).when(r5 == 1, F.lit("no")).when(r5 == 2, F.lit("")).when(r5 == 3, F.lit(" T ")).alias("flag"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("word"),
        F.when(k % 6 == 0, F.lit("")).otherwise(F.concat(F.lit("2024-03-0"), (k % 9 + 1).cast("string"), F.lit("T10:00:00"))).alias("stamp"),
    )


@query(f"""SELECT k, CASE WHEN isnan(v) THEN NULL ELSE CAST(trunc(v) AS BIGINT) END AS num, CASE WHEN trim(flag) = '' THEN NULL ELSE lower(trim(flag)) IN ('true', 'yes', '1', 'y', 't') END AS flag,
nullif(word, '') AS word, substr(nullif(stamp, ''), 1, 10) AS stamp, CAST(NULL AS DOUBLE) AS extra FROM (SELECT *, try_cast(trim(num) AS DOUBLE) AS v FROM ({_RAW_SQL}))""")
def coerce(t):
    return coerce_rows(_raw(t), _TABLE).withColumn("stamp", F.col("stamp").cast("string"))


@query(f"""SELECT 'num' AS "column", 'malformed' AS rule, count(*) FILTER (WHERE num LIKE 'x%') AS n FROM ({_RAW_SQL})
UNION ALL SELECT 'word', 'required', count(*) FILTER (WHERE word = '') FROM ({_RAW_SQL})""")
def coercion_violations(t):
    return count_violations(_raw(t), _TABLE)


_ALT = "CASE WHEN p_size % 3 = 0 THEN ' ' || p_brand || ' |' || p_type WHEN p_size % 3 = 1 THEN p_type ELSE '' END"


def _alternatives(t):
    r = F.col("p_size") % 3
    cell = F.when(r == 0, F.concat(F.lit(" "), F.col("p_brand"), F.lit(" |"), F.col("p_type"))).when(r == 1, F.col("p_type")).otherwise(F.lit(""))
    return t.part.select("p_partkey", cell.alias("cell"), "p_size", "p_brand", "p_type", "p_name", "p_retailprice")


@query(f"SELECT p_partkey, trim(split_part(cell, '|', 1)) AS first, nullif(trim(cell), '') AS verbatim FROM (SELECT p_partkey, {_ALT} AS cell FROM part)")
def first_alternative(t):
    return _alternatives(t).select("p_partkey", c.first_alternative("cell").alias("first"), c.verbatim("cell").alias("verbatim"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, v AS as_float, CAST(trunc(v) AS BIGINT) AS as_int FROM (SELECT *, CASE WHEN isnan(x) THEN NULL ELSE x END AS v
FROM (SELECT *, try_cast(trim(split_part(cell, '|', 1)) AS DOUBLE) AS x FROM (SELECT *, CASE l_linenumber WHEN 1 THEN l_tax || '|7' WHEN 2 THEN 'n/a' WHEN 3 THEN 'NaN' ELSE l_quantity::VARCHAR END AS cell FROM lineitem)))""")
def lenient_numbers(t):
    line = F.col("l_linenumber")
    cell = F.when(line == 1, F.concat(F.col("l_tax").cast("string"), F.lit("|7"))).when(line == 2, F.lit("n/a")).when(line == 3, F.lit("NaN")).otherwise(F.col("l_quantity").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", c.lenient_float(cell).alias("as_float"), c.lenient_int(cell).alias("as_int"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN contains(upper(x), 'D') THEN 'decoy' WHEN contains(upper(x), 'C') THEN 'contaminant' ELSE 'target' END AS label,
CASE WHEN length(x) > 0 THEN CASE WHEN contains(upper(x), 'D') THEN 'decoy' WHEN contains(upper(x), 'C') THEN 'contaminant' ELSE 'target' END END AS label_or_null
FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 't|c' WHEN 'N' THEN CASE WHEN l_linestatus = 'F' THEN '' ELSE 'T' END ELSE 'T|D|C' END AS x FROM lineitem)""")
def worst_label(t):
    flag = F.col("l_returnflag")
    x = F.when(flag == "A", F.lit("t|c")).when(flag == "N", F.when(F.col("l_linestatus") == "F", F.lit("")).otherwise(F.lit("T"))).otherwise(F.lit("T|D|C"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", rules.worst_label(x).alias("label"), rules.worst_label_or_null(x).alias("label_or_null"))


_SPAN = "CASE WHEN l_linenumber = 7 THEN 'none' ELSE '[' || l_linenumber || ' to ' || l_suppkey || ']|[' || l_partkey || '  to 9]' END"


@query(f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, try_cast(nullif(regexp_extract(x, '\\[(\\d+)\\s+to\\s+(\\d+)\\]', 1), '') AS BIGINT) AS first_start,
try_cast(nullif(regexp_extract(x, '\\[(\\d+)\\s+to\\s+(\\d+)\\]', 2), '') AS BIGINT) AS first_end, array_to_string(regexp_extract_all(x, '\\[(\\d+)\\s+to\\s+(\\d+)\\]', 1), ',') AS starts
FROM (SELECT *, {_SPAN} AS x FROM lineitem)""")
def residue_range(t):
    num = lambda name: F.col(name).cast("string")
    x = F.when(F.col("l_linenumber") == 7, F.lit("none")).otherwise(
        F.concat(F.lit("["), num("l_linenumber"), F.lit(" to "), num("l_suppkey"), F.lit("]|["), num("l_partkey"), F.lit("  to 9]")))
    span = c.residue_range(x)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", span["start"].alias("first_start"), span["end"].alias("first_end"), joined(c.all_starts(x)).alias("starts"))


@query(f"SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(cell, '|'), lambda v: trim(v)), lambda v: v <> ''), ';') AS entries FROM (SELECT p_partkey, {_ALT} AS cell FROM part)")
def split_list(t):
    return _alternatives(t).select("p_partkey", joined(c.split_list("cell"), ";").alias("entries"))


@query(f"""SELECT p_partkey, CASE WHEN len(parts) = n THEN array_to_string(list_transform(parts, lambda v: coalesce(nullif(v, ''), '-')), ';')
WHEN len(parts) = 1 THEN array_to_string(list_transform(range(n), lambda i: coalesce(nullif(parts[1], ''), '-')), ';') ELSE array_to_string(list_transform(range(n), lambda i: '-'), ';') END AS aligned
FROM (SELECT p_partkey, 1 + p_size % 4 AS n, list_transform(string_split({_ALT}, '|'), lambda v: trim(v)) AS parts FROM part)""")
def align_list(t):
    aligned = c.align_list("cell", F.col("p_size") % 4 + 1)
    return _alternatives(t).select("p_partkey", F.array_join(F.transform(aligned, lambda x: F.coalesce(x, F.lit("-"))), ";").alias("aligned"))


@query("""SELECT p_partkey, nullif(trim(replace(split_part(x, ',', 1), 'primary:', '')), '') AS symbol FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'primary:' || p_brand || ', synonym:' || p_type
WHEN p_size % 3 = 0 THEN '' ELSE p_type END AS x FROM part)""")
def primary_symbol(t):
    x = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("primary:"), F.col("p_brand"), F.lit(", synonym:"), F.col("p_type"))).when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.col("p_type"))
    return t.part.select("p_partkey", c.primary_symbol(x).alias("symbol"))


_CELL = """CASE p_size % 6 WHEN 0 THEN 'NT=' || p_name || ';AC=MS:' || p_partkey WHEN 1 THEN p_name WHEN 2 THEN 'ac = X' || p_partkey || '; ' || p_type WHEN 3 THEN 'NT=' || p_type || ';NT=' || p_brand
WHEN 4 THEN 'NT=Not Available;AC=unknown' ELSE '' END"""


def _cells(t):
    r = F.col("p_size") % 6
    x = F.when(r == 0, F.concat(F.lit("NT="), F.col("p_name"), F.lit(";AC=MS:"), F.col("p_partkey").cast("string"))).when(r == 1, F.col("p_name")) \
        .when(r == 2, F.concat(F.lit("ac = X"), F.col("p_partkey").cast("string"), F.lit("; "), F.col("p_type"))).when(r == 3, F.concat(F.lit("NT="), F.col("p_type"), F.lit(";NT="), F.col("p_brand"))) \
        .when(r == 4, F.lit("NT=Not Available;AC=unknown")).otherwise(F.lit(""))
    return t.part.select("p_partkey", x.alias("x"))


@query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_type WHEN 3 THEN p_brand WHEN 4 THEN 'Not Available' ELSE '' END AS nt,
CASE p_size % 6 WHEN 0 THEN 'MS:' || p_partkey WHEN 2 THEN 'X' || p_partkey WHEN 4 THEN 'unknown' END AS ac,
CASE p_size % 6 WHEN 0 THEN 2 WHEN 2 THEN 2 WHEN 4 THEN 2 ELSE 1 END AS n_keys FROM part""")
def key_value_cell(t):
    m = c.parse_key_value_cell("x")
    return _cells(t).select("p_partkey", F.try_element_at(m, F.lit("NT")).alias("nt"), F.try_element_at(m, F.lit("AC")).alias("ac"), F.size(m).alias("n_keys"))


@query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_type WHEN 3 THEN p_brand END AS name,
CASE p_size % 6 WHEN 0 THEN 'MS:' || p_partkey WHEN 2 THEN 'X' || p_partkey END AS term FROM part""")
def name_and_term(t):
    return _cells(t).select("p_partkey", c.cell_name("x").alias("name"), c.cell_term("x").alias("term"))


_WORD = "CASE p_size % 5 WHEN 0 THEN ' Not Applicable ' WHEN 1 THEN 'NA' WHEN 2 THEN p_type WHEN 3 THEN '' ELSE 'none of it' END"


@query(f"""SELECT p_partkey, lower(trim(x)) IN ('', 'not available', 'not applicable', 'na', 'n/a', 'unknown', 'none') AS reserved,
CASE WHEN lower(trim(x)) NOT IN ('', 'not available', 'not applicable', 'na', 'n/a', 'unknown', 'none') THEN trim(x) END AS cleaned FROM (SELECT p_partkey, {_WORD} AS x FROM part)""")
def reserved_word(t):
    r = F.col("p_size") % 5
    x = F.when(r == 0, F.lit(" Not Applicable ")).when(r == 1, F.lit("NA")).when(r == 2, F.col("p_type")).when(r == 3, F.lit("")).otherwise(F.lit("none of it"))
    return t.part.select("p_partkey", c.reserved_word(x).alias("reserved"), c.clean(x).alias("cleaned"))


@query("""SELECT p_partkey, CASE WHEN lower(p_type) = 'economy' THEN 'T:1' WHEN lower(p_type) = 'promo' THEN 'T:2' ELSE p_brand END AS term,
CASE WHEN contains(lower(p_name), 'ring') THEN 'jewel' WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') THEN 'paint' END AS vendor FROM part""")
def lookup_term(t):
    return t.part.select("p_partkey", rules.lookup_term("p_type", {"economy": "T:1", "promo": "T:2"}, F.col("p_brand")).alias("term"),
                         rules.first_fragment("p_name", [("jewel", ["ring"]), ("paint", ["red", "blue"])]).alias("vendor"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'label_free' WHEN p_size % 3 = 1 THEN replace(p_name, ' ', '') ELSE 'label_free' END AS channel FROM part""")
def channel_label(t):
    r = F.col("p_size") % 3
    x = F.when(r == 0, F.lit("NT=label free sample;AC=MS:1002038")).when(r == 1, F.concat(F.lit("NT="), F.col("p_name"))).otherwise(F.lit("none"))
    return t.part.select("p_partkey", rules.channel_label(x).alias("channel"))


@query(r"""SELECT l_orderkey, l_linenumber, l_suppkey, regexp_replace(x, '(-calib|-averaged|-calibrated)+$', '') AS stripped,
'r' || l_suppkey || CASE l_linenumber % 4 WHEN 1 THEN '.thermo-calib' WHEN 2 THEN '-averaged-calib' WHEN 3 THEN '-calib.x' ELSE '' END AS mangled
FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN '/data/r' || l_suppkey WHEN 1 THEN 'r' || l_suppkey || '.RAW.thermo-calib' WHEN 2 THEN 'C:\dir\r' || l_suppkey || '.mzml-averaged-calib' ELSE 'r' || l_suppkey || '-calib.x' END AS x FROM lineitem)""")
def strip_suffixes(t):
    r, s = F.col("l_linenumber") % 4, text("r", "l_suppkey")
    x = F.when(r == 0, F.concat(F.lit("/data/"), s)).when(r == 1, F.concat(s, F.lit(".RAW.thermo-calib"))).when(r == 2, F.concat(F.lit("C:\\dir\\"), s, F.lit(".mzml-averaged-calib"))).otherwise(F.concat(s, F.lit("-calib.x")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", c.strip_run_suffixes(x).alias("stripped"), c.delete_extensions(x).alias("mangled"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber <> 3 THEN 'mzspec:X:run' || l_suppkey || ':scan:' || l_orderkey || ':' || l_returnflag || '/' || l_linenumber END AS usi FROM lineitem""")
def mint_identifier(t):
    run = F.when(F.col("l_linenumber") != 3, text("run", "l_suppkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", rules.mint_identifier(F.lit("X"), run, F.col("l_orderkey"), F.col("l_returnflag"), F.col("l_linenumber")).alias("usi"))


@query("SELECT p_partkey, 'X:' || array_to_string(list_sort([p_type, p_brand, p_name]), ';') AS key FROM part")
def canonical_key(t):
    return t.part.select("p_partkey", rules.canonical_key(F.array("p_type", "p_brand", "p_name"), F.lit("X")).alias("key"))


@query(f"SELECT p_partkey, CASE WHEN trim(cell) <> '' THEN contains(trim(cell), '|') END AS ambiguous FROM (SELECT p_partkey, {_ALT} AS cell FROM part)")
def ambiguous_flag(t):
    return _alternatives(t).select("p_partkey", rules.ambiguous_flag("cell").alias("ambiguous"))


@query("SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '3' THEN 5 WHEN '4' THEN 6 WHEN '5' THEN 7 ELSE 8 END AS rank FROM orders")
def level_rank(t):
    return t.orders.select("o_orderkey", rules.level_rank(F.substr("o_orderpriority", F.lit(1), F.lit(1))).alias("rank"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_linenumber = 1 OR (l_linenumber = 2 AND l_linestatus = 'F') THEN 'protein_n_term' ELSE 'peptide_n_term' END
WHEN l_returnflag = 'N' THEN CASE WHEN l_quantity > 40 THEN NULL WHEN l_linenumber = CAST(l_quantity AS BIGINT) THEN 'protein_c_term' ELSE 'peptide_c_term' END ELSE 'residue' END AS site_type FROM lineitem""")
def site_type(t):
    previous = F.when(F.col("l_linestatus") == "F", F.lit(" m ")).otherwise(F.lit("K"))
    length = F.when(F.col("l_quantity") <= 40, F.col("l_quantity").cast("bigint"))
    out = rules.site_type(F.col("l_returnflag") == "A", F.col("l_returnflag") == "N", F.col("l_linenumber"), previous, F.col("l_linenumber"), length)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", out.alias("site_type"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'UNIMOD:' || p_size END AS modification, CASE WHEN p_size % 3 = 1 THEN try_cast('-' || p_size || '.25' AS DOUBLE) END AS mass_shift, CASE WHEN p_size % 3 = 2 THEN p_brand END AS unresolved_name FROM part""")
def tag_class(t):
    r, n = F.col("p_size") % 3, F.col("p_size").cast("string")
    tag = F.when(r == 0, F.concat(F.lit("UNIMOD:"), n)).when(r == 1, F.concat(F.lit("-"), n, F.lit(".25"))).otherwise(F.concat(F.lit("Info:"), F.col("p_brand")))
    a, m, u = rules.tag_class(tag)
    return t.part.select("p_partkey", a.alias("modification"), m.alias("mass_shift"), u.alias("unresolved_name"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'MSMS' WHEN 'view' THEN 'MBR' WHEN 'error' THEN 'not_detected' END AS detection FROM events""")
def detection_type(t):
    kind = F.col("event_type")
    label = F.when(kind == "click", F.lit(" MSMSAmbiguousPeakfinding ")).when(kind == "view", F.lit("MBR")).when(kind == "error", F.lit("MSMSIdentifiedButNotQuantified")).otherwise(F.lit("other"))
    return t.events.select("event_id", rules.detection_type(label).alias("detection"))


@query("SELECT page_id, CASE WHEN regexp_matches(lower(url), 'contaminant|crap|the') THEN 'contaminant' ELSE 'target' END AS role FROM pages")
def database_role(t):
    return t.pages.select("page_id", rules.database_role(F.replace(F.lower("url"), F.lit("the"), F.lit("cRAP"))).alias("role"))


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN true WHEN event_type = 'view' THEN false END AS flag, event_type = 'error' AS refused FROM events")
def tri_state(t):
    kind = F.col("event_type")
    cell = F.when(kind == "click", F.lit("true")).when(kind == "view", F.lit("false")).when(kind == "error", F.lit("TRUE")).otherwise(F.lit(""))
    return t.events.select("event_id", c.tri_state(cell).alias("flag"), c.tri_state_bad(cell).alias("refused"))


@query("""SELECT user_id::VARCHAR || ':' || code AS finding_id, user_id::VARCHAR AS dataset_id, code, CASE code WHEN 'low_id_rate' THEN 'warning' WHEN 'no_output_sdrf' THEN 'info' WHEN 'old_provenance_schema' THEN 'error' ELSE 'warning' END AS severity, message
FROM (SELECT user_id, CASE event_type WHEN 'click' THEN 'low_id_rate' WHEN 'view' THEN 'no_output_sdrf' WHEN 'error' THEN 'old_provenance_schema' ELSE event_type END AS code,
CASE WHEN event_type IN ('click', 'view') THEN props WHEN event_type = 'error' THEN 'old_provenance_schema' ELSE event_type END AS message FROM events)""")
def flag_to_finding(t):
    kind = F.col("event_type")
    flag = F.when(kind == "click", F.concat(F.lit("low_id_rate: "), F.col("props"))).when(kind == "view", F.concat(F.lit("no_output_sdrf : "), F.col("props"))) \
        .when(kind == "error", F.lit("old_provenance_schema")).otherwise(kind)
    docs = t.events.select(F.col("user_id").cast("string").alias("dataset_id"), F.array(flag).alias("flags"))
    return flags_to_findings(docs, "flags", "dataset_id", "flags").select("finding_id", "dataset_id", "code", "severity", "message")


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_tax = 0 THEN CASE WHEN l_linestatus = 'F' THEN 'intensity_unassigned' ELSE 'count_only' END WHEN l_discount = 0 THEN 'floor' ELSE 'quantified' END AS state,
l_discount = 0 AS is_floor, l_tax = 0.05 AS is_ceiling FROM lineitem""")
def stoichiometry_state(t):
    total, floor = F.nullif("l_tax", F.lit(0.0)), rules.intensity_is_floor(F.col("l_discount"), F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", rules.stoichiometry_state(total, floor, F.col("l_linestatus") == "F").alias("state"), floor.alias("is_floor"),
                             rules.intensity_is_ceiling(F.col("l_tax") * 20).alias("is_ceiling"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s AS segment, CAST(CASE WHEN s = 0 THEN l_linenumber ELSE l_suppkey END AS BIGINT) AS position, CASE WHEN s = 0 THEN 'Oxidation on M' ELSE l_returnflag || ' [x] on ' || l_linestatus END AS modification,
l_discount AS fraction, CAST(l_linenumber AS DOUBLE) AS numerator, l_quantity AS denominator FROM lineitem, (SELECT unnest([0, 1]) AS s)""")
def occupancy_cell(t):
    num = lambda name: F.col(name).cast("string")
    values = F.concat(F.lit(",info:fraction="), num("l_discount"), F.lit("("), num("l_linenumber"), F.lit("/"), num("l_quantity"), F.lit(")]"))
    cell = F.concat(F.lit("pos"), num("l_linenumber"), F.lit("[Oxidation on M"), values, F.lit("|pos"), num("l_suppkey"), F.lit("["), F.col("l_returnflag"), F.lit(" [x] on "), F.col("l_linestatus"), values)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return read_occupancy(t.lineitem.withColumn("cell", cell), "cell", keys)[0].drop("entry")


@query("""SELECT l_orderkey, arg_min(path, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS database, arg_min(l_suppkey::VARCHAR, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS sha256 FROM (SELECT *, 'db' || l_partkey || CASE WHEN l_returnflag = 'A' THEN '.FASTA' ELSE '.xml' END AS path FROM lineitem WHERE l_returnflag <> 'R') GROUP BY 1""")
def first_matching_input(t):
    flag = F.col("l_returnflag")
    path = F.concat(text("in/db", "l_partkey"), F.when(flag == "A", F.lit(".FASTA")).when(flag == "N", F.lit(".xml")).otherwise(F.lit(".toml")))
    rows = t.lineitem.select("l_orderkey", path.alias("path"), F.col("l_suppkey").cast("string").alias("sha"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("pos"))
    return first_input(rows, ["l_orderkey"], "path", "sha", "pos")


@query("""SELECT event_id::VARCHAR AS dataset_id, CASE WHEN event_type = 'view' THEN 'search' ELSE event_type END AS stage, 'x-provenance/3' AS provenance_schema, 'c' || user_id AS pipeline_commit,
CASE WHEN event_type <> 'error' THEN '{"k":' || user_id || '}' END AS params_json, value AS wall_seconds, '{"wall_s":' || value || '}' AS resources_json FROM events""")
def provenance_record(t):
    kind = F.col("event_type")
    docs = t.events.select(
        F.when(kind != "view", kind).alias("stage"), F.lit("x-provenance/3").alias("schema"), F.lit("2024-01-01T00:00:00+00:00").alias("started_utc"), F.lit(None).cast("string").alias("finished_utc"),
        F.struct(F.lit("r").alias("repo"), text("c", "user_id").alias("commit")).alias("pipeline"), F.struct(F.lit("s").alias("sha256")).alias("params_file"),
        F.create_map(F.lit("tool"), F.lit("1")).alias("tools"), F.when(kind != "error", F.struct(F.col("user_id").alias("k"))).alias("params"),
        F.struct(F.col("value").alias("wall_s"), F.lit(None).cast("double").alias("peak_rss_gib")).alias("resources"), F.lit("p").alias("document_path"), F.lit("s").alias("sha256"), "event_id")
    out = make_record(docs, F.lit("search"), F.col("event_id").cast("string"))
    return out.select("dataset_id", "stage", "provenance_schema", "pipeline_commit", "params_json", "wall_seconds", "resources_json")


@query("""SELECT p.p_type AS dataset_id, CASE WHEN bool_or(contains(p_name, 'ring')) THEN 'named' END IS NOT NULL AS has_ring, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS instruments,
'label_free' AS quant_method, min(p_brand) AS search_database, 'v' || max(p_size) AS search_engine_version FROM part p GROUP BY 1""")
def dataset_row(t):
    declared = t.part.groupBy(F.col("p_type").alias("dataset_id")).agg(
        F.max(F.contains("p_name", F.lit("ring"))).alias("has_ring"), F.lit(None).cast("string").alias("recorded_version"), text("v", F.max("p_size")).alias("declared_version"), F.lit("LFQ").alias("quant_method"))
    facts = t.part.select(F.col("p_type").alias("dataset_id"), F.col("p_brand").alias("instrument_model"))
    inputs = t.part.groupBy(F.col("p_type").alias("dataset_id")).agg(F.min("p_brand").alias("database"), F.lit("s").alias("sha256"))
    out = make_dataset_row(declared, facts, inputs, F.lit("gptmd"), "engine")
    return out.select("dataset_id", "has_ring", joined("instruments").alias("instruments"), "quant_method", "search_database", "search_engine_version")


@query("SELECT event_id, event_type || ',HCD' AS modes FROM events")
def map_key_suffixes(t):
    m = F.create_map(F.concat(F.lit("Trap/"), F.col("event_type")), F.lit(1), F.lit("HCD"), F.lit(2), F.concat(F.lit("Other/"), F.col("event_type")), F.lit(3))
    return t.events.select("event_id", joined(c.map_key_suffixes(m)).alias("modes"))
