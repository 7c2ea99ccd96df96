"""Ranks, first-wins, names and identification tables on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.functions.rules import canonical_key
from veracat.operators import identification as ident
from veracat.operators.notation import translate_notation
from veracat.operators.search import ranked_hits as ranked
from veracat.operators.snapshots import latest_snapshot as choose
from veracat.operators.snapshots import newest_row
from veracat.workload.registry import joined, query, text


@query("""SELECT user_id, min(value) AS best, min(CASE WHEN event_type <> 'error' THEN value END) AS best_clean,
string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, CASE WHEN bool_or(event_type = 'target') THEN 'target' ELSE arg_min(event_type, event_id) END AS event_type,
arg_min(props, event_id) AS props FROM events GROUP BY user_id""")
def best_per_key(t):
    rows = t.events.withColumn("clean", F.when(F.col("event_type") != "error", F.col("value")))
    out = ident.best_per_key(rows, ["user_id"], "event_id", {"best": "value", "best_clean": "clean"}, {"types": "event_type"}, "event_type", ["props"])
    return out.withColumn("types", joined("types"))


@query("SELECT event_type, user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def first_wins(t):
    return ident.first_wins(t.events.select("event_type", "user_id", "event_id", "value"), ["event_type", "user_id"], "event_id")


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL")
def count_by_key(t):
    return ident.count_by_key(t.events, ["event_type", "user_id"])


_LEVEL = "CASE l_linenumber WHEN 1 THEN '2A' WHEN 2 THEN '1' WHEN 3 THEN '3' WHEN 4 THEN '2D' WHEN 5 THEN '5' WHEN 6 THEN NULL ELSE '9' END"


@query(f"""SELECT l_partkey, l_linestatus, count(*) AS n_matches, min(q) AS best_q_value, CASE WHEN bool_or(label = 'target') THEN 'target' ELSE min(label) END AS target_decoy,
CASE min(rank) FILTER (WHERE level IS NOT NULL) WHEN 0 THEN '1' WHEN 1 THEN '2A' WHEN 4 THEN '2D' WHEN 5 THEN '3' WHEN 7 THEN '5' WHEN 8 THEN '9' END AS best_level
FROM (SELECT *, CASE level WHEN '1' THEN 0 WHEN '2A' THEN 1 WHEN '2D' THEN 4 WHEN '3' THEN 5 WHEN '5' THEN 7 ELSE 8 END AS rank
FROM (SELECT *, {_LEVEL} AS level FROM lines)) GROUP BY ALL""", lines=True)
def site_rollup(t):
    line = F.col("l_linenumber")
    level = F.when(line == 1, "2A").when(line == 2, "1").when(line == 3, "3").when(line == 4, "2D").when(line == 5, "5").when(line != 6, "9")
    rows = t.lines.withColumn("level", level)
    # Without a target the first label wins; ordering by the label makes "first" the smallest.
    return ident.site_rollup(rows, ["l_partkey", "l_linestatus"], "q", "label", "level", "label")


@query("SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rank FROM events")
def occurrence_rank(t):
    rows = t.events.select("event_id", "user_id", "event_type")
    return ident.occurrence_rank(rows, ["event_type"], "event_id")


@query("SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def newest_order(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return newest_row(rows, ["o_custkey"], F.struct("o_orderdate", "o_orderkey")).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT o_custkey AS dataset, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS snapshot, NULL AS reason FROM orders GROUP BY 1 HAVING count(*) = 1
UNION ALL SELECT o_custkey, NULL, count(*) || ' snapshots and no pin' FROM orders GROUP BY 1 HAVING count(*) > 1""")
def latest_snapshot(t):
    candidates = t.orders.select(F.col("o_custkey").cast("string").alias("dataset"), F.col("o_orderkey").cast("string").alias("snapshot"), "o_orderdate", "o_orderkey")
    chosen, refused = choose(candidates, "dataset", "snapshot", F.struct("o_orderdate", "o_orderkey"))
    out = chosen.withColumn("reason", F.lit(None).cast("string")).unionByName(refused.withColumn("snapshot", F.lit(None).cast("string")))
    return out.select(F.col("dataset").cast("bigint").alias("dataset"), F.col("snapshot").cast("bigint").alias("snapshot"), "reason")


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE contains(lower(c_mktsegment), 'build') ORDER BY c_mktsegment = 'BUILDING' DESC, c_acctbal DESC, c_custkey LIMIT 26""")
def ranked_hits(t):
    hits = t.customer.filter(F.contains(F.lower("c_mktsegment"), F.lit("build")))
    return ranked(hits, [(F.col("c_mktsegment") == "BUILDING").desc(), F.col("c_acctbal").desc(), F.col("c_custkey")], limit=25).select("c_custkey", "c_name", "c_acctbal")


@query("""SELECT lang, source, array_to_string(list_sort(list(DISTINCT n_chars))[1:5], ',') AS examples, greatest(count(DISTINCT n_chars) - 5, 0) AS n_more FROM documents GROUP BY ALL""")
def examples(t):
    return ident.examples(t.documents, ["lang", "source"], "n_chars", 5).withColumn("examples", joined("examples"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS place FROM orders")
def stable_order(t):
    rows = t.orders.select(F.struct("o_orderpriority", "o_orderkey").alias("key"), "o_orderkey")
    ranked = ident.occurrence_rank(rows, [], "key", "place")
    return ident.stable_order(ranked.select("o_orderkey", "place"), ["place"])


_NAMES = """reported AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE l_linenumber % 4 WHEN 0 THEN s WHEN 1 THEN s || '-calib' WHEN 2 THEN upper(s) || '-averaged-calib' ELSE replace(s, '.raw.x', '.x') END AS name
 FROM (SELECT l_orderkey, l_linenumber, l_suppkey, 'run' || l_suppkey || CASE WHEN l_suppkey % 2 = 0 THEN '.raw.x' ELSE '' END AS s FROM lineitem)),
known AS (SELECT 'run' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN '.raw.x' ELSE '' END AS name FROM supplier WHERE s_acctbal > 1000),
bare AS (SELECT lower(replace(name, '.raw', '')) AS k, min(name) AS name FROM known GROUP BY 1 HAVING count(*) = 1),
tried AS (SELECT r.*, regexp_replace(r.name, '(-calib|-averaged|-calibrated)+$', '') AS cut FROM reported r)"""


def _reported(t):
    tail = F.when(F.col("l_suppkey") % 2 == 0, F.lit(".raw.x")).otherwise(F.lit(""))
    s = F.concat(F.lit("run"), F.col("l_suppkey").cast("string"), tail)
    kind = F.col("l_linenumber") % 4
    name = F.when(kind == 0, s).when(kind == 1, F.concat(s, F.lit("-calib"))).when(kind == 2, F.concat(F.upper(s), F.lit("-averaged-calib"))) \
        .otherwise(F.replace(s, F.lit(".raw.x"), F.lit(".x")))
    known = t.supplier.filter("s_acctbal > 1000").select(F.concat(
        F.lit("run"), F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 2 == 0, F.lit(".raw.x")).otherwise(F.lit(""))).alias("name"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", name.alias("name")), known


@query(f"""WITH {_NAMES} SELECT t.l_orderkey, t.l_linenumber, t.l_suppkey, t.name, coalesce(a.name, b.name, c.name, d.name) AS resolved FROM tried t
LEFT JOIN known a ON lower(a.name) = lower(t.name) LEFT JOIN known b ON lower(b.name) = lower(t.cut) LEFT JOIN bare c ON c.k = lower(t.name) LEFT JOIN bare d ON d.k = lower(t.cut)""")
def resolve_names(t):
    rows, known = _reported(t)
    return ident.resolve_names(rows, "name", known.withColumnRenamed("name", "known"), "known")


@query(f"""WITH {_NAMES} SELECT name AS reported, count(*) AS uses FROM tried t WHERE NOT EXISTS (SELECT 1 FROM known k WHERE lower(k.name) IN (lower(t.name), lower(t.cut)))
AND NOT EXISTS (SELECT 1 FROM bare b WHERE b.k IN (lower(t.name), lower(t.cut))) GROUP BY 1""")
def unmatched_names(t):
    rows, known = _reported(t)
    return ident.unmatched_names(rows, "name", known, "name")


@query("""SELECT l_orderkey, members, key AS group_id FROM (SELECT l_orderkey, 'D:' || string_agg(DISTINCT l_suppkey::VARCHAR, ';' ORDER BY l_suppkey::VARCHAR) AS members FROM lineitem GROUP BY 1)
LEFT JOIN (SELECT DISTINCT 'D:' || s_suppkey AS key FROM supplier WHERE s_acctbal > 0) ON key = members""")
def link_to_existing_group(t):
    rows = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.col("l_suppkey").cast("string")).alias("m"))
    groups = t.supplier.filter("s_acctbal > 0").select(F.concat(F.lit("D:"), F.col("s_suppkey").cast("string")).alias("gid"))
    out = ident.link_to_existing_group(rows, "m", groups, "gid", F.lit("D"), "group_id")
    return out.select("l_orderkey", canonical_key("m", F.lit("D")).alias("members"), "group_id")


ROLES_SQL = """roles AS (SELECT k AS accession, CASE WHEN bool_or(r = 'c') AND bool_or(r = 't') THEN 'both' WHEN bool_or(r = 'c') THEN 'contaminant' ELSE 'target' END AS status
 FROM (SELECT p_partkey AS k, 't' AS r FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT p_partkey, 'c' FROM part WHERE p_retailprice > 1000 AND p_size % 4 <> 0) GROUP BY 1)"""


def _databases(t):
    entries = t.part.filter(F.col("p_size") % 3 != 0).select("p_partkey", F.lit("target").alias("role")).unionByName(
        t.part.filter("p_retailprice > 1000 AND p_size % 4 <> 0").select("p_partkey", F.lit("contaminant").alias("role")))
    return ident.database_status(entries, "p_partkey", "role")


@query(f"WITH {ROLES_SQL} SELECT * FROM roles")
def database_status(t):
    return _databases(t)


# A row names its part and, on three lines of seven, a second one; the second symbol is collapsed away.
_ENTITY_ROWS = """src AS (SELECT event_id AS o, user_id % 50 AS a, (user_id * 7) % 60 AS b, event_type FROM events),
rows AS (SELECT o, 0 AS pos, a AS acc, event_type AS gene, CASE WHEN event_type = 'error' THEN 'C|T' WHEN event_type = 'click' THEN 'C' ELSE 'T' END AS label FROM src
 UNION ALL SELECT o, 1, b, event_type, CASE WHEN event_type = 'error' THEN 'C|T' WHEN event_type = 'click' THEN 'C' ELSE 'T' END FROM src)"""


@query(f"""WITH {ROLES_SQL}, {_ENTITY_ROWS}, firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY acc ORDER BY o, pos) AS r FROM rows) WHERE r = 1),
settled AS (SELECT f.*, CASE WHEN d.status = 'both' THEN false WHEN d.status = 'contaminant' THEN true WHEN d.status = 'target' THEN false END AS decided, label = 'C|T' AS mixed,
 contains(label, 'C') AS row_c FROM firsts f LEFT JOIN roles d ON d.accession = f.acc)
SELECT acc::VARCHAR AS protein_accession, gene, CASE WHEN mixed THEN coalesce(decided, row_c) ELSE row_c END AS is_contaminant, mixed AND decided IS NULL AS label_fallback,
CASE WHEN NOT CASE WHEN mixed THEN coalesce(decided, row_c) ELSE row_c END THEN 'taxon' END AS organism FROM settled""")
def entity_table(t):
    kind = F.col("event_type")
    rows = t.events.select(
        "event_id", F.concat_ws("|", (F.col("user_id") % 50).cast("string"), ((F.col("user_id") * 7) % 60).cast("string")).alias("acc"), kind.alias("gene"), F.lit("").alias("org"),
        F.when(kind == "error", F.lit("C|T")).when(kind == "click", F.lit("C")).otherwise(F.lit("T")).alias("label"))
    databases = _databases(t).withColumn("accession", F.col("accession").cast("string"))
    out = ident.entity_table(rows, {"accession": "acc", "gene": "gene", "organism_name": "org", "label": "label"}, "event_id", "taxon", databases, "RemoveContaminant")
    return out.select("protein_accession", "gene", "is_contaminant", "label_fallback", "organism")


@query("""WITH g AS (SELECT o_orderkey, o_orderstatus, o_custkey AS a, o_custkey + 500 AS b FROM orders), m AS (SELECT o_orderkey, 0 AS pos, a AS acc, o_orderstatus FROM g UNION ALL SELECT o_orderkey, 1, b, o_orderstatus FROM g),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY acc ORDER BY o_orderkey, pos) AS r FROM m WHERE acc NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)) WHERE r = 1)
SELECT c_custkey::VARCHAR AS protein_accession, c_mktsegment AS gene, false AS is_contaminant FROM customer WHERE c_acctbal > 5000
UNION ALL SELECT acc::VARCHAR, 'g' || pos, o_orderstatus = 'F' FROM f""")
def expand_members(t):
    have = t.customer.filter("c_acctbal > 5000").select(
        F.col("c_custkey").cast("string").alias("protein_accession"), F.col("c_custkey").cast("string").alias("canonical_accession"), F.col("c_mktsegment").alias("gene"),
        F.lit(None).cast("string").alias("organism"), F.lit(None).cast("string").alias("organism_name"), F.lit("uniprot").alias("source_db"),
        F.lit(False).alias("is_contaminant"), F.lit(False).alias("label_fallback"))
    groups = t.orders.select("o_orderkey", F.array(F.col("o_custkey").cast("string"), (F.col("o_custkey") + 500).cast("string")).alias("members"), F.array(F.lit("g0"), F.lit("g1")).alias("genes"),
                             F.when(F.col("o_orderstatus") == "F", F.lit("contaminant")).otherwise(F.lit("target")).alias("label"))
    return ident.expand_members(have, groups, "members", "genes", "label", "o_orderkey", "taxon").select("protein_accession", "gene", "is_contaminant")


@query("""WITH pairs AS (SELECT p_partkey AS o, 0 AS pos, p_name || ' on ' || upper(substr(p_brand, 1, 1)) AS name, p_type AS usage FROM part
 UNION ALL SELECT p_partkey, 1, p_brand, p_type FROM part), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, usage ORDER BY o, pos) AS r FROM pairs) WHERE r = 1)
SELECT f.name, f.usage, CASE WHEN contains(f.name, ' on ') THEN substr(f.name, length(f.name)) ELSE f.name END AS residues, 'N:' || n.n_nationkey AS modification
FROM f LEFT JOIN nation n ON f.name = 'Brand#' || n.n_nationkey""")
def declared_modifications(t):
    packed = F.concat(F.col("p_type"), F.lit("\t"), F.col("p_name"), F.lit(" on "), F.upper(F.substr("p_brand", F.lit(1), F.lit(1))), F.lit("\t\t"), F.col("p_type"), F.lit("\t"), F.col("p_brand"))
    pairs = ident.unpack_pairs(t.part.select("p_partkey", F.col("p_type").alias("usage"), packed.alias("packed")), "packed", ["p_partkey", "usage"])
    hits = t.nation.select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("name"), text("N:", "n_nationkey").alias("accession"))
    return ident.declared_modifications(pairs, hits, F.struct("p_partkey", "pair_position"))


@query("""SELECT p_partkey, pos AS pair_position, category, name, CASE WHEN contains(name, ' on ') THEN substr(name, length(name)) ELSE name END AS residues
FROM (SELECT p_partkey, 0 AS pos, p_type AS category, p_name || ' on ' || upper(substr(p_brand, 1, 1)) AS name FROM part UNION ALL SELECT p_partkey, 1, p_type, p_brand FROM part)""")
def unpack_pairs(t):
    packed = F.concat(F.col("p_type"), F.lit("\t"), F.col("p_name"), F.lit(" on "), F.upper(F.substr("p_brand", F.lit(1), F.lit(1))), F.lit("\t\t"), F.col("p_type"), F.lit("\t"), F.col("p_brand"), F.lit("\t\t "))
    return ident.unpack_pairs(t.part.select("p_partkey", packed.alias("packed")), "packed", ["p_partkey"])


# Line items as match lines: a bracketed notation per return flag, and registered names for two of three.
def notation_of():
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    mod = F.concat(F.lit("[Kind:"), F.when(flag == "A", F.lit("alpha on C")).when(flag == "N", F.lit("beta on C")).otherwise(F.lit("gamma on C")), F.lit("]"))
    return F.concat(F.lit("PEP"), F.when(status == "F", F.concat(F.lit("C"), mod)).otherwise(F.lit("C")), (F.col("l_linenumber") % 3).cast("string"), mod)


def registry(t):
    """alpha has an accession, beta a mass, gamma is unknown; read off the orders' priorities."""
    rank = F.substr("o_orderpriority", F.lit(1), F.lit(1)).cast("int")
    rows = t.orders.groupBy(rank.alias("r")).agg(F.min("o_orderkey").alias("o")).filter("r <= 2")
    return rows.select(F.when(F.col("r") == 1, F.lit("alpha")).otherwise(F.lit("beta")).alias("name"), F.array(F.lit("C")).alias("targets"),
                       F.when(F.col("r") == 1, F.lit(21)).cast("bigint").alias("unimod"), F.when(F.col("r") == 2, F.lit(57.5)).alias("mass"), F.col("o").alias("entry_order"))


_TAG = "CASE l_returnflag WHEN 'A' THEN '[UNIMOD:21]' WHEN 'N' THEN '[+57.500000]' ELSE '[Info:gamma on C]' END"
FORM_SQL = f"'PEPC' || CASE WHEN l_linestatus = 'F' THEN {_TAG} ELSE '' END || (l_linenumber % 3) || {_TAG}"


@query("SELECT 'Kind:gamma on C' AS name, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS uses FROM lineitem")
def unresolved_counts(t):
    rows = t.lineitem.withColumn("notation", notation_of())
    return ident.unresolved_counts(rows, "notation", translate_notation(rows, "notation", registry(t)))


MATCH_COLUMNS = {r: [r] for r in (
    "file", "scan", "full_sequence", "charge", "mz", "retention_time", "score", "delta_score", "q_value", "q_value_notch", "notch", "pep", "pep_q_value",
    "mass_diff_ppm", "label", "accession", "ambiguity_level", "missed_cleavages", "ranges")}


def match_lines(t):
    flag = F.col("l_returnflag")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return t.lineitem.select(
        order.alias("row_order"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), F.when(flag == "A", F.lit("-calib")).otherwise(F.lit(""))).alias("file"),
        F.col("l_partkey").cast("string").alias("scan"), notation_of().alias("full_sequence"), F.col("l_quantity").cast("string").alias("charge"),
        F.col("l_discount").cast("string").alias("q_value"), F.col("l_tax").cast("string").alias("q_value_notch"),
        F.when(F.col("l_linestatus") == "F", F.lit("0|1")).otherwise(F.lit("0")).alias("notch"), F.when(flag == "R", F.lit("D|T")).otherwise(F.lit("T")).alias("label"),
        F.concat_ws("|", text("P", "l_partkey"), text("P", F.col("l_partkey") % 97)).alias("accession"), F.concat(F.lit("["), F.col("l_linenumber").cast("string"), F.lit(" to 20]")).alias("ranges"))


@query(f"""SELECT 'X:s' || l_suppkey || ':' || l_partkey || ':' || row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS psm_id,
CASE WHEN s_suppkey IS NOT NULL THEN 'mzspec:X:s' || l_suppkey || ':scan:' || l_partkey || ':' || {FORM_SQL} || '/' || CAST(l_quantity AS BIGINT) END AS usi,
l_discount AS q_value, l_tax AS q_value_notch, l_linestatus = 'F' AS notch_ambiguous, CASE WHEN l_returnflag = 'R' THEN 'decoy' ELSE 'target' END AS target_decoy,
'P' || l_partkey || ',P' || (l_partkey % 97) AS protein_accessions, CAST(l_linenumber AS BIGINT) AS start_residue, CAST(20 AS BIGINT) AS end_residue
FROM (SELECT * REPLACE (l_suppkey::VARCHAR || CASE WHEN s_suppkey IS NULL AND l_returnflag = 'A' THEN '-calib' ELSE '' END AS l_suppkey)
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 2000)""")
def match_rows(t):
    rows = match_lines(t)
    forms = translate_notation(rows, "full_sequence", registry(t))
    runs = t.supplier.filter("s_acctbal > 2000").select(text("s", "s_suppkey").alias("name"))
    # Match lines of this binding come in order of their order key, so a run of keys is a block.
    out = ident.match_rows(rows, MATCH_COLUMNS, "X", runs, "name", forms, "gptmd")
    return out.select("psm_id", "usi", "q_value", "q_value_notch", "notch_ambiguous", "target_decoy", joined("protein_accessions").alias("protein_accessions"), "start_residue", "end_residue")


@query("""SELECT 'X:' || least(a, b) || ';' || greatest(a, b) AS protein_group_id, least(a, b) || ',' || greatest(a, b) AS protein_accessions,
CASE WHEN p_type = 'PROMO' THEN 'decoy' WHEN p_type = 'ECONOMY' THEN 'contaminant' WHEN p_type = 'SMALL' THEN NULL ELSE 'target' END AS target_decoy,
CAST(p_size % 10 AS DOUBLE) AS q_value, CAST(p_size AS BIGINT) AS unique_peptides, CASE WHEN p_size % 2 = 0 THEN CAST(30 - p_size AS BIGINT) END AS shared_peptides
FROM (SELECT *, 'P' || p_partkey AS a, 'Q' || p_size AS b FROM part)""")
def group_rows(t):
    kind = F.col("p_type")
    rows = t.part.select(
        F.concat(text("Q", "p_size"), F.lit("| "), text("P", "p_partkey")).alias("acc"), F.lit("").alias("gene"),
        F.when(kind == "PROMO", F.lit("D")).when(kind == "ECONOMY", F.lit("C")).when(kind == "SMALL", F.lit("")).otherwise(F.lit("T")).alias("label"),
        (F.col("p_size") % 10).cast("string").alias("q"), F.lit("0.5|0.6").alias("cov"), F.when(F.col("p_size") % 2 == 0, F.lit("30.0")).otherwise(F.lit("")).alias("all"),
        F.col("p_size").cast("string").alias("uniq"))
    out = ident.group_rows(rows, {"accession": "acc", "gene": "gene", "label": "label", "q_value": "q", "coverage": "cov", "n_peptides": "all", "n_unique": "uniq"}, "X")
    return out.select("protein_group_id", joined("protein_accessions").alias("protein_accessions"), "target_decoy", "q_value", "unique_peptides", "shared_peptides")


@query(f"""WITH f AS (SELECT {FORM_SQL} AS form, l.*, l_discount AS q, l_tax AS q2, CASE WHEN l_returnflag = 'R' THEN 'decoy' ELSE 'target' END AS label FROM lineitem l)
SELECT 'X:' || form AS peptidoform_id, min(q) AS best_q_value, min(q2) AS best_q_value_notch, min(label) AS target_decoy, count(*) AS n_psms,
arg_min('P' || l_partkey || ',P' || (l_partkey % 97), (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS protein_accessions FROM f GROUP BY form""")
def form_rows(t):
    rows = match_lines(t)
    forms = translate_notation(rows, "full_sequence", registry(t))
    held = rows.groupBy(F.col("full_sequence").alias("notation")).agg(F.count("*").alias("n"))
    counts = held.join(forms, "notation").groupBy(F.col("proforma").alias("peptidoform")).agg(F.sum("n").alias("n_psms"))
    groups = t.part.select(text("X:P", "p_partkey").alias("protein_group_id"))
    out = ident.form_rows(rows, MATCH_COLUMNS, "X", forms, counts, groups)
    return out.select("peptidoform_id", "best_q_value", "best_q_value_notch", "target_decoy", "n_psms", joined("protein_accessions").alias("protein_accessions"))
