"""Data-quality operators on the benchmark tables."""

from dataclasses import replace

from pyspark.sql import functions as F

from veracat.operators import quality as q
from veracat.operators.search import table_list
from veracat.operators.snapshots import self_description as describe
from veracat.sources.files import cell_shape_check as check_shape
from veracat.workload.registry import query, text

_KEY_CHECK = """SELECT '{name}' AS name, '{kind}' AS kind, count(*) = 0 AS ok, count(*) AS observed, CAST(0 AS BIGINT) AS expected,
CASE WHEN count(*) > 0 THEN 'e.g. ' || min({example}::VARCHAR) END AS detail FROM ({bad})"""


def _sql(name, bad, example, kind="unique"):
    return _KEY_CHECK.format(name=name, kind=kind, example=example, bad=bad)


_UNIQUE = _sql("orders.o_orderkey", "SELECT o_custkey, o_orderkey FROM orders GROUP BY ALL HAVING count(*) > 1", "o_orderkey")
_COMPOSITE = _sql("lineitem (l_orderkey, l_linenumber)", "SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber FROM lineitem) WHERE l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1", "l_orderkey")
_NULLSAFE = _sql("lineitem (l_suppkey, l_linenumber)", "SELECT l_suppkey, l_linenumber FROM (SELECT l_suppkey, nullif(l_linenumber, 7) AS l_linenumber FROM lineitem) GROUP BY ALL HAVING count(*) > 1", "l_suppkey", "engine-unique")


@query(_UNIQUE)
def unique_key(t):
    return q.unique_key(t.orders, "orders", ["o_orderkey"], ["o_custkey"])


@query(_COMPOSITE)
def unique_composite(t):
    return q.unique_key(t.lineitem.withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(7))), "lineitem", ["l_orderkey", "l_linenumber"], [])


@query(_NULLSAFE)
def unique_key_nullsafe(t):
    return q.unique_key_nullsafe(t.lineitem.withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(7))), "lineitem", ["l_suppkey", "l_linenumber"], "l_suppkey")


_DANGLING = _sql("lineitem.l_orderkey -> orders.o_orderkey", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')", "l_orderkey", "reference")


@query(_DANGLING)
def dangling_references(t):
    return q.dangling_references(t.lineitem, "lineitem", "l_orderkey", t.orders.filter("o_orderstatus <> 'P'"), "orders", "o_orderkey", scope=[])


@query("""SELECT DISTINCT dataset_id, m AS val FROM (SELECT dataset_id, unnest(members) AS m FROM members) a WHERE NOT EXISTS (SELECT 1 FROM lines l WHERE l.dataset_id = a.dataset_id AND l.entity = a.m AND l.label = 'target')""", lines=True)
def dangling_members(t):
    return q.dangling_values(t.members, "members[]", t.lines.filter("label = 'target'"), "entity")


_TYPES = """SELECT CASE WHEN event_type IN ('click', 'view', 'error') THEN 'events.user_id -> ' || CASE event_type WHEN 'click' THEN 'click.c_custkey' WHEN 'view' THEN 'view.s_suppkey' ELSE 'error.p_partkey' END ELSE 'events.event_type ' || event_type END AS name,
'reference' AS kind, event_type IN ('click', 'view', 'error') AND count(*) FILTER (WHERE NOT known) = 0 AS ok, CASE WHEN event_type IN ('click', 'view', 'error') THEN count(*) FILTER (WHERE NOT known) END AS observed, CAST(0 AS BIGINT) AS expected,
CASE WHEN event_type NOT IN ('click', 'view', 'error') THEN 'names no table' WHEN count(*) FILTER (WHERE NOT known) > 0 THEN 'e.g. ' || min(user_id::VARCHAR) FILTER (WHERE NOT known) END AS detail
FROM (SELECT DISTINCT event_type, user_id, CASE event_type WHEN 'click' THEN user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) WHEN 'view' THEN user_id IN (SELECT s_suppkey FROM supplier) WHEN 'error' THEN user_id IN (SELECT p_partkey FROM part) ELSE false END AS known FROM events) GROUP BY event_type"""


@query(_TYPES)
def polymorphic_reference(t):
    targets = {"click": (t.customer.filter("c_acctbal > 0"), "c_custkey"), "view": (t.supplier, "s_suppkey"), "error": (t.part, "p_partkey")}
    return q.polymorphic_reference(t.events, "events", "event_type", "user_id", targets, scope=[])


def _copies(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", F.array("o_orderstatus").alias("tags"))
    altered = t.orders.filter("o_orderpriority LIKE '2%'").select("o_orderkey", "o_custkey", "o_orderpriority", F.array(F.lit("X")).alias("tags"))
    return o.unionByName(o.filter("o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%'")).unionByName(altered)


_COPIES = """copies AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus AS tag FROM orders UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%'
UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, 'X' FROM orders WHERE o_orderpriority LIKE '2%')"""


@query(f"WITH {_COPIES}, w AS (SELECT o_orderkey, count(DISTINCT (o_custkey, o_orderpriority, tag)) AS v FROM copies GROUP BY 1) SELECT DISTINCT c.* FROM copies c JOIN w USING (o_orderkey) WHERE v = 1 UNION ALL SELECT c.* FROM copies c JOIN w USING (o_orderkey) WHERE v > 1")
def collapse_exact_duplicates(t):
    kept, _ = q.collapse_exact_duplicates(_copies(t), ["o_orderkey"])
    return kept.select("o_orderkey", "o_custkey", "o_orderpriority", F.element_at("tags", 1).alias("tag"))


@query(f"WITH {_COPIES} SELECT o_orderkey, count(*) AS written, count(*) - 1 AS dropped FROM copies GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT (o_custkey, o_orderpriority, tag)) = 1")
def collapse_report(t):
    return q.collapse_exact_duplicates(_copies(t), ["o_orderkey"])[1]


@query("SELECT text, count(*) AS written, count(*) - 1 AS dropped FROM documents GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT lang) = 1")
def collapse_documents(t):
    return q.collapse_exact_duplicates(t.documents.select("text", "lang"), ["text"])[1]


@query("""SELECT y || '/' || p AS name, 'row_count' AS kind, p <> '5-LOW' AND coalesce(n, 0) = e AS ok, CASE WHEN p <> '5-LOW' THEN coalesce(n, 0) END AS observed, e AS expected, CASE WHEN p = '5-LOW' THEN 'a table no schema knows' END AS detail
FROM (SELECT year(o_orderdate)::VARCHAR AS y, o_orderpriority AS p, count(*) FILTER (WHERE o_orderkey <> 7) + count(*) FILTER (WHERE o_custkey = 1) AS e FROM orders GROUP BY ALL) LEFT JOIN (SELECT year(o_orderdate)::VARCHAR AS y, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL) USING (y, p)""")
def row_count_check(t):
    rows = t.orders.select(F.year("o_orderdate").cast("string").alias("y"), F.col("o_orderpriority").alias("p"), "o_orderkey", "o_custkey")
    expected = rows.groupBy("y", "p").agg((F.count_if(F.col("o_orderkey") != 7) + F.count_if(F.col("o_custkey") == 1)).alias("expected"))
    return q.row_count_check(rows, expected, ["y", "p"], ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"], "p")


_PAIR = """obs AS (SELECT l_orderkey::VARCHAR AS dataset_id, 'qty' AS name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS v FROM lineitem GROUP BY 1),
exp AS (SELECT l_orderkey::VARCHAR AS dataset_id, 'qty' AS name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) + CASE WHEN max(l_suppkey) = 50 THEN 1 ELSE 0 END AS v FROM lineitem WHERE l_returnflag <> 'Z' GROUP BY l_orderkey HAVING min(l_linenumber) < 4)"""


def _pair(t):
    qty = F.sum(F.col("l_quantity").cast("bigint"))
    key = F.col("l_orderkey").cast("string").alias("dataset_id")
    obs = t.lineitem.groupBy(key).agg(qty.alias("value")).withColumn("name", F.lit("qty"))
    exp = t.lineitem.groupBy(key).agg((qty + F.when(F.max("l_suppkey") == 50, 1).otherwise(0)).alias("value"), F.min("l_linenumber").alias("m")).filter("m < 4").drop("m").withColumn("name", F.lit("qty"))
    return q.reconcile(obs, exp, ["dataset_id", "name"])


@query(f"WITH {_PAIR} SELECT coalesce(o.dataset_id, e.dataset_id) AS dataset_id, coalesce(o.name, e.name) AS name, o.v AS observed, e.v AS expected, o.v IS NOT NULL AND e.v IS NOT NULL AS comparable, coalesce(o.v = e.v, true) AS ok FROM obs o FULL JOIN exp e ON o.dataset_id = e.dataset_id")
def reconcile(t):
    return _pair(t)


_MISMATCH = f"SELECT o.dataset_id || ':count_mismatch:qty' AS finding_id, o.dataset_id, CAST(NULL AS VARCHAR) AS run_id, 'count_mismatch' AS code, 'warning' AS severity, 'open' AS status, 'qty: these tables hold ' || o.v || ', the producer reported ' || e.v AS message, 'reconciliation' AS source FROM obs o JOIN exp e ON o.dataset_id = e.dataset_id WHERE o.v <> e.v"


@query(f"WITH {_PAIR} {_MISMATCH}")
def mismatch_findings(t):
    return q.mismatch_findings(_pair(t))


_METRICS = "SELECT l_orderkey, CASE WHEN l_linenumber = 3 THEN NULL ELSE CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 2 END END AS v, l_returnflag AS source FROM lineitem"


def _metrics(t):
    v = F.when(F.col("l_linenumber") != 3, F.when(F.col("l_suppkey") % 5 == 0, 1).otherwise(2))
    return t.lineitem.select("l_orderkey", v.alias("value"), F.col("l_returnflag").alias("source"))


_CONFLICT = f"SELECT l_orderkey FROM ({_METRICS}) GROUP BY 1 HAVING count(*) > 1 AND (count(DISTINCT v) > 1 OR (count(v) > 0 AND count(v) < count(*)))"


@query(f"SELECT l_orderkey, count(*) AS n_rows, min(v) AS lowest, max(v) AS highest, count(*) FILTER (WHERE v IS NULL) AS n_null FROM ({_METRICS}) WHERE l_orderkey IN ({_CONFLICT}) GROUP BY 1")
def metric_conflicts(t):
    return q.metric_conflicts(_metrics(t), ["l_orderkey"])


@query(f"SELECT l_orderkey, source, v AS value, count(*) AS n_rows FROM ({_METRICS}) WHERE l_orderkey IN ({_CONFLICT}) GROUP BY ALL")
def conflicting_values(t):
    return q.conflicting_values(_metrics(t), ["l_orderkey"])


_STUDY = _sql("study.o_custkey -> customer.c_custkey", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')", "o_custkey", "study-reference")


@query(_STUDY)
def study_references(t):
    return q.dangling_references(t.orders, "study", "o_custkey", t.customer.filter("c_mktsegment <> 'BUILDING'"), "customer", "c_custkey", scope=[], kind="study-reference")


@query("""SELECT o_orderkey, lower(v) IN ('unknown', 'na') AS computed_flag FROM (SELECT o_orderkey, o_orderstatus AS s, CASE o_orderpriority WHEN '1-URGENT' THEN 'unknown' WHEN '2-HIGH' THEN 'NA' WHEN '3-MEDIUM' THEN '' ELSE o_orderpriority END AS v FROM orders)
WHERE v <> '' AND s <> 'P' AND (s = 'F') <> (lower(v) IN ('unknown', 'na'))""")
def reserved_flag_conflicts(t):
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    rows = t.orders.select("o_orderkey", F.when(p == "1-URGENT", F.lit("unknown")).when(p == "2-HIGH", F.lit("NA")).when(p == "3-MEDIUM", F.lit("")).otherwise(p).alias("v"),
                           F.when(s == "F", F.lit("True")).when(s == "O", F.lit("no")).alias("flag"))
    return q.reserved_flag_conflicts(rows, "flag", "v").select("o_orderkey", "computed_flag")


@query("SELECT DISTINCT 'B' || o_custkey AS definition_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def undeclared_definitions(t):
    return q.undeclared_definitions(t.orders.select(text("B", "o_custkey").alias("d")), "d", t.customer.filter("c_acctbal > 0").select(text("B", "c_custkey").alias("d")), "d")


@query("""SELECT 'differs: o_orderstatus' AS rule, count(*) FILTER (WHERE o_orderstatus <> 'F') AS n FROM orders UNION ALL SELECT 'unknown o_orderpriority', count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) FROM orders
UNION ALL SELECT 'no rows', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM orders UNION ALL SELECT 'unknown columns', 1""")
def acceptance_checks(t):
    rows = t.orders.select("o_orderstatus", "o_orderpriority", "o_totalprice")
    return q.acceptance_checks(rows, {"o_orderstatus": "F"}, "o_orderpriority", ["1-URGENT", "2-HIGH"], ["o_orderstatus", "o_orderpriority"])


@query("""WITH d AS (SELECT 'h' || (p_partkey % 40) AS sha256, count(DISTINCT p_brand) AS n_datasets FROM part GROUP BY 1), a AS (SELECT 'h' || s_suppkey AS sha256, count(*) FILTER (WHERE s_acctbal > 0) AS n, count(*) FILTER (WHERE s_acctbal <= 0) AS stale,
min(s_name) FILTER (WHERE s_acctbal > 0) AS id FROM (SELECT s_suppkey % 60 AS s_suppkey, s_name, s_acctbal FROM supplier) GROUP BY 1)
SELECT sha256, n_datasets, coalesce(n, 0) AS n_artefacts, coalesce(stale, 0) AS n_stale, CASE WHEN n = 1 THEN id END AS artefact_id, CASE WHEN coalesce(n, 0) = 0 THEN 'uncovered' WHEN n = 1 THEN 'covered' ELSE 'ambiguous' END AS status FROM d LEFT JOIN a USING (sha256)""")
def engine_coverage(t):
    databases = t.part.select(F.col("p_brand").alias("dataset_id"), text("h", F.col("p_partkey") % 40).alias("sha256"))
    artefacts = t.supplier.select(F.col("s_name").alias("artefact_id"), text("h", F.col("s_suppkey") % 60).alias("search_database"), F.when(F.col("s_acctbal") > 0, F.lit("1")).otherwise(F.lit("0")).alias("schema_version"))
    return q.engine_coverage(databases, artefacts, "1")


@query("""SELECT o_custkey, 'more than one snapshot' AS problem FROM orders GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT o_custkey, 'o_orderstatus is not F' FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus <> 'F') > 0""")
def version_gate(t):
    return q.version_gate(t.orders, "o_custkey", {"o_orderstatus": "F"})



@query("""SELECT p_brand || ':unmatched_runs' AS finding_id, p_brand AS dataset_id, CAST(NULL AS VARCHAR) AS run_id, 'unmatched_runs' AS code, 'warning' AS severity, 'open' AS status, count(*) || ' name(s), e.g. ' || min(p_name) AS message, 'ingest' AS source
FROM part WHERE p_size > 40 GROUP BY p_brand UNION ALL SELECT p_brand || ':excluded_from_search:' || p_partkey, p_brand, p_partkey::VARCHAR, 'excluded_from_search', CASE WHEN p_size > 45 THEN 'error' ELSE 'info' END, 'open', p_name, 'provenance' FROM part WHERE p_type = 'PROMO'""")
def finding_builders(t):
    counted = t.part.filter("p_size > 40").groupBy(F.col("p_brand").alias("dataset_id")).agg(F.count("*").alias("n"), F.min("p_name").alias("e"))
    names = q.findings(counted, "unmatched_runs", "warning", F.concat(F.col("n").cast("string"), F.lit(" name(s), e.g. "), F.col("e")), "ingest")
    part = t.part.filter("p_type = 'PROMO'").withColumnRenamed("p_brand", "dataset_id")
    key = F.col("p_partkey").cast("string")
    gone = q.findings(part, "excluded_from_search", F.when(F.col("p_size") > 45, F.lit("error")).otherwise(F.lit("info")), F.col("p_name"), "provenance", run=key, suffix=key)
    return names.unionByName(gone)


_ALL_CHECKS = " UNION ALL ".join(f"SELECT * FROM ({s})" for s in (_UNIQUE, _COMPOSITE, _NULLSAFE, _DANGLING, _TYPES, _STUDY))


@query(f"SELECT * FROM ({_ALL_CHECKS}) WHERE NOT ok")
def build_gate(t):
    """All rules at once, as a build checks them: each table is read once."""
    tables = {
        "lineitem": t.lineitem.withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(7))), "orders": t.orders, "kept": t.orders.filter("o_orderstatus <> 'P'"), "study": t.orders,
        "customer": t.customer.filter("c_mktsegment <> 'BUILDING'"), "events": t.events, "click": t.customer.filter("c_acctbal > 0"), "view": t.supplier, "error": t.part,
    }
    rules = [
        q.unique_rule("orders", ["o_orderkey"], ["o_custkey"]), q.unique_rule("lineitem", ["l_orderkey", "l_linenumber"], []), q.nullsafe_rule("lineitem", ["l_suppkey", "l_linenumber"], "l_suppkey"),
        replace(q.reference_rule("lineitem", "l_orderkey", "orders", "o_orderkey", []), targets=((None, "kept", "o_orderkey"),)),
        q.typed_rule("events", "event_type", "user_id", {"click": ("click", "c_custkey"), "view": ("view", "s_suppkey"), "error": ("error", "p_partkey")}, []),
        q.reference_rule("study", "o_custkey", "customer", "c_custkey", [], "study-reference"),
    ]
    return q.build_gate(q.checked(tables, rules))


@query("""SELECT 'lineitem' AS table_name, count(*) AS rows, 'bundle' AS kind FROM lineitem UNION ALL SELECT 'orders', count(*), 'bundle' FROM orders UNION ALL SELECT 'accepted', count(*), 'view' FROM lineitem WHERE l_discount <= 0.01 UNION ALL SELECT 'nobody', 0, 'study'""")
def table_list_rows(t):
    nobody = t.orders.filter("o_orderkey IS NULL")
    return table_list({"lineitem": (t.lineitem, "bundle"), "orders": (t.orders, "bundle"), "accepted": (t.lineitem.filter("l_discount <= 0.01"), "view"), "nobody": (nobody, "study")})


@query("SELECT 'orders' AS table_name, count(*) AS rows, '1' AS schema_version FROM orders UNION ALL SELECT 'customer', count(*), '1' FROM customer")
def self_description(t):
    tables = table_list({"orders": (t.orders, "bundle"), "customer": (t.customer, "bundle")})
    out = describe({"schema_version": "1"}, t.spark, unique_key(t), tables, t.orders.select("o_orderkey"))
    # The description holds one row of versions, so attaching it multiplies nothing.
    version = out["catalog_meta"].first()["schema_version"]
    return out["catalog_tables"].select("table_name", "rows", F.lit(version).alias("schema_version"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def schema_drift(t):
    return q.schema_drift(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "F")


@query("""SELECT o_orderkey, o_orderdate_changed AS changed FROM (SELECT o_orderkey, o_totalprice > 300000 OR o_orderstatus = 'P' AS o_orderdate_changed FROM orders) WHERE o_orderdate_changed""")
def replaced_since(t):
    opened = t.orders.select("o_orderkey", F.col("o_totalprice").alias("v"))
    now = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", F.when(F.col("o_totalprice") > 300000, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("v"))
    return q.replaced_since(now, opened, "o_orderkey", "v").select("o_orderkey", F.lit(True).alias("changed"))


@query(r"SELECT doc_id, len(string_split(text, ' ')) AS n_cells FROM documents WHERE len(string_split(text, ' ')) <> 40")
def cell_shape(t):
    return check_shape(t.documents.select("doc_id", "text"), "text", 40, " ").select("doc_id", F.col("n_cells").cast("bigint").alias("n_cells"))
