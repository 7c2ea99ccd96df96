"""Figures and documents on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.operators import figures
from veracat.workload.deriving import INDEX_SQL, PRESENCE_SQL, index, presence
from veracat.workload.registry import joined, query, text

_COUNTABLE = "(n_protein_groups > 0 OR n_peptidoforms > 0) AND NOT coalesce(is_contaminant, false) AND NOT starts_with(protein_accession, 'DECOY_')"
_SPREAD = f"+{PRESENCE_SQL}, spread AS (SELECT n AS n_datasets, count(*) AS n_entities FROM (SELECT protein_accession, count(DISTINCT dataset_id) AS n FROM presence WHERE {_COUNTABLE} GROUP BY 1) GROUP BY 1)"


@query(f"{_SPREAD} SELECT * FROM spread", lines=True)
def presence_spread(t):
    return figures.presence_spread(presence(t))


@query(f"""{_SPREAD}, up AS (SELECT CAST(n_datasets AS INTEGER) AS n, CAST(sum(n_entities) OVER (ORDER BY n_datasets DESC) AS BIGINT) AS n_entities FROM spread)
SELECT n, n_entities FROM up WHERE n >= 2 ORDER BY abs(n_entities - 400), n DESC LIMIT 1""", lines=True)
def shared_threshold(t):
    return figures.shared_threshold(figures.presence_spread(presence(t)), 400)


@query("SELECT count(*) AS n_keys, count(*) FILTER (WHERE u) AS n_unanimous FROM (SELECT l_suppkey, l_partkey, bool_and(coalesce(CASE WHEN l_linenumber <> 5 THEN l_linestatus = 'F' END, false)) AS u FROM lineitem GROUP BY ALL)")
def unanimous_unique(t):
    rows = t.lineitem.select(F.concat_ws(":", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")).alias("k"), F.when(F.col("l_linenumber") != 5, F.col("l_linestatus") == "F").alias("u"))
    return figures.unanimous_unique(rows, "k", "u")


@query(f"""+{PRESENCE_SQL} SELECT count(DISTINCT protein_accession) AS n_entities FROM presence WHERE dataset_id IN (SELECT 'D' || n_nationkey FROM nation WHERE n_regionkey = 1 AND n_nationkey % 2 = 0) AND {_COUNTABLE}""", lines=True)
def filtered_population(t):
    datasets = t.nation.select(text("D", "n_nationkey").alias("dataset_id"), F.when(F.col("n_regionkey") == 1, F.array(F.lit("none"))).otherwise(F.array(F.lit("none"), F.lit("phospho"))).alias("axis"),
                               F.when(F.col("n_nationkey") % 2 == 1, True).alias("mixed"))
    return figures.filtered_population(presence(t), datasets, "axis", ["none"], "mixed")


@query("SELECT count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events")
def conditional_counts(t):
    return figures.conditional_counts(t.events, "event_type", {"clicks": "click", "errors": "error"})


@query("""SELECT (SELECT count(*) FROM supplier) AS n_datasets, (SELECT CAST(sum(s_nationkey) AS BIGINT) FROM supplier) AS runs, (SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) FROM lineitem WHERE l_returnflag = 'A') AS reported,
(SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_returnflag = 'A') AS n_reporting""")
def headline_sums(t):
    reports = t.lineitem.filter("l_returnflag = 'A'").select(F.col("l_suppkey").alias("dataset_id"), F.col("l_quantity").cast("bigint").alias("value"))
    return figures.headline_sums(t.supplier, {"runs": "s_nationkey"}, reports, "value")


@query("SELECT p_brand, p_type, arg_min(p_name, (-n, p_name)) AS p_name FROM (SELECT p_brand, p_type, p_name, count(*) AS n FROM part GROUP BY ALL) GROUP BY ALL")
def modal_name(t):
    return figures.modal_name(t.part, ["p_brand", "p_type"], "p_name")


@query("SELECT dataset_id, l_returnflag AS modification_name, min(entity) AS modification, count(*) AS n_sites FROM lines WHERE label = 'target' GROUP BY ALL", lines=True)
def modification_counts(t):
    rows = t.lines.select("dataset_id", F.col("l_returnflag").alias("modification_name"), F.col("entity").alias("modification"), F.col("label").alias("target_decoy"))
    return figures.modification_counts(rows)


def _findings(t):
    kind = F.col("event_type")
    severity = F.when(kind == "error", F.lit("error")).when(kind == "view", F.lit("info")).otherwise(F.lit("warning"))
    return t.events.select(F.col("user_id").alias("dataset_id"), kind.alias("code"), severity.alias("severity"), F.col("props").alias("message"), F.when(F.col("value") > 10, F.lit("open")).otherwise(F.lit("closed")).alias("status"), "event_id")


_FINDINGS = "findings AS (SELECT user_id AS dataset_id, event_type AS code, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'info' ELSE 'warning' END AS severity, props AS message, CASE WHEN value > 10 THEN 'open' ELSE 'closed' END AS status, event_id FROM events)"


@query(f"WITH {_FINDINGS} SELECT code, severity, count(*) AS n, min(message) AS example FROM findings WHERE severity IN ('warning', 'error') GROUP BY ALL")
def finding_summary(t):
    return figures.finding_summary(_findings(t))


@query(f"""WITH {_FINDINGS} SELECT dataset_id, count(*) FILTER (WHERE severity = 'error') AS error, count(*) FILTER (WHERE severity = 'warning') AS warning, count(*) FILTER (WHERE severity = 'info') AS info,
array_to_string(list_sort(list(DISTINCT code)), ',') AS finding_codes FROM findings GROUP BY 1""")
def findings_by_severity(t):
    return figures.findings_by_severity(_findings(t)).withColumn("finding_codes", joined("finding_codes"))


@query(f"WITH {_FINDINGS} SELECT event_id, dataset_id, severity, code FROM findings WHERE status = 'open' ORDER BY dataset_id, CASE severity WHEN 'error' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END, code, event_id")
def severity_order(t):
    rows = _findings(t).filter("status = 'open'").select("event_id", "dataset_id", "severity", "code")
    return figures.severity_order(rows, ["dataset_id"], "severity", ["code", "event_id"])


@query(f"""+{PRESENCE_SQL}, {INDEX_SQL} SELECT protein_accession, i.gene, string_agg(dataset_id || '=' || n_protein_groups || '/' || n_peptidoforms, ';' ORDER BY dataset_id, n_protein_groups, n_peptidoforms) AS datasets
FROM presence p JOIN pindex i USING (protein_accession) WHERE n_protein_groups > 0 OR n_peptidoforms > 0 GROUP BY ALL""", lines=True)
def presence_join(t):
    p, i = index(t, keep_presence=True)
    out = figures.presence_join(p, i, attributes=["gene"])
    entry = F.transform("datasets", lambda d: F.concat(d["dataset_id"], F.lit("="), d["n_protein_groups"].cast("string"), F.lit("/"), d["n_peptidoforms"].cast("string")))
    return out.select("protein_accession", "gene", F.array_join(entry, ";").alias("datasets"))


@query(f"""WITH {_FINDINGS}, f AS (SELECT dataset_id, count(*) FILTER (WHERE severity = 'error') AS error, array_to_string(list_sort(list(DISTINCT code)), ',') AS finding_codes, count(DISTINCT (code, severity, message)) AS n_findings FROM findings WHERE status = 'open' GROUP BY 1),
m AS (SELECT o_custkey AS dataset_id, o_orderstatus AS modification_name, count(*) AS n_sites FROM orders GROUP BY ALL), mm AS (SELECT dataset_id, string_agg(modification_name || n_sites, ',' ORDER BY n_sites DESC, modification_name) AS modifications FROM m GROUP BY 1)
SELECT c_custkey AS dataset_id, c_name AS title, c_mktsegment AS instrument, s_name AS bundle_id, f.error, f.finding_codes, f.n_findings, mm.modifications
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN f ON f.dataset_id = c_custkey LEFT JOIN mm ON mm.dataset_id = c_custkey""")
def dataset_documents(t):
    overview = t.customer.select(F.col("c_custkey").alias("dataset_id"), F.col("c_name").alias("title"))
    facts = t.customer.select(F.col("c_custkey").alias("dataset_id"), F.col("c_mktsegment").alias("instrument"))
    snaps = t.supplier.select(F.col("s_suppkey").alias("dataset_id"), F.col("s_name").alias("bundle_id"))
    mods = t.orders.groupBy(F.col("o_custkey").alias("dataset_id"), F.col("o_orderstatus").alias("modification_name")).agg(F.count("*").alias("n_sites")).withColumn("modification", F.lit("U"))
    values = t.customer.select(F.col("c_custkey").alias("dataset_id"), F.lit("id_rate").alias("name"), F.col("c_acctbal").alias("value"), F.lit("d").alias("definition_id"))
    out = figures.dataset_documents(overview, facts, snaps, _findings(t), mods, values)
    mod = F.transform("modifications", lambda m: F.concat(m["modification_name"], m["n_sites"].cast("string")))
    return out.select("dataset_id", "title", "instrument", "bundle_id", "error", joined("finding_codes").alias("finding_codes"), F.when(F.col("findings").isNotNull(), F.size("findings")).cast("bigint").alias("n_findings"), F.array_join(mod, ",").alias("modifications"))


@query("""SELECT c_custkey AS dataset_id, c_mktsegment AS pipeline_commit, p.repo AS public_repo, p.pc AS public_commit FROM customer LEFT JOIN (SELECT o_custkey, o_orderpriority, min(o_orderkey)::VARCHAR AS pc, 'r' || min(o_orderkey) AS repo FROM (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'BUILDING' WHEN 'O' THEN 'MACHINERY' END AS o_orderpriority FROM orders) GROUP BY ALL) p ON p.o_custkey = c_custkey AND p.o_orderpriority = c_mktsegment""")
def public_source_lookup(t):
    s = F.col("o_orderstatus")
    firsts = t.orders.select(F.col("o_custkey").alias("dataset_id"), F.when(s == "F", F.lit("BUILDING")).when(s == "O", F.lit("MACHINERY")).alias("commit"), "o_orderkey") \
        .groupBy("dataset_id", "commit").agg(F.min("o_orderkey").alias("k"))
    commits = firsts.select("dataset_id", "commit", F.col("k").cast("string").alias("public_commit"), text("r", "k").alias("public_repo"))
    datasets = t.customer.select(F.col("c_custkey").alias("dataset_id"), F.col("c_mktsegment").alias("pipeline_commit"))
    return figures.public_source_lookup(datasets, commits)
