"""Acceptance rules and gates on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.functions.rules import allowed_taxon, classify_source
from veracat.operators import filters, samples
from veracat.operators.identification import accepted_counts as count_accepted
from veracat.operators.identification import accepted_group_count as count_groups
from veracat.workload.registry import query

_KEYS = ["dataset_id", "entity", "group_id", "form_id", "label", "q", "n"]
_ROWS = "SELECT dataset_id, entity, group_id, form_id, label, q, n FROM lines "
_NOTCH = "(q2 IS NULL OR q2 <= 0.01)"


@query(_ROWS + f"WHERE label = 'target' AND q <= 0.01 AND {_NOTCH} AND coalesce(ambiguous, false) = false", lines=True)
def accepted_matches(t):
    return filters.accepted_matches(t.lines, "label", "q", "q2", "ambiguous").select(*_KEYS)


@query(_ROWS + f"WHERE label = 'target' AND q <= 0.01 AND {_NOTCH}", lines=True)
def accepted_forms(t):
    return filters.accepted_forms(t.lines, "label", "q", "q2").select(*_KEYS)


@query(_ROWS.replace("FROM lines", "FROM (SELECT * REPLACE (nullif(label, 'contaminant') AS label) FROM lines)")
       + "WHERE label <> 'decoy' AND q <= 0.01", lines=True)
def accepted_groups(t):
    rows = t.lines.withColumn("label", F.nullif("label", F.lit("contaminant")))
    return filters.accepted_groups(rows, "label", "q").select(*_KEYS)


@query(f"""SELECT count(*) FILTER (WHERE l_returnflag = 'N' AND q <= 0.01 AND {_NOTCH} AND NOT coalesce(ambiguous, false)) AS n_accepted
FROM lines""", lines=True)
def accepted_counts(t):
    return count_accepted(t.lines, F.col("q"), F.col("l_returnflag") == "N", F.col("q2"), F.col("ambiguous"))


@query("""SELECT count(*) FILTER (WHERE (label IS NULL OR label <> 'decoy') AND q <= 0.01) AS n_accepted
FROM (SELECT nullif(label, 'contaminant') AS label, q FROM lines)""", lines=True)
def accepted_group_count(t):
    return count_groups(t.lines.withColumn("label", F.nullif("label", F.lit("contaminant"))), "label", "q")


@query("""SELECT p_partkey, accession FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'DECOY_' WHEN p_size % 5 = 1 THEN 'DECOYX' ELSE 'P' END
|| p_partkey AS accession FROM part) WHERE NOT starts_with(accession, 'DECOY_')""")
def without_decoys(t):
    kind = F.col("p_size") % 5
    prefix = F.when(kind == 0, F.lit("DECOY_")).when(kind == 1, F.lit("DECOYX")).otherwise(F.lit("P"))
    rows = t.part.select("p_partkey", F.concat(prefix, F.col("p_partkey").cast("string")).alias("accession"))
    return filters.without_decoys(rows, "accession")


@query("""SELECT o_orderkey, CASE WHEN ok THEN 'kept' ELSE 'refused' END AS side, CASE WHEN ok THEN reason ELSE coalesce(nullif(trim(reason), ''), 'no reason given') END AS reason
FROM (SELECT o_orderkey, coalesce(o_orderstatus = 'F', false) AS ok, CASE WHEN o_orderpriority LIKE '1%' THEN '' ELSE o_orderpriority END AS reason FROM orders)""")
def status_gate(t):
    entries = t.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.when(F.startswith("o_orderpriority", F.lit("1")), F.lit("")).otherwise(F.col("o_orderpriority")).alias("reason"),
    )
    kept, refused = filters.status_gate(entries, allowed=["F"])
    return kept.select("o_orderkey", F.lit("kept").alias("side"), "reason").unionByName(refused.select("o_orderkey", F.lit("refused").alias("side"), "reason"))


@query("""SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS available FROM customer""")
def available_only(t):
    allowed = t.customer.select("c_custkey")
    snapshots = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    have, lack = filters.available_only(allowed, snapshots, "c_custkey")
    return have.withColumn("available", F.lit(True)).unionByName(lack.withColumn("available", F.lit(False)))


_ANNOTATED = """(SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN '' ELSE p_brand END AS term, p_type AS aspect,
CASE WHEN p_size % 8 = 0 THEN 'no_entry' ELSE 'annotated' END AS status FROM part)"""


def _annotated(t):
    return t.part.select(
        "p_partkey", F.when(F.col("p_size") % 4 == 0, F.lit("")).otherwise(F.col("p_brand")).alias("term"), F.col("p_type").alias("aspect"),
        F.when(F.col("p_size") % 8 == 0, F.lit("no_entry")).otherwise(F.lit("annotated")).alias("status"),
    )


@query(f"SELECT p_partkey, term FROM {_ANNOTATED} WHERE term <> '' AND aspect = 'ECONOMY'")
def annotation_filter(t):
    return filters.annotation_filter(_annotated(t), "term", "aspect", "status", "ECONOMY")[0].select("p_partkey", "term")


@query(f"""SELECT CASE WHEN term = '' THEN 'no term (' || status || ')' ELSE 'aspect ' || aspect END AS reason, count(*) AS n
FROM {_ANNOTATED} WHERE term = '' OR aspect <> 'ECONOMY' GROUP BY 1""")
def annotation_left_out(t):
    return filters.annotation_filter(_annotated(t), "term", "aspect", "status", "ECONOMY")[1]


@query("""SELECT 'kept' AS side, doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
UNION ALL SELECT 'unsearched', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
UNION ALL SELECT 'unnamed', doc_id FROM labels WHERE quality = 1 AND doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 400)""")
def scope_gate(t):
    good = t.labels.filter("quality = 1").select("doc_id")
    kept, unsearched, _, _ = samples.scope_gate(t.documents.select("doc_id"), good, "doc_id")
    _, _, unnamed, _ = samples.scope_gate(t.documents.filter("n_chars > 400").select("doc_id"), good, "doc_id")
    tag = lambda df, side: df.select(F.lit(side).alias("side"), "doc_id")
    return tag(kept, "kept").unionByName(tag(unsearched, "unsearched")).unionByName(tag(unnamed, "unnamed"))


@query("""SELECT n_kept, n_unsearched, n_unnamed, CASE WHEN n_kept = 0 THEN 'unmatched' WHEN n_unsearched > 0 OR n_unnamed > 0 THEN 'partial' ELSE 'trusted' END AS status
FROM (SELECT count(*) FILTER (WHERE l.doc_id IS NOT NULL AND d.doc_id IS NOT NULL) AS n_kept, count(*) FILTER (WHERE l.doc_id IS NULL) AS n_unsearched,
count(*) FILTER (WHERE d.doc_id IS NULL) AS n_unnamed FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id)""")
def scope_status(t):
    return samples.scope_gate(t.documents.select("doc_id"), t.labels.select("doc_id"), "doc_id")[3]


@query("""SELECT file, p_partkey FROM (SELECT p_partkey, p_brand || '_' || p_size || '.raw' AS file, p_brand || '_' || p_size AS stem FROM part)
WHERE file NOT IN (SELECT p_brand || '_' || p_size || '.raw' FROM part WHERE p_type = 'PROMO')
AND stem NOT IN (SELECT p_brand || '_' || p_size FROM part WHERE p_type = 'SMALL' AND p_retailprice > 1000)""")
def excluded_inputs(t):
    stem = F.concat(F.col("p_brand"), F.lit("_"), F.col("p_size").cast("string"))
    files = t.part.select("p_partkey", F.concat(stem, F.lit(".raw")).alias("file"))
    gone = t.part.filter("p_type = 'PROMO'").select(F.concat(F.lit("/work/"), stem, F.lit(".raw")).alias("name")).unionByName(
        t.part.filter("p_type = 'SMALL' AND p_retailprice > 1000").select(F.concat(stem, F.lit(".mzML")).alias("name"))
    )
    return samples.excluded_inputs(files, "file", gone, "name")


@query("""(SELECT 'left' AS side, p_brand AS v FROM part WHERE p_size <= 25 EXCEPT ALL SELECT 'left', p_brand FROM part WHERE p_size > 25)
UNION ALL (SELECT 'right', p_brand FROM part WHERE p_size > 25 EXCEPT ALL SELECT 'right', p_brand FROM part WHERE p_size <= 25)""")
def set_differences(t):
    small, large = t.part.filter("p_size <= 25").select(F.col("p_brand").alias("v")), t.part.filter("p_size > 25").select(F.col("p_brand").alias("v"))
    left, right = samples.difference(small, large)
    return left.select(F.lit("left").alias("side"), "v").unionByName(right.select(F.lit("right").alias("side"), "v"))


@query("""SELECT o.o_orderkey, CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderstatus END AS recorded, a.sha AS actual,
coalesce(CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderstatus END = a.sha, true) AS unchanged
FROM orders o JOIN (SELECT l_orderkey, max(CASE WHEN l_linestatus = 'O' THEN 'O' ELSE 'F' END) AS sha FROM lineitem GROUP BY 1) a ON a.l_orderkey = o.o_orderkey""")
def unchanged_lineage(t):
    recorded = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus")).alias("recorded"))
    actual = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linestatus").alias("sha"))
    same, changed = samples.unchanged_lineage(recorded, "o_orderkey", "recorded", actual, "l_orderkey", "sha")
    kept = same.join(actual, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "recorded", F.col("sha").alias("actual"), F.lit(True).alias("unchanged"))
    return kept.unionByName(changed.withColumn("unchanged", F.lit(False)))


@query("""SELECT p_partkey, CASE WHEN starts_with(upper(acc), 'DECOY_') THEN 'decoy' WHEN c THEN 'contaminants' ELSE 'uniprot' END AS source_db,
CASE WHEN NOT starts_with(upper(acc), 'DECOY_') AND NOT c THEN p_brand END AS organism
FROM (SELECT p_partkey, p_brand, CASE WHEN p_size % 3 = 0 THEN 'Decoy_' ELSE 'P' END || p_partkey AS acc, p_size % 2 = 0 AS c FROM part)""")
def classify_sources(t):
    acc = F.concat(F.when(F.col("p_size") % 3 == 0, F.lit("Decoy_")).otherwise(F.lit("P")), F.col("p_partkey").cast("string"))
    source = classify_source(acc, F.col("p_size") % 2 == 0)
    return t.part.select("p_partkey", source.alias("source_db"), allowed_taxon(source, "p_brand").alias("organism"))
