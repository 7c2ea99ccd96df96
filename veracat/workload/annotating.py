"""Term annotations on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.operators import annotation
from veracat.operators.search import localisation_categories as locate
from veracat.workload.registry import joined, query, text

# A part is an annotation row: its brand is the group, its name the term, its size the members.
_STATUS = "CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'no_entry' WHEN p_brand = 'Brand#3' THEN 'contaminant' WHEN p_brand = 'Brand#4' AND p_size > 25 THEN 'no_go_terms' ELSE 'annotated' END"


def _status():
    b = F.col("p_brand")
    return F.when(b.isin("Brand#1", "Brand#2"), F.lit("no_entry")).when(b == "Brand#3", F.lit("contaminant")).when((b == "Brand#4") & (F.col("p_size") > 25), F.lit("no_go_terms")).otherwise(F.lit("annotated"))


@query(f"""WITH g AS (SELECT p_brand, min({_STATUS}) AS lo, max({_STATUS}) AS hi, max(p_retailprice) AS q, max(p_size) AS m FROM part GROUP BY 1)
SELECT unnest(['status_annotated', 'status_no_go_terms', 'status_no_entry', 'status_contaminant', 'n_multi_member_groups', 'two_statuses']) AS counter, unnest([count(*) FILTER (WHERE q <= 1100 AND lo = 'annotated'), count(*) FILTER (WHERE q <= 1100 AND lo = 'no_go_terms'),
count(*) FILTER (WHERE q <= 1100 AND lo = 'no_entry'), count(*) FILTER (WHERE q <= 1100 AND lo = 'contaminant'), count(*) FILTER (WHERE q <= 1100 AND m > 1), count(*) FILTER (WHERE lo <> hi)]) AS n FROM g""")
def status_recount(t):
    return annotation.status_recount(t.part.withColumn("status", _status()), "p_brand", "status", "p_retailprice", "p_size", 1100.0)


@query("SELECT 'status_annotated' AS counter, count(*) AS n, CAST(-1 AS BIGINT) AS header FROM (SELECT p_type, p_brand FROM part GROUP BY ALL HAVING max(p_retailprice) <= 2000)")
def counter_problems(t):
    rows = t.part.select(F.concat_ws(":", "p_type", "p_brand").alias("g"), F.lit("annotated").alias("s"), F.col("p_retailprice").alias("q"), F.lit(1).alias("m"))
    recount = annotation.status_recount(rows, "g", "s", "q", "m", 2000.0)
    header = recount.select(F.col("counter").alias("key"), F.when(F.col("counter") == "status_annotated", F.lit("-1")).otherwise(F.col("n").cast("string")).alias("value"))
    return annotation.counter_problems(recount, header)


@query("SELECT l_partkey::VARCHAR AS accession, count(DISTINCT l_orderkey) AS n_groups FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) > 1")
def single_membership(t):
    groups = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("m")).select("l_orderkey", F.array_join(F.transform("m", lambda x: x.cast("string")), "|").alias("m"))
    return annotation.single_membership(groups, F.split("m", r"\|"), "l_orderkey")


@query(f"SELECT 'a term on a group that is not annotated' AS rule, count(*) AS n FROM part WHERE {_STATUS} <> 'annotated' UNION ALL SELECT 'n_with is not the accessions used', count(*) FROM part WHERE p_size % 2 = 1 UNION ALL SELECT 'go_release differs from the header', count(*) FROM part WHERE p_type <> 'ECONOMY'")
def annotation_problems(t):
    rows = t.part.select(_status().alias("annotation_status"), F.col("p_name").alias("go_id"), F.lit("1").alias("n_with"), F.when(F.col("p_size") % 2 == 1, F.lit("a;b")).otherwise(F.lit("a;")).alias("accession_used"), F.col("p_type").alias("go_release"))
    return annotation.annotation_problems(rows, {"go_release": "ECONOMY"})


@query("SELECT DISTINCT p_name AS go_id, p_brand AS go_release FROM part WHERE p_size > 10 AND (p_name, p_brand) NOT IN (SELECT p_name, p_brand FROM part WHERE p_type = 'PROMO')")
def coverage_pair(t):
    pair = lambda df: df.select(F.col("p_name").alias("go_id"), F.col("p_brand").alias("go_release"))
    return annotation.coverage_pair(pair(t.part.filter("p_size > 10")), pair(t.part.filter("p_type = 'PROMO'")), pins=["go_release"])


@query("""SELECT acc AS protein_accession, p_name AS compartment, arg_max(p_brand, p_partkey) AS protein_group, CAST(arg_max(p_size, p_partkey) AS BIGINT) AS n_members,
CASE arg_max(p_size % 3, p_partkey) WHEN 0 THEN true WHEN 1 THEN false END AS inherited FROM (SELECT *, unnest(['A' || p_size, 'B' || (p_size % 5)]) AS acc FROM part) GROUP BY acc, p_name""")
def localisation_rows(t):
    r = F.col("p_size") % 3
    rows = t.part.select(
        "p_partkey", F.concat(text("A", "p_size"), F.lit(";"), text("B", F.col("p_size") % 5)).alias("accession_used"), F.col("p_name").alias("go_id"), F.lit("r").alias("go_release"), F.lit("IDA").alias("evidence"),
        F.col("p_brand").alias("protein_group"), F.lit("0.001").alias("q_value"), F.col("p_size").cast("string").alias("n_members"), F.lit("1").alias("n_with"),
        F.when(r == 0, F.lit("true")).when(r == 1, F.lit("false")).otherwise(F.lit("")).alias("inherited"), F.lit("").alias("propagated"))
    return annotation.localisation_rows(rows, "p_partkey", F.lit("go:r:x")).select("protein_accession", "compartment", "protein_group", "n_members", "inherited")


@query("SELECT p_name AS compartment, p_brand AS organelle_category, CASE WHEN p_size % 2 = 0 THEN p_type END AS organelle_subcategory, 'm' AS category_map_name FROM part")
def category_rows(t):
    rows = t.part.select(F.col("p_name").alias("go_id"), F.col("p_brand").alias("category"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.lit("")).alias("subcategory"))
    return annotation.category_rows(rows, F.lit("m"), F.lit("1"), F.lit("r"), F.lit("s")).select("compartment", "organelle_category", "organelle_subcategory", "category_map_name")


@query("""SELECT 'go:' || p_type || ':' || substr(sha256(p_type), 1, 12) AS source_id, 'go' AS owner_project FROM part GROUP BY p_type""")
def annotation_source(t):
    kinds = t.part.select(F.col("p_type").alias("file")).distinct()
    header = kinds.select("file", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col("file").alias("value")) for k in ("go_release", "go_obo_sha256", "annotation_db_sha256", "code")])).alias("h")).select("file", "h.*")
    digests = kinds.select(F.col("file").alias("path"), F.sha2("file", 256).alias("sha256"))
    return annotation.annotation_source(header, digests, "go", "code").select("source_id", "owner_project")


@query("""SELECT l_returnflag AS dataset_id, l_partkey AS term, c.p_type AS category, count(DISTINCT l_suppkey) AS n_entities, array_to_string(list_sort(list(DISTINCT l_suppkey))[1:10], ',') AS examples
FROM lineitem LEFT JOIN (SELECT p_partkey, p_type FROM part WHERE p_size > 20) c ON c.p_partkey = l_partkey GROUP BY ALL""")
def localisation_categories(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("dataset_id"), F.col("l_partkey").alias("term"), F.lit("r").alias("release"), F.col("l_suppkey").alias("entity"))
    categories = t.part.filter("p_size > 20").select(F.col("p_partkey").alias("term"), F.lit("r").alias("release"), F.col("p_type").alias("category"))
    return locate(rows, categories, "term", "release", "entity", ["dataset_id"], ["category"]).withColumn("examples", joined("examples"))
