"""Search and profiles on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.operators import search
from veracat.workload.deriving import INDEX_SQL, PRESENCE_SQL, index
from veracat.operators.search_index import SearchIndex, write_search_index
from veracat.session import scratch_dir
from veracat.workload.registry import joined, query


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey::VARCHAR = 'AUTO' OR contains(lower(c_mktsegment), 'auto') OR contains(lower(c_name || ' ' || c_mktsegment), 'auto') ORDER BY c_custkey")
def search_dataset(t):
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", F.array("c_name", "c_mktsegment").alias("both"))
    return search.search_dataset(rows, "auto", "c_custkey", ["c_mktsegment"], ["both"]).drop("both")


@query(f"""+{PRESENCE_SQL}, {INDEX_SQL} SELECT protein_accession, gene, starts_with(protein_accession, 'DECOY_') AS is_decoy, n_datasets_1pct FROM pindex WHERE upper(protein_accession) = 'R' OR upper(coalesce(gene, '')) = 'R' OR upper(coalesce(gene, '')) LIKE 'R%'
ORDER BY is_decoy, (upper(protein_accession) = 'R' OR upper(coalesce(gene, '')) = 'R') DESC, n_datasets_1pct DESC, protein_accession""", lines=True)
def search_entity(t):
    return search.search_entity(index(t)[1], "r", "protein_accession", "gene", "n_datasets_1pct").select("protein_accession", "gene", "is_decoy", "n_datasets_1pct")


@query("""SELECT upper(word) AS base_sequence, count(*) AS n_datasets FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) WHERE regexp_matches('ERESTH', '^[ACDEFGHIKLMNPQRSTVWY]{6,}$') AND contains(upper(word), 'ERESTH') GROUP BY 1 ORDER BY upper(word) = 'ERESTH' DESC, n_datasets DESC, base_sequence""")
def search_sequence(t):
    words = t.documents.select(F.explode(F.split(F.lower("text"), " ")).alias("word")).groupBy(F.upper("word").alias("base_sequence")).agg(F.count("*").alias("n_datasets"))
    return search.search_sequence(words, "eresth", "base_sequence", "n_datasets")


_SITES = "SELECT p_name AS modification_name, CASE WHEN p_size % 2 = 0 THEN p_type END AS modification, p_brand AS dataset_id, p_size AS n_psms FROM part"


def _sites(t):
    return t.part.select(F.col("p_name").alias("modification_name"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("modification"), F.col("p_brand").alias("dataset_id"), F.col("p_size").cast("bigint").alias("n_psms"))


@query(f"""SELECT modification, modification_name, count(*) AS n_sites, count(DISTINCT dataset_id) AS n_datasets, array_to_string(list_sort(list(DISTINCT dataset_id)), ',') AS dataset_ids, CAST(sum(n_psms) AS BIGINT) AS n_psms FROM ({_SITES})
WHERE contains(lower(modification_name), 'ring') OR contains(lower(coalesce(modification, '')), 'ring') GROUP BY ALL ORDER BY n_sites DESC, modification_name, modification NULLS FIRST""")
def search_modification(t):
    declared = t.part.select(F.col("p_type").alias("modification"), F.col("p_name").alias("name"), F.lit("C").alias("residues"), F.lit("fixed").alias("usage"), F.col("p_brand").alias("dataset_id"))
    return search.search_modification(_sites(t), declared, "RING")[0].withColumn("dataset_ids", joined("dataset_ids"))


@query("SELECT DISTINCT p_type AS modification, p_name AS name, 'C' AS residues, 'fixed' AS usage, p_brand AS dataset_id, 'search_modifications_declared' AS _source FROM part WHERE contains(lower(p_name), 'blue ring') ORDER BY name, dataset_id, usage, p_type")
def search_declared(t):
    declared = t.part.select(F.col("p_type").alias("modification"), F.col("p_name").alias("name"), F.lit("C").alias("residues"), F.lit("fixed").alias("usage"), F.col("p_brand").alias("dataset_id"))
    _, told = search.search_modification(_sites(t), declared, "blue ring")
    return search.ranked_hits(told, [F.col("name"), F.col("dataset_id"), F.col("usage"), F.col("modification")])


@query("SELECT c_mktsegment AS dataset_id, count(*) AS n_samples, array_to_string(list_sort(list(DISTINCT c_nationkey::VARCHAR)), ',') AS nations FROM customer WHERE contains(c_nationkey::VARCHAR, '7') OR contains(lower(c_name), '7') GROUP BY 1 ORDER BY 1")
def search_sample(t):
    rows = t.customer.select(F.col("c_mktsegment").alias("dataset_id"), "c_name", F.col("c_nationkey").cast("string").alias("nation"))
    chars = t.part.select(F.col("p_name").alias("name"), F.col("p_type").alias("value"))
    hits, _ = search.search_sample(rows, chars, "7", ["nation"], ["c_name"])
    return hits.withColumn("nations", joined("nations"))


@query("SELECT p_name AS name, p_type AS value, count(*) AS n_samples FROM part WHERE contains(lower(p_type), 'promo') OR contains(lower(p_name), 'promo') GROUP BY ALL ORDER BY n_samples DESC, name, value")
def search_characteristics(t):
    chars = t.part.select(F.col("p_name").alias("name"), F.col("p_type").alias("value"))
    rows = t.customer.select(F.col("c_mktsegment").alias("dataset_id"), F.col("c_name").alias("n"))
    return search.search_sample(rows, chars, "Promo", ["n"])[1]


@query("SELECT page_id, url FROM pages WHERE contains(lower(url), 'example.org') OR contains(lower(html), 'example.org') ORDER BY page_id")
def search_run(t):
    return search.search_run(t.pages, "Example.org", ["url", "html"], ["page_id"]).select("page_id", "url")


_DEFS = "SELECT doc_id::VARCHAR AS definition_id, lang AS version, source AS owner_project, text, NULL AS url FROM documents"


def _definitions(t):
    return t.documents.select(F.col("doc_id").cast("string").alias("definition_id"), F.col("lang").alias("version"), F.col("source").alias("owner_project"), "text", F.lit(None).cast("string").alias("url"))


def _metrics(t):
    return t.events.select(F.col("event_type").alias("name"), F.col("user_id").cast("string").alias("definition_id"), F.col("event_id").alias("dataset_id"), F.lit("s").alias("source"), "value")


@query(f"SELECT definition_id, version, owner_project FROM ({_DEFS}) WHERE contains(lower(definition_id), 'tion') OR contains(lower(text), 'tion') ORDER BY definition_id, version DESC")
def search_definition(t):
    return search.search_definition(_definitions(t), _metrics(t), "tion")[0].select("definition_id", "version", "owner_project")


@query("SELECT event_id AS dataset_id, event_type AS name, user_id::VARCHAR AS definition_id, value FROM events WHERE contains(event_type, 'err') OR contains(user_id::VARCHAR, 'err') ORDER BY event_id, event_type")
def search_metrics(t):
    return search.search_definition(_definitions(t), _metrics(t), "ERR")[1].select("dataset_id", "name", "definition_id", "value")


@query("SELECT '7' AS definition_id, (SELECT array_to_string(list_sort(list(DISTINCT lang)), ',') FROM documents WHERE doc_id = 7) AS versions, (SELECT text FROM documents WHERE doc_id = 7) AS text, (SELECT array_to_string(list_sort(list(DISTINCT event_type)), ',') FROM events WHERE user_id = 7) AS metrics_using_it")
def definition_lookup(t):
    out = search.definition_lookup(_definitions(t), _metrics(t), "7")
    return out.select("definition_id", joined("versions").alias("versions"), "text", joined("metrics_using_it").alias("metrics_using_it"))


_LOCATED = "SELECT p_brand AS dataset_id, p_name AS term, p_type AS category, count(DISTINCT p_size) AS n_entities FROM part GROUP BY ALL"


@query(f"SELECT * FROM ({_LOCATED}) WHERE contains(lower(term), 'gear') OR contains(lower(coalesce(category, '')), 'gear') ORDER BY n_entities DESC, term, category, dataset_id")
def search_localisation(t):
    rows = t.part.select(F.col("p_brand").alias("dataset_id"), F.col("p_name").alias("term"), F.lit("r").alias("release"), F.col("p_size").alias("entity"), F.col("p_type").alias("kind"))
    located = rows.groupBy("dataset_id", "term", F.col("kind").alias("category")).agg(F.count_distinct("entity").alias("n_entities"))
    other = t.customer.select(F.col("c_mktsegment").alias("dataset_id"), F.lit("k").alias("key"), F.col("c_name").alias("value"))
    hits, _ = search.search_localisation(located, other, "Gear", ["term", "category"])
    return search.ranked_hits(hits, [F.col("n_entities").desc(), F.col("term"), F.col("category"), F.col("dataset_id")])


@query("""SELECT 'customer' AS kind, '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS hit FROM customer WHERE contains(lower(c_mktsegment), 'auto') UNION ALL SELECT 'part', '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '"}' FROM part WHERE contains(lower(p_name), 'auto') OR contains(lower(p_name), 'gear')""")
def search_all(t):
    customers = t.customer.filter(search.any_contains(["c_mktsegment"], "auto")).select("c_custkey", "c_mktsegment")
    parts = t.part.filter(search.any_contains(["p_name"], "auto") | search.any_contains(["p_name"], "gear")).select("p_partkey", "p_name")
    return search.search_all({"customer": customers, "part": parts})


@query("""SELECT unnest(['doc_id', 'lang', 'quality', 'toxic', 'nothing']) AS "column", count(*) AS rows, unnest([count(d.doc_id), count(lang), count(quality), count(toxic), 0]) AS populated, unnest([false, false, false, false, true]) AS all_null
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def non_null_profile(t):
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").withColumn("nothing", F.lit(None).cast("string"))
    return search.non_null_profile(rows)


@query("""SELECT 'documents' AS source, count(*) AS rows, 'nothing' AS columns_all_null FROM documents UNION ALL SELECT 'labels', count(*), '' FROM labels UNION ALL SELECT 'empty', 0, ''""")
def searched_lines(t):
    docs = t.documents.withColumn("nothing", F.lit(None).cast("string"))
    lines = search.searched_lines({"documents": (docs, ["text", "nothing"]), "labels": (t.labels, ["quality"]), "empty": (t.labels.filter("quality > 5"), ["quality"])})
    return lines.withColumn("columns_all_null", joined("columns_all_null"))


@query("""SELECT c_custkey, c_name, c_acctbal, CASE WHEN (SELECT count(*) FROM customer WHERE c_acctbal > 5000) > 400 THEN 'rows' END AS cut_by FROM customer WHERE c_acctbal > 5000 ORDER BY c_acctbal DESC, c_custkey LIMIT 400""")
def bounded_answer(t):
    wanted = t.customer.filter("c_acctbal > 5000").select("c_custkey", "c_name", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey")
    answer = search.bounded_answer(wanted, rows=400)
    return t.spark.createDataFrame(answer.rows, "c_custkey bigint, c_name string, c_acctbal double").withColumn("cut_by", F.lit(answer.truncated_by).cast("string"))


@query("""SELECT 'documents' AS source, count(*) AS rows, 'nothing' AS columns_all_null, false AS empty, 'pep' AS run_relative, 'labels' AS related FROM documents UNION ALL SELECT 'empty', 0, '', true, 'pep', 'labels'""")
def disclosed_answer(t):
    """What an answer rests on, as it is told beside the answer."""
    docs = t.documents.withColumns({"nothing": F.lit(None).cast("string"), "pep": F.lit(0.5)})
    answer = search.bounded_answer(docs.select("doc_id", "pep").orderBy("doc_id"), rows=3)
    told = search.disclose_sources(answer, {"documents": (docs, ["text", "nothing", "pep"]), "empty": (t.labels.filter("quality > 5"), ["quality"])}, {"labels": t.labels, "gone": t.labels.filter("quality > 5")})
    rows = [(s["source"], s["rows"], ",".join(s["columns_all_null"]), s["source"] in told.empty_sources, ",".join(told.run_relative_columns), ",".join(told.related_tables)) for s in told.searched]
    return t.spark.createDataFrame(rows, "source string, rows bigint, columns_all_null string, empty boolean, run_relative string, related string")



@query("""SELECT p_partkey, p_name, p_type FROM part WHERE contains(lower(p_name), 'blue r') OR contains(lower(p_type), 'blue r') UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier WHERE contains(lower(s_name), '#00000001')""")
def stored_search(t):
    """Rows found by the grams that a build stored, and then verified."""
    folder = scratch_dir(t.spark, "search")
    write_search_index(t.spark, {"part": (t.part, ["p_name", "p_type"]), "supplier": (t.supplier, ["s_name"])}, folder)
    stored = SearchIndex(t.spark, folder)
    parts = stored.candidates("part", "Blue R").filter(search.any_contains(["p_name", "p_type"], "Blue R")).select("p_partkey", "p_name", "p_type")
    suppliers = stored.candidates("supplier", "#00000001").filter(search.any_contains(["s_name"], "#00000001"))
    return parts.unionByName(suppliers.select(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name"), F.lit(None).cast("string").alias("p_type")))
