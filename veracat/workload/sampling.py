"""Sheets, runs and provenance on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.operators import samples
from veracat.workload.registry import joined, query, text

# Each part is a sheet row: its name and brand make the source name, so sources repeat.
_SHEET = """sheet AS (SELECT p_partkey AS o, p_name || '-' || p_brand AS source, CASE p_size % 4 WHEN 0 THEN 'not available' WHEN 1 THEN 'NT=' || p_type || ';AC=T:' || p_size ELSE p_type END AS organ,
CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS cell, 'r' || p_partkey || '-calib.raw' AS file, CASE WHEN p_size % 2 = 0 THEN 'NT=label free sample' ELSE 'TMT 126' END AS label, p_size::VARCHAR AS frac, p_type AS src FROM part),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY o) AS r FROM sheet) WHERE r = 1)"""

HEADER = ["source name", "characteristics[organism part]", "characteristics[cell type]", "comment[data file]", "comment[label]", "comment[fraction identifier]", "comment[organism part source]", "characteristics[cell type]"]


def sheet(t):
    r, n = F.col("p_size") % 4, F.col("p_size").cast("string")
    organ = F.when(r == 0, F.lit("not available")).when(r == 1, F.concat(F.lit("NT="), F.col("p_type"), F.lit(";AC=T:"), n)).otherwise(F.col("p_type"))
    cell = F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.col("p_brand"))
    label = F.when(F.col("p_size") % 2 == 0, F.lit("NT=label free sample")).otherwise(F.lit("TMT 126"))
    cells = F.array(F.concat_ws("-", "p_name", "p_brand"), organ, cell, F.concat(text("r", "p_partkey"), F.lit("-calib.raw")), label, n, F.col("p_type"), F.lit("second"))
    return t.part.select(F.lit("f").alias("file"), F.col("p_partkey").alias("row_order"), F.array(*[F.lit(h) for h in HEADER]).alias("header"), cells.alias("cells"))


_LONG = """SELECT 'X:' || source AS sample_id, 'characteristics[organism part]' AS name, organ AS value, organ = 'not available' AS value_reserved, CASE WHEN organ LIKE 'NT=%' THEN split_part(organ, 'AC=', 2) END AS term, src AS source FROM first
UNION ALL SELECT 'X:' || source, 'characteristics[cell type]', cell, false, NULL, NULL FROM first WHERE cell <> '' UNION ALL SELECT 'X:' || source, 'characteristics[cell type]', 'second', false, NULL, NULL FROM first"""


@query(f"WITH {_SHEET} {_LONG}")
def melt_sheet(t):
    return samples.melt_sheet(sheet(t), "X").drop("source_reference", "source_method")


@query(f"""WITH {_SHEET} SELECT 'X:' || source AS sample_id, 'taxon' AS organism, CASE WHEN organ LIKE 'NT=%' THEN split_part(organ, 'AC=', 2) END AS organism_part FROM first""")
def sheet_samples(t):
    return samples.sheet_samples(sheet(t), "X", "taxon").select("sample_id", "organism", "organism_part")


@query(f"""WITH {_SHEET} SELECT 'X:r' || o || ':' || CASE WHEN label LIKE 'NT%' THEN 'label_free' ELSE 'TMT126' END AS assay_id, 'X:r' || o AS run_id, CASE WHEN label LIKE 'NT%' THEN 'label_free' ELSE 'TMT126' END AS channel, 'X:' || source AS sample_id FROM sheet""")
def sheet_assays(t):
    return samples.sheet_assays(sheet(t), "X")


@query(f"WITH {_SHEET} SELECT 'r' || o AS run, CAST(frac AS BIGINT) AS fraction FROM sheet")
def run_facts(t):
    return samples.run_facts(sheet(t)).select("run", "fraction")


_COLS = {"part_name": ["characteristics[organism part]"], "cell_name": ["factor value[cell type]", "characteristics[cell type]"]}


@query(f"""WITH {_SHEET}, long AS ({_LONG}), named AS (SELECT sample_id, name, CASE WHEN value LIKE 'NT=%' THEN split_part(split_part(value, ';', 1), '=', 2) WHEN value = 'not available' THEN NULL ELSE value END AS v FROM long)
SELECT s.sample_id, (SELECT string_agg(DISTINCT v, '; ' ORDER BY v) FROM named n WHERE n.sample_id = s.sample_id AND name = 'characteristics[organism part]') AS part_name,
(SELECT string_agg(DISTINCT v, '; ' ORDER BY v) FROM named n WHERE n.sample_id = s.sample_id AND name = 'characteristics[cell type]') AS cell_name FROM (SELECT DISTINCT 'X:' || source AS sample_id FROM first) s""")
def sample_names(t):
    rows = sheet(t)
    return samples.sample_names(samples.sheet_samples(rows, "X").select("sample_id"), samples.melt_sheet(rows, "X"), _COLS)


@query("""SELECT p_type AS dataset_id, characteristic, array_to_string(list_sort(list(DISTINCT v))[1:5], ',') AS examples, greatest(count(DISTINCT v) - 5, 0) AS n_more FROM (
SELECT p_type, 'organism part' AS characteristic, p_name AS v FROM part UNION ALL SELECT p_type, 'disease', p_brand FROM part WHERE p_size % 2 = 1) GROUP BY ALL""")
def uncoded_annotation(t):
    kind = F.explode(F.array(F.struct(F.lit("Characteristics[organism part] ").alias("name"), F.col("p_name").alias("value")),
                             F.struct(F.lit("characteristics[disease]").alias("name"), F.when(F.col("p_size") % 2 == 1, F.col("p_brand")).otherwise(F.lit("n/a")).alias("value")),
                             F.struct(F.lit("characteristics[age]").alias("name"), F.col("p_name").alias("value"))))
    long = t.part.select(F.col("p_type").alias("dataset_id"), kind.alias("c")).select("dataset_id", "c.*")
    return samples.uncoded_annotation(long, ["dataset_id"], ["characteristics[organism part]", "characteristics[disease]"]).withColumn("examples", joined("examples"))


@query("""SELECT 'X:' || d.doc_id || CASE WHEN b.doc_id IS NOT NULL THEN '#run' ELSE '' END AS sample_id, d.doc_id::VARCHAR AS source_name, 'X' AS dataset_id, 'taxon' AS organism FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id AND b.toxic = 0""")
def synthetic_samples(t):
    taken = t.labels.filter("toxic = 0").select(text("X:", "doc_id").alias("sample_id"))
    return samples.synthetic_samples(t.documents.select(F.col("doc_id").cast("string").alias("run")), "run", taken, "X", "taxon").select("sample_id", "source_name", "dataset_id", "organism")


@query("""SELECT 'X:' || coalesce(a.k, b.k) AS run_id, coalesce(a.k, b.k) || '.raw' AS file_name, a.sha256, b.ms2 AS ms2_spectra, f.fraction FROM (SELECT 'd' || doc_id AS k, max(lang) AS sha256 FROM documents WHERE source <> 'src1' GROUP BY 1) a
FULL JOIN (SELECT 'd' || doc_id AS k, CAST(quality AS BIGINT) AS ms2 FROM labels) b ON a.k = b.k LEFT JOIN (SELECT 'd' || doc_id AS k, n_chars AS fraction FROM documents WHERE lang = 'en') f ON f.k = coalesce(a.k, b.k)
WHERE coalesce(a.k, b.k) NOT IN (SELECT 'd' || doc_id FROM labels WHERE toxic = 1)""")
def build_runs(t):
    name = F.concat(F.lit("/raw/d"), F.col("doc_id").cast("string"), F.lit(".raw"))
    fetched = t.documents.select(name.alias("name"), F.col("lang").alias("sha256"), F.lit(None).cast("string").alias("pride_checksum"), F.when(F.col("source") == "src1", F.lit("RESULT")).when(F.col("source") == "src2", F.lit("raw")).alias("category"))
    qc = t.labels.select(F.concat(text("d", "doc_id"), F.lit(".raw")).alias("name"), F.col("quality").cast("bigint").alias("ms2"), F.lit(1.0).alias("run_minutes"), F.lit(True).alias("pass"), F.array(F.lit("HCD")).alias("fragmentation"))
    blank = [F.lit(None).cast("string").alias(c) for c in ("fraction_source", "technical_replicate", "technical_replicate_source", "instrument_model")]
    facts = t.documents.filter("lang = 'en'").select(text("d", "doc_id").alias("run"), F.col("n_chars").alias("fraction"), *blank)
    gone = t.labels.filter("toxic = 1").select(F.concat(text("d", "doc_id"), F.lit(".raw")).alias("name"))
    return samples.build_runs(fetched, qc, facts, "X", gone).select("run_id", "file_name", "sha256", "ms2_spectra", "fraction")


def _given(t):
    given = t.labels.select(F.col("doc_id").alias("run"), F.when(F.col("quality") == 1, F.lit("phospho")).when(F.col("toxic") == 1, F.lit("mystery")).otherwise(F.lit("none")).alias("value"))
    return samples.assign_run_attribute(t.documents.select("doc_id"), "doc_id", ["acetyl"], False, given)


_VALUE = "CASE WHEN quality = 1 THEN 'phospho' WHEN toxic = 1 THEN 'mystery' ELSE 'none' END"


@query(f"SELECT d.doc_id, {_VALUE.replace('ELSE', 'WHEN l.doc_id IS NULL THEN NULL ELSE')} AS enrichment, CASE WHEN l.doc_id IS NOT NULL THEN 'manifest_run_enrichment' END AS enrichment_source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def assign_run_attribute(t):
    return _given(t)[0].withColumn("enrichment", joined("enrichment"))


@query(f"""SELECT * FROM (SELECT 'unknown value' AS problem, min(v) AS example, count(*) AS n FROM (SELECT {_VALUE} AS v FROM labels) WHERE v = 'mystery' UNION ALL SELECT 'run without a value', min(doc_id::VARCHAR), count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'undeclared value', min(v), count(*) FROM (SELECT {_VALUE} AS v FROM labels) WHERE v <> 'none' UNION ALL SELECT 'not a run', min(doc_id::VARCHAR), count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) WHERE n > 0""")
def run_attribute_problems(t):
    return _given(t)[1]


@query("SELECT p_brand, CASE WHEN p_size % 5 <> 0 THEN p_type || ', x' END AS value, count(*) AS n_runs FROM part GROUP BY ALL")
def enrichment_split(t):
    rows = t.part.withColumn("enrichment", F.when(F.col("p_size") % 5 != 0, F.array("p_type", F.lit("x"))))
    return samples.enrichment_split(rows, ["p_brand"])


_FIELDS = "SELECT event_id, CASE event_type WHEN 'click' THEN 2 ELSE 3 END AS layout, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events"


@query(f"""SELECT event_id, 'hits' AS name, value, CASE layout WHEN 2 THEN 'engine' ELSE 'summary' END AS definition_id, 'doc.value' AS source FROM ({_FIELDS})
UNION ALL SELECT event_id, 'key', k, 'any', 'doc.k' FROM ({_FIELDS}) WHERE k IS NOT NULL""")
def metric_rows(t):
    docs = t.events.select("event_id", F.when(F.col("event_type") == "click", 2).otherwise(3).alias("layout"), "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    # The definitions are read off the events: one per layout that occurs, and one for any.
    seen = docs.select("layout").distinct().select(F.lit("hits").alias("name"), "layout", F.when(F.col("layout") == 2, F.lit("engine")).otherwise(F.lit("summary")).alias("definition_id"), F.lit("doc.value").alias("source"))
    anyone = docs.select(F.lit("key").alias("name")).distinct().select("name", F.lit(None).cast("int").alias("layout"), F.lit("any").alias("definition_id"), F.lit("doc.k").alias("source"))
    return samples.metric_rows(docs, ["event_id"], {"hits": "value", "key": "k"}, seen.unionByName(anyone))


@query("""SELECT c_custkey::VARCHAR AS definition_id, c_mktsegment AS version FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') OR c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error') OR c_custkey = 3""")
def definitions_used(t):
    definitions = t.customer.select(F.col("c_custkey").cast("string").alias("definition_id"), F.col("c_mktsegment").alias("version"))
    users = [t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("definition_id")), t.events.filter("event_type = 'error'").select(F.col("user_id").cast("string").alias("definition_id"))]
    return samples.definitions_used(definitions, users, ["3"])
