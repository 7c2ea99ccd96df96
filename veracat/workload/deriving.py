"""Derived tables on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.functions.cells import extract_tags
from veracat.functions.rules import tag_class
from veracat.operators import derive, filters
from veracat.session import materialise
from veracat.workload.registry import joined, query, text


def presence(t):
    """The accepted evidence of every (dataset, entity, label), as a build counts it."""
    m = t.members
    entities = m.select("dataset_id", F.col("entity").alias("protein_accession"), (F.col("label") == "contaminant").alias("is_contaminant"))
    groups = filters.accepted_groups(m, "label", "q").select("dataset_id", F.col("group_id").alias("protein_group_id"), F.col("members").alias("protein_accessions"), F.col("q").alias("q_value"))
    forms = filters.accepted_forms(m, "label", "q", "q2").select("dataset_id", F.col("form_id").alias("peptidoform_id"), F.col("members").alias("protein_accessions"))
    return derive.entity_datasets(entities, groups, forms)


# Evidence is said line by line, of a group or of a form, and tallied for each entity of a dataset before
# anything is joined to it. The roll lists what each dataset names.
PRESENCE_SQL = """said AS (
  SELECT dataset_id, unnest(members) AS who, 'group' AS what, group_id AS id, q FROM members WHERE q <= 0.01 AND label IN ('target', 'contaminant')
  UNION ALL SELECT dataset_id, unnest(members), 'form', form_id, NULL FROM members WHERE q <= 0.01 AND coalesce(q2, 0.0) <= 0.01 AND label = 'target'
), tally AS (
  SELECT dataset_id, who, min(q) AS lowest, len(list_distinct(list(id) FILTER (what = 'group'))) AS groups, len(list_distinct(list(id) FILTER (what = 'form'))) AS forms
  FROM said GROUP BY ALL
), roll AS (
  SELECT dataset_id, entity AS who, label = 'contaminant' AS tainted, max(l_returnflag) AS flag, max(l_linestatus) AS state FROM lines GROUP BY ALL
), presence AS (
  SELECT roll.dataset_id, roll.who AS protein_accession, tainted AS is_contaminant, coalesce(groups, 0)::BIGINT AS n_protein_groups, coalesce(forms, 0)::BIGINT AS n_peptidoforms, lowest AS best_q_value
  FROM roll LEFT JOIN tally ON (tally.dataset_id, tally.who) = (roll.dataset_id, roll.who)
)"""

INDEX_SQL = """each AS (
  SELECT protein_accession AS who, p.dataset_id, max(flag) AS flag, max(state) AS state, bool_or(tainted) AS tainted, max(n_protein_groups + n_peptidoforms) > 0 AS seen, min(best_q_value) AS lowest
  FROM presence p JOIN roll r ON r.dataset_id = p.dataset_id AND r.who = p.protein_accession AND r.tainted = p.is_contaminant GROUP BY ALL
), pindex AS (
  SELECT who AS protein_accession, max(flag) AS gene, max(state) AS organism, count_if(tainted)::BIGINT AS n_datasets_contaminant, count(*) AS n_datasets, count_if(seen)::BIGINT AS n_datasets_1pct,
         list(dataset_id ORDER BY dataset_id) AS dataset_ids, list(dataset_id ORDER BY dataset_id) FILTER (seen) AS dataset_ids_1pct, min(lowest) AS best_q_value
  FROM each GROUP BY who
)"""


def index(t, keep_presence=False):
    """(presence, index over it). Where the caller reads both, the presence is written once."""
    p = presence(t)
    if keep_presence:
        p = materialise(p, "presence")
    entities = t.lines.select(
        "dataset_id", F.col("entity").alias("protein_accession"), (F.col("label") == "contaminant").alias("is_contaminant"), F.col("l_returnflag").alias("gene"), F.col("l_linestatus").alias("organism"))
    return p, derive.entity_index(entities, p)


@query(f"+{PRESENCE_SQL} SELECT * FROM presence", lines=True)
def entity_datasets(t):
    return presence(t)


@query(f"""+{PRESENCE_SQL}, {INDEX_SQL} SELECT * REPLACE (array_to_string(dataset_ids, ',') AS dataset_ids, array_to_string(dataset_ids_1pct, ',') AS dataset_ids_1pct)
FROM pindex""", lines=True)
def entity_index(t):
    return index(t)[1].withColumn("dataset_ids", joined("dataset_ids")).withColumn("dataset_ids_1pct", joined("dataset_ids_1pct"))


@query(f"""+{PRESENCE_SQL}, {INDEX_SQL} SELECT p.dataset_id, p.protein_accession, p.n_protein_groups, p.n_peptidoforms, p.best_q_value, i.n_datasets_1pct
FROM presence p JOIN pindex i USING (protein_accession) WHERE p.n_protein_groups > 0 OR p.n_peptidoforms > 0""", lines=True)
def where_is_evidence(t):
    """In which datasets does an entity have accepted evidence, and how much?"""
    p, i = index(t, keep_presence=True)
    return p.filter("n_protein_groups > 0 OR n_peptidoforms > 0").join(i.select("protein_accession", "n_datasets_1pct"), "protein_accession").select(
        "dataset_id", "protein_accession", "n_protein_groups", "n_peptidoforms", "best_q_value", "n_datasets_1pct"
    )


@query("""+counted AS (
  SELECT s_nationkey AS k, 'run' AS what FROM supplier UNION ALL SELECT c_nationkey, 'sample' FROM customer
  UNION ALL SELECT substr(dataset_id, 2)::INTEGER, unnest(['line'] || CASE WHEN label = 'target' AND q <= 0.01 AND coalesce(q2, 0.0) <= 0.01 AND ambiguous IS NOT TRUE THEN ['accepted'] ELSE [] END) FROM lines
  UNION ALL SELECT c_nationkey, 'finding' FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus <> 'O')
SELECT n_nationkey AS dataset_id, any_value(n_name) AS title, count_if(what = 'run')::BIGINT AS n_runs, count_if(what = 'sample')::BIGINT AS n_samples, count_if(what = 'line')::BIGINT AS n_psms_all,
       count_if(what = 'accepted')::BIGINT AS n_psms_1pct, count_if(what = 'finding')::BIGINT AS n_open_findings
FROM nation LEFT JOIN counted ON k = n_nationkey GROUP BY n_nationkey""", lines=True)
def dataset_overview(t):
    key = "dataset_id"
    lines = t.lines.withColumn(key, F.substr("dataset_id", F.lit(2)).cast("int"))
    nation_of = lambda df, c: df.select(F.col(c).alias(key))
    late = t.orders.filter("o_orderstatus IN ('F', 'P')").join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return derive.per_dataset_counts(t.nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias("title")), {
        "n_runs": nation_of(t.supplier, "s_nationkey"), "n_samples": nation_of(t.customer, "c_nationkey"), "n_psms_all": lines.select(key),
        "n_psms_1pct": filters.accepted_matches(lines, "label", "q", "q2", "ambiguous").select(key), "n_open_findings": nation_of(late, "c_nationkey"),
    })


@query("""+accepted AS (SELECT p_name, dataset_id, count(*) AS forms, min(q) AS lowest FROM lines, part
  WHERE p_partkey = l_partkey AND label = 'target' AND q <= 0.01 AND coalesce(q2, 0.0) <= 0.01 GROUP BY ALL)
SELECT p_name AS base_sequence, count(*) AS n_datasets, string_agg(dataset_id, ',' ORDER BY dataset_id) AS dataset_ids, sum(forms)::BIGINT AS n_peptidoforms, min(lowest) AS best_q_value
FROM accepted GROUP BY p_name""", lines=True)
def sequence_index(t):
    forms = filters.accepted_forms(t.lines, "label", "q", "q2").join(t.part.select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
    out = derive.sequence_index(forms.select("dataset_id", F.col("p_name").alias("base_sequence"), F.col("q").alias("best_q_value")))
    return out.withColumn("dataset_ids", joined("dataset_ids"))


FORMS_SQL = """tagged AS (SELECT l.dataset_id, l.form_id, 'A' || CASE WHEN n % 3 = 0 THEN '[UNIMOD:' || (n % 7) || ']' WHEN n % 3 = 1 THEN '[+' || n || '.5]K'
 ELSE '[Info:' || l_returnflag || ']' END || CASE WHEN n % 2 = 0 THEN 'C[UNIMOD:4]' ELSE 'C' END AS form FROM lines l)"""


def tagged_forms(t):
    n = F.col("n")
    tag = F.when(n % 3 == 0, F.concat(F.lit("[UNIMOD:"), (n % 7).cast("string"), F.lit("]"))) \
        .when(n % 3 == 1, F.concat(F.lit("[+"), n.cast("string"), F.lit(".5]K"))).otherwise(F.concat(F.lit("[Info:"), F.col("l_returnflag"), F.lit("]")))
    form = F.concat(F.lit("A"), tag, F.when(n % 2 == 0, F.lit("C[UNIMOD:4]")).otherwise(F.lit("C")))
    return t.lines.select("dataset_id", "form_id", form.alias("form"))


@query(f"""+{FORMS_SQL}, tags AS (
  SELECT dataset_id, tag, count(*) AS placed FROM (SELECT dataset_id, form_id, unnest(regexp_extract_all(form, '\\[([^\\]]*)\\]', 1)) AS tag FROM tagged) GROUP BY dataset_id, form_id, tag)
SELECT dataset_id, tag, nullif(regexp_extract(tag, '^UNIMOD:.*'), '') AS modification, try_cast(nullif(regexp_extract(tag, '^[+-][0-9].*'), '') AS DOUBLE) AS mass_shift,
       nullif(regexp_extract(tag, '^Info:(.*)', 1), '') AS unresolved_name, sum(placed)::BIGINT AS n_placements, count(*) AS n_peptidoforms FROM tags GROUP BY dataset_id, tag""", lines=True)
def placed_tags(t):
    return derive.placed_tags(tagged_forms(t), "form", "form_id", ["dataset_id"])


@query(f"""+{FORMS_SQL} SELECT form_id, tag, coalesce(CASE WHEN tag LIKE 'UNIMOD:%' THEN tag END, CASE WHEN tag LIKE 'Info:%' THEN substr(tag, 6) END, 'mass') AS kind
FROM (SELECT form_id, unnest(regexp_extract_all(form, '\\[([^\\]]*)\\]', 1)) AS tag FROM tagged)""", lines=True)
def extracted_tags(t):
    tags = tagged_forms(t).select("form_id", F.explode(extract_tags("form")).alias("tag"))
    accession, _, name = tag_class("tag")
    return tags.select("form_id", "tag", F.coalesce(accession, name, F.lit("mass")).alias("kind"))


@query("""SELECT dataset_id, entity AS protein_accession, l_linenumber AS position, modification, coalesce(modification, name) AS chemistry_key,
count(*) AS n_names, array_to_string(list_sort(list(DISTINCT name)), ',') AS modification_names, CAST(sum(n) AS BIGINT) AS n_psms, min(q) AS best_q_value,
min(l_linestatus) AS best_ambiguity_level, max(label) AS target_decoy
FROM (SELECT *, CASE WHEN l_returnflag <> 'A' THEN 'U' || (n % 2) END AS modification, l_returnflag || l_linestatus AS name FROM lines) GROUP BY ALL""", lines=True)
def chemistry_view(t):
    sites = t.lines.select(
        "dataset_id", F.col("entity").alias("protein_accession"), F.col("l_linenumber").alias("position"),
        F.when(F.col("l_returnflag") != "A", text("U", F.col("n") % 2)).alias("modification"), F.concat("l_returnflag", "l_linestatus").alias("modification_name"),
        F.col("n").alias("n_psms"), F.col("q").alias("best_q_value"), F.col("l_linestatus").alias("best_ambiguity_level"), F.col("label").alias("target_decoy"),
    )
    return derive.chemistry_view(sites, ["dataset_id", "protein_accession", "position"]).withColumn("modification_names", joined("modification_names"))


@query("""SELECT e.dataset_id, e.entity AS protein_accession, p.p_brand AS database, p.p_type AS outcome, p.p_size AS n_genes
FROM (SELECT DISTINCT dataset_id, entity, l_partkey FROM lines WHERE label <> 'contaminant') e
JOIN (SELECT DISTINCT 'D' || (p_size % 25) AS dataset_id, p_brand FROM part WHERE p_size % 2 = 0) d ON d.dataset_id = e.dataset_id
JOIN part p ON p.p_partkey = e.l_partkey AND p.p_brand = d.p_brand WHERE e.entity NOT LIKE 'DECOY\\_%' ESCAPE '\\'""", lines=True)
def entity_resolutions(t):
    entities = t.lines.select("dataset_id", F.lit("b").alias("bundle_id"), F.col("entity").alias("protein_accession"), (F.col("label") == "contaminant").alias("is_contaminant")).distinct()
    databases = t.part.select(text("D", F.col("p_size") % 25).alias("dataset_id"), F.col("p_brand").alias("database"), F.col("p_brand").alias("sha256"),
                              F.when(F.col("p_size") % 2 == 0, F.lit("target")).otherwise(F.lit("contaminant")).alias("role")).distinct()
    blank = [F.lit(None).cast("string").alias(c) for c in ("gene_id", "gene_symbol", "gene_biotype", "source", "ensembl_xref_agrees", "gene_set_release", "definition_id", "artefact_id")]
    found = t.part.select(text("P", "p_partkey").alias("accession"), F.col("p_brand").alias("search_database_sha256"), F.col("p_type").alias("outcome"), F.col("p_size").alias("n_genes"), *blank)
    return derive.entity_resolutions(entities, databases, found).select("dataset_id", "protein_accession", "database", "outcome", "n_genes")
