"""Notation, placement and occupancy on the benchmark tables."""

from pyspark.sql import functions as F

from veracat.operators import sites
from veracat.operators.identification import occurrence_rank
from veracat.operators.notation import lookup_with_preference as look_up
from veracat.operators.notation import translate_notation as translate
from veracat.operators.pieces import find_pieces
from veracat.workload.identifying import FORM_SQL, notation_of, registry
from veracat.workload.registry import joined, query, text


@query(f"""SELECT DISTINCT 'PEP' || CASE WHEN l_linestatus = 'F' THEN 'C' || m ELSE 'C' END || (l_linenumber % 3) || m AS notation, {FORM_SQL} AS proforma, 'PEPC' || (l_linenumber % 3) AS base_sequence,
CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END AS n_mods, CASE WHEN l_returnflag = 'R' THEN 'Kind:gamma on C' ELSE '' END AS unresolved
FROM (SELECT *, '[Kind:' || CASE l_returnflag WHEN 'A' THEN 'alpha' WHEN 'N' THEN 'beta' ELSE 'gamma' END || ' on C]' AS m FROM lineitem)""")
def translate_notation(t):
    out = translate(t.lineitem.withColumn("notation", notation_of()), "notation", registry(t))
    return out.select("notation", "proforma", "base_sequence", F.size("mods").alias("n_mods"), joined("unresolved").alias("unresolved"))


@query("""WITH names AS (SELECT DISTINCT p_name || ' on ' || upper(substr(p_type, 1, 1)) AS name, p_name AS stem, upper(substr(p_type, 1, 1)) AS residue FROM part),
entries AS (SELECT p_name AS name, upper(substr(p_brand, 7, 1)) AS target, CASE WHEN p_size % 2 = 0 THEN p_size END AS unimod, p_retailprice AS mass, p_partkey AS o, upper(substr(p_type, 1, 1)) AS t2 FROM part)
SELECT name, residue, CAST(unimod AS BIGINT) AS unimod, mass FROM (SELECT n.name, n.residue, e.unimod, e.mass, row_number() OVER (PARTITION BY n.name, n.residue ORDER BY CASE WHEN n.residue IN (e.target, e.t2) THEN 0 WHEN e.unimod IS NOT NULL THEN 1 ELSE 2 END, e.o) AS r
FROM names n JOIN entries e ON lower(e.name) = lower(n.stem)) WHERE r = 1""")
def lookup_with_preference(t):
    first = F.upper(F.substr("p_type", F.lit(1), F.lit(1)))
    names = t.part.select(F.concat(F.col("p_name"), F.lit(" on "), first).alias("name"), first.alias("residue"))
    entries = t.part.select(F.col("p_name").alias("name"), F.array(F.upper(F.substr("p_brand", F.lit(7), F.lit(1))), first).alias("targets"),
                            F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("bigint")).alias("unimod"), F.col("p_retailprice").alias("mass"), F.col("p_partkey").alias("entry_order"))
    return look_up(names, entries).drop("found")


# A document's pieces are all its distinct words, and one word of another language. Letter by letter in SQL, all words
# of whole texts take minutes; tests compare with brute force.
def _pieces(t):
    words = F.filter(F.split(F.lower("text"), " "), lambda w: w != "")
    return t.documents.select("doc_id", F.array_distinct(F.concat(words, F.array(F.lit("tion")))).alias("pieces"))


@query(None)
def occurrences(t):
    texts = t.documents.select(F.col("doc_id").cast("string").alias("accession"), F.lower("text").alias("sequence"))
    found = find_pieces(_pieces(t).withColumn("doc", F.col("doc_id").cast("string")), "pieces", "doc", texts).filter("starts IS NOT NULL")
    place = lambda i: F.element_at("starts", i).cast("bigint")
    return found.select(F.col("accession").cast("bigint").alias("doc_id"), "piece", F.size("starts").cast("bigint").alias("n"), place(1).alias("first_place"), place(-1).alias("last_place"))


@query(None)
def place_peptides(t):
    pairs = _pieces(t).select(text("D", "doc_id").alias("accession"), "pieces")
    seqs = t.documents.filter("lang <> 'fr'").select(text("D", "doc_id").alias("accession"), F.lower("text").alias("sequence"))
    # A list as text, every place with all that is known of it.
    return sites.placed_lists(pairs, "pieces", "accession", seqs).withColumn("places", F.to_json("places"))


@query("""SELECT CASE WHEN d.text IS NULL THEN 'no_sequence' WHEN s.place > length(d.text) THEN 'beyond_length' WHEN array_slice(d.text, s.place, s.place) = 'e' THEN 'residue_matches' ELSE 'wrong_residue' END AS outcome, count(*) AS n
FROM (SELECT user_id AS doc, event_id + 1 AS place FROM events) s LEFT JOIN (SELECT * FROM documents WHERE lang <> 'fr') d ON d.doc_id = s.doc GROUP BY 1""")
def verify_positions(t):
    rows = t.events.select("user_id", (F.col("event_id") + 1).alias("place"), F.lit("e").alias("residue"))
    seqs = t.documents.filter("lang <> 'fr'").select(F.col("doc_id").alias("accession"), F.col("text").alias("sequence"))
    return sites.verify_positions(rows, "user_id", "place", "residue", seqs)


# An order's lines are the members of its group; a member's sequence is its part's name. Every line states a segment, by
# the first and the third letter of its name (a blank is no letter, and fits any). Its order has three cells: the lines at
# even places, those at odd ones, and all. In SQL every order-preserving choice is listed, and one that is alone counts.
_ASSIGN = """RECURSIVE m AS (
  SELECT l_orderkey AS g, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS m, l_partkey, p_name AS s FROM lineitem JOIN part ON p_partkey = l_partkey),
seg AS (SELECT g, unnest([m % 2, 2]) AS part, unnest([m // 2, m]) AS segment, s FROM m),
fit AS (SELECT seg.g, part, segment, m.m FROM seg JOIN m ON m.g = seg.g AND (substr(seg.s, 1, 1) IN ('', ' ') OR substr(seg.s, 1, 1) = substr(m.s, 1, 1)) AND (substr(seg.s, 3, 1) IN ('', ' ') OR substr(seg.s, 3, 1) = substr(m.s, 3, 1)) AND length(m.s) >= 3),
sized AS (SELECT g, part, count(*) AS n FROM seg GROUP BY ALL),
choice AS (SELECT g, part, 0 AS k, m, [m] AS path FROM fit WHERE segment = 0 UNION ALL SELECT c.g, c.part, c.k + 1, f.m, list_append(c.path, f.m) FROM choice c JOIN fit f ON f.g = c.g AND f.part = c.part AND f.segment = c.k + 1 AND f.m > c.m),
alone AS (SELECT g, part, any_value(path) AS path FROM choice JOIN sized USING (g, part) WHERE k = n - 1 GROUP BY ALL HAVING count(*) = 1)"""


def _groups(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("o"))
    ranked = occurrence_rank(rows, ["l_orderkey"], "o", "r")
    return ranked.select(F.col("l_orderkey").alias("g"), (F.col("r") - 1).cast("int").alias("member"), F.col("l_partkey").cast("string").alias("accession"))


@query(f"""WITH {_ASSIGN} SELECT seg.g, seg.part, seg.segment, m.l_partkey::VARCHAR AS accession
FROM seg LEFT JOIN alone USING (g, part) LEFT JOIN m ON m.g = seg.g AND m.m = alone.path[seg.segment + 1]""")
def assign_segments(t):
    groups = _groups(t)
    seqs = t.part.select(F.col("p_partkey").cast("string").alias("accession"), F.col("p_name").alias("sequence"))
    stated = groups.join(seqs, "accession").withColumn("part", F.explode(F.array(F.col("member") % 2, F.lit(2))))
    segment = F.when(F.col("part") == 2, F.col("member")).otherwise(F.floor(F.col("member") / 2).cast("int")).alias("segment")
    letters = stated.select("g", "part", segment, "sequence", F.explode(F.array(F.lit(1), F.lit(3))).alias("at"))
    entries = letters.select("g", "part", "segment", F.col("at").cast("bigint").alias("position"), F.concat(F.lit("Mark on "), F.substr("sequence", F.col("at"), F.lit(1))).alias("modification"))
    return sites.assign_segments(entries, ["part"], "g", groups, seqs).select("g", "part", "segment", "accession")


@query("""SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45) AS has_site FROM orders""")
def site_key_join(t):
    known = t.lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").alias("site"))
    have, lack = sites.site_key_join(t.orders.select("o_orderkey"), "o_orderkey", known, "site")
    return have.withColumn("has_site", F.lit(True)).unionByName(lack.withColumn("has_site", F.lit(False)))


_BASES = "SELECT *, CASE WHEN l_returnflag = 'A' THEN 'intensity' ELSE 'count' END AS basis, (l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS o FROM lineitem"


def _entries(t):
    return t.lineitem.select(
        "l_partkey", "l_linestatus", F.when(F.col("l_returnflag") == "A", F.lit("intensity")).otherwise(F.lit("count")).alias("basis"), F.col("l_orderkey").alias("grp"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("o"), F.col("l_discount").alias("fraction"), F.col("l_linenumber").cast("double").alias("numerator"), F.col("l_quantity").alias("denominator"))


@query(f"""WITH b AS ({_BASES}), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_linestatus, basis ORDER BY o) AS r FROM b), c AS (SELECT * FROM r WHERE r = 1 AND basis = 'count'), i AS (SELECT * FROM r WHERE r = 1 AND basis = 'intensity'),
g AS (SELECT l_partkey, l_linestatus, arg_min(l_orderkey, o) AS grp FROM b GROUP BY ALL)
SELECT g.l_partkey, g.l_linestatus, g.grp, c.l_discount AS modified_fraction_count, CAST(c.l_linenumber AS BIGINT) AS n_modified_psms, CAST(c.l_quantity AS BIGINT) AS n_covering_psms, c.l_linenumber = c.l_quantity AS count_is_ceiling,
i.l_discount AS modified_fraction_intensity, CAST(i.l_linenumber AS DOUBLE) AS intensity_modified, i.l_quantity AS intensity_total, i.l_discount = 0 AND i.l_linenumber = 0 AS intensity_is_floor, i.l_discount = 1 AS intensity_is_ceiling
FROM g LEFT JOIN c USING (l_partkey, l_linestatus) LEFT JOIN i USING (l_partkey, l_linestatus)""")
def merge_two_bases(t):
    return sites.merge_two_bases(_entries(t), ["l_partkey", "l_linestatus"], "basis", "grp", "o")[0]


@query(f"""WITH b AS ({_BASES}), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_linestatus, basis ORDER BY o) AS r FROM b), f AS (SELECT * FROM r WHERE r = 1), g AS (SELECT l_partkey, l_linestatus, arg_min(l_orderkey, o) AS grp FROM b GROUP BY ALL)
SELECT CASE WHEN r.l_discount = f.l_discount AND r.l_linenumber = f.l_linenumber AND r.l_quantity = f.l_quantity THEN 'identical' ELSE 'different' END AS what, CASE WHEN r.l_orderkey = g.grp THEN 'same group' ELSE 'another group' END AS "where", count(*) AS n
FROM r JOIN f ON f.l_partkey = r.l_partkey AND f.l_linestatus = r.l_linestatus AND f.basis = r.basis JOIN g ON g.l_partkey = r.l_partkey AND g.l_linestatus = r.l_linestatus WHERE r.r > 1 GROUP BY ALL""")
def duplicate_entries(t):
    return sites.merge_two_bases(_entries(t), ["l_partkey", "l_linestatus"], "basis", "grp", "o")[1]


@query("""SELECT 'X:P' || acc || ':C' || (place + 3) || ':' || name AS ptm_site_id, count(*) AS n_psms, min(q) AS best_q_value, min(label) AS target_decoy, CAST(place + 3 AS BIGINT) AS position
FROM (SELECT l_partkey AS acc, l_discount AS q, 'target' AS label, CASE l_returnflag WHEN 'A' THEN 'alpha' ELSE 'beta' END || ' on C' AS name, 1 + p_size AS place, l_linenumber
 FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'R' AND l_discount <= 0.01 AND l_linestatus = 'F') GROUP BY ALL""")
def site_rows(t):
    """Peptide PEPC with its C modified, in a protein of p_size residues before it."""
    mod = F.when(F.col("l_returnflag") == "A", F.lit("alpha")).otherwise(F.lit("beta"))
    notation = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("PEPC[Kind:"), mod, F.lit(" on C]"))).otherwise(F.lit("PEPC"))
    matches = t.lineitem.select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_order"), notation.alias("notation"), F.col("l_discount").alias("q_value"),
        F.when(F.col("l_returnflag") == "R", F.lit("decoy")).otherwise(F.lit("target")).alias("target_decoy"), F.lit("1").alias("ambiguity_level"),
        F.array(text("P", "l_partkey")).alias("accessions"), F.lit("[1 to 4]").alias("ranges"), F.lit("K").alias("previous"))
    seqs = t.part.select(text("P", "p_partkey").alias("accession"), F.concat(F.repeat(F.lit("A"), F.col("p_size")), F.lit("PEPC")).alias("sequence"))
    forms = translate(matches, "notation", registry(t))
    rows, _ = sites.site_rows(matches, forms, seqs, "X")
    return rows.select("ptm_site_id", "n_psms", "best_q_value", "target_decoy", "position")
