"""Translate bracketed sequence notation, and resolve modification names against a registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.functions.cells import quote, strip
from veracat.session import materialise

N_TERMINUS = 0
C_TERMINUS = -1


# Brackets inside a bracket, written as signs that no notation holds, so that one pattern finds the outer ones.
INNER_OPEN, INNER_CLOSE = "\x02", "\x03"
# A bracket that opens before the one before it closes.
NESTED = r"\[[^\]]*\["
# One outer bracket, or an unclosed one to the end of the text.
BRACKET = r"(?:\[[^\[\]]*+\]|\[.*$)"


def outer_brackets(notation: str) -> Column:
    """The notation with only its outer brackets left as brackets, however deep they nest.

    Only a notation with a bracket inside a bracket is folded over, one step a bracket: what stands between two
    brackets is one piece. A notation that holds the signs of inner brackets itself is refused.
    """
    def step(acc: Column, piece: Column) -> Column:
        first, rest = F.substr(piece, F.lit(1), F.lit(1)), F.substr(piece, F.lit(2))
        opens, closes = first == "[", first == "]"
        sign = F.when(opens & (acc["depth"] > 0), INNER_OPEN).when(closes & (acc["depth"] > 1), INNER_CLOSE).otherwise(first)
        depth = F.when(opens, acc["depth"] + 1).when(closes, F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"])
        return F.struct(depth.alias("depth"), F.array_append(acc["pieces"], F.concat(sign, rest)).alias("pieces"))

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("pieces"))
    folded = F.aggregate(F.split(notation, r"(?=[\[\]])"), start, step, lambda acc: F.array_join(acc["pieces"], ""))
    refused = F.raise_error(F.concat(F.lit("a notation holds the sign of an inner bracket: "), F.col(notation)))
    return F.when(F.rlike(F.col(notation), F.lit(f"[{INNER_OPEN}{INNER_CLOSE}]")), refused).when(F.rlike(F.col(notation), F.lit(NESTED)), folded).otherwise(F.col(notation))


# Fixed format: ``Category:Name on X`` inside a bracket.
_TOKEN = r"^([^:]+):(.+?) on ([A-Zc-z]|[A-Z][a-z]+)$"


def _contents(brackets: Column) -> Column:
    """Every ``|``-separated token of a run of brackets, as an array."""
    found = F.regexp_extract_all(brackets, F.lit(f"(?s)({BRACKET})"), F.lit(1))
    inner = F.transform(found, lambda b: F.substr(b, F.lit(2), F.greatest(F.length(b) - 2, F.lit(0))))
    tokens = F.split(F.array_join(inner, "|"), quote("|"))
    return F.transform(tokens, lambda t: F.translate(t, INNER_OPEN + INNER_CLOSE, "[]"))


def lookup_with_preference(names: DataFrame, registry: DataFrame) -> DataFrame:
    """(name, residue, unimod, mass, found) for distinct (name, residue).

    The full name is looked up first, then the name without `` on X``. Among the entries of a name
    one that targets the residue is preferred, then one with an accession, then the first listed.
    """
    stem = F.regexp_extract("name", r"(?s)^(.*) on .*$", 1)
    tail = F.upper(F.substr(strip(F.element_at(F.split("name", quote(" on ")), -1)), F.lit(1), F.lit(1)))
    tries = F.array(
        F.struct(F.lit(0).alias("tier"), F.lower("name").alias("key"), F.col("residue").alias("target")),
        F.struct(
            F.lit(1).alias("tier"), F.when(F.contains("name", F.lit(" on ")), F.lower(stem)).alias("key"),
            F.coalesce("residue", tail).alias("target"),
        ),
    )
    candidates = names.select("name", "residue").distinct().select("name", "residue", F.explode(tries).alias("t"))
    # What a name can find of a key is reduced first: its best entry for each residue, and its best entry for any other.
    # The entries are dealt by their order, so that a key with many of them is reduced by many tasks.
    entries = registry.select(F.lower("name").alias("key"), "targets", F.struct("unimod", "mass").alias("e"), "entry_order").repartition("entry_order")
    any_order = F.struct(F.when(F.col("e.unimod").isNotNull(), 1).otherwise(2).alias("rank"), "entry_order")
    for_any = entries.select("key", F.lit(None).cast("string").alias("for"), "e", any_order.alias("at"))
    for_one = entries.select("key", F.explode("targets").alias("for"), "e", F.struct(F.lit(0).alias("rank"), "entry_order").alias("at")).filter("`for` IS NOT NULL")
    reduced = for_any.unionByName(for_one).groupBy("key", "for").agg(F.min_by("e", "at").alias("e"), F.min("at").alias("at"))
    best = (
        candidates.join(reduced, (F.col("t.key") == F.col("key")) & (F.col("for").isNull() | (F.col("for") == F.upper("t.target"))))
        .groupBy("name", "residue")
        .agg(F.min_by("e", F.struct(F.col("t.tier"), F.col("at"))).alias("e"))
        .select("name", "residue", F.col("e.unimod").alias("unimod"), F.col("e.mass").alias("mass"), F.lit(True).alias("found"))
    )
    return best


def tag_text(name: Column, unimod: Column, mass: Column) -> Column:
    return (
        F.when(unimod.isNotNull(), F.concat(F.lit("[UNIMOD:"), unimod.cast("string"), F.lit("]")))
        .when(mass.isNotNull(), F.format_string("[%+.6f]", mass))
        .otherwise(F.concat(F.lit("[Info:"), name, F.lit("]")))
    )


def translate_notation(strings: DataFrame, column: str, registry: DataFrame) -> DataFrame:
    """One row per distinct notation: proforma, base_sequence, mods and unresolved tokens.

    mods: array of (position, residue, name, category, unimod, mass), position 0 for the N-terminus
    and -1 for the C-terminus. The work is per distinct string; join the result back. The distinct strings
    are written in parts once, so that no filter carries the parsing down to the raw rows.
    """
    lead = F.regexp_extract("_flat", f"(?s)^((?:{BRACKET})*)", 1)
    distinct = (
        strings.select(F.col(column).alias("notation")).filter("notation <> ''").distinct()
        .withColumn("_flat", outer_brackets("notation"))
        .withColumn("_lead", lead)
        .withColumn("_body", F.substr("_flat", F.length("_lead") + F.lit(1)))
        # A unit is one residue and the brackets behind it, so its index is its position.
        .withColumn("_units", F.regexp_extract_all("_body", F.lit(rf"(?s)([^\[](?:{BRACKET})*)"), F.lit(1)))
    )
    last = F.get("_units", F.size("_units") - 1)
    c_terminal = F.coalesce(F.startswith(last, F.lit("-[")), F.lit(False))
    parsed_once = distinct.withColumn("_cterm", c_terminal).withColumn(
        "_residues",
        F.transform(
            F.slice("_units", F.lit(1), F.size("_units") - F.col("_cterm").cast("int")),
            lambda u: F.substr(u, F.lit(1), F.lit(1)),
        ),
    )
    pieces = materialise(parsed_once.select("notation", "_lead", "_units", "_residues"), "notations")
    n = F.size("_residues")
    slots = F.array_append(
        F.transform("_units", lambda u, i: F.struct(
            F.when(i < n, i + 1).otherwise(F.lit(C_TERMINUS)).alias("position"), F.substr(u, F.lit(2)).alias("brackets"))),
        F.struct(F.lit(N_TERMINUS).alias("position"), F.col("_lead").alias("brackets")),
    )
    tokens = (
        pieces.select("notation", "_residues", F.explode(F.filter(slots, lambda s: s["brackets"] != "")).alias("s"))
        .select("notation", "_residues", F.col("s.position").alias("position"), F.posexplode(_contents(F.col("s.brackets"))).alias("_i", "token"))
    )
    parsed = F.col("token").rlike(_TOKEN)
    part = [F.regexp_extract("token", _TOKEN, i) for i in (1, 2, 3)]
    named = tokens.select(
        "notation", "position", "_i", "token",
        F.when(parsed, F.concat(part[1], F.lit(" on "), part[2])).otherwise(F.col("token")).alias("name"),
        F.when(parsed, part[0]).otherwise(F.lit("")).alias("category"), F.when(parsed, part[2]).alias("target"),
        F.when(F.col("position") == N_TERMINUS, F.lit("N-term")).when(F.col("position") == C_TERMINUS, F.lit("C-term"))
        .otherwise(F.get("_residues", F.col("position") - 1)).alias("residue"),
    )
    wanted = named.select("name", F.col("target").alias("residue"))
    hits = lookup_with_preference(wanted, registry).select(F.col("name").alias("_n"), F.col("residue").alias("_r"), "unimod", "mass")
    resolved = named.join(hits, (F.col("name") == F.col("_n")) & F.col("target").eqNullSafe(F.col("_r")), "left")
    # A notation is one peptide, so its list of modifications is as long as the peptide at most.
    at = F.struct(
        F.when(F.col("position") == C_TERMINUS, F.lit(2147483647)).otherwise(F.col("position")).alias("sort"),
        F.col("_i").alias("i"),
        F.struct("position", "residue", "name", "category",
                 F.concat(F.lit("UNIMOD:"), F.col("unimod").cast("string")).alias("unimod"), "mass").alias("mod"),
        tag_text(F.col("name"), F.col("unimod"), F.col("mass")).alias("tag"),
        F.when(F.col("unimod").isNull() & F.col("mass").isNull(), F.col("token")).alias("unresolved"),
    )
    grouped = resolved.groupBy("notation").agg(F.array_sort(F.collect_list(at)).alias("_m"))
    joined = pieces.join(grouped, "notation", "left")

    def tags_at(position: Column) -> Column:
        return F.array_join(F.transform(F.filter("_m", lambda m: m["mod"]["position"] == position), lambda m: m["tag"]), "")

    marked = F.array_join(F.transform("_residues", lambda r, i: F.concat(r, tags_at(i + 1))), "")
    lead_tags, end_tags = tags_at(F.lit(N_TERMINUS)), tags_at(F.lit(C_TERMINUS))
    plain = F.array_join("_residues", "")
    return joined.select(
        "notation",
        F.when(F.col("_m").isNull(), plain).otherwise(F.concat(
            F.when(lead_tags != "", F.concat(lead_tags, F.lit("-"))).otherwise(F.lit("")), marked,
            F.when(end_tags != "", F.concat(F.lit("-"), end_tags)).otherwise(F.lit("")),
        )).alias("proforma"),
        plain.alias("base_sequence"),
        F.transform("_m", lambda m: m["mod"]).alias("mods"),
        F.array_distinct(F.filter(F.transform("_m", lambda m: m["unresolved"]), lambda u: u.isNotNull())).alias("unresolved"),
    )
