"""Term annotations of groups and the categories of terms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.functions.cells import split_list, tri_state
from veracat.operators.identification import first_wins

# The annotation and category files' columns, and the statuses a group may have.
ANNOTATION_COLUMNS = [
    "protein_group", "accession_used", "go_id", "go_name", "aspect", "evidence", "inherited", "propagated",
    "n_members", "n_with", "annotation_status", "q_value", "go_release", "go_obo_sha256", "annotation_db_sha256",
]
CATEGORY_COLUMNS = ["go_id", "category", "subcategory"]
STATUSES = ["annotated", "no_go_terms", "no_entry", "contaminant"]
CELLULAR_COMPONENT = "cellular_component"


def status_recount(rows: DataFrame, group: str, status: str, q: str, members: str, q_max: float,
                   statuses: Sequence[str] = STATUSES) -> DataFrame:
    """(counter, n) over groups at q of at most ``q_max``: one per status, the groups with several
    members, and the groups that carry two statuses, which must be refused."""
    per_group = rows.groupBy(group).agg(
        F.min(status).alias("_lo"), F.max(status).alias("_hi"), F.max(q).alias("_q"), F.max(members).alias("_members")
    )
    counted = F.col("_q") <= q_max
    counters = {f"status_{s}": F.count_if(counted & (F.col("_lo") == s)) for s in statuses}
    counters["n_multi_member_groups"] = F.count_if(counted & (F.col("_members") > 1))
    counters["two_statuses"] = F.count_if(F.col("_lo") != F.col("_hi"))
    one = per_group.agg(*[c.alias(n) for n, c in counters.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("counter"), F.col(n).alias("n")) for n in counters])
    return one.select(F.explode(pairs).alias("c")).select("c.*")


def counter_problems(recount: DataFrame, header: DataFrame) -> DataFrame:
    """Counters of the header (key, value) that the rows do not confirm."""
    h = header.select(F.col("key").alias("counter"), F.col("value").try_cast("bigint").alias("header"))
    return recount.join(h, "counter").filter(~F.col("n").eqNullSafe(F.col("header")))


def single_membership(groups: DataFrame, members: Column, group: str) -> DataFrame:
    """(accession, n_groups) of accessions that sit in more than one group."""
    pairs = groups.select(F.col(group).alias("_g"), F.explode(members).alias("accession")).distinct()
    return pairs.groupBy("accession").agg(F.count("*").alias("n_groups")).filter("n_groups > 1")


def annotation_problems(rows: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """(rule, n) over the rows in one pass."""
    has_term = F.col("go_id") != ""
    rules = {f"{c} differs from the header": F.col(c) != v for c, v in expected.items()}
    rules["unknown status"] = ~F.col("annotation_status").isin(STATUSES)
    rules["a term on a group that is not annotated"] = has_term & (F.col("annotation_status") != "annotated")
    rules["n_with is not the accessions used"] = has_term & (
        F.col("n_with").try_cast("bigint") != F.size(split_list("accession_used", ";"))
    )
    one = rows.agg(*[F.count_if(c).alias(f"r{i}") for i, c in enumerate(rules.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("n")) for i, n in enumerate(rules)])
    return one.select(F.explode(pairs).alias("x")).select("x.*").filter("n > 0")


def coverage_pair(categories: DataFrame, annotations: DataFrame, term: str = "go_id", pins: Sequence[str] = ()) -> DataFrame:
    """Category terms the annotation side does not have, under the same pins (release, digest)."""
    have = annotations.filter(F.col(term) != "").select(term, *pins).distinct()
    return categories.select(term, *pins).distinct().join(have, [term, *pins], "left_anti")


def annotation_source(header: DataFrame, digests: DataFrame, owner: str, code_key: str) -> DataFrame:
    """One source row per file: its id names the release and the file, its version every pin."""
    h = header.groupBy("file").agg(*[
        F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in ("go_release", "go_obo_sha256", "annotation_db_sha256", code_key)
    ])
    d = digests.select(F.col("path").alias("file"), "sha256")
    return h.join(d, "file").select(
        source_id(F.col("go_release"), F.col("sha256")).alias("source_id"), F.lit(owner).alias("owner_project"),
        F.concat(F.col("go_release"), F.lit("; code "), F.coalesce(code_key, F.lit("?")), F.lit("; file "), F.col("sha256"),
                 F.lit("; go.obo "), F.col("go_obo_sha256"), F.lit("; annotation db "), F.col("annotation_db_sha256")).alias("version"),
        F.lit(None).cast("string").alias("doi"),
    )


def source_id(release: Column, sha: Column) -> Column:
    return F.concat(F.lit("go:"), release, F.lit(":"), F.substr(sha, F.lit(1), F.lit(12)))


def localisation_rows(rows: DataFrame, order: str, source: Column, term: str = "go_id", used: str = "accession_used") -> DataFrame:
    """One row per (accession, term) over the accessions used; the last row wins. A member that does
    not carry the term gets none."""
    exploded = rows.select("*", F.explode(split_list(used, ";")).alias("protein_accession")).select(
        "protein_accession", F.col(term).alias("compartment"), "go_release", F.nullif("evidence", F.lit("")).alias("evidence"),
        source.alias("source_id"), "protein_group", F.col("q_value").try_cast("double").alias("q_value"),
        F.col("n_members").try_cast("bigint").alias("n_members"), F.col("n_with").try_cast("bigint").alias("n_with"),
        tri_state("inherited").alias("inherited"), tri_state("propagated").alias("propagated"), F.col(order).alias("_o"),
    )
    return first_wins(exploded, ["protein_accession", "compartment"], "_o", last=True).drop("_o")


def category_rows(rows: DataFrame, map_name: Column, map_version: Column, release: Column, source: Column) -> DataFrame:
    return rows.select(
        F.col("go_id").alias("compartment"), map_name.alias("category_map_name"), map_version.alias("organelle_map_version"),
        release.alias("go_release"), F.col("category").alias("organelle_category"),
        F.nullif("subcategory", F.lit("")).alias("organelle_subcategory"), source.alias("source_id"),
    )
