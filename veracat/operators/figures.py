"""Headline figures and per-dataset documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.functions.rules import is_decoy
from veracat.operators.ordering import running_sum
from veracat.operators.quality import union_all

SHARED_TARGET = 10_000


def _evidence() -> Column:
    return (F.col("n_protein_groups") > 0) | (F.col("n_peptidoforms") > 0)


def countable(presence: DataFrame, entity: str = "protein_accession") -> DataFrame:
    """Presence rows that count: evidence passed, no contaminant in that dataset, no decoy."""
    return presence.filter(_evidence() & ~F.coalesce("is_contaminant", F.lit(False)) & ~is_decoy(entity))


def presence_spread(presence: DataFrame, entity: str = "protein_accession", dataset: str = "dataset_id") -> DataFrame:
    """(n_datasets, n_entities)."""
    pairs = countable(presence, entity).select(entity, dataset).distinct()
    return pairs.groupBy(entity).agg(F.count("*").alias("n_datasets")).groupBy("n_datasets").agg(F.count("*").alias("n_entities"))


def shared_threshold(spread: DataFrame, target: int = SHARED_TARGET) -> DataFrame:
    """The N of at least 2 whose "in N or more datasets" count is nearest the target; a tie goes to
    the larger N. No row when nothing is in two datasets.

    The counts are a running sum over the histogram, from the largest N down. Only an N that some entity has is on offer.
    """
    shared = spread.filter("n_datasets >= 2")
    at_least = running_sum(shared, [], [F.col("n_datasets").desc()], F.col("n_entities"), "_at_least")
    offered = at_least.select(F.col("n_datasets").cast("int").alias("n"), F.col("_at_least").alias("n_entities"))
    return offered.orderBy(F.abs(F.col("n_entities") - target), F.col("n").desc()).limit(1)


def unanimous_unique(rows: DataFrame, key: str, flag: str) -> DataFrame:
    """One row: keys, and keys whose flag holds in every row (NULL does not hold)."""
    return rows.groupBy(key).agg(F.bool_and(F.coalesce(flag, F.lit(False))).alias("_u")).agg(
        F.count("*").alias("n_keys"), F.count_if("_u").alias("n_unanimous")
    )


def filtered_population(presence: DataFrame, datasets: DataFrame, axis: str, value: Sequence[str], mixed: str, entity: str = "protein_accession",
                        dataset: str = "dataset_id") -> DataFrame:
    """One row: distinct countable entities over the datasets whose axis is exactly ``value`` and not mixed."""
    wanted = F.array(*[F.lit(v) for v in value])
    chosen = datasets.filter((F.col(axis) == wanted) & ~F.coalesce(F.col(mixed), F.lit(False))).select(dataset).distinct()
    return countable(presence, entity).join(chosen, dataset, "left_semi").agg(F.count_distinct(entity).alias("n_entities"))


def conditional_counts(rows: DataFrame, code: str, codes: Mapping[str, str]) -> DataFrame:
    """One row with a count per wanted code."""
    return rows.agg(*[F.count_if(F.col(code) == value).alias(name) for name, value in codes.items()])


def headline_sums(overview: DataFrame, sums: Mapping[str, str], reports: DataFrame, value: str, dataset: str = "dataset_id") -> DataFrame:
    """One row of totals, and how many datasets report a figure some cannot supply."""
    # Counts are added as whole numbers: a double loses them above 2^53.
    none = F.lit(None).cast("bigint")
    rows = union_all([
        overview.select(F.lit("d").alias("k"), *[F.col(c).cast("bigint").alias(n) for n, c in sums.items()], none.alias("_v"), F.lit(None).cast("string").alias("_d")),
        reports.select(F.lit("r").alias("k"), *[none.alias(n) for n in sums], F.col(value).cast("bigint").alias("_v"), F.col(dataset).cast("string").alias("_d")),
    ])
    return rows.agg(
        F.count_if(F.col("k") == "d").alias("n_datasets"), *[F.sum(n).alias(n) for n in sums],
        F.sum("_v").alias("reported"), F.count_distinct("_d").alias("n_reporting"),
    )


def modal_name(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The most frequent name per key, the smallest on a tie. Names are counted first, so a key is
    decided over its distinct names."""
    counted = rows.filter(F.col(name).isNotNull()).dropna(subset=list(keys)).groupBy(*keys, name).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(F.min_by(name, F.struct((-F.col("_n")).alias("n"), F.col(name))).alias(name))


def modification_counts(sites: DataFrame, dataset: str = "dataset_id", name: str = "modification_name", term: str = "modification") -> DataFrame:
    return sites.filter("target_decoy = 'target'").groupBy(dataset, name).agg(F.min(term).alias(term), F.count("*").alias("n_sites"))


def severity_rank(severity: str) -> Column:
    return F.when(F.col(severity) == "error", 0).when(F.col(severity) == "warning", 1).otherwise(2)


def severity_order(findings: DataFrame, before: Sequence[str], severity: str = "severity", after: Sequence[str] = ()) -> DataFrame:
    return findings.orderBy(*before, severity_rank(severity), *after)


def finding_summary(findings: DataFrame, severities: Sequence[str] = ("warning", "error")) -> DataFrame:
    """Per (code, severity): how many and the smallest message."""
    return findings.filter(F.col("severity").isin(list(severities))).groupBy("code", "severity").agg(
        F.count("*").alias("n"), F.min("message").alias("example")
    )


def findings_by_severity(findings: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """Per dataset a count per severity and the codes that occur."""
    return findings.groupBy(dataset).agg(
        *[F.count_if(F.col("severity") == s).alias(s) for s in ("error", "warning", "info")],
        F.array_sort(F.collect_set("code")).alias("finding_codes"),
    )


def presence_join(presence: DataFrame, index: DataFrame, entity: str = "protein_accession", attributes: Sequence[str] = ("gene", "organism"),
                  dataset: str = "dataset_id") -> DataFrame:
    """Per entity with passed evidence: its attributes and where, one entry per dataset and label.
    Decoys are left out, contaminants stay and say so."""
    passed = presence.filter(_evidence() & ~is_decoy(entity))
    entry = F.struct(dataset, "n_protein_groups", "n_peptidoforms", "best_q_value", "is_contaminant")
    nested = passed.groupBy(entity).agg(F.array_sort(F.collect_list(entry)).alias("datasets"))
    return nested.join(index.select(entity, *attributes), entity).select(entity, *attributes, "datasets")


def nested(rows: DataFrame, key: str, order: Sequence[Column], fields: Sequence[str], alias: str) -> DataFrame:
    """(key, all its rows as a list of structs, in order)."""
    listed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("_order"), *fields))).alias(alias))
    return listed.select(key, F.transform(alias, lambda x: x.dropFields("_order")).alias(alias))


def dataset_documents(overview: DataFrame, facts: DataFrame, snapshots: DataFrame, findings: DataFrame, modifications: DataFrame,
                      metrics: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """One document per dataset: its counts, facts, snapshot, and nested open findings, modifications and metrics.

    A list holds every distinct summary row with how often it occurs, never evidence, so it is as long as a dataset has
    different things to say.
    """
    open_findings = findings.filter("status = 'open'")
    distinct = open_findings.groupBy(dataset, "code", "severity", "message").agg(F.count("*").alias("n"))
    told = nested(distinct, dataset, [severity_rank("severity"), F.col("code"), F.col("message")], ["code", "severity", "message", "n"], "findings")
    names = ["modification_name", "modification", "n_sites"]
    mods = nested(modifications.select(dataset, *names).distinct(), dataset, [-F.col("n_sites"), F.col("modification_name"), F.col("modification")], names, "modifications")
    fields = ["name", "value", "definition_id"]
    values = nested(metrics.select(dataset, *fields).distinct(), dataset, [F.col(f) for f in fields], fields, "metrics")
    out = overview
    for frame in (facts, snapshots, told, mods, values, findings_by_severity(open_findings, dataset)):
        out = out.join(frame, dataset, "left")
    return out


def public_source_lookup(datasets: DataFrame, commits: DataFrame, dataset: str = "dataset_id", commit: str = "pipeline_commit") -> DataFrame:
    """The public repository and commit recorded beside a private commit, by dataset and commit."""
    public = commits.filter("public_commit IS NOT NULL").select(dataset, F.col("commit").alias(commit), "public_repo", "public_commit")
    one = public.groupBy(dataset, commit).agg(F.min(F.struct("public_commit", "public_repo")).alias("_p"))
    return datasets.join(one, [dataset, commit], "left").select(
        *datasets.columns, F.col("_p.public_repo").alias("public_repo"), F.col("_p.public_commit").alias("public_commit")
    )
