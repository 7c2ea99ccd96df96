"""Keyword search, profiles and bounded answers.

Every search returns its hits, ordered, one more than asked for, so that a cut is observed and not
inferred; and ``searched`` lines say what each source holds, so an absence can be read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracat.functions.rules import is_decoy
from veracat.operators.quality import union_all

ROW_CAP = 1_000
CHAR_CAP = 50_000

# Fixed format: text that is also tried as a peptide sequence.
SEQUENCE_QUERY = "^[ACDEFGHIKLMNPQRSTVWY]{6,}$"

# Columns whose value means something only inside the search that wrote it.
RUN_RELATIVE = ["pep", "best_pep", "pep_q_value"]


def text_of(c: str | Column) -> Column:
    return F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))


def any_contains(columns: Sequence[str | Column], query: str) -> Column:
    """Does any of the columns contain the text, ignoring case? A wildcard in the query is text."""
    return reduce(lambda a, b: a | b, [F.contains(text_of(c), F.lit(query.lower())) for c in columns])


def ranked_hits(hits: DataFrame, order: Sequence[Column], limit: int | None = None) -> DataFrame:
    """All hits in order, or the first ``limit`` + 1, the last of which says that there are more."""
    ordered = hits.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit + 1)


def search_dataset(overview: DataFrame, query: str, key: str, texts: Sequence[str], lists: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    cells = [*texts, *[F.array_join(c, " ") for c in lists]]
    return ranked_hits(overview.filter((F.upper(key) == query.upper()) | any_contains(cells, query)), [F.col(key)], limit)


def search_entity(index: DataFrame, query: str, key: str, symbol: str, count: str, limit: int | None = None) -> DataFrame:
    """Identifier or symbol equal, or the symbol's beginning. Decoys last, exact hits first."""
    q = query.upper()
    sym = F.upper(F.coalesce(symbol, F.lit("")))
    exact = (F.upper(key) == q) | (sym == q)
    hits = index.filter(exact | F.startswith(sym, F.lit(q))).withColumn("is_decoy", is_decoy(key))
    return ranked_hits(hits, [F.col("is_decoy"), exact.desc(), F.col(count).desc(), F.col(key)], limit)


def search_sequence(index: DataFrame, query: str, key: str, count: str, limit: int | None = None) -> DataFrame:
    """Only text of six or more residue letters is a sequence; any other query gives no rows."""
    q = F.lit(query.upper())
    hits = index.filter(q.rlike(SEQUENCE_QUERY) & F.contains(F.col(key), q))
    return ranked_hits(hits, [(F.col(key) == q).desc(), F.col(count).desc(), F.col(key)], limit)


def search_modification(sites: DataFrame, declared: DataFrame, query: str, dataset: str = "dataset_id", limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(what was placed, aggregated; what was declared). They are kept apart: a declared name with no
    site was searched for and not found."""
    hits = sites.filter(any_contains(["modification_name", "modification"], query))
    per_dataset = hits.groupBy("modification", "modification_name", dataset).agg(F.count("*").alias("_n"), F.sum("n_psms").alias("_psms"))
    placed = per_dataset.groupBy("modification", "modification_name").agg(
        F.sum("_n").alias("n_sites"), F.count("*").alias("n_datasets"), F.array_sort(F.collect_list(dataset)).alias("dataset_ids"),
        F.sum("_psms").alias("n_psms"),
    )
    told = declared.filter(any_contains(["name", "modification"], query)).select("modification", "name", "residues", "usage", dataset).distinct() \
        .withColumn("_source", F.lit("search_modifications_declared"))
    return (ranked_hits(placed, [F.col("n_sites").desc(), F.col("modification_name"), F.col("modification")], limit),
            ranked_hits(told, [F.col("name"), F.col(dataset), F.col("usage")], limit))


def search_sample(samples: DataFrame, characteristics: DataFrame, query: str, listed: Sequence[str], also: Sequence[str] = (),
                  dataset: str = "dataset_id", limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(datasets with the distinct values of each listed column, matching characteristics counted)."""
    hits = samples.filter(any_contains([*listed, *also], query)).groupBy(dataset).agg(
        F.count("*").alias("n_samples"), *[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(f"{c}s") for c in listed]
    )
    named = characteristics.filter(any_contains(["value", "name"], query)).groupBy("name", "value").agg(F.count("*").alias("n_samples"))
    return ranked_hits(hits, [F.col(dataset)], limit), ranked_hits(named, [F.col("n_samples").desc(), F.col("name"), F.col("value")], limit)


def search_run(runs: DataFrame, query: str, texts: Sequence[str], order: Sequence[str], limit: int | None = None) -> DataFrame:
    return ranked_hits(runs.filter(any_contains(texts, query)), [F.col(c) for c in order], limit)


def search_definition(definitions: DataFrame, metrics: DataFrame, query: str, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    told = definitions.filter(any_contains(["definition_id", "text"], query)).select("definition_id", "version", "owner_project", "text", "url").distinct()
    used = metrics.filter(any_contains(["name", "definition_id"], query))
    return (ranked_hits(told, [F.col("definition_id"), F.col("version").desc()], limit),
            ranked_hits(used, [F.col("dataset_id"), F.col("name"), F.col("source")], limit))


def definition_lookup(definitions: DataFrame, metrics: DataFrame, target: str) -> DataFrame:
    """One definition: its newest text, its versions and the metrics that use it."""
    own = definitions.filter(F.upper("definition_id") == target.upper())
    one = own.groupBy("definition_id").agg(
        F.sort_array(F.collect_set("version"), asc=False).alias("versions"), F.max_by("text", "version").alias("text"),
        F.max_by("url", "version").alias("url"), F.max_by("owner_project", "version").alias("owner_project"),
    )
    names = metrics.filter(F.upper("definition_id") == target.upper()).groupBy("definition_id").agg(F.array_sort(F.collect_set("name")).alias("metrics_using_it"))
    return one.join(names, "definition_id", "left")


def localisation_categories(annotations: DataFrame, categories: DataFrame, term: str, pin: str, entity: str, keep: Sequence[str],
                            category_columns: Sequence[str], n_examples: int = 10) -> DataFrame:
    """Annotations beside the categories of their term under the same release: entities counted, the
    first few named. An annotation without a category stays, with NULL."""
    cats = categories.select(term, pin, *category_columns).distinct()
    keys = [*keep, term, *category_columns]
    # Entities are made distinct per annotation term before the join multiplies them by categories.
    own = annotations.select(*keep, term, pin, entity).distinct()
    pairs = own.join(cats, [term, pin], "left").select(*keys, entity).distinct()
    w = Window.partitionBy(*keys).orderBy(entity)
    top = pairs.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n_examples)
    shown = top.groupBy(*keys).agg(F.array_sort(F.collect_list(entity)).alias("examples"))
    totals = pairs.groupBy(*keys).agg(F.count("*").alias("n_entities"))
    same = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    return totals.alias("t").join(shown.alias("s"), same).select(*[F.col(f"t.{k}").alias(k) for k in keys], "n_entities", "examples")


def search_localisation(located: DataFrame, annotations: DataFrame, query: str, texts: Sequence[str], limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``located``: see ``localisation_categories``. ``annotations``: (dataset_id, key, value, ..)."""
    hits = located.filter(any_contains(texts, query))
    other = annotations.filter(any_contains(["value", "key"], query)).groupBy("dataset_id", "key", "value").agg(F.count("*").alias("n_entities"))
    return (ranked_hits(hits, [F.col("n_entities").desc(), *[F.col(t) for t in texts]], limit),
            ranked_hits(other, [F.col("n_entities").desc(), F.col("dataset_id"), F.col("key"), F.col("value")], limit))


def search_all(hits: Mapping[str, DataFrame]) -> DataFrame:
    """(kind, hit) over every kind, a hit as JSON so kinds of any shape go in one frame."""
    return union_all([df.select(F.lit(kind).alias("kind"), F.to_json(F.struct("*")).alias("hit")) for kind, df in hits.items()])


def table_list(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, rows, kind), counted in one union so the list is one job."""
    return union_all([
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows", F.lit(kind).alias("kind"))
        for name, (df, kind) in tables.items()
    ])


def non_null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, rows, populated, all_null) in one pass."""
    names = list(columns or df.columns)
    one = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("populated")) for i, c in enumerate(names)])
    return one.select(F.col("_rows").alias("rows"), F.explode(cells).alias("c")).select(
        F.col("c.column").alias("column"), "rows", F.col("c.populated").alias("populated"),
        ((F.col("rows") > 0) & (F.col("c.populated") == 0)).alias("all_null"),
    )


def searched_lines(sources: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(source, rows, columns_all_null) per source: an empty source and an unfilled column are two
    different reasons for no hit."""
    out = []
    for name, (df, columns) in sources.items():
        p = non_null_profile(df, columns)
        out.append(p.agg(
            F.max("rows").alias("rows"), F.array_sort(F.collect_list(F.when(F.col("all_null"), F.col("column")))).alias("columns_all_null")
        ).select(F.lit(name).alias("source"), "rows", "columns_all_null"))
    return union_all(out)


@dataclass
class Answer:
    columns: list[str]
    rows: list[tuple]
    truncated_by: str | None
    max_rows: int
    searched: list[dict] = field(default_factory=list)
    empty_sources: list[str] = field(default_factory=list)
    run_relative_columns: list[str] = field(default_factory=list)
    related_tables: list[str] = field(default_factory=list)

    @property
    def truncated(self) -> bool:
        return self.truncated_by is not None


def bounded_answer(df: DataFrame, rows: int = ROW_CAP, chars: int = CHAR_CAP) -> Answer:
    """At most ``rows`` rows and ``chars`` characters. A caller can only tighten the caps. One row
    more than the cap is fetched, so a cut is seen; whole rows are dropped, never part of a cell."""
    cap, budget = min(rows, ROW_CAP), min(chars, CHAR_CAP)
    fetched = [tuple(r) for r in df.limit(cap + 1).collect()]
    by = "rows" if len(fetched) > cap else None
    kept, budget = [], budget - sum(len(c) + 1 for c in df.columns)
    for row in fetched[:cap]:
        budget -= sum(len(str(v)) + 1 for v in row)
        if budget < 0:
            by = "characters"
            break
        kept.append(row)
    return Answer(df.columns, kept, by, cap)


def disclose_sources(answer: Answer, sources: Mapping[str, tuple[DataFrame, Sequence[str]]], related: Mapping[str, DataFrame] = {}) -> Answer:
    """Say what the answer rests on: rows held per declared source, sources that hold none, searched
    columns that are NULL throughout, run-relative columns read, and related tables that hold rows."""
    answer.searched = [r.asDict() for r in searched_lines(sources).collect()]
    answer.empty_sources = sorted(s["source"] for s in answer.searched if s["rows"] == 0)
    read = {c for _, columns in sources.values() for c in columns} | set(answer.columns)
    answer.run_relative_columns = [c for c in RUN_RELATIVE if c in read]
    answer.related_tables = sorted(name for name, df in related.items() if df.limit(1).count())
    return answer
