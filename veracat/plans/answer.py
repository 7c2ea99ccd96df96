"""Answer a keyword question over every kind of thing a catalog holds, and say what was searched."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from veracat.operators import search
from veracat.plans.catalog import Catalog

#: Hits of a kind that an answer shows.
LIMIT, MOST = 25, 200


@dataclass
class Found:
    query: str
    hits: dict[str, list[dict]] = field(default_factory=dict)
    #: Kinds that matched more than is shown.
    cut: list[str] = field(default_factory=list)
    #: What each source holds: rows, and searched columns that are NULL throughout.
    searched: list[dict] = field(default_factory=list)
    empty_sources: list[str] = field(default_factory=list)
    #: Every dataset that a hit names.
    datasets: list[str] = field(default_factory=list)


Source = tuple[str, Sequence[str]]
Search = Callable[[Catalog, str, int], list[DataFrame]]

SAMPLE_TEXTS = ["organism_part", "cell_type", "disease", "condition", "cell_line"]
RUN_TEXTS = ["run_id", "file_name", "instrument_model"]
CATEGORY = ["organelle_category", "organelle_subcategory"]


def _dataset(c: Catalog, q: str, n: int) -> list[DataFrame]:
    return [search.search_dataset(c.rows("dataset_overview", q), q, "dataset_id", ["dataset_id", "title"], ["organisms"], n)]


def _protein(c: Catalog, q: str, n: int) -> list[DataFrame]:
    return [search.search_entity(c.rows("protein_index", q), q, "protein_accession", "gene", "n_datasets_1pct", n)]


def _peptide(c: Catalog, q: str, n: int) -> list[DataFrame]:
    return [search.search_sequence(c.rows("peptide_index", q), q, "base_sequence", "n_datasets", n)]


def _modification(c: Catalog, q: str, n: int) -> list[DataFrame]:
    return list(search.search_modification(c["ptm_sites"], c.rows("search_modifications_declared", q), q, limit=n))


def _sample(c: Catalog, q: str, n: int) -> list[DataFrame]:
    return list(search.search_sample(c.rows("samples", q), c["sample_characteristics"], q, SAMPLE_TEXTS, ["source_name", "organism"], limit=n))


def _run(c: Catalog, q: str, n: int) -> list[DataFrame]:
    return [search.search_run(c.rows("runs", q), q, RUN_TEXTS, ["run_id"], n)]


def _definition(c: Catalog, q: str, n: int) -> list[DataFrame]:
    return list(search.search_definition(c.rows("definitions", q), c["metrics"], q, n))


def _localization(c: Catalog, q: str, n: int) -> list[DataFrame]:
    located = search.localisation_categories(c["protein_localizations"], c["organelle_term_categories"], "compartment", "go_release", "protein_accession", [], CATEGORY)
    return list(search.search_localisation(located, c["protein_annotations"], q, ["compartment", *CATEGORY], n))


#: Kind to how it is searched, and the tables and columns that it rests on.
KINDS: dict[str, tuple[Search, list[Source]]] = {
    "dataset": (_dataset, [("dataset_overview", ["dataset_id", "title", "organisms"])]),
    "protein": (_protein, [("protein_index", ["protein_accession", "gene"])]),
    "peptide": (_peptide, [("peptide_index", ["base_sequence"])]),
    "modification": (_modification, [("ptm_sites", ["modification_name", "modification"]), ("search_modifications_declared", ["name", "modification"])]),
    "sample": (_sample, [("samples", [*SAMPLE_TEXTS, "source_name", "organism"]), ("sample_characteristics", ["name", "value"])]),
    "run": (_run, [("runs", RUN_TEXTS)]),
    "definition": (_definition, [("definitions", ["definition_id", "text"]), ("metrics", ["name", "definition_id"])]),
    "localization": (_localization, [("protein_localizations", ["compartment"]), ("organelle_term_categories", CATEGORY), ("protein_annotations", ["key", "value"])]),
}


def search_catalog(catalog: Catalog, query: str, kinds: Sequence[str] | None = None, limit: int = LIMIT) -> Found:
    """At most ``limit`` hits of each kind. One more is asked for, so a cut is seen; what each source holds is told
    beside the hits, so "no hits" and "that table is empty" stay two answers. No kind means all of them."""
    text = (query or "").strip()
    if not text:
        raise ValueError("a search needs something to look for")
    unknown = [k for k in kinds or [] if k not in KINDS]
    if unknown:
        raise ValueError(f"a kind is one of {', '.join(KINDS)}, not {', '.join(unknown)}")
    limit = max(1, min(limit, MOST))
    out = Found(text)
    datasets: set[str] = set()
    sources: dict[str, tuple[DataFrame, Sequence[str]]] = {}
    for kind in kinds or KINDS:
        run, rests_on = KINDS[kind]
        # Each frame is limited before it is fetched.
        hits = [row.asDict(recursive=True) for df in run(catalog, text, limit) for row in df.collect()]
        if len(hits) > limit:
            out.cut.append(kind)
        if hits:
            out.hits[kind] = hits[:limit]
        sources |= {name: (catalog[name], columns) for name, columns in rests_on}
    for hit in (h for hits in out.hits.values() for h in hits):
        datasets |= {d for d in [hit.get("dataset_id"), *(hit.get("dataset_ids_1pct") or hit.get("dataset_ids") or [])] if d is not None}
    out.datasets = sorted(datasets)
    out.searched = [r.asDict() for r in search.searched_lines(sources).orderBy("source").collect()]
    out.empty_sources = [s["source"] for s in out.searched if s["rows"] == 0]
    return out
