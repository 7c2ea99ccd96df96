"""Benchmark decontamination by winnowing: fingerprints find candidate documents, windows extend their hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.llm.common import folded_words, grams, let, whole
from veracat.session import materialise

WINDOW = 10
GRAM = 5


def winnow(items: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """The smallest gram hash of every ``window`` consecutive items, each value once.

    Two lists that share ``window`` items in a row share all gram hashes of that stretch, hence its smallest:
    no shared stretch of that length goes unseen.
    """
    span = window - gram + 1

    def least(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - (span - 1)), lambda i: F.array_min(F.slice(h, i, F.lit(span))))

    return F.when(F.size(items) >= window, F.array_distinct(let(grams(items, gram), least))).otherwise(F.array().cast("array<bigint>"))


def windows(items: Column, n: int) -> Column:
    """Every n consecutive items as (place, n, text); words hold no blanks, so the text is exact."""
    starts = F.sequence(F.lit(1), F.size(items) - (n - 1))
    made = F.transform(starts, lambda i: F.struct(i.alias("place"), F.lit(n).alias("n"), F.array_join(F.slice(items, i, F.lit(n)), " ").alias("words")))
    return F.when(F.size(items) >= n, made).otherwise(F.array().cast("array<struct<place:int,n:int,words:string>>"))


def joined(parts: list[Column], kind: str) -> Column:
    return F.concat(*parts) if parts else F.array().cast(kind)


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, digest, n_hit, items) of every document that holds a whole window of a benchmark item.

    A window is ``window`` consecutive words, or all words of a shorter item; an item without words has none, and one
    without an id is found but not listed.
    ``n_hit`` counts the document's words inside any occurrence, ``items`` lists the items in question.
    (doc_id, md5 of the text) names a document, so repeated rows have one entry; a NULL text has no words.

    Winnowed fingerprints pick candidates; only those documents are cut into windows, which are compared as
    text. The benchmark's side of a join is broadcast only if the planner's size threshold allows it.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), folded_words(item_text).alias("w"))
    items = materialise(items.where(F.size("w") > 0).distinct(), "items")
    # At most one value for each length below the window.
    short = sorted(r[0] for r in items.where(F.size("w") < window).select(F.size("w")).distinct().collect())
    long_ = [window] if not items.where(F.size("w") >= window).isEmpty() else []

    own = F.when(F.size("w") >= window, winnow(F.col("w"), window, gram)).otherwise(F.array(F.xxhash64("w")))
    marks = items.select(F.explode(own).alias("mark")).distinct()
    own_windows = F.when(F.size("w") >= window, windows(F.col("w"), window)).otherwise(F.array(F.struct(F.lit(1).alias("place"), F.size("w").alias("n"), F.array_join("w", " ").alias("words"))))
    known = items.select("item_id", F.explode(own_windows).alias("x")).select("item_id", "x.n", "x.words")
    known = known.groupBy("n", "words").agg(F.collect_set(F.col("item_id").cast("string")).alias("found"))

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("t"))
    cut = rows.select("doc_id", F.md5("t").alias("digest"), folded_words("t").alias("w"))
    w = F.col("w")
    prints = joined([winnow(w, window, gram)] * bool(long_) + [grams(w, n) for n in short], "array<bigint>")
    seen = cut.select("doc_id", "digest", F.explode(prints).alias("mark"))
    candidates = materialise(seen.join(marks, "mark", "left_semi").select("doc_id", "digest").distinct(), "candidates")

    named = rows.withColumn("digest", F.md5("t")).alias("d")
    again = named.join(candidates.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.digest") == F.col("c.digest")), "left_semi")
    again = again.select("doc_id", "digest", folded_words("t").alias("w"))
    cuts = joined([windows(w, n) for n in [*short, *long_]], "array<struct<place:int,n:int,words:string>>")
    hits = again.select("doc_id", "digest", F.explode(cuts).alias("x")).select("doc_id", "digest", "x.*").join(known, ["n", "words"])
    # A document's own hits: no longer than its words, and one list of items for each distinct window.
    per = hits.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(F.struct("place", "n"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("found")))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["place"] + x["n"] - F.greatest(x["place"], s["end"]))).cast("bigint").alias("n"), F.greatest(s["end"], x["place"] + x["n"]).alias("end")),
        lambda s: s["n"],
    )
    return materialise(per.select("doc_id", "digest", covered.alias("n_hit"), "items"), "contaminated")


def annotate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contamination(docs, benchmark, doc_id, text, **options).select(F.col("doc_id").alias("of_doc"), F.col("digest").alias("of_digest"), "n_hit", "items")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.md5(whole(text)).alias("digest"), F.size(folded_words(text)).cast("bigint").alias("n_words"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("digest") == F.col("of_digest")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, with all their columns."""
    found = contamination(docs, benchmark, doc_id, text, **options).select(F.col("doc_id").alias("of_doc"), F.col("digest").alias("of_digest"))
    packed = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("its_id"), F.md5(whole(text)).alias("its_digest"))
    left = packed.join(found, F.col("its_id").eqNullSafe(F.col("of_doc")) & (F.col("its_digest") == F.col("of_digest")), "left_anti")
    return left.select([F.col("row")[c].alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), known AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), cuts AS (
  SELECT r, n, i, w[i:i + n - 1] AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM known))
), hits AS (
  SELECT r, cuts.n, i, item_id FROM cuts JOIN known ON cuts.n = known.n AND cuts.g = known.g
), places AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN found USING (r)
"""
