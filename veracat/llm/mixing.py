"""Mixing sources to target weights: repetition rates per source, whole copies plus one seeded draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.llm.common import running_sum, whole
from veracat.session import materialise

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"


def word_count(text: str | Column) -> Column:
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources by code point, NULL last, take the weights in turn and share the size of all documents. A target
    stops at ``most`` times its source's size, and the rest is shared anew by weight among those below, until
    none is above. A round reads one row of sums; every round but the last stops at least one source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.lit(1).alias("one"))
    placed = running_sum(per_source, [F.col("source").asc_nulls_last()], "one", "place")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = materialise(placed.select("source", "source_size", turn.cast("bigint").alias("weight"), (most * F.col("source_size")).alias("ceiling")), "sources")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    stopped, rest, share = F.lit(False), total, 0
    while True:
        below = ~stopped
        full, share = table.agg(F.coalesce(F.sum(F.when(stopped, F.col("ceiling"))), F.lit(0)), F.coalesce(F.sum(F.when(below, F.col("weight"))), F.lit(0))).first()
        rest = total - full
        if not share:
            break
        above = F.col("ceiling") * share < F.col("weight") * rest
        if not table.where(below & above).limit(1).count():
            break
        stopped = above  # the level only rises, so what was above stays above
    level = F.col("weight") * F.lit(rest) / F.lit(share) if share else F.col("ceiling").cast("double")
    return table.select("source", "source_size", F.least(F.col("ceiling").cast("double"), level.cast("double")).alias("target"))


def draw(doc_id: str, text: str, seed: str = SEED) -> Column:
    """A number from 0 to 1 that depends on the row and the seed alone, so a rerun or a lost task draws it again."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(whole(text)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies.

    A document of a source whose rate is target / source_size is taken floor(rate) times, and once more with
    the fraction as probability. NULL texts and texts without a word have size 0; a source of size 0 has rate
    0. A NULL source is a source of its own. Repeated rows draw alike. Only these columns are written, once.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), draw(doc_id, text, seed).alias("draw"))
    rows = materialise(rows, "sizes")
    targets = source_targets(rows, weights, most).withColumnRenamed("source", "of_source")
    joined = rows.join(targets, rows["source"].eqNullSafe(targets["of_source"]))
    return joined.select("doc_id", "source", "size", "source_size", "target", copies("draw").alias("copies"))


def copies(drawn: str) -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return F.floor(rate) + F.when(F.col(drawn) < rate - F.floor(rate), 1).otherwise(0)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The documents of the mix, each row as often as it is taken, with the columns of ``docs``."""
    sizes = materialise(docs.select(F.col(source).alias("source"), word_count(text).alias("size")), "sizes")
    targets = source_targets(sizes, weights, most).select(F.col("source").alias("of_source"), F.struct("source_size", "target").alias("goal"))
    row, drawn = "row", "drawn"
    packed = docs.select(F.struct("*").alias(row), F.col(source).alias("its_source"), draw(doc_id, text, seed).alias(drawn))
    joined = packed.join(targets, F.col("its_source").eqNullSafe(F.col("of_source"))).select(row, drawn, "goal.*")
    taken = joined.where(copies(drawn) > 0).select(row, F.explode(F.sequence(F.lit(1), copies(drawn).cast("int"))).alias("copy"))
    return taken.select([F.col(row)[c].alias(c) for c in docs.columns])


SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw
  FROM documents
), sources AS (
  SELECT *, 3 * source_size AS ceiling, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source)
), filled AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(ceiling) OVER (ORDER BY ceiling / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY ceiling / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM sources
), level AS (
  SELECT rest::BIGINT AS rest, share::BIGINT AS share FROM filled WHERE ceiling * share >= weight * rest ORDER BY ceiling / weight, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, least(ceiling::DOUBLE, (weight * rest)::DOUBLE / share) AS target,
         CASE WHEN source_size > 0 THEN least(ceiling::DOUBLE, (weight * rest)::DOUBLE / share) / source_size ELSE 0 END AS rate
  FROM sources, level
)
SELECT s.doc_id, s.size, t.source_size, t.target,
       s.size * (floor(t.rate)::BIGINT + CASE WHEN s.draw < t.rate - floor(t.rate) THEN 1 ELSE 0 END) AS taken
FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
"""
