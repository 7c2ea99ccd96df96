"""Language identification by rank-order profiles of the most frequent letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from veracat.llm.common import free, without

RANKS = 400
LONGEST = 3
#: Labelled rows that a language's profile is fitted on, at most.
FIT_ROWS = 3000
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The 1- to 3-grams of letters and word edges in a whole text, as numbers, and how often each occurs.

    A word edge is one 0; a gram never spans two words. Empty for a text without letters.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    points = np.where(_letters()[points], points, 0)
    points = np.concatenate([[0], points, [0]])
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    points = points[keep]
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = (points[:-1] << 21) | points[1:]
    three = (two[:-1] << 21) | points[2:]
    # A code point needs 21 bits; three fit a 63-bit number.
    return np.unique(np.concatenate([points[points != 0], two, three[points[1:-1] != 0]]), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """The most frequent grams, most frequent first, ties by number."""
    return grams[np.argsort(-counts, kind="stable")[:ranks]]


def fit(rows: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", ranks: int = RANKS, fit_rows: int = FIT_ROWS) -> dict[str, list[int]]:
    """Profiles from labelled rows: language to its ``ranks`` most frequent n-grams, most frequent first.

    At most ``fit_rows`` rows of a language are used, those with the smallest hash of their id and text, so
    the choice does not depend on the order of rows. The counts are made in tasks; what comes to the driver is
    ``ranks`` numbers for a language. Rows with a NULL language or text teach nothing.
    """
    labelled = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("h"))
    # Rank by part first: a part sorts a small share of a hot language, and the tops of the parts meet after.
    part = Window.partitionBy("lang", F.pmod("h", F.lit(64))).orderBy("h")
    tops = labelled.select("lang", "h").withColumn("r", F.row_number().over(part)).where(F.col("r") <= fit_rows).drop("r")
    chosen = tops.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= fit_rows).groupBy("lang").agg(F.max("h").alias("most"))
    sample = labelled.join(F.broadcast(chosen), "lang")  # one row for a language
    sample = sample.where(F.col("h") <= F.col("most")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list] = {}
            for name, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by.setdefault(name, []).append(gram_counts(t))
            for name, found in by.items():
                grams, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                counts = np.bincount(where, np.concatenate([n for _, n in found])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams, pa.int64()), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    counts = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= ranks)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def nearest(text: str, names: list[str], grams: np.ndarray, places: np.ndarray, ranks: int) -> tuple[str, float]:
    """The language with the smallest out-of-place distance, ties to the first name, and 1 less the distance as a
    share of its largest value. ``places[i, j]`` is the rank of gram j in language i, ``ranks`` if it has none."""
    own = ranked(*gram_counts(text), ranks)
    if not len(own) or not names:
        return UNKNOWN, 0.0
    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
    known = grams[at] == own
    theirs = np.where(known, places[:, at], ranks)
    # A gram that a profile lacks is out of place by the most possible.
    far = np.where(theirs == ranks, ranks, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
    best = int(np.argmin(far))
    return names[best], float(1 - far[best] / (ranks * len(own)))


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", ranks: int = RANKS, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the columns ``pred`` and ``score`` (columns of those names are replaced).

    The whole text is counted. NULL texts and texts without a letter are ``und`` with score 0. Rows are
    independent; the profiles that go to every task are ``ranks`` numbers for a language.
    """
    docs = without(docs, pred, score)
    schema = StructType([*docs.schema.fields, StructField(pred, StringType()), StructField(score, DoubleType())])
    names = sorted(profiles)
    grams = np.unique(np.asarray([g for n in names for g in profiles[n]], np.int64))
    places = np.full((len(names), len(grams)), ranks)
    for i, n in enumerate(names):
        places[i, np.searchsorted(grams, profiles[n])] = np.arange(len(profiles[n]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(t or "", names, grams, places, ranks) for t in batch.column(text).to_pylist()]
            yield batch.append_column(pred, pa.array([f[0] for f in found], pa.string())).append_column(score, pa.array([f[1] for f in found], pa.float64()))

    return docs.mapInArrow(predict, schema)


def least_scores(rows: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", share: float = 0.7) -> dict[str, float]:
    """Language to ``share`` of the score that all but a hundredth of its own held-out rows reach.

    One row in four is held out, by its id, and scored by profiles of the others. The share leaves room for texts
    that are shorter or odder than those. A language of which no row was held out and told right has no score.
    """
    labelled = rows.where(F.col(lang).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scored = identify(labelled.where(held), fit(labelled.where(~held))).where(F.col("lang") == F.col("lang_pred"))
    low = scored.groupBy("lang").agg(F.percentile_approx("score", 0.01, 1000).alias("low"))
    return {r["lang"]: share * r["low"] for r in low.collect()}


def keep_identified(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", least: float = 0.0, by_lang: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score above ``least``, or above that of the language in
    ``by_lang`` where it has one, with the columns of ``docs``."""
    pred, score = free(docs, "lang_pred", "score")
    scored = identify(docs, profiles, text, pred=pred, score=score)
    bound = F.lit(least)
    for name, own in sorted((by_lang or {}).items()):
        bound = F.when(F.col(pred) == name, F.lit(own)).otherwise(bound)
    return scored.where((F.col(pred) != UNKNOWN) & (F.col(score) > bound)).drop(pred, score)
