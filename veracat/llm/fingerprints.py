"""Document fingerprints: bottom-k sketches of shingle hashes, mergeable, for resemblance, containment and counts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh3_64_intdigest

from veracat.llm.common import whole

SHINGLE = 5
#: Hashes that a sketch keeps; the standard error of a resemblance r is sqrt(r * (1 - r) / K), 0.044 at most.
K = 128
#: A hash is a number below 2 ** BITS, written as 12 hexadecimal digits: two texts of a million shingles each are told
#: apart but for one shingle in 10 ** 8.
BITS = 48
DIGITS = BITS // 4


class Hasher:
    """Bottom-k sketches of texts. A word is what white space of ASCII sets apart; a text of fewer words than a
    shingle, but not none, is one shingle."""

    def __init__(self, k: int = K, shingle: int = SHINGLE):
        self.k, self.shingle = k, shingle

    def words(self, text: bytes) -> np.ndarray:
        """A 64-bit hash of each word, in order."""
        words = text.split()
        return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))

    def sketch(self, hashes: np.ndarray) -> np.ndarray:
        """The k smallest different shingle hashes, in order, given the hashes of a text's words."""
        if not len(hashes):
            return hashes
        width = min(self.shingle, len(hashes))
        out = np.zeros(len(hashes) - width + 1, np.uint64)
        for i in range(width):
            out = (out ^ hashes[i:len(hashes) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return bottom(out >> np.uint64(64 - BITS), self.k)

    def of(self, text: bytes) -> np.ndarray:
        return self.sketch(self.words(text))


def bottom(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest different values, in order."""
    if len(hashes) > 4 * k:
        # Copies of one value may fill the smallest 2 k; then all are looked at.
        least = np.unique(np.partition(hashes, 2 * k)[:2 * k])
        if len(least) >= k:
            return least[:k]
    return np.unique(hashes)[:k]


def written(sketch: np.ndarray) -> str:
    """A sketch as text: its hashes in order, 12 hexadecimal digits each."""
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8:].tobytes().hex()


def resemblance_of(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """The share of the k smallest hashes of both that are in each; 1 for two sketches without hashes."""
    both = np.union1d(a, b)[:k]
    return 1.0 if not len(both) else float(np.count_nonzero(np.isin(both, a) & np.isin(both, b)) / len(both))


def sketches(docs: DataFrame, text: str, name: str = "fingerprint", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Every row with the sketch of its whole text as a further column, as text. Rows keep their own columns, those
    under other names included; a column of the sketch's name is replaced.

    A NULL text is the empty one; without words the sketch is the empty text. Equal texts have equal sketches, so
    repeated rows have too. An empty table gives no rows.
    """

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher(k, shingle)
        for batch in texts:
            yield pa.array([written(hasher.of((t or "").encode("utf-8", "replace"))) for t in batch.to_pylist()], pa.string())

    made = F.arrow_udf(run, "string")
    return docs.withColumn(name, made(whole(text)))


def hashes(fingerprint: str | Column) -> Column:
    """The hashes of a written sketch, in order, as an array."""
    f = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    n = (F.length(f) / DIGITS).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.conv(F.substr(f, i * DIGITS + 1, F.lit(DIGITS)), 16, 10).cast("bigint"))


def merged(parts: DataFrame, keys: Sequence[str], fingerprint: str = "fingerprint", k: int = K) -> DataFrame:
    """One sketch for each key, of the shingles of all its parts together, as if they had been sketched at once;
    shingles never cross from one part to another.

    Hashes are rows here: equal ones meet first, and of each key the k smallest stay, in every task before the
    shuffle as well, so a key of very many parts is never gathered. NULL keys are one key; a key whose parts have no
    hash has the empty sketch; an empty table gives no rows.
    """
    f = F.coalesce(F.col(fingerprint), F.lit(""))
    at = F.when(F.length(f) > 0, F.sequence(F.lit(0), (F.length(f) / DIGITS).cast("int") - 1))
    single = parts.select(*keys, F.explode_outer(F.transform(at, lambda i: F.substr(f, i * DIGITS + 1, F.lit(DIGITS)))).alias("_hash")).distinct()
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_hash").asc_nulls_last()))
    least = single.withColumn("_nth", nth).filter(F.col("_nth") <= k)
    # k texts of one length at most, so their order as texts is that as numbers.
    return least.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("_hash")), "").alias(fingerprint))


def resemblance(a: str | Column, b: str | Column, k: int = K) -> Column:
    """The estimated share of common shingles among all of both; 1 for two sketches without hashes."""
    x, y = hashes(a), hashes(b)
    both = F.slice(F.array_sort(F.array_union(x, y)), 1, k)
    common = F.size(F.array_intersect(both, F.array_intersect(x, y)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def distinct_shingles(fingerprint: str | Column, k: int = K) -> Column:
    """The number of different shingles: exact below k, estimated from the kth smallest hash beyond."""
    h = hashes(fingerprint)
    return F.when(F.size(h) < k, F.size(h).cast("double")).otherwise((k - 1) * F.lit(float(2 ** BITS)) / (F.element_at(h, -1) + 1))


def containment(a: str | Column, b: str | Column, k: int = K) -> Column:
    """The estimated share of a's shingles that b has: what both share of all, times all, over a's. Without shingles
    in a it is 1."""
    x, y = hashes(a), hashes(b)
    together = F.array_sort(F.array_union(x, y))
    # The smallest k of both are the sketch of their union.
    union = F.when(F.size(together) < k, F.size(together).cast("double")).otherwise((k - 1) * F.lit(float(2 ** BITS)) / (F.get(together, F.lit(k - 1)) + 1))
    return F.when(F.size(x) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k)))


def _first_of_ranges(docs: DataFrame, doc_id: str, text: str) -> list[tuple[int | None, int]]:
    """The first row, as (id, hash of the text), of each of as many ranges as a shuffle has partitions: two numbers a
    range come to the driver, whatever the rows hold."""
    light = docs.select(F.col(doc_id).cast("bigint").alias("d"), F.xxhash64(whole(text)).alias("h"))
    dealt = light.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("d").desc_nulls_last(), F.col("h").desc())
    firsts = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.max(F.struct(F.col("d").isNotNull().alias("known"), "d", "h")).alias("first"))
    return [(r["first"]["d"], r["first"]["h"]) for r in firsts.orderBy("p").collect()]


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Each document beside its edited text and the next document, by their fingerprints.

    The next document is the one of the next smaller id; after the last comes the first. The last floor(n / 2) code
    points of a text are replaced by the first as many (or all) of the next. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    Ids are whole numbers. NULL texts are empty; ids that are NULL come last; rows of one id follow by a hash of their text, so repeated
    rows follow each other. A table of one row is its own next. An empty table gives no rows. Other columns are not
    returned, whatever their names.

    Texts are shuffled once, by ranges of ids; the first row of a range goes also to the range before. A task reads
    its range in order and holds one batch of texts at a time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    firsts = _first_of_ranges(rows, "doc_id", "text")
    out = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if not firsts:
        return spark.createDataFrame([], out)
    n = len(firsts)
    # Known ids go from large to small, NULL after them; a range begins at its first row.
    key = F.struct(F.col("doc_id").isNull(), -F.col("doc_id").cast("decimal(20,0)"), -F.xxhash64("text").cast("decimal(20,0)"))

    def key_of(d: int | None, h: int) -> Column:
        return F.struct(F.lit(d is None), F.lit(None if d is None else Decimal(-d)).cast("decimal(20,0)"), F.lit(Decimal(-h)).cast("decimal(20,0)"))

    starts = F.array(*[key_of(d, h) for d, h in firsts])
    steps = F.sequence(F.lit(1), F.lit(max(1, n.bit_length())))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        begun = F.get(starts, mid) <= key
        return F.when(acc["low"] >= acc["high"], acc).otherwise(
            F.struct(F.when(begun, mid + 1).otherwise(acc["low"]).alias("low"), F.when(begun, acc["high"]).otherwise(mid).alias("high")))

    ranges = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(n).alias("high")), halve, lambda acc: acc["low"] - 1)
    placed = rows.withColumn("range", ranges)
    # One text a range at most, so this side has a bound: the number of partitions.
    first_keys = spark.createDataFrame([(i, d, h) for i, (d, h) in enumerate(firsts)], "i int, d bigint, h bigint")
    is_first = F.col("doc_id").cast("bigint").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("h"))
    heads = rows.join(F.broadcast(first_keys), is_first).dropDuplicates(["i"]).select("doc_id", "text", F.pmod(F.col("i") - 1, F.lit(n)).alias("range"))
    sent = placed.withColumn("guest", F.lit(False)).unionByName(heads.withColumn("guest", F.lit(True)))
    order = [F.col("guest"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()]
    dealt = sent.repartitionById(n, F.col("range")).sortWithinPartitions("range", *order)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(k, shingle)
        made: list[tuple] = []
        last = None

        def pair(row: tuple, following: tuple) -> tuple:
            (d, t, _, own), (_, u, _, other) = row, following
            cut = len(t) // 2
            changed = (t[:len(t) - cut] + u[:cut]).encode("utf-8", "replace")
            near = hasher.of(changed)
            return d, len(t), hashlib.sha256(changed).hexdigest(), written(own), written(near), resemblance_of(own, near, k), resemblance_of(own, other, k)

        for batch in batches:
            for d, t, r, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "range", "guest"))):
                row = (d, t, r, hasher.of(t.encode("utf-8", "replace")))
                if last is not None and last[2] == r:
                    made.append(pair(last, row))
                last = None if guest else row
            yield pa.RecordBatch.from_arrays([pa.array(c, kind_) for c, kind_ in zip(zip(*made) if made else [[]] * 7, types)], names)
            made = []

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [to_arrow_type(rows.schema["doc_id"].dataType), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return dealt.select("doc_id", "text", "range", "guest").mapInArrow(measure, out)

