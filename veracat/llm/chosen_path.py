"""N-gram Jaccard join by chosen paths: sets split on sampled shared tokens until buckets are small."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracat.llm.common import components, light, whole, words
from veracat.llm.verify import blocks, in_groups, owned_pairs, weigh
from veracat.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Coordinates of a set's sample: the smallest token under each of so many orders.
SAMPLE = 64
SMALL = 64
DEEPEST = 5
#: A bucket that keeps this share of its parent holds copies that no token tells apart.
ALIKE = 0.7


def runs(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEEPEST) -> int:
    """Runs until a pair at the threshold meets in a leaf of the deepest level with the target probability.

    A root splits on one coordinate; below it a bucket splits on one, or with a chance of one in four on two.
    A pair goes on together at a coordinate with a probability of its similarity.
    """
    meet = 1.0
    for _ in range(depth - 1):
        one, two = threshold * meet, 1 - (1 - threshold * meet) ** 2
        meet = 0.75 * one + 0.25 * two
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold * meet))


def shingle_set(hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the n-word shingles of a text, given its words' hashes; a shorter text is one shingle."""
    h = hashes.astype(np.uint64)
    if not len(h):
        return np.zeros(0, np.int64)
    width = min(n, len(h))
    out = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        out = (out ^ h[k:len(h) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def _orders(sample: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.frombuffer(b"".join(hashlib.blake2b(str(i).encode(), digest_size=16, person=b"order").digest() for i in range(sample)), "<u8")
    return made[0::2] | np.uint64(1), made[1::2]


def sketch(tokens: np.ndarray, sample: int = SAMPLE, step: int = 8192) -> np.ndarray:
    """For each order, 32 bits of the token that comes first in it."""
    a, b = _orders(sample)
    least = np.full(sample, np.iinfo(np.uint64).max, np.uint64)
    t = tokens.view(np.uint64)
    for i in range(0, len(t), step):
        least = np.minimum(least, (t[i:i + step, None] * a + b).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def hashed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, digest, hashes): the id, the md5 of the text and the hash of every word of the whole text."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.md5(whole(text)).alias("digest"), F.transform(words(text), lambda w: F.xxhash64(w)).alias("hashes"))


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    at, values = np.asarray(column.offsets), np.asarray(column.values)
    return (values[a:b] for a, b in zip(at, at[1:]))


def set_id(tokens: np.ndarray) -> str:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest() if len(tokens) else ""


def sketches(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, digest, set_id, n, sample, low) for every row; ``low`` has a byte of each coordinate."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(h, shingle) for h in _lists(batch.column("hashes"))]
            made = [sketch(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array([set_id(s) for s in sets]), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([m.view(np.int32).tolist() for m in made], pa.list_(pa.int32())), pa.array([m.astype(np.uint8).tobytes() for m in made], pa.binary())],
                ["doc_id", "digest", "set_id", "n", "sample", "low"],
            )

    kind = dict(docs.dtypes)[doc_id]
    return hashed(docs, doc_id, text).mapInArrow(measure, f"doc_id {kind}, digest string, set_id string, n bigint, sample array<int>, low binary")


def leaves(sets: DataFrame, n_runs: int, small: int = SMALL, deepest: int = DEEPEST) -> DataFrame:
    """(path, n, set_id): the buckets in which sets are compared, every one with at least two sets.

    A run splits all sets on the sampled token of one coordinate. A bucket of at most ``small`` sets is a leaf,
    as is one that keeps most of its parent, or one of the deepest level, whatever its size; others are split
    on. Only sets in large buckets are looked at again.
    """
    root = F.transform(F.sequence(F.lit(0), F.lit(n_runs - 1)), lambda r: F.xxhash64(r, F.get("sample", r)))
    now = sets.select("set_id", F.explode(root).alias("path"), F.lit(1 << 62).alias("above"))
    found = None
    for depth in range(1, deepest + 1):
        counts = now.groupBy("path").agg(F.count("*").alias("n"), F.max("above").alias("above")).where("n > 1")
        dealt = materialise(now.select("set_id", "path").join(counts, "path").transform(light), "paths")
        leaf = (F.col("n") <= small) | (F.col("n") > ALIKE * F.col("above")) | F.lit(depth == deepest)
        part = dealt.where(leaf).select("path", "n", "set_id")
        found = part if found is None else found.unionByName(part)
        rest = dealt.where(~leaf)
        if depth == deepest or rest.isEmpty():
            return found
        first, second = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(SAMPLE)), F.pmod(F.xxhash64("path", F.lit(2)), F.lit(SAMPLE))
        chosen = F.when((F.pmod(F.xxhash64("path", F.lit(3)), F.lit(4)) == 0) & (first != second), F.array(first, second)).otherwise(F.array(first))
        children = F.transform(chosen, lambda c: F.xxhash64(F.col("path"), c, F.get("sample", c)))
        now = rest.join(sets.select("set_id", "sample"), "set_id").select("set_id", F.explode(children).alias("path"), F.col("n").alias("above"))
    return found


def plausible(members: DataFrame, threshold: float, sample: int = SAMPLE) -> DataFrame:
    """The members of a leaf with a partner there whose sampled similarity is within five standard deviations
    of the threshold, in the first leaf that the two share."""
    least = threshold - 5 * math.sqrt(threshold * (1 - threshold) / sample)

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        if group.num_rows < 2:
            return
        here, left, right = (group.column(c)[0].as_py() for c in ("grp", "left", "right"))
        own = np.asarray(group.column("own"))
        n = np.asarray(group.column("n")).astype(np.float64)
        pairs = owned_pairs([np.asarray(g, np.int64) for g in group.column("groups").to_pylist()], here, own, left != right)
        pairs &= np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :])
        low = np.frombuffer(b"".join(group.column("low").to_pylist()), np.uint8).reshape(len(n), sample)
        for i in np.flatnonzero(pairs.any(axis=1)):
            pairs[i] &= (low[i] == low).mean(axis=1) >= least
        keep = np.flatnonzero(pairs.any(axis=0) | pairs.any(axis=1))
        if len(keep):
            k = len(keep)
            yield pa.RecordBatch.from_arrays(
                [pa.array([here] * k, pa.int64()), pa.array([left] * k, pa.int32()), pa.array([right] * k, pa.int32()), pa.array(own[keep], pa.int32()), group.column("set_id").combine_chunks().take(pa.array(keep))],
                ["grp", "left", "right", "own", "set_id"],
            )

    return in_groups(members, ["grp", "left", "right"], work, "grp bigint, left int, right int, own int, set_id string")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest (md5 of the text), class_id, n_links, root (the class, also where
    no doc_id names it; NULL for a text without words).

    ``n_links`` counts the other rows whose set of word shingles has a Jaccard similarity of ``threshold`` or
    more; rows that are linked, directly or over others, share a class, named by its smallest doc_id. Rows with
    equal sets become one set at once, so copies are counted and never paired. A text without words, a NULL one
    included, has no shingles and no links, and is a class of its own. Repeated rows are copies of each other.
    """
    spark = docs.sparkSession
    measured = materialise(sketches(docs, doc_id, text, shingle), "sketches")
    one = F.min_by(F.struct("doc_id", "digest"), F.struct("doc_id", "digest"))
    held = measured.where("n > 0").groupBy("set_id").agg(F.count("*").alias("copies"), F.min("doc_id").alias("smallest"), one.alias("at"))
    held = materialise(light(held), "held")
    distinct = measured.where("n > 0").select("doc_id", "digest", "set_id", "n", "sample", "low").join(
        held.select(F.col("set_id").alias("of_set"), "at"), (F.col("set_id") == F.col("of_set")) & F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("digest") == F.col("at.digest"))
    ).dropDuplicates(["set_id"])
    distinct = materialise(distinct.select("set_id", "n", "sample", "low"), "sets")

    found = materialise(light(leaves(distinct, runs(threshold, recall))), "leaves")
    mine = found.groupBy("set_id").agg(F.sort_array(F.collect_set("path")).alias("groups"))  # a few leaves a run
    members = found.select("set_id", F.col("path").alias("grp"), F.col("n").alias("size")).join(mine, "set_id").join(distinct.select("set_id", "n", "low"), "set_id")
    flagged = materialise(plausible(blocks(members, "size", "set_id"), threshold), "flagged")

    places = flagged.groupBy("set_id").agg(F.collect_list(F.struct("grp", "left", "right", "own")).alias("places"))
    wanted = places.join(mine, "set_id").join(held.select("set_id", "copies", "at"), "set_id").select(F.col("at.doc_id").alias("of_doc"), F.col("at.digest").alias("of_digest"), "set_id", "copies", "places", "groups")
    named = docs.select(F.col(doc_id).alias("doc_id"), F.md5(whole(text)).alias("digest"), F.col(text).alias("text"))
    texts = named.join(wanted, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("digest") == F.col("of_digest")))
    texts = texts.select("set_id", "copies", "places", "groups", F.transform(words("text"), lambda w: F.xxhash64(w)).alias("hashes"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([shingle_set(h, shingle).astype("<i8").tobytes() for h in _lists(batch.column("hashes"))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("set_id", "copies", "places", "groups")), made], ["set_id", "copies", "places", "groups", "tokens"])

    kind = "array<struct<grp:bigint,left:int,right:int,own:int>>"
    full = texts.mapInArrow(tokens, f"set_id string, copies bigint, places {kind}, groups array<bigint>, tokens binary")
    full = full.select(F.col("set_id").alias("id"), F.col("copies").alias("weight"), "groups", "tokens", F.explode("places").alias("p")).select("id", "weight", "groups", "tokens", "p.*")
    linked = materialise(weigh(full, threshold), "linked")

    links = linked.groupBy("id").agg(F.sum("links").alias("others"))
    rooted = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_set = held.join(links, held["set_id"] == links["id"], "left").join(rooted, held["set_id"] == rooted["node"], "left")
    per_set = materialise(per_set.transform(light).select("set_id", "smallest", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "set_id").alias("root")), "classes")
    named_class = per_set.groupBy("root").agg(F.min("smallest").alias("class_id"))
    classes = per_set.join(named_class, "root").select(F.col("set_id").alias("of_set"), "class_id", "n_links", "root")
    out = measured.select("doc_id", "digest", "set_id").join(classes, F.col("set_id") == F.col("of_set"), "left")
    return out.select("doc_id", "digest", F.when(F.col("set_id") == "", F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), "root")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one of each class: that with the smallest doc_id (NULL last), then digest. Texts
    without words all stay. Of rows repeated in id and text one stays, whichever Spark meets first."""
    classes = join(docs, doc_id, text, **options)
    rows = classes.groupBy("root", "doc_id", "digest").agg(F.count("*").alias("times"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    first = rows.where("root is not null").groupBy("root").agg(F.min_by(F.struct("doc_id", "digest", "times"), order).alias("x")).select("x.*")
    blank = rows.where("root is null").select("doc_id", "digest", F.lit(1).cast("bigint").alias("times"))
    keepers = materialise(first.unionByName(blank).select(F.col("doc_id").alias("of_doc"), F.col("digest").alias("of_digest"), "times"), "keepers")
    packed = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("its_id"), F.md5(whole(text)).alias("its_digest"))

    def kept(some: DataFrame) -> DataFrame:
        return packed.join(some, F.col("its_id").eqNullSafe(F.col("of_doc")) & (F.col("its_digest") == F.col("of_digest")), "left_semi")

    out = kept(keepers.where("times = 1"))
    several = keepers.where("times > 1")
    if not several.isEmpty():
        out = out.unionByName(kept(several).dropDuplicates(["its_id", "its_digest"]))
    return out.select([F.col("row")[c].alias(c) for c in docs.columns])
