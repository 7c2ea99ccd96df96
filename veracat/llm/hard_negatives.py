"""Hard negatives by a multiway hyperplane tree whose split points keep distance ranges to their sibling subtrees."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracat.session import materialise

#: Rows that the split points are chosen from, those with the smallest hash of their id; every row is indexed.
SAMPLE = 8192
FANOUT = 8
#: A node with fewer sampled rows is a leaf.
LEAF_SAMPLE = 512
#: Rows and anchors of a leaf that meet in one task, about.
BLOCK, ANCHORS = 16_384, 2_048
#: Rows that a task scores at once.
PIECE = 1_024
#: Slack of a distance, as a part of the longest vector: distances are floats, scores are whole numbers.
SLACK = 1e-6


def quantised(rows: DataFrame, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: those with a label and a vector whose components are all
    finite numbers. A component x becomes floor(scale * x); beyond 64 bits it stays at their limit."""
    x = F.transform(vector, lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & ~odd)
    return kept.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector"))


@dataclass
class Node:
    """Split points, and for each the child behind it: a node or the number of a leaf. ``near`` and ``far`` at (i, j)
    are the smallest and largest distance of split point i to the rows below split point j; a child without rows has
    an empty range."""
    number: int
    points: np.ndarray
    children: list
    near: np.ndarray = field(init=False)
    far: np.ndarray = field(init=False)

    def __post_init__(self):
        self.near = np.full((len(self.points),) * 2, np.inf)
        self.far = np.full((len(self.points),) * 2, -np.inf)


@dataclass
class Tree:
    root: Node | int
    nodes: list[Node]
    leaves: int
    #: Components of the longest vector, and the square of the largest length.
    width: int
    top: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Rows with one more component, so that all have the largest length: then the distance of a row to an anchor,
        whose further component is 0, falls as their inner product rises, and a window of scores is an annulus."""
        rest = np.sqrt(np.maximum(0.0, self.top - (vectors ** 2).sum(axis=1)))
        return np.hstack([vectors, rest[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1) - 2 * a @ b.T))


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(column), width))
    at, values = np.asarray(column.offsets), column.values.to_numpy(zero_copy_only=False)
    for i, (a, b) in enumerate(zip(at, at[1:])):
        out[i, :b - a] = values[a:b]
    return out


def spread_out(points: np.ndarray, n: int) -> np.ndarray:
    """At most n points far from each other: each next one is that farthest from those chosen."""
    chosen = [0]
    least = distances(points, points[:1])[:, 0]
    while len(chosen) < n and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def grown(points: np.ndarray, width: int, top: float, fanout: int = FANOUT, leaf: int = LEAF_SAMPLE) -> Tree:
    """The tree over sampled, lifted vectors without copies."""
    tree = Tree(0, [], 0, width, top)

    def grow(inside: np.ndarray, whole: bool = False) -> Node | int:
        points = spread_out(inside, fanout) if len(inside) >= (2 if whole else leaf) else inside[:0]
        if len(points) < 2:
            tree.leaves += 1
            return tree.leaves - 1
        node = Node(len(tree.nodes), points, [])
        tree.nodes.append(node)
        behind = distances(inside, points).argmin(axis=1)
        node.children = [grow(inside[behind == j]) for j in range(len(points))]
        return node

    tree.root = grow(points, whole=True)
    return tree


def placed(tree: Tree, vectors: np.ndarray, visit: Callable[[Node, np.ndarray, np.ndarray], None] = lambda *_: None) -> np.ndarray:
    """The leaf of each lifted vector: at every node it goes behind its nearest split point. ``visit`` sees the node,
    the distances to its split points and the children taken."""
    out = np.zeros(len(vectors), np.int32)

    def descend(at: Node | int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(at, int):
            out[rows] = at
            return
        d = distances(vectors[rows], at.points)
        behind = d.argmin(axis=1)
        visit(at, d, behind)
        for j, child in enumerate(at.children):
            descend(child, rows[behind == j])

    descend(tree.root, np.arange(len(vectors)))
    return out


def reached(tree: Tree, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, anchors that must look into it), for windows of scores (anchor, window): low to high, none where low is
    above high. A sibling stays for an anchor if, for some window, its range at every split point meets the annulus."""
    square = (anchors ** 2).sum(axis=1)[:, None] + tree.top
    outer, inner = np.sqrt(np.maximum(0.0, square - 2 * low)), np.sqrt(np.maximum(0.0, square - 2 * high))
    slack = SLACK * (1 + np.sqrt(tree.top))
    query = np.hstack([anchors, np.zeros((len(anchors), 1))])
    open_ = low <= high

    def descend(at: Node | int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        if isinstance(at, int):
            yield at, rows
            return
        d = distances(query[rows], at.points)[:, None, :, None]
        far, near = outer[rows][:, :, None, None], inner[rows][:, :, None, None]
        meets = (at.near <= d + far + slack) & (at.far >= np.maximum(d - far, near - d) - slack)
        stays = (meets.all(axis=2) & open_[rows][:, :, None]).any(axis=1)
        for j, child in enumerate(at.children):
            if stays[:, j].any():
                yield from descend(child, rows[stays[:, j]])

    if len(anchors):
        yield from descend(tree.root, np.arange(len(anchors)))


ROW = "uid bigint, vec_id bigint, label bigint, vector array<bigint>"


def index(rows: DataFrame, sample: int = SAMPLE, fanout: int = FANOUT, leaf: int = LEAF_SAMPLE) -> tuple[Tree, DataFrame]:
    """The tree and every row with its leaf: (uid, vec_id, label, vector, leaf). ``uid`` tells repeated rows apart.

    To the driver come the sampled rows, and for each node the ranges between its children, both bounded by the
    parameters; they are kept by every task.
    """
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, top = 0, 0.0
        for batch in batches:
            v = batch.column("vector")
            width = max(width, int(np.diff(np.asarray(v.offsets)).max(initial=0)))
            top = max(top, float((padded(v, width) ** 2).sum(axis=1).max(initial=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array([width]), pa.array([top])], ["width", "top"])

    size = rows.select("vector").mapInArrow(measure, "width bigint, top double").agg(F.max("width"), F.max("top")).first()
    width, top = size[0] or 0, size[1] or 0.0
    chosen = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(sample).select("vector").toArrow().column("vector").combine_chunks()
    points = np.unique(padded(chosen, width), axis=0) if len(chosen) else np.zeros((0, width))
    tree = Tree(0, [], 1, width, top)
    tree = grown(tree.lifted(points), width, top, fanout, leaf)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = placed(tree, tree.lifted(padded(batch.column("vector"), width)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], [*batch.schema.names, "leaf"])

    numbered = rows.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("bigint").alias("vec_id"), "label", "vector")
    indexed = materialise(numbered.mapInArrow(assign, f"{ROW}, leaf int"), "indexed")

    def extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], tuple[float, float]] = {}

        def visit(node: Node, d: np.ndarray, behind: np.ndarray) -> None:
            for j in np.unique(behind):
                inside = d[behind == j]
                for i, (a, b) in enumerate(zip(inside.min(axis=0), inside.max(axis=0))):
                    old = found.get((node.number, i, int(j)), (np.inf, -np.inf))
                    found[node.number, i, int(j)] = (min(old[0], a), max(old[1], b))

        for batch in batches:
            placed(tree, tree.lifted(padded(batch.column("vector"), width)), visit)
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([k[c] for k in keys], pa.int32()) for c in range(3)), *(pa.array([found[k][c] for k in keys], pa.float64()) for c in range(2))],
            ["node", "i", "j", "near", "far"],
        )

    ranges = indexed.select("vector").mapInArrow(extents, "node int, i int, j int, near double, far double")
    for r in ranges.groupBy("node", "i", "j").agg(F.min("near").alias("near"), F.max("far").alias("far")).collect():
        node = tree.nodes[r["node"]]
        node.near[r["i"], r["j"]], node.far[r["i"], r["j"]] = r["near"], r["far"]
    return tree, indexed


def probes(tree: Tree, anchors: DataFrame, own: bool = True) -> DataFrame:
    """A row for each anchor and leaf that its windows reach: the columns of ``anchors`` with ``leaf`` set. ``anchors``
    has ``low`` and ``high``, arrays of scores; NULL in ``low`` is no lower bound. Its own leaf goes where not ``own``."""
    names = anchors.columns

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high, home = batch.column("low").to_pylist(), batch.column("high").to_pylist(), np.asarray(batch.column("leaf"))
            n = max([1, *map(len, low)])
            lows, highs = np.full((len(low), n), np.inf), np.full((len(low), n), -np.inf)
            for i, (a, b) in enumerate(zip(low, high)):
                lows[i, :len(a)] = [-np.inf if x is None else x for x in a]
                highs[i, :len(b)] = [np.inf if x is None else x for x in b]
            for leaf, rows in reached(tree, padded(batch.column("vector"), tree.width), lows, highs):
                rows = rows if own else rows[home[rows] != leaf]
                if len(rows):
                    some = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), leaf, np.int32)) if c == "leaf" else some.column(c) for c in names], names)

    return anchors.mapInArrow(reach, anchors.schema)


def scored(indexed: DataFrame, probing: DataFrame, pick: Callable, out: str, arrow: pa.Schema, width: int, exact: bool) -> DataFrame:
    """What ``pick`` finds for anchors in the leaves they look into. A leaf's rows are cut into blocks and its anchors
    into groups, all of about a fixed size, and each block meets each group once, in one task. A task keeps a group of
    anchors and a piece of a block. Without probes there is no row."""
    spark = indexed.sparkSession
    rows = indexed.groupBy("leaf").agg(F.count("*").alias("n_rows"))
    sizes = probing.groupBy("leaf").agg(F.count("*").alias("n_anchors")).join(rows, "leaf")
    # One row a leaf, and their number is bounded by the sample.
    sizes = F.broadcast(sizes.select("leaf", F.ceil(F.col("n_rows") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("n_anchors") / ANCHORS).cast("int").alias("groups")))

    def dealt(of: str) -> Column:
        return F.pmod(F.xxhash64("uid"), F.col(of)).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    asked = probing.join(sizes, "leaf").select("uid", "vec_id", "label", "vector", "leaf", "wanted", every("blocks").alias("block"), dealt("groups").alias("part"), F.lit(0).alias("kind"))
    offered = indexed.join(sizes, "leaf").select("uid", "vec_id", "label", "vector", "leaf", F.lit(None).cast("array<bigint>").alias("wanted"), dealt("blocks").alias("block"), every("groups").alias("part"), F.lit(1).alias("kind"))
    key = ["leaf", "block", "part"]
    # The work of a key is its pairs, not its bytes: the number of tasks is named, so that it is not merged by size.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = asked.unionByName(offered).repartition(n, *key).sortWithinPartitions(*key, "kind")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs() -> Iterator[tuple[tuple, pa.RecordBatch]]:
            for batch in batches:
                marks = list(zip(*(batch.column(c).to_pylist() for c in [*key, "kind"])))
                at = 0
                for mark, group in groupby(marks):
                    n = sum(1 for _ in group)
                    yield mark, batch.slice(at, n)
                    at += n

        for _, group in groupby(runs(), lambda r: r[0][:3]):
            anchors: list[pa.RecordBatch] = []
            waiting: list[pa.RecordBatch] = []
            for mark, batch in group:
                (waiting if mark[3] else anchors).append(batch)
                if sum(b.num_rows for b in waiting) >= PIECE:
                    yield from found(anchors, waiting)
                    waiting = []
            if waiting:
                yield from found(anchors, waiting)

    def found(anchors: list[pa.RecordBatch], waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if anchors:
            a, b = (pa.Table.from_batches(x).combine_chunks() for x in (anchors, waiting))
            yield from pa.Table.from_pylist(pick(Side(a, width, exact), Side(b, width, exact)), arrow).to_batches()

    return together.mapInArrow(meet, out)


class Side:
    """Rows as arrays, in the order of their ids, NULL last, so that a stable sort by score breaks ties as asked."""

    def __init__(self, table: pa.Table, width: int, exact: bool):
        ids = table.column("vec_id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        table = table.take(pa.array(order)).combine_chunks()
        self.ids = [ids[i] for i in order]
        self.uid, self.label = (table.column(c).to_numpy() for c in ("uid", "label"))
        vector = table.column("vector").combine_chunks()
        vector = vector.chunk(0) if isinstance(vector, pa.ChunkedArray) else vector
        self.vectors = padded(vector, width)
        if not exact:  # beyond 2 ** 53 scores are summed as whole numbers of any size
            self.vectors = np.array([v + [0] * (width - len(v)) for v in vector.to_pylist()], dtype=object).reshape(len(ids), width)
        self.wanted = table.column("wanted").to_pylist()

    def __len__(self) -> int:
        return len(self.ids)


def best_first(scores: np.ndarray) -> np.ndarray:
    return np.argsort(-scores, axis=1, kind="stable")


def alike(n: int) -> Callable[[Side, Side], list[dict]]:
    """For each anchor its n best other rows of its label."""
    def pick(a: Side, b: Side) -> list[dict]:
        out = []
        for label in np.unique(a.label):
            mine, theirs = np.flatnonzero(a.label == label), np.flatnonzero(b.label == label)
            if not len(theirs):
                continue
            scores = a.vectors[mine] @ b.vectors[theirs].T
            for i, row, order in zip(mine, scores, best_first(scores)[:, :n + 1]):
                others = [k for k in order if b.uid[theirs[k]] != a.uid[i]][:n]
                out += [{"uid": int(a.uid[i]), "vec_id": a.ids[i], "other": b.ids[theirs[k]], "other_uid": int(b.uid[theirs[k]]), "score": int(row[k])} for k in others]
        return out

    return pick


def unlike(n: int, low: int, high: int) -> Callable[[Side, Side], list[dict]]:
    """For each anchor and each of its wanted scores s, its n best rows of other labels with a score from low to high
    per cent of s."""
    def pick(a: Side, b: Side) -> list[dict]:
        out = []
        for label in np.unique(a.label):
            mine, theirs = np.flatnonzero(a.label == label), np.flatnonzero(b.label != label)
            if not len(theirs):
                continue
            scores = a.vectors[mine] @ b.vectors[theirs].T
            order = best_first(scores)
            for i, row, ks in zip(mine, scores, order):
                falling = 100 * row[ks]
                for nth, s in enumerate(a.wanted[i]):
                    begin = int(np.searchsorted(-falling, -high * s, "left"))
                    for k, hundred in zip(ks[begin:begin + n], falling[begin:begin + n]):
                        if hundred >= low * s:
                            out.append({"uid": int(a.uid[i]), "nth": nth, "other": b.ids[theirs[k]], "other_uid": int(b.uid[theirs[k]]), "score": int(row[k])})
        return out

    return pick


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, sample: int = SAMPLE, fanout: int = FANOUT, leaf: int = LEAF_SAMPLE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its
    ``positives`` best other rows of its label, the ``negatives`` best rows of other labels whose score lies between
    ``low`` and ``high`` per cent of the positive's. Scores are inner products of whole numbers; higher ones come
    first, ties by smaller id, NULL ids last.

    ``rows`` is (vec_id, label, vector) as ``quantised`` gives it; ``is_anchor`` is a condition over them. Repeated rows
    are rows: a copy of an anchor is another row, and an anchor itself. Shorter vectors end in zeros, an empty one is
    all zeros. An anchor without positives, or without rows in a window, gives no row, as does an empty table. Scores
    beyond 64 bits cannot be returned and raise an error.

    Every anchor looks into its own leaf first; what it finds there bounds its first window from below, and other
    leaves are visited only where the ranges of their split points meet the annulus of a window. Leaves are searched
    row by row, so the result is exact.
    """
    tree, indexed = index(rows, sample, fanout, leaf)
    exact = tree.top * 100 < 2 ** 53
    no_score = F.lit(None).cast("bigint")
    anchors = indexed.where(is_anchor).withColumns({"low": F.array(no_score), "high": F.array(no_score), "wanted": F.array().cast("array<bigint>")})
    found = [("other", pa.int64()), ("other_uid", pa.int64()), ("score", pa.int64())]
    of_anchor = pa.schema([("uid", pa.int64()), ("vec_id", pa.int64()), *found])
    best = [F.col("score").desc(), F.col("other").asc_nulls_last(), F.col("other_uid")]

    def first(df: DataFrame, keys: list[str], n: int) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= n)

    def same(probing: DataFrame) -> DataFrame:
        return scored(indexed, probing, alike(positives), "uid bigint, vec_id bigint, other bigint, other_uid bigint, score bigint", of_anchor, tree.width, exact)

    at_home = materialise(first(same(anchors), ["uid"], positives), "at_home")
    least = at_home.where(F.col("rank") == positives).select("uid", F.array("score").alias("bound"))
    bounded = anchors.join(least, "uid", "left").withColumn("low", F.coalesce("bound", "low")).select(anchors.columns)
    abroad = same(probes(tree, bounded, own=False))
    chosen = materialise(first(at_home.drop("rank").unionByName(abroad), ["uid"], positives), "positives")
    # At most ``positives`` scores an anchor.
    wanted = chosen.groupBy("uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
    lows = F.transform("wanted", lambda s: F.ceil(s * low / 100).cast("bigint"))
    highs = F.transform("wanted", lambda s: F.floor(s * high / 100).cast("bigint"))
    windows = anchors.drop("wanted", "low", "high").join(wanted, "uid").withColumnRenamed("scores", "wanted").withColumns({"low": lows, "high": highs})
    of_window = pa.schema([("uid", pa.int64()), ("nth", pa.int32()), *found])
    rest = scored(indexed, probes(tree, windows.select(anchors.columns)), unlike(negatives, low, high), "uid bigint, nth int, other bigint, other_uid bigint, score bigint", of_window, tree.width, exact)
    ranked = first(rest, ["uid", "nth"], negatives).select("uid", "nth", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    named = chosen.select("uid", F.col("vec_id").alias("anchor_id"), (F.col("rank") - 1).alias("nth"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return named.join(ranked, ["uid", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """WITH v AS (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.uid, a.vec_id AS anchor_id, b.uid AS other_uid, b.vec_id AS other, a.label = b.label AS alike, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.uid <> b.uid),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, other NULLS LAST, other_uid) AS nth FROM s WHERE alike) WHERE nth <= 5),
n AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.uid, p.nth ORDER BY s.score DESC, s.other NULLS LAST, s.other_uid) AS rank
 FROM p JOIN s ON s.uid = p.uid AND NOT s.alike AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, other AS positive_id, CAST(rank AS INTEGER) AS rank, negative_id, score AS positive_score, negative_score FROM n WHERE rank <= 5"""
