"""Exact Jaccard inside groups of sets, in blocks: each pair is weighed once, in the first group the two share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members of a group that meet in one task; a larger group becomes blocks, and each two blocks meet.
BLOCK = 256


def blocks(members: DataFrame, size: str, by: str, block: int = BLOCK) -> DataFrame:
    """Adds ``left`` and ``right``, the block pairs of its group that a member takes part in, and ``own``, its
    block. A group of n members in b blocks gives n * b rows, never n * n."""
    n = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(by), n).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return dealt.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).drop("other")


def in_groups(df: DataFrame, keys: list[str | Column], work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, batch: int = 1 << 16) -> DataFrame:
    """Run ``work`` on every group of rows with equal ``keys``: dealt and sorted by Spark, streamed through tasks."""
    names = [k for k in keys if isinstance(k, str)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            changed = np.zeros(b.num_rows, bool)
            for k in names:
                column = np.asarray(b.column(k))
                changed[1:] |= column[1:] != column[:-1]
                if waiting:
                    changed[0] |= waiting[-1].column(k)[-1].as_py() != column[0]
            starts = [*np.flatnonzero(changed), b.num_rows]
            if starts[0] > 0:
                waiting.append(b.slice(0, int(starts[0])))
            for s, e in zip(starts, starts[1:]):
                if waiting:
                    yield from work(pa.Table.from_batches(waiting))
                waiting = [b.slice(int(s), int(e - s))]
        if waiting:
            yield from work(pa.Table.from_batches(waiting))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def owned_pairs(groups: list[np.ndarray], here: int, own: np.ndarray, cross: bool) -> np.ndarray:
    """Which pairs i < j (or across blocks) share no group smaller than ``here``, so that this one weighs them."""
    n = len(groups)
    smaller = [g[g < here] for g in groups]
    pairs = np.triu(np.ones((n, n), bool), 1)
    if cross:
        pairs &= own[:, None] != own[None, :]
    values = np.unique(np.concatenate(smaller)) if n else np.zeros(0, np.int64)
    if len(values):
        held = np.zeros((n, len(values)), np.float32)
        for i, g in enumerate(smaller):
            held[i, np.searchsorted(values, g)] = 1
        pairs &= (held @ held.T) == 0
    return pairs


def intersections(sets: list[np.ndarray], wanted: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of the wanted pairs of sorted sets; a few pairs one by one, many as products
    of 0/1 matrices over slices of the values."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    at = np.argwhere(wanted)
    if len(at) <= 4 * n:
        for i, j in at:
            out[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    values = np.concatenate(sets)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    found, where, counts = np.unique(values, return_inverse=True, return_counts=True)
    shared = counts[where] > 1
    where, of = where[shared], of[shared]
    order = np.argsort(where, kind="stable")
    where, of = where[order], of[order]
    edges = np.flatnonzero(np.diff(where, prepend=-1))
    rank = np.repeat(np.arange(len(edges)), np.diff([*edges, len(where)]))
    for a in range(0, len(edges), width):
        part = slice(edges[a], edges[a + width] if a + width < len(edges) else len(where))
        m = np.zeros((n, width), np.float32)
        m[of[part], rank[part] - a] = 1
        out += m @ m.T
    return out


def roots(pairs: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each index is linked to, over the given pairs."""
    up = np.arange(n)

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in pairs:
        a, b = top(i), top(j)
        up[max(a, b)] = min(a, b)
    return np.asarray([top(i) for i in range(n)])


def weigh(members: DataFrame, threshold: float) -> DataFrame:
    """From members (grp, left, right, own, id, weight, groups, tokens) to (id, root, links): the weight of the
    other members with a Jaccard similarity of ``threshold`` or more, counted in the first group that the two
    share, and a smaller or equal id that the member is linked to there. ``tokens`` are sorted 64-bit hashes.

    A task holds two blocks of sets. No pair becomes a row.
    """

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = np.asarray(group.column("id").to_pylist(), dtype=object)
        _, first = np.unique(ids.astype(str), return_index=True)  # sorted by id, repeated rows once
        if len(first) < 2:
            return
        take = lambda c: [group.column(c)[int(i)].as_py() for i in first]
        ids, own, weight = ids[first], np.asarray(take("own")), np.asarray(take("weight"), np.float64)
        groups = [np.asarray(g, np.int64) for g in take("groups")]
        sets = [np.frombuffer(t, "<i8") for t in take("tokens")]
        cross = group.column("left")[0].as_py() != group.column("right")[0].as_py()
        pairs = owned_pairs(groups, group.column("grp")[0].as_py(), own, cross)
        n = np.asarray([len(s) for s in sets], np.float32)
        pairs &= np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :]) - 1e-6
        if not pairs.any():
            return
        both = intersections(sets, pairs)
        union = n[:, None] + n[None, :] - both
        linked = pairs & (both >= threshold * union - 1e-6 * union)
        if not linked.any():
            return
        links = linked @ weight + linked.T @ weight
        root = roots(np.argwhere(linked), len(ids))
        keep = np.flatnonzero(links > 0)
        yield pa.RecordBatch.from_arrays([pa.array(ids[keep].tolist(), pa.string()), pa.array(ids[root[keep]].tolist(), pa.string()), pa.array(links[keep].astype(np.int64))], ["id", "root", "links"])

    return in_groups(members, ["grp", "left", "right"], work, "id string, root string, links bigint")
