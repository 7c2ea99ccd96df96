"""Many pieces in many texts: each text is cut into seeds once, and each piece looks up its rarest one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracat.session import materialise

#: Letters of a seed at most, for a text of few different ones.
WIDEST = 16
#: Pieces of one text that a task looks for; a text with more is cut into seeds by several tasks.
PIECES = 20_000
#: Places of pieces that are looked at together.
PLACES = 1_000_000
#: Letters of a piece that are compared beside those of all other pieces; the rest of a longer one is compared alone.
COLUMNS = 96


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _windows(codes: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Every ``width`` letters in a row as one number, of ``bits`` a letter; 0 stands for none, behind the end."""
    codes = np.append(codes, np.zeros(width - 1, np.uint64))
    out = codes[:len(codes) - width + 1].copy()
    for i in range(1, width):
        out = (out << np.uint64(bits)) | codes[i:len(codes) - width + 1 + i]
    return out


class Seeds:
    """The places of a text by the letters that stand there: as many in a row as a number holds, in order. So a piece of as
    many letters or fewer is a range of them, and a longer one is found by its rarest seed."""

    def __init__(self, text: str):
        self.points = _points(text)
        self.letters = np.unique(self.points)
        self.bits = max(len(self.letters), 1).bit_length()
        self.width = min(63 // self.bits, WIDEST)
        self.windows = _windows(self.codes(self.points), self.width, self.bits)
        self.order = np.argsort(self.windows)
        self.ordered = self.windows[self.order]

    def codes(self, points: np.ndarray) -> np.ndarray:
        """The number of each letter, from 1; 0 for one that the text does not hold."""
        at = np.searchsorted(self.letters, points)
        held = self.letters[np.minimum(at, len(self.letters) - 1)] == points if len(self.letters) else np.zeros(len(points), bool)
        return np.where(held, at + 1, 0).astype(np.uint64)

    def starts(self, letters: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(which piece, place from 0) of every place where a piece starts, overlaps included, piece by piece and in order:
        the pieces lie in ``letters`` one behind the other; an empty one has no place. In parts of bounded size."""
        which = np.flatnonzero(size)
        if not len(which):
            return
        codes = self.codes(letters)
        which = which[(np.minimum.reduceat(codes, begin[which]) > 0) & (size[which] <= len(self.points))]
        seeds = _windows(codes, self.width, self.bits)
        short, long_ = which[size[which] <= self.width], which[size[which] > self.width]
        free = (self.bits * (self.width - size[short])).astype(np.uint64)
        least = (seeds[begin[short]] >> free) << free
        low = np.searchsorted(self.ordered, least)
        yield from self._parts(seeds, begin, size, short, low, np.searchsorted(self.ordered, least + (np.uint64(1) << free)) - low, np.zeros(len(short), np.int64))
        if len(long_):
            counts = size[long_] - self.width + 1
            edges = np.cumsum(counts) - counts
            at_seed = np.repeat(begin[long_] - edges, counts) + np.arange(counts.sum())
            low = np.searchsorted(self.ordered, seeds[at_seed])
            held = np.searchsorted(self.ordered, seeds[at_seed], "right") - low
            rarest = np.minimum.reduceat(held * len(held) + np.arange(len(held)), edges) % len(held)
            yield from self._parts(seeds, begin, size, long_, low[rarest], held[rarest], at_seed[rarest] - begin[long_])

    def _parts(self, seeds: np.ndarray, begin: np.ndarray, size: np.ndarray, which: np.ndarray, low: np.ndarray, hits: np.ndarray, shift: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        some = np.flatnonzero(hits)
        if len(some):
            cuts = np.flatnonzero(np.diff(np.cumsum(hits[some]) // PLACES, prepend=-1))
            for part in np.split(some, cuts[1:]):
                mine = which[part]
                owner, at = self._extended(seeds, begin[mine], size[mine], low[part], hits[part], shift[part])
                key = np.sort(owner * (len(self.points) + 1) + at)
                yield mine[key // (len(self.points) + 1)], key % (len(self.points) + 1)

    def _extended(self, seeds: np.ndarray, begin: np.ndarray, size: np.ndarray, low: np.ndarray, hits: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the seeds at which the whole piece stands."""
        windows, width = self.windows, self.width
        owner = np.repeat(np.arange(len(begin)), hits)
        at = self.order[np.repeat(low - (np.cumsum(hits) - hits), hits) + np.arange(len(owner))] - shift[owner]
        if size.max() <= width:
            return owner, at
        keep = (at >= 0) & (at + size[owner] <= len(self.points))
        owner, at = owner[keep], at[keep]
        # The seed is extended by the ones beside it, each behind the one before, and the last.
        last = size - width
        for i in range(0, min(int(last.max()), COLUMNS) + width, width):
            step = np.minimum(i, last)[owner]
            keep = windows[at + step] == seeds[begin[owner] + step]
            owner, at = owner[keep], at[keep]
        for k in np.unique(owner[last[owner] >= COLUMNS]) if int(last.max()) >= COLUMNS else ():
            mine = np.flatnonzero(owner == k)
            left = mine
            for i in {*range(COLUMNS - COLUMNS % width, int(last[k]), width), int(last[k])}:
                if len(left) < 4:  # a few places are compared as a whole
                    whole = seeds[begin[k]:begin[k] + last[k] + 1]
                    left = left[[bool((windows[a:a + len(whole)] == whole).all()) for a in at[left]]] if len(left) else left
                    break
                left = left[windows[at[left] + i] == seeds[begin[k] + i]]
            gone = np.setdiff1d(mine, left)
            owner, at = np.delete(owner, gone), np.delete(at, gone)
        return owner, at


def find_pieces(pairs: DataFrame, piece: str, accession: str, sequences: DataFrame) -> DataFrame:
    """(piece, accession, known, length, starts, before) over the distinct pairs: the 1-based starts of a piece in a
    sequence of the accession, in order, and the letters in front of them as one text (any letter stands for none).

    ``piece`` is a piece or a list of them; lists are dealt whole. An accession of several sequences gives a row for each
    that adds a place, as (start, letter in front, length). A pair without a place is one row without starts; ``known``
    tells whether the accession has a sequence at all. Sequences are dealt by accession; one that very many pieces name
    goes to several tasks, each with a part of them.
    """
    return _dealt(pairs, piece, accession, sequences).mapInArrow(lambda rows: _found(rows, places, _rows), "piece string, accession string, known boolean, length bigint, starts array<int>, before string")


def place_pieces(pairs: DataFrame, piece: str, accession: str, sequences: DataFrame) -> DataFrame:
    """(piece, accession, known, places) over the distinct pairs, one row each: every place as (start, previous, length),
    ``previous`` the letter in front, "" at the beginning, ``length`` that of the sequence. A place that several sequences of
    the accession have alike is there once; a pair without a place has no list. Otherwise as ``find_pieces``."""
    return _dealt(pairs, piece, accession, sequences).mapInArrow(lambda rows: _found(rows, gathered, _gathered_rows), f"piece string, accession string, known boolean, places {_PLACES}")


def _dealt(pairs: DataFrame, piece: str, accession: str, sequences: DataFrame) -> DataFrame:
    """Sequences and pieces where they meet: a pair is in one task, and one after the other what an accession has there."""
    listed = dict(pairs.dtypes)[piece].startswith("array")
    wanted = pairs.select(F.col(accession).alias("accession"), (F.col(piece) if listed else F.array(piece)).alias("pieces"))
    many = wanted.groupBy("accession").agg(F.sum(F.size("pieces")).alias("n")).filter(F.col("n") > PIECES)
    parts = materialise(many.select(F.col("accession").alias("_a"), F.ceil(F.col("n") / PIECES).cast("int").alias("parts")), "parts")
    texts = sequences.select("accession", "sequence").where("accession IS NOT NULL AND sequence IS NOT NULL")
    none, all_parts = F.lit(None), F.array(F.lit(0))
    if parts.isEmpty():
        asked = wanted.select("accession", F.lit(0).alias("part"), "pieces")
    else:
        wanted, texts = (df.join(parts, F.col("accession") == F.col("_a"), "left") for df in (wanted, texts))
        all_parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        apart = wanted.filter("parts IS NOT NULL").select("accession", "parts", F.explode("pieces").alias("piece"))
        asked = wanted.filter("parts IS NULL").select("accession", F.lit(0).alias("part"), "pieces") \
            .unionByName(apart.select("accession", F.pmod(F.xxhash64("piece"), "parts").cast("int").alias("part"), F.array("piece").alias("pieces")))
    asked = asked.select("accession", "part", F.lit(1).alias("kind"), none.cast("string").alias("text"), "pieces")
    held = texts.select("accession", F.explode(all_parts).alias("part"), F.lit(0).alias("kind"), F.col("sequence").alias("text"), none.cast("array<string>").alias("pieces"))
    # Sequences come before the pieces, and repeated ones one behind the other.
    return held.unionByName(asked).repartition("accession", "part").sortWithinPartitions("accession", "part", "kind", "text")


_PLACES = "array<struct<start:bigint,previous:string,length:bigint>>"
_SCHEMA = pa.schema([("piece", pa.string()), ("accession", pa.string()), ("known", pa.bool_()), ("length", pa.int64()), ("starts", pa.list_(pa.int32())), ("before", pa.string())])


def _letters(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the letters of all pieces, one behind the other; the number of each piece's)."""
    filled = pc.fill_null(pieces, "")
    ends = np.frombuffer(filled.buffers()[1], np.int32)[filled.offset:filled.offset + len(filled) + 1]
    data = filled.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if ends[-1] > ends[0] else b""
    return _points(data.decode()), np.asarray(pc.utf8_length(filled)).astype(np.int64)


def places(known: list[Seeds], pieces: pa.Array) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(pieces, length of the sequence, how many places each has, the places, the letters before them): which of different
    pieces are in the sequences of an accession. Last, those that are in none."""
    hit, seen = np.zeros(len(pieces), bool), {}
    if known:
        letters, size = _letters(pieces)
        begin = np.cumsum(size) - size
    for seeds in known:
        for owner, at in seeds.starts(letters, begin, size):
            before = seeds.points[np.maximum(at - 1, 0)]
            if len(known) > 1:  # a place that an earlier sequence has as well is left out
                keys = [(o, a, b if a else 0, len(seeds.points)) for o, a, b in zip(owner.tolist(), at.tolist(), before.tolist())]
                new = np.fromiter((k not in seen for k in keys), bool, len(keys))
                seen.update(dict.fromkeys(keys))
                owner, at, before = owner[new], at[new], before[new]
            if len(owner):
                counts = np.bincount(owner, minlength=len(pieces))
                held = np.flatnonzero(counts)
                hit[held] = True
                yield held, len(seeds.points), counts[held], at, before
    rest = np.flatnonzero(~hit)
    if len(rest):
        yield rest, 0, np.zeros(len(rest), np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)


def gathered(known: list[Seeds], pieces: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """As ``places``, with a piece once and the length of the sequence for each place: places of several sequences are put
    together, those of one are by themselves already."""
    several = []
    for held, length, counts, at, before in places(known, pieces):
        if len(known) > 1 and len(at):
            several.append((np.repeat(held, counts), np.full(len(at), length), at, before))
        else:
            yield held, np.full(len(at), length), counts, at, before
    if several:
        owner, lengths, at, before = (np.concatenate(x) for x in zip(*several))
        order = np.argsort(owner, kind="stable")
        held, counts = np.unique(owner, return_counts=True)
        yield held, lengths[order], counts, at[order], before[order]


def _texts(letters: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(where each letter begins, and the last ends; all letters one behind the other) in UTF-8."""
    size = 1 + (letters >= 0x80).astype(np.int64) + (letters >= 0x800) + (letters >= 0x10000)
    return np.append(0, np.cumsum(size)), letters.astype("<u4").tobytes().decode("utf-32-le").encode()


def _gathered_rows(done: list[tuple]) -> pa.RecordBatch:
    """A row a piece of (pieces, accession, known, lengths, counts, places, letters before), with the list of its places."""
    pieces, names, known, lengths, counts, at, before = zip(*done)
    each = [len(p) for p in pieces]
    lengths, counts, at, before = (np.concatenate(x) for x in (lengths, counts, at, before))
    inside = at > 0
    edges, letters = _texts(before[inside])
    offsets = edges[np.append(0, np.cumsum(inside))].astype(np.int32)
    previous = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters)])
    one = pa.StructArray.from_arrays([pa.array(at + 1, pa.int64()), previous, pa.array(lengths, pa.int64())], ["start", "previous", "length"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), one, mask=pa.array(counts == 0))
    which = pa.array(np.repeat(np.arange(len(each)), each))
    return pa.RecordBatch.from_arrays([pa.concat_arrays(pieces), pa.array(names, pa.string()).take(which), pa.array(known).take(which), lists], ["piece", "accession", "known", "places"])


def _rows(done: list[tuple]) -> pa.RecordBatch:
    """A row a piece of (pieces, accession, known, length, counts, places, letters before); one without a place has no
    length and no starts."""
    pieces, names, known, lengths, counts, at, before = zip(*done)
    each = [len(p) for p in pieces]
    counts, at, before = np.concatenate(counts), np.concatenate(at), np.concatenate(before)
    none, ends = counts == 0, np.append(0, np.cumsum(counts))
    starts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at + 1, pa.int32()), mask=pa.array(none))
    edges, letters = _texts(before)
    offsets = edges[ends].astype(np.int32)
    bits = np.packbits(~none, bitorder="little").tobytes()
    texts = pa.Array.from_buffers(pa.string(), len(counts), [pa.py_buffer(bits), pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters)])
    which = pa.array(np.repeat(np.arange(len(each)), each))
    length = pa.array(np.repeat(np.array(lengths, np.int64), each), mask=none)
    return pa.RecordBatch.from_arrays([pa.concat_arrays(pieces), pa.array(names, pa.string()).take(which), pa.array(known).take(which), length, starts, texts], schema=_SCHEMA)


def _found(batches: Iterator[pa.RecordBatch], looked_up: Callable[[list[Seeds], pa.Array], Iterator[tuple]], rows: Callable[[list[tuple]], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task, whose input is in order: the sequences of an accession before its pieces. ``looked_up`` gives what
    is found, ``rows`` makes a batch of it."""
    known: list[Seeds] = []
    waiting: list[pa.Array] = []
    done: list[tuple] = []
    group, last, name, n_waiting = None, None, None, 0
    n_rows = n_places = 0

    def closed() -> Iterator[pa.RecordBatch]:
        """What the accession so far has found, once there is enough for a batch."""
        nonlocal known, waiting, done, last, n_waiting, n_rows, n_places
        if waiting:
            pieces = pa.concat_arrays(waiting).unique()
            for which, length, counts, at, before in looked_up(known, pieces):
                done.append((pieces if len(which) == len(pieces) else pieces.take(pa.array(which)), name, bool(known), length, counts, at, before))
                n_rows, n_places = n_rows + len(which), n_places + len(at)
                if n_rows >= 10_000 or n_places >= PLACES:
                    yield rows(done)
                    done, n_rows, n_places = [], 0, 0
        known, waiting, last, n_waiting = [], [], None, 0

    for batch in batches:
        if not batch.num_rows:
            continue
        names, texts, lists = (batch.column(c) for c in ("accession", "text", "pieces"))
        part, kind = (np.asarray(batch.column(c)) for c in ("part", "kind"))
        filled, null = pc.fill_null(names, ""), np.asarray(names.is_null())
        change = np.diff(part, prepend=part[0]) != 0
        change[1:] |= np.asarray(pc.not_equal(filled.slice(1), filled.slice(0, len(names) - 1))) | (null[1:] != null[:-1])
        change[0] = (names[0].as_py(), int(part[0])) != group
        edges = np.unique(np.append(0, np.flatnonzero(change)))
        ends, values = np.asarray(lists.offsets), lists.values
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows]):
            if change[a]:
                yield from closed()
                name = names[a].as_py()
                group = (name, int(part[a]))
            while a < b and not kind[a]:
                text = texts[a].as_py()
                if text != last:
                    known.append(Seeds(text))
                last, a = text, a + 1
            if ends[b] > ends[a]:
                waiting.append(values.slice(int(ends[a]), int(ends[b] - ends[a])))
                n_waiting += len(waiting[-1])
                if n_waiting > 5 * PIECES and len(waiting) > 1:  # repeated pairs do not pile up
                    waiting = [pa.concat_arrays(waiting).unique()]
                    n_waiting = len(waiting[0])
    yield from closed()
    if done:
        yield rows(done)
