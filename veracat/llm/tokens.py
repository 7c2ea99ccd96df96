"""Token ids of whole texts: a chunk cache before the tokenizer, ORC files with indexes, flat files and their scan."""

from __future__ import annotations

import io
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracat.llm.common import running_sum, spread, whole
from veracat.llm.shared import open_shared
from veracat.session import materialise, scratch_dir

END = 2
SEPARATOR = 49407
CACHE_ENTRIES = 1_000_000
BLOCK = 4 << 20

_encoders: dict[tuple[str, bool], Encoder] = {}


#: A chunk that is one word of Latin letters and the marks after it: its pieces are known without a tokenizer.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")


@cache
def byte_signs() -> dict[int, str]:
    """The sign that byte-level vocabularies write for a byte: a printable one stands for itself, the others
    take the code points from 256 on in turn."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """A tokenizer with a bounded cache of the ids of space-delimited chunks.

    Only for tokenizers that never join characters across a space or newline, as those that drop white space
    before their merges; the cache is emptied when full, so memory is bounded. A new chunk that is a plain word
    goes to the tokenizer's merges at once, if that gives this tokenizer's ids; every other one is encoded whole.
    """

    def __init__(self, path: str, literal: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        probe = ["Word", "stra\u00dfe,", "\u00c9t\u00e9...", "unbelievably!?", "a"]
        self.plain = all(self._plain(PLAIN.fullmatch(c)) == whole for c, whole in zip(probe, self._whole(probe)))

    def _whole(self, chunks: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _plain(self, match: re.Match) -> bytes:
        word, marks = match.groups()
        return self._piece(word.lower()) + (self._piece(marks) if marks else b"")

    def _piece(self, piece: str) -> bytes:
        if piece not in self.pieces:
            signs = piece if piece.isascii() else "".join(map(byte_signs().__getitem__, piece.encode()))
            self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()
        return self.pieces[piece]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        chunks = text.replace("\n", " ").split(" ")
        known = self.known
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            pass
        if len(known) + len(self.pieces) > CACHE_ENTRIES:
            known.clear()
            self.pieces.clear()
            known[""] = b""
        odd = []
        for c in dict.fromkeys(chunks):
            if c not in known:
                match = PLAIN.fullmatch(c) if self.plain else None
                if match:
                    known[c] = self._plain(match)
                else:
                    odd.append(c)
        known.update(zip(odd, self._whole(odd)))
        return b"".join([known[c] for c in chunks])


def encoder(path: str, literal: bool = False) -> Encoder:
    """One per Python worker, so that the cache outlives a task."""
    if (path, literal) not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path, literal] = Encoder(path, literal)
    return _encoders[path, literal]


def token_ids(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """(doc_id, digest, ids) in ascending doc_id order, NULL first; a NULL text is empty. ``ids`` ends with ``end``.

    Rows are ordered by (doc_id, a hash of the text), so equal ids have a fixed order too.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(whole(text)).alias("digest"), whole(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last = encoder(tokenizer), np.asarray([end], "<u4").tobytes()
        for batch in batches:
            for part in _slices(batch, "text"):
                made = [enc.encode(t) + last for t in part.column("text").to_pylist()]
                ends = np.cumsum([0, *(len(m) >> 2 for m in made)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(made), "<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("digest"), ids], ["doc_id", "digest", "ids"])

    return ordered.mapInArrow(encode, "doc_id bigint, digest bigint, ids array<int>")


def _slices(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, a longer text alone."""
    sizes = np.asarray(pc.binary_length(batch.column(text)).fill_null(0)) if batch.num_rows else np.zeros(0)
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def write_orc(ids: DataFrame, path: str) -> None:
    """ORC with run-length encoded ids, a row index every 1,000 rows and a Bloom filter on the document id, so
    a lookup reads the row groups that may hold the id and a scan reads stripes in parallel."""
    ids.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").option("orc.row.index.stride", "1000") \
        .option("orc.stripe.size", str(32 << 20)).option("compression", "zstd").orc(path)


def read_ids(df: DataFrame) -> DataFrame:
    """(doc_id, digest, n_tokens, ids_crc32) of stored ids; the id column goes to numpy as it stands."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            at, values = np.asarray(ids.offsets), np.asarray(ids.values)
            sums = [zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(np.diff(at), pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "digest", "n_tokens", "ids_crc32"]
            )

    return df.select("doc_id", "digest", "ids").mapInArrow(measure, "doc_id bigint, digest bigint, n_tokens bigint, ids_crc32 bigint")


def token_index(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a folder of token files; start is the number
    of ids before it in file order."""
    read = materialise(read_ids(spark.read.schema("doc_id bigint, digest bigint, ids array<int>").orc(path)), "measured")
    placed = running_sum(read, ["doc_id", "digest", "ids_crc32"], "n_tokens", "start")
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")


def encode_to_orc(docs: DataFrame, tokenizer: str, path: str | None = None, doc_id: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """Write the token files of ``docs`` and return their index, read back from the files. An empty table
    gives an empty folder of files and no rows; other columns of ``docs`` are not stored."""
    path = path or scratch_dir(docs.sparkSession, "tokens")
    write_orc(token_ids(docs, tokenizer, doc_id, text, end), path)
    return token_index(docs.sparkSession, path)


# Flat files: ids without any index, 16 bits each, a separator after every document.


def write_flat(docs: DataFrame, tokenizer: str, folder: str, doc_id: str = "doc_id", text: str = "text", separator: int = SEPARATOR) -> DataFrame:
    """Write flat token files, one for a task, and return (file, ordinal, doc_id): which document stands where.

    A task that is run again writes another file, and only files named in the returned table count. Strings
    that look like special tokens are ordinary text here, so the separator stands at document ends alone.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole(text).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, name, ordinal, out = encoder(tokenizer, literal=True), f"{folder}/{uuid.uuid4().hex}.bin", 0, None
        last = np.asarray([separator], "<u2").tobytes()
        for batch in batches:
            for part in _slices(batch, "text"):
                out = out or open_shared(name, "w")
                for t in part.column("text").to_pylist():
                    ids = np.frombuffer(enc.encode(t), "<u4")
                    if len(ids) and ids.max() > 0xFFFF:
                        raise ValueError(f"a flat file holds ids of 16 bits, and this vocabulary gives {ids.max()}")
                    out.write(ids.astype("<u2").tobytes() + last)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(np.arange(ordinal, ordinal + n), pa.int64()), part.column("doc_id")], ["file", "ordinal", "doc_id"])
                ordinal += n
        if out:
            out.close()

    return materialise(rows.mapInArrow(write, "file string, ordinal bigint, doc_id bigint"), "places")


def scan_flat(files: DataFrame, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """(file, ordinal, n_tokens) of the documents in flat token files, given their names as ``file``.

    Blocks of fixed size are scanned independently: numpy finds the separators, and a block reports the
    distance from each to the one before it, the first from the block's start. A prefix scan over the blocks'
    summaries gives each block the documents before it and the ids left open before it. A text after the last
    separator is a document too.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("file").to_pylist()
            sizes = [_size(n) for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64())], ["file", "bytes"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, at in zip(batch.column("file").to_pylist(), batch.column("at").to_pylist()):
                with open_shared(name, "r") as f:
                    f.seek(at)
                    ids = np.frombuffer(f.read(block), "<u2")
                found = np.flatnonzero(ids == separator)
                gaps = np.diff(found, prepend=-1) - 1
                tail = len(ids) - (found[-1] + 1 if len(found) else 0)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at]), pa.array([len(found)]), pa.array([tail], pa.int64()), pa.array([gaps.tolist()], pa.list_(pa.int64()))], ["file", "at", "n", "tail", "gaps"])

    sized = spread(materialise(files.select("file").distinct(), "names")).mapInArrow(lengths, "file string, bytes bigint").where("bytes > 0")
    blocks = sized.select("file", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(block).cast("bigint"))).alias("at"))
    found = materialise(spread(materialise(blocks, "cuts")).mapInArrow(search, "file string, at bigint, n bigint, tail bigint, gaps array<bigint>"), "blocks")

    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    end = F.sum(F.when(F.col("n") > 0, 0).otherwise(F.col("tail"))).over(before)  # ids of blocks without a separator
    open_at = F.last(F.when(F.col("n") > 0, F.struct("tail", F.col("skipped"))), ignorenulls=True).over(before)
    stitched = found.select("file", "at", "n", "tail").withColumn("skipped", F.coalesce(F.sum(F.when(F.col("n") > 0, 0).otherwise(F.col("tail"))).over(Window.partitionBy("file").orderBy("at")), F.lit(0)))
    last = F.row_number().over(Window.partitionBy("file").orderBy(F.col("at").desc())) == 1
    stitched = stitched.select(
        "file", "at", "n", "tail", last.alias("is_last"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        (F.coalesce(end, F.lit(0)) - F.coalesce(open_at["skipped"], F.lit(0)) + F.coalesce(open_at["tail"], F.lit(0))).alias("carry"),
    )
    joined = found.select("file", "at", "gaps").join(stitched, ["file", "at"])
    inner = joined.select("file", "first", "carry", F.posexplode("gaps").alias("k", "gap"))
    closed = inner.select("file", (F.col("first") + F.col("k")).alias("ordinal"), (F.col("gap") + F.when(F.col("k") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"))
    rest = F.col("tail") + F.when(F.col("n") == 0, F.col("carry")).otherwise(0)
    unended = stitched.where("is_last").select("file", (F.col("first") + F.col("n")).alias("ordinal"), rest.alias("n_tokens")).where("n_tokens > 0")
    return closed.unionByName(unended)


def _size(name: str) -> int:
    with open_shared(name, "r") as f:
        return f.seek(0, io.SEEK_END)


def count_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, doc_id: str = "doc_id", text: str = "text", separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_tokens) of every document, counted in the flat files that hold their ids. A NULL or blank
    text has 0 tokens; repeated rows have an entry each."""
    folder = folder or scratch_dir(docs.sparkSession, "flat")
    places = write_flat(docs, tokenizer, folder, doc_id, text, separator)
    counts = scan_flat(places, separator, block)
    return places.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
