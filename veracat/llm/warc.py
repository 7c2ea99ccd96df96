"""WARC files of records compressed one by one with a Zstandard dictionary that stands at the head of the file."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracat.llm.common import spread
from veracat.llm.shared import open_shared
from veracat.session import materialise, scratch_dir

# Fixed by the format: the magic number of the skippable frame that holds the dictionary.
DICTIONARY_FRAME = 0x184D2A5D
# Bytes of records that a file's dictionary is trained on, and the size of the dictionary.
TRAIN_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
# A file is closed when it has taken in so many bytes.
FILE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
LINE = "\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, date: str = DATE) -> bytes:
    """One record: a response with its payload, or a revisit of page ``first`` with headers only."""
    http = f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: {len(payload)}{LINE}{LINE}".encode()
    block = http if first is not None else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{base32_sha1(payload)}")
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date),
        ("WARC-Target-URI", _field(url)), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("X-Page-Id", page_id), ("X-Payload-Length", len(payload)),
    ]
    if first is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", first)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}{LINE}" for k, v in fields if v is not None)
    return f"WARC/1.1{LINE}{head}{LINE}".encode() + block + (LINE * 2).encode()


def _field(value: str | None) -> str | None:
    """A header value on one line; NULL is left out."""
    return None if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


def train(samples: list[bytes]) -> bytes:
    """A dictionary from records, or nothing where there are too few of them to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class Writer:
    """A file: the dictionary in a skippable frame, then a frame for every record. Memory holds the records that
    the dictionary is trained on and then one record at a time."""

    def __init__(self, name: str):
        self.name, self.waiting, self.taken, self.out = name, [], 0, None

    def add(self, made: bytes) -> None:
        self.taken += len(made)
        if self.out:
            self.out.write(self.compressor.compress(made))
            return
        self.waiting.append(made)
        if self.taken >= TRAIN_BYTES:
            self.start()

    def start(self) -> None:
        dictionary = train(self.waiting)
        self.out = open_shared(self.name, "w")
        if dictionary:
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True)
        for made in self.waiting:
            self.out.write(self.compressor.compress(made))
        self.waiting = []

    def close(self) -> int:
        if not self.out:
            self.start()
        self.out.close()
        return self.taken


def read_records(name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, in file order, one in memory at a time."""
    with open_shared(name, "r") as raw:
        dictionary = None
        head = raw.read(8)
        if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_FRAME:
            dictionary = zstandard.ZstdCompressionDict(raw.read(struct.unpack("<II", head)[1]))
        else:
            raw.seek(0)
        with zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(raw, read_across_frames=True, closefd=False) as plain:
            # What was read and not yet given out starts at ``at``; it is moved only when more is read.
            kept, at = b"", 0

            def more() -> bool:
                nonlocal kept, at
                got = plain.read(1 << 20)
                kept, at = kept[at:] + got, 0
                return bool(got)

            while at < len(kept) or more():
                while (end := kept.find(b"\r\n\r\n", at)) < 0:
                    if not more():
                        raise ValueError(f"{name} ends inside a record's headers")
                lines = kept[at:end].decode().split(LINE)
                headers = dict(line.split(": ", 1) for line in lines[1:])
                at = end + 4
                left, parts = int(headers["Content-Length"]) + 4, []
                while left > len(kept) - at:
                    parts.append(kept[at:])
                    left -= len(kept) - at
                    at = len(kept)
                    if not more():
                        raise ValueError(f"{name} ends inside a record")
                parts.append(kept[at:at + left])
                at += left
                yield headers, b"".join(parts)[:-4]


def write_archive(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write a record for every row of ``pages`` and return the files, one row (file, records, bytes) each.

    The payload is the html in UTF-8, a NULL one empty. Of records with equal payloads of ``least`` bytes or
    more, that with the smallest page_id is a response and the others are revisits of it; rows that tie on it,
    and rows of a payload with no page_id at all, are all responses. Payloads are compared by SHA-1.

    Only payloads that occur twice take part in the join, as (digest, smallest page_id); the pages are never
    shuffled. A task that runs again writes other files; only the files of the returned table count.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    seen = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    again = materialise(seen.where("n > 1 and first is not null").select(F.col("digest").alias("of_digest"), "first"), "firsts")
    joined = rows.join(again, F.col("digest") == F.col("of_digest"), "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = None, 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([n], pa.int64()), pa.array([out.close()], pa.int64())], ["file", "records", "bytes"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "first")]
            for i in range(batch.num_rows):
                out = out or Writer(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                out.add(record(*(c[i].as_py() for c in columns)))
                n += 1
                if out.taken >= FILE_BYTES:
                    yield closed()
                    out, n = None, 0
        if out:
            yield closed()

    written = joined.select("page_id", "url", "payload", refers.alias("first")).mapInArrow(write, "file string, records bigint, bytes bigint")
    return materialise(written, "files")


def read_archive(files: DataFrame) -> DataFrame:
    """A row for every record in the files: page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    digest_ok. Files are spread over tasks; the digest of a response is taken again from its payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                made = []
                for headers, block in read_records(name):
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                    whole = block[block.index(b"\r\n\r\n") + 4:] if kind == "response" else None
                    number = lambda k: int(headers[k]) if k in headers else None
                    made.append((number("X-Page-Id"), headers.get("WARC-Target-URI"), len(whole) if whole is not None else number("X-Payload-Length"), digest, kind, number("X-Refers-To-Page-Id"), whole is None or base32_sha1(whole) == digest))
                    if len(made) == 1000:
                        yield _table(made)
                        made = []
                if made:
                    yield _table(made)

    return spread(files.select("file")).mapInArrow(read, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, digest_ok boolean")


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def archive(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as an archive and return what its files hold, read back."""
    return read_archive(write_archive(pages, folder or scratch_dir(pages.sparkSession, "warc"), **options))
