"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed independently; a skippable frame at the end of each
file holds the seek table (sizes of all frames), so that a reader can decompress any one frame. The writer
returns an index from record to file, frame and offset inside the decompressed frame.

Archives go to the shared folder (or a given URI) through a file-system client, under names that carry
the task's attempt. Only files named in the index of attempts that succeeded are ever read, so a lost
executor or a repeated task leaves at worst an unused file. The index is settled before anything is read.

A page whose payload has at least DEDUP_BYTES and equals that of a page with a larger id becomes a revisit
record without a payload that names that page.

Defined cases: null html is an empty payload; a null url has no target header; a null id is written as
`null` and is never the largest id of a group that has another; rows that repeat the largest id of a group
are responses each; an empty table gives an empty archive set; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import require, settle, shared_folder

DEDUP_BYTES = 1000
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
BROADCAST_GROUPS = 200_000
MOST_READERS = 20_000
#: The format's fixed values: skippable frame of the seek table, its footer; the record header's date.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"
URN = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id string, file string, frame int, offset long, length long, record_type string"
RECORD = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary, frame int, offset long, file string"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith(("file:", "hdfs:")) else f"file://{uri}")


def _record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response record, or a revisit record that keeps only the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=URL_SAFE)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


URL_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


class Bundle:
    """Writes one file of frames; add() returns a record's frame and offset."""

    def __init__(self, folder: str, name: str):
        system, path = _fs(folder)
        system.create_dir(path, recursive=True)
        self.name, self.out = name, system.open_output_stream(f"{path}/{name}", compression=None)
        self.packer, self.frame, self.size, self.frames, self.written = zstandard.ZstdCompressor(level=3), [], 0, [], 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.size and self.size + len(record) > FRAME_BYTES:
            self.flush()
        at = len(self.frames), self.size
        self.frame.append(record)
        self.size += len(record)
        return at

    def flush(self) -> None:
        if self.size:
            packed = self.packer.compress(b"".join(self.frame))
            self.out.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.frame, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem, bundle, number = f"part-{task.partitionId():06d}-{task.taskAttemptId()}", None, 0
        for batch in batches:
            out = []
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle is None:
                    bundle, number = Bundle(folder, f"{stem}-{number:04d}.warc.zst"), number + 1
                record = _record(page_id, url, (html or "").encode(), digest, refers_to)
                out.append((page_id, bundle.name, *bundle.add(record), len(record), "response" if refers_to is None else "revisit"))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            names = ("page_id", "file", "frame", "offset", "length", "record_type")
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=list(names))
        if bundle is not None:
            bundle.close()

    return write


def write(df: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, str]:
    """Write all rows; returns the index (page_id, file, frame, offset, length, record_type) and the folder."""
    require(df, id_col, url_col, html_col)
    folder = folder or f"{shared_folder(df.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"))
    long = F.octet_length("html") >= DEDUP_BYTES
    groups = settle(rows.filter(long).groupBy("digest").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("digest", "last"))
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    rows = rows.join(groups, "digest", "left")
    refers_to = F.when(long & F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last")), F.col("last").cast("string"))
    rows = rows.select(F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("page_id"), "url", "html", "digest", refers_to.alias("refers_to"))
    return settle(rows.mapInArrow(_writer(folder), INDEX)), folder


def seek_table(source) -> list[tuple[int, int, int]]:
    """(start, packed size, size) of every frame, from the table at the end of an open file."""
    end = source.size()
    source.seek(end - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    source.seek(end - 9 - 8 * n)
    sizes, at, out = struct.unpack(f"<{2 * n}I", source.read(8 * n)), 0, []
    for packed, size in zip(sizes[::2], sizes[1::2], strict=True):
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(source, at: tuple[int, int, int]) -> bytes:
    source.seek(at[0])
    return zstandard.ZstdDecompressor().decompress(source.read(at[1]), max_output_size=at[2])


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at an offset, and where the next one starts."""
    head_end = data.index(b"\r\n\r\n", at)
    head = dict(line.split(": ", 1) for line in data[at:head_end].decode().split("\r\n")[1:])
    start = head_end + 4
    stop = start + int(head["Content-Length"])
    return head, data[start:stop], stop + 4


def _read_files(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.parse import unquote

        system, path = _fs(folder)
        for pdf in batches:
            for name in pdf["file"]:
                with system.open_input_file(f"{path}/{name}") as source:
                    for number, frame in enumerate(seek_table(source)):
                        data, at, out = read_frame(source, frame), 0, []
                        while at < len(data):
                            head, block, after = parse(data, at)
                            http, _, payload = block.partition(b"\r\n\r\n")
                            size = int(http.rpartition(b"Content-Length: ")[2])
                            kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                            if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                                raise ValueError(f"record {head['WARC-Record-ID']} of {name} is damaged")
                            urn = lambda x: x and x[1:-1].removeprefix(URN)
                            url = head.get("WARC-Target-URI")
                            out.append((urn(head["WARC-Record-ID"]), url and unquote(url), size, digest, kind, urn(head.get("WARC-Refers-To")), payload if kind == "response" else None, number, at, name))
                            at = after
                        yield pd.DataFrame(out, columns=[c.split()[0] for c in RECORD.split(", ")])

    return read


def read(index: DataFrame, folder: str) -> DataFrame:
    """All records of the files that an index names; a task for each file, up to MOST_READERS."""
    files = settle(index.select("file").distinct())
    return files.repartition(max(1, min(files.count(), MOST_READERS))).mapInPandas(_read_files(folder), RECORD)


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """The records of an index's rows only, each by decompressing its one frame: page_id and record bytes."""

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _fs(folder)
        for pdf in batches:
            for (name, number), part in pdf.groupby(["file", "frame"]):
                with system.open_input_file(f"{path}/{name}") as source:
                    data = read_frame(source, seek_table(source)[number])
                yield pd.DataFrame({"page_id": part["page_id"], "record": [data[o : o + n] for o, n in zip(part["offset"], part["length"], strict=True)]})

    return index.mapInPandas(get, "page_id string, record binary")


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write rows as archives and read them back: one row for each, without the payloads."""
    index, folder = write(df, folder, id_col, url_col, html_col)
    kind = df.schema[id_col].dataType
    number = lambda c: F.when(F.col(c) != "null", F.col(c)).cast(kind)
    return read(index, folder).select(number("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "file", "frame", "offset")
