"""WARC records in ZIP-packaged archives: writing them, and reading them back by byte ranges.

An archive is a ZIP file with stored members: `archive/data.warc.gz`, one gzip
member for each WARC record, and `indexes/index.cdxj`, one line for each record
with its place in the former.  The reader never extracts a member.  It reads the
end of the file, follows the ZIP64 locator where there is one, parses the central
directory, finds where each stored member's bytes begin, takes the record places
from the index, and then reads runs of neighbouring records, each as one range.
Runs are dealt over all tasks, so that one large archive is read by many.

Files are reached through pyarrow's file systems, by the URI of the folder that
the executors share.  A task that is run again writes a file of another name;
the manifest, written as Parquet, lists those of the tasks that ended well.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import pieces
from ledgerloom.session import shared_folder, store, write_once

#: Payloads below this many bytes are always written in full.
LEAST_SHARED = 100
ARCHIVE_BYTES = 64 << 20
#: One range read covers neighbouring records of about so many bytes.
RANGE_BYTES = 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


# Writing


def record(page, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response with the same payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page is None else page}>",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else _ID + str(page)}",
        "WARC-Date: 2000-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is None:
        block = http + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    else:
        block = http + b"\r\n"
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {IDENTICAL}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Archive:
    """A ZIP archive that is written in one pass; the index follows the records."""

    def __init__(self, folder: str):
        system, path = pafs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.wacz"
        self.out = system.open_output_stream(f"{path}/{self.name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.bytes, self.lines = 0, []

    def add(self, page, packed: bytes, kind: str) -> None:
        self.data.write(packed)
        self.lines.append(f"{_ID}{page} " + json.dumps({"type": kind, "offset": self.bytes, "length": len(packed)}))
        self.bytes += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(INDEX, "w") as index:
            index.write("".join(line + "\n" for line in self.lines).encode())
        self.zip.close()
        self.out.close()
        return self.name, len(self.lines), self.bytes


def shared_payloads(pages: DataFrame) -> DataFrame:
    """(page, digest, first) of each page whose payload of at least LEAST_SHARED bytes also has a smaller page."""
    long = pages.where(F.col("_bytes") >= LEAST_SHARED).select("_page", "_digest")
    # A payload that a third of all pages share is counted on the map side; the join below is one that Spark splits.
    firsts = long.groupBy("_digest").agg(F.min("_page").alias("_first"), F.max("_page").alias("_last")).where("_last > _first")
    return long.join(firsts.drop("_last"), "_digest").where("_page > _first").groupBy("_page", "_digest").agg(F.min("_first").alias("_first"))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record for every row of `pages` below `folder`; returns the manifest (archive, records, bytes).

    A null html is an empty payload, a null url is left out.  Among equal payloads of at least LEAST_SHARED bytes the
    smallest key is the response; rows that repeat that very key are responses too, as is a row with a null key.  Other
    columns are not read; an empty table gives an empty manifest.
    """
    base = pages.select(
        F.col(key).alias("_page"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("_payload"), F.col(url).alias("_url")
    ).withColumns({"_digest": F.sha2("_payload", 256), "_bytes": F.octet_length("_payload")})
    shared = store(shared_payloads(base), "warc-shared")
    # The pages are moved only if the list of shared payloads is too large to be sent to them.
    side = F.broadcast(shared.df) if shared.fits_broadcast else shared.df
    told = base.join(side, ["_page", "_digest"], "left").select("_page", "_payload", "_url", "_digest", "_first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None

        def closed() -> pa.RecordBatch:
            done = archive.close()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in done], names=["archive", "records", "bytes"])

        for batch in pieces(batches):
            for page, payload, address, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                archive = archive or Archive(folder)
                packed = gzipped(record(page, address, payload, digest, first))
                archive.add(page, packed, "response" if first is None else "revisit")
                if archive.bytes >= ARCHIVE_BYTES:
                    yield closed()
                    archive = None
        if archive:
            yield closed()

    return write_once(told.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")


# Reading


@dataclass(frozen=True)
class Member:
    """A stored member of a ZIP file: its bytes are `size` from `start`."""

    name: str
    start: int
    size: int


def directory(file, size: int) -> list[Member]:
    """The stored members of a ZIP file, from its central directory; `file` needs seek and read.

    Compressed members are left out, as ranges of them can't be read.
    """

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    tail_at = max(0, size - (22 + 0xFFFF))
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] > len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of a central directory")
    count, length, begin = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or begin == 0xFFFFFFFF:
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of the central directory")
        count, length, begin = struct.unpack_from("<QQQ", end, 32)
    entries, members, at = read(begin, length), [], 0
    for _ in range(count):
        if entries[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is broken")
        method, packed, full = (struct.unpack_from("<H", entries, at + 10)[0], *struct.unpack_from("<II", entries, at + 20))
        named, extra, comment = struct.unpack_from("<HHH", entries, at + 28)
        header = struct.unpack_from("<I", entries, at + 42)[0]
        name = entries[at + 46 : at + 46 + named].decode("utf-8", "replace")
        fields, k = entries[at + 46 + named : at + 46 + named + extra], 0
        while k + 4 <= len(fields):
            tag, n = struct.unpack_from("<HH", fields, k)
            if tag == 1:  # ZIP64: 8 bytes for each value that didn't fit, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", fields, k + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            k += 4 + n
        if method == 0:
            own_name, own_extra = struct.unpack_from("<HH", read(header, 30), 26)
            members.append(Member(name, header + 30 + own_name + own_extra, packed))
        at += 46 + named + extra + comment
    return members


def index_lines(file, member: Member) -> Iterator[dict]:
    """The entries of an index member, read by ranges."""
    rest, at, end = b"", member.start, member.start + member.size
    while at < end:
        file.seek(at)
        chunk = file.read(min(RANGE_BYTES, end - at))
        at += len(chunk)
        *lines, rest = (rest + chunk).split(b"\n")
        for line in lines:
            if b"{" in line:
                yield json.loads(line[line.index(b"{") :])


def runs(file, size: int) -> Iterator[tuple[int, list[int]]]:
    """Runs of neighbouring records: where a run starts in the file, and the length of each of its records."""
    members = {m.name: m for m in directory(file, size)}
    data = members[DATA]
    start, lengths, end = data.start, [], data.start
    for entry in index_lines(file, members[INDEX]):
        at = data.start + entry["offset"]
        if lengths and (at != end or end - start >= RANGE_BYTES):
            yield start, lengths
            lengths = []
        if not lengths:
            start = at
        lengths.append(entry["length"])
        end = at + entry["length"]
    if lengths:
        yield start, lengths


def parse(packed: bytes) -> dict:
    """The fields of one gzipped WARC record, its payload's digest checked against the record's own."""
    head, _, block = zlib.decompress(packed, 31).partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(named["Content-Length"])]
    page = named["WARC-Record-ID"][1:-1].removeprefix(_ID)
    digest = named["WARC-Payload-Digest"].removeprefix("sha256:")
    first = named.get("WARC-Refers-To")
    payload = block.partition(b"\r\n\r\n")[2] if first is None else None
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of page {page} isn't what its digest says")
    return {
        "page_id": int(page) if page else None,
        "target_uri": named["WARC-Target-URI"],
        "record_type": named["WARC-Type"],
        "payload_bytes": int(named["X-Payload-Length"]) if payload is None else len(payload),
        "payload_digest": digest,
        "refers_to": None if first is None else int(first[1:-1].removeprefix(_ID)),
        "payload": payload,
    }


RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("target_uri", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives that `manifest.archive` names below `folder`; payload is null for revisits.

    Archives that a repeated or lost task has left behind are not in the manifest, and so are not read.
    """

    def list_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{path}/{name}") as file:
                    found = list(runs(file, file.size()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array([s for s, _ in found], pa.int64()), pa.array([n for _, n in found], pa.list_(pa.int64()))],
                    names=["archive", "start", "lengths"],
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(f"{path}/{name}") as file:
                    file.seek(start)
                    whole, at, rows = memoryview(file.read(sum(lengths))), 0, []
                for n in lengths:
                    rows.append(parse(bytes(whole[at : at + n])))
                    at += n
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    found = manifest.select("archive").mapInArrow(list_runs, "archive string, start long, lengths array<long>")
    return found.repartition(max(1, -(-total // (2 * RANGE_BYTES)))).mapInArrow(read, RECORD)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives among the run's files in the folder that all executors share."""
    return f"{shared_folder(spark)}/ledgerloom/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
