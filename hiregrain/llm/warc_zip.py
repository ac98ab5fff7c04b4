"""WARC records in ZIP-packaged archives, written and read back by range reads.

An archive is a ZIP file of stored members: archive/data-N.warc with records one after the other,
and indexes/index.cdx with a line for each record (member, offset, length). The reader takes the
end of the file, its central directory (also in ZIP64 form) and the local headers to find where a
member's bytes begin, reads the index, and then ranges of records; nothing is extracted.

Archives lie in the shared folder. A task writes under a name of its attempt and the table of
archives holds only names of attempts that ended well, so a lost executor leaves nothing wrong.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm.common import checked_broadcast, ranges, shared_folder, stored, table

#: Payloads of at least so many bytes are kept once.
LEAST_PAYLOAD = 1000
#: Bytes of records in a member, and of members in an archive, about.
MEMBER_BYTES = 8 << 20
ARCHIVE_BYTES = 128 << 20
#: Bytes of neighbouring records that are read at once.
RANGE_BYTES = 4 << 20

#: Fixed values of the ZIP format.
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR = b"PK\x06\x06", b"PK\x06\x07"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_DATE_1980 = 0x21


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that tasks reach, and its path there."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class ZipWriter:
    """Stored members one after the other; sizes and places in ZIP64 fields where needed or
    asked for."""

    def __init__(self, out, zip64: bool = True):
        self.out, self.zip64 = out, zip64
        self.at = 0
        self.central: list[bytes] = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, data: bytes) -> None:
        raw, crc, size, place = name.encode(), zlib.crc32(data), len(data), self.at
        wide = self.zip64 or size >= _FULL32 or place >= _FULL32
        short = _FULL32 if wide else size
        extra = struct.pack("<HHQQ", 1, 16, size, size) if wide else b""
        head = struct.pack(
            "<HHHHHIIIHH", 45, 0x800, 0, 0, _DATE_1980, crc, short, short, len(raw), len(extra)
        )
        self._put(_LOCAL + head + raw + extra)
        self._put(data)
        extra = struct.pack("<HHQQQ", 1, 24, size, size, place) if wide else b""
        self.central.append(
            _CENTRAL
            + struct.pack("<HHHHHHIIIHH", 45, 45, 0x800, 0, 0, _DATE_1980, crc, short, short, len(raw), len(extra))
            + struct.pack("<HHHII", 0, 0, 0, 0, _FULL32 if wide else place)
            + raw
            + extra
        )

    def close(self) -> None:
        start, count = self.at, len(self.central)
        for entry in self.central:
            self._put(entry)
        size = self.at - start
        if self.zip64 or count >= _FULL16 or start >= _FULL32:
            end64 = self.at
            self._put(_END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, size, start))
            self._put(_LOCATOR + struct.pack("<IQI", 0, end64, 1))
            count, size, start = _FULL16, _FULL32, _FULL32
        self._put(_END + struct.pack("<HHHHIIH", 0, 0, count, count, size, start, 0))


@dataclass
class Member:
    name: str
    start: int
    size: int


def members(source) -> list[Member]:
    """The stored members of an open file, with where their bytes begin."""
    total = source.size()
    tail = source.read_at(min(total, 22 + 0xFFFF + 20), max(0, total - (22 + 0xFFFF + 20)))
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if count == _FULL16 or size == _FULL32 or start == _FULL32:
        if tail[at - 20 : at - 16] != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        (place,) = struct.unpack_from("<Q", tail, at - 12)
        end64 = source.read_at(56, place)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end of a directory")
        count, size, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at, found = source.read_at(size, start), 0, []
    for _ in range(count):
        if directory[at : at + 4] != _CENTRAL:
            raise ValueError("a broken ZIP directory")
        (method,) = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        (place,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n].decode()
        extra = directory[at + 46 + n : at + 46 + n + m]
        plain, packed, place = _wide(extra, plain, packed, place)
        at += 46 + n + m + k
        if method != 0:
            raise ValueError(f"{name} is not stored")
        local = source.read_at(30, place)
        n, m = struct.unpack_from("<HH", local, 26)
        found.append(Member(name, place + 30 + n + m, plain))
    return found


def _wide(extra: bytes, *values: int) -> list[int]:
    """The values with those that do not fit taken from the ZIP64 field, in their order."""
    at, out = 0, list(values)
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            place = at + 4
            for i, value in enumerate(out):
                if value == _FULL32 and place + 8 <= at + 4 + size:
                    (out[i],) = struct.unpack_from("<Q", extra, place)
                    place += 8
        at += 4 + size
    return out


def _quoted(value: str | None) -> str:
    return "" if value is None else "".join(value.split("\r")).replace("\n", "")


def record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit has the HTTP head of its response, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {_quoted(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """What a record says: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The payload of a response is measured; a revisit has its length and digest in its heads.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    if kind == "response":
        length, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")

    def page(name: str) -> int | None:
        value = fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else ""
        return int(value) if value else None

    return {
        "page_id": page("WARC-Record-ID"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
    }


def with_roles(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """``pages`` (page_id, url, html) with digest and refers_to (null for a response).

    Only digests that occur more than once meet the pages again; html is not shuffled unless
    there are too many of them to broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= least
    copies = (
        rows.where(long)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last"))
        .where("n > 1")
        .select("digest", "last")
    )
    joined = rows.join(checked_broadcast(stored(copies)), "digest", "left")
    is_copy = long & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", "digest", F.when(is_copy, F.col("last")).alias("refers_to"))


def archived(
    rows: DataFrame,
    folder: str,
    member_bytes: int = MEMBER_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    zip64: bool = True,
) -> DataFrame:
    """Writes ``rows`` of with_roles to archives in ``folder``; (path, records) of each archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = filesystem(folder)
        paths, counts = [], []
        out = writer = None
        lines: list[str] = []
        held: list[bytes] = []
        size = number = 0

        def flush() -> None:
            nonlocal held, size, number
            if held:
                writer.add(f"archive/data-{number:05d}.warc", b"".join(held))
                held, size, number = [], 0, number + 1

        def finish() -> None:
            nonlocal out, writer, lines, number
            if writer is not None:
                flush()
                writer.add("indexes/index.cdx", "\n".join(lines).encode())
                writer.close()
                out.close()
                counts.append(len(lines))
                out, writer, lines, number = None, None, [], 0

        for batch in batches:
            for start, stop in ranges(batch.column("payload")):
                for row in batch.slice(start, stop - start).to_pylist():
                    if writer is None:
                        paths.append(posixpath.join(place, f"{uuid.uuid4().hex}.wacz"))
                        out = store.open_output_stream(paths[-1])
                        writer = ZipWriter(out, zip64)
                    page = "" if row["page_id"] is None else str(row["page_id"])
                    refers = None if row["refers_to"] is None else str(row["refers_to"])
                    raw = record(page, row["url"], row["payload"], row["digest"], refers)
                    lines.append(f"{number} {size} {len(raw)}")
                    held.append(raw)
                    size += len(raw)
                    if size >= member_bytes:
                        flush()
                    if writer.at >= archive_bytes:
                        finish()
        finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"]
        )

    store, place = filesystem(folder)
    store.create_dir(place, recursive=True)
    return stored(rows.mapInArrow(run, "path string, records long"))


def record_ranges(archives: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, lengths): neighbouring records of ``archives`` (path) to read at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as source:
                    own = {member.name: member for member in members(source)}
                    index = own["indexes/index.cdx"]
                    lines = source.read_at(index.size, index.start).decode().split("\n")
                starts, lengths = [], []
                held, before = 0, None
                for line in lines:
                    number, offset, size = map(int, line.split(" "))
                    start = own[f"archive/data-{number:05d}.warc"].start + offset
                    if start != before or held >= range_bytes:
                        starts.append(start)
                        lengths.append([])
                        held = 0
                    lengths[-1].append(size)
                    held += size
                    before = start + size
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(starts), pa.string()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.list_(pa.int64())),
                    ],
                    names=["path", "start", "lengths"],
                )

    return archives.select("path").mapInArrow(run, "path string, start long, lengths array<long>")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def records(spans: DataFrame, folder: str) -> DataFrame:
    """The records (RECORD) of ``spans`` of record_ranges, each span read at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as source:
                    raw = source.read_at(sum(row["lengths"]), row["start"])
                out, at = [], 0
                for size in row["lengths"]:
                    out.append(parsed(raw[at : at + size]))
                    at += size
                yield pa.RecordBatch.from_pylist(out, schema=_RECORD)

    return spans.mapInArrow(run, RECORD)


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to archives in the shared folder and reads them back.

    A null html is an empty payload. Of rows with the same large payload those of the largest
    page_id are responses (a null id is the smallest; all are if no id is known). An empty table gives
    no archive and no row.
    """
    folder = f"{shared_folder(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    archives = archived(with_roles(pages), folder)
    spans = record_ranges(archives.repartition("path"), folder)
    return records(spans.repartition("path", "start"), folder)


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back. A null html is an empty payload; payloads
    that repeat are revisits of the largest page_id's if they are long enough; an empty table makes
    no archive and no rows."""
    return round_trip(table(spark, sf_dir, "pages"))


OP9_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
sums AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest
  FROM payloads),
lasts AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM sums)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 1000 OR last IS NULL OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 1000 OR page_id = last THEN NULL ELSE last END AS refers_to
FROM lasts
"""
