"""WARC records in ZIP packages, written and read by range.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, one gzip member a record,
and ``indexes/index.cdx``, a line a record with the page, the offset and the length of its gzip member. The reader
looks at the end of the file for the central directory (the ZIP64 one, where the classic fields overflow), finds
the members' places from their local headers, reads the index and then each record by its range. Nothing is
extracted, and a single record costs a few small reads.

Of pages with equal payloads of at least ``MIN_REVISIT`` bytes, one is written as a response and the others as
revisits that name it; a revisit keeps the payload's digest and length.

Packages are written by the tasks to a folder that all executors share, through ``pyarrow.fs``, under names no
other attempt uses; a table of the packages that were completed says which ones count. So a task that runs again
leaves no second copy in the result. Each package holds about ``PACKAGE_BYTES`` of payload.

Defined cases: a null payload is empty, a null address is left out, line ends in addresses are escaped. A null id is
smaller than any other and read back as null. Repeated rows are records of their own; if the largest id of equal
payloads repeats, each of its rows is a response. An empty table gives no package and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide.llm.common import small_batches, utf8

MIN_REVISIT = 1000
PACKAGE_BYTES = 32 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
COMPRESSION = 6
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time, and equal input gives equal records
EOL = b"\r\n"

# Fixed values of the ZIP format.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


# --- records -----------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    return int(identifier[10:-1]) if identifier[10:-1] else None


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit of ``refers_to``: the HTTP headers alone."""
    revisit = refers_to is not None
    http = EOL.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""])
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        headers["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if revisit:
        headers |= {"WARC-Profile": IDENTICAL, "WARC-Refers-To": record_id(refers_to)}
    head = "".join(f"{name}: {value}\r\n" for name, value in headers.items()).encode()
    return b"WARC/1.1\r\n" + head + EOL + block + EOL + EOL


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record headers, HTTP headers and payload. Header names are in lower case."""

    def headers(lines: list[bytes]) -> dict[str, str]:
        return {n.strip().lower(): v.strip() for n, _, v in (line.decode().partition(":") for line in lines)}

    head, _, rest = data.partition(EOL + EOL)
    version, *lines = head.split(EOL)
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = headers(lines)
    http, _, payload = rest[: int(fields["content-length"])].partition(EOL + EOL)
    return fields, headers(http.split(EOL)[1:]), payload


# --- packages ------------------------------------------------------------------------


class PackageWriter:
    """Collects records of one package in memory, which ``PACKAGE_BYTES`` bounds."""

    def __init__(self) -> None:
        self.data, self.index, self.payload, self.records = io.BytesIO(), [], 0, 0

    def add(self, page_id: int | None, record: bytes) -> None:
        packed = gzip.compress(record, COMPRESSION, mtime=0)
        self.index.append(f"{'-' if page_id is None else page_id} {self.data.tell()} {len(packed)}\n")
        self.data.write(packed)
        self.payload += len(record)
        self.records += 1

    def write(self, out: BinaryIO) -> None:
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
            for name, data in ((INDEX, "".join(self.index).encode()), (DATA, self.data.getbuffer())):
                entry = zipfile.ZipInfo(name)  # a fixed date: equal records give equal packages
                with package.open(entry, "w", force_zip64=True) as member:
                    member.write(data)


@dataclass(frozen=True)
class Member:
    name: str
    offset: int  # of its data in the file
    size: int


class PackageReader:
    """Stored members of a ZIP file that is read by range."""

    def __init__(self, file: BinaryIO, size: int):
        self.file, self.size = file, size
        self.members = {m.name: m for m in self.directory()}

    def read(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError("the package ends early")
        return data

    def directory(self) -> Iterator[Member]:
        # The end record is the last thing but a comment of at most 65,535 bytes.
        tail_at = max(0, self.size - 22 - FULL16)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(END)
        if at < 0:
            raise ValueError("not a ZIP file")
        count, length, offset = struct.unpack_from("<HII", tail, at + 10)
        locator = tail_at + at - 20
        if locator >= 0 and (found := self.read(locator, 20))[:4] == LOCATOR64:
            end64 = self.read(struct.unpack_from("<Q", found, 8)[0], 56)
            if end64[:4] != END64:
                raise ValueError("the ZIP64 end record is missing")
            count, length, offset = struct.unpack_from("<QQQ", end64, 32)
        central, at = self.read(offset, length), 0
        for _ in range(count):
            if central[at : at + 4] != CENTRAL:
                raise ValueError("the central directory is damaged")
            method = struct.unpack_from("<H", central, at + 10)[0]
            packed, size, names, extras, comments = struct.unpack_from("<IIHHH", central, at + 20)
            local = struct.unpack_from("<I", central, at + 42)[0]
            name = central[at + 46 : at + 46 + names].decode()
            extra = central[at + 46 + names : at + 46 + names + extras]
            size, packed, local = self.wide(extra, size, packed, local)
            if method != 0 or packed != size:
                raise ValueError(f"{name} is compressed, so it has no ranges")
            yield Member(name, self.data_offset(local), size)
            at += 46 + names + extras + comments

    @staticmethod
    def wide(extra: bytes, *fields: int) -> list[int]:
        """Fields that are full are in the ZIP64 extra field, in this order."""
        values: list[int] = []
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:
                values = list(struct.unpack_from(f"<{length // 8}Q", extra, 4))
            extra = extra[4 + length :]
        return [values.pop(0) if f == FULL32 and values else f for f in fields]

    def data_offset(self, local: int) -> int:
        header = self.read(local, 30)
        if header[:4] != LOCAL:
            raise ValueError("a local header is missing")
        names, extras = struct.unpack_from("<HH", header, 26)
        return local + 30 + names + extras

    def index(self) -> Iterator[tuple[int, int]]:
        """Offset and length of each record in the data member."""
        member = self.members[INDEX]
        for line in self.read(member.offset, member.size).decode().splitlines():
            _, offset, length = line.split(" ")
            yield int(offset), int(length)

    def record(self, offset: int, length: int) -> bytes:
        member = self.members[DATA]
        if offset + length > member.size:
            raise ValueError("a record lies outside its member")
        return zlib.decompress(self.read(member.offset + offset, length), wbits=31)


# --- Spark ----------------------------------------------------------------------------


def with_decisions(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``; ``refers_to`` is null for responses.

    Only digests and ids are grouped. The join back is by digest; a payload that a third of the pages have is split by
    the adaptive skew join.
    """
    payload = utf8("html")
    wide = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    wide = wide.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= min_revisit
    alike = wide.filter(large).groupBy(F.col("digest").alias("_digest")).agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    joined = wide.join(alike.filter("n > 1").drop("n"), (F.col("digest") == F.col("_digest")) & large, "left").drop("_digest")
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))).drop("last")


def write_packages(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes the packages below ``path`` and returns the table of them, ``package, records, size``."""
    spark = pages.sparkSession
    small_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        held = PackageWriter()

        def flush() -> Iterator[pa.RecordBatch]:
            if held.records:
                store.create_dir(folder, recursive=True)
                name = f"{uuid.uuid4().hex}.wacz"
                with store.open_output_stream(f"{folder}/{name}") as out:
                    buffer = io.BytesIO()
                    held.write(buffer)
                    out.write(buffer.getbuffer())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([held.records], pa.int64()), pa.array([buffer.tell()], pa.int64())], ["package", "records", "size"]
                )

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.add(page_id, make_record(page_id, url, payload, digest, refers_to))
                if held.payload >= package_bytes:
                    yield from flush()
                    held = PackageWriter()
        yield from flush()

    rows = with_decisions(pages, min_revisit).select("page_id", "url", "payload", "digest", "refers_to")
    rows.mapInArrow(write, "package string, records long, size long").write.parquet(f"{path}-packages")
    return spark.read.parquet(f"{path}-packages")


#: Tasks of a reader for each core, if there are as many packages.
READ_WAVES = 4


def read_packages(packages: DataFrame, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record, and its ``url`` and ``payload``.

    The digest of a response is computed from the payload that was read; it must be the one in its header.
    """
    small_batches(packages.sparkSession)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [f.split()[0] for f in schema.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{folder}/{name}") as file:
                    reader, rows, held = PackageReader(file, size), [], 0
                    for offset, length in reader.index():
                        fields, http, payload = parse_record(reader.record(offset, length))
                        digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
                        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{fields['warc-record-id']}: the payload is damaged")
                        refers_to = page_of(fields["warc-refers-to"]) if kind == "revisit" else None
                        rows.append((page_of(fields["warc-record-id"]), int(http["content-length"]), digest, kind, refers_to, fields.get("warc-target-uri"), payload))
                        held += len(payload)
                        if held > 1 << 22 or len(rows) >= 512:
                            yield as_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield as_batch(rows)

    # Packages are about equally large, and their names random. A given number of tasks is not merged by adaptive execution,
    # to which a table of names looks small.
    tasks = min(packages.count(), READ_WAVES * packages.sparkSession.sparkContext.defaultParallelism)
    return packages.select("package", "size").repartitionByRange(max(1, tasks), "package").mapInArrow(read, schema)
