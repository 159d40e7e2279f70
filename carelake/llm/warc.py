"""WARC records in ZIP-packaged archives: write, locate, range-read.

An archive is a ZIP file with stored (not deflated) members:
``archive/data.warc.gz`` holds the records, each a gzip member of its own, and
``indexes/index.cdx`` one line of JSON per record with its offset and length.
As members are stored, a record's place in the archive is the member's place
plus its offset, so a reader needs no extraction: it reads the end of the file
(end-of-central-directory record, ZIP64 locator and directory), the central
directory, each member's local header, the index, and then the byte ranges of
the records it wants.

Writing: payloads are told apart by SHA-1 and length.  Of rows with equal
payloads of ``least`` bytes or more, the one with the largest page_id is the
response and the others are revisit records without payload, so a payload is
written once.  Digests that many rows share are few and are broadcast; the rest
meet their group by a shuffle on the digest, and no group is gathered anywhere.
A task streams its records into archives of at most ``ARCHIVE_BYTES`` (or one
larger record); the table of written archives names only those of tasks that
succeeded, so files of lost or repeated tasks are never read.

Reading: a task per archive parses the directories and the index and deals
byte ranges of about ``RANGE_BYTES``; other tasks read the ranges, check each
payload against its digest and give one row per record.

Cases: a null html is an empty payload; a null page_id is smaller than all
others and is written as ``null``; rows that share both payload and the largest
page_id can't be told apart and are all responses; a null url has no target
header, and control characters and spaces of a url are percent-encoded; an
empty table has no archive; other columns aren't read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import cut, table
from carelake.session import shared_dir

ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
#: packed bytes that a reading task takes
TASK_BYTES = 16 << 20
#: a digest shared by more than this part of all rows is broadcast; there are at most as many
HOT_PART = 4_000
DATE = "2000-01-01T00:00:00Z"
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SQL = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS last FROM p),
b AS (SELECT *, list_reduce(list_transform(range(1, 41), lambda i: format('{:04b}', instr('0123456789abcdef', x[i]) - 1)), lambda s, t: s || t) AS bits FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
         1 + 16 * CAST(bits[5 * i + 1] AS INTEGER) + 8 * CAST(bits[5 * i + 2] AS INTEGER) + 4 * CAST(bits[5 * i + 3] AS INTEGER)
         + 2 * CAST(bits[5 * i + 4] AS INTEGER) + CAST(bits[5 * i + 5] AS INTEGER)]), lambda s, t: s || t) AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM b"""


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


# ── ZIP directories ───────────────────────────────────────────────────────

# Fixed values of the ZIP format: signatures and sizes of its records.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
EOCD_SIZE, LOCATOR_SIZE, EOCD64_SIZE, CENTRAL_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
ZIP64_EXTRA = 1


class Archive:
    """The members of a ZIP file, found from its directories by range reads."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        self.members = {name: (start, size, stored) for name, start, size, stored in self._directory()}

    def read(self, start: int, size: int) -> bytes:
        data = self.file.read_at(size, start) if size else b""
        if len(data) != size:
            raise ValueError(f"the archive ends before byte {start + size}")
        return data

    def _directory(self) -> Iterator[tuple[str, int, int, bool]]:
        length = self.file.size()
        # the end record stands before a comment of at most 65535 bytes
        tail_at = max(0, length - EOCD_SIZE - 0xFFFF)
        tail = self.read(tail_at, length - tail_at)
        at = tail.rfind(EOCD)
        while at >= 0 and (len(tail) - at < EOCD_SIZE or at + EOCD_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(EOCD, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory")
        count, size, start = struct.unpack_from("<HII", tail, at + 10)
        end = tail_at + at  # where the central directory must end
        if 0xFFFF == count or 0xFFFFFFFF in (size, start):
            locator = self.read(tail_at + at - LOCATOR_SIZE, LOCATOR_SIZE) if tail_at + at >= LOCATOR_SIZE else b""
            if locator[:4] == LOCATOR64:
                end = self._find64(struct.unpack_from("<Q", locator, 8)[0], tail_at + at - LOCATOR_SIZE)
                count, size, start = struct.unpack_from("<QQQ", self.read(end, EOCD64_SIZE), 32)
        # bytes before the first member (a file may have a prefix) move all offsets
        shift = end - size - start
        yield from self._entries(self.read(start + shift, size), count, shift)

    def _find64(self, said: int, before: int) -> int:
        """Where the ZIP64 end record is: where the locator says, or right before it."""
        for at in (said, before - EOCD64_SIZE):
            if 0 <= at <= before - EOCD64_SIZE and self.read(at, 4) == EOCD64:
                return at
        raise ValueError("no ZIP64 end of a central directory")

    def _entries(self, directory: bytes, count: int, shift: int) -> Iterator[tuple[str, int, int, bool]]:
        at = 0
        for _ in range(count):
            if directory[at:at + 4] != CENTRAL:
                raise ValueError("no entry of a central directory")
            flags, method = struct.unpack_from("<HH", directory, at + 8)
            packed, size, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
            offset, = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + CENTRAL_SIZE:at + CENTRAL_SIZE + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = directory[at + CENTRAL_SIZE + n_name:at + CENTRAL_SIZE + n_name + n_extra]
            packed, offset = self._wide(extra, size, packed, offset)
            yield name, offset + shift, packed, method == 0
            at += CENTRAL_SIZE + n_name + n_extra + n_comment

    @staticmethod
    def _wide(extra: bytes, size: int, packed: int, offset: int) -> tuple[int, int]:
        """Packed size and offset, from the ZIP64 field where the short ones are full."""
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == ZIP64_EXTRA:
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
                if size == 0xFFFFFFFF:
                    next(values)
                packed = next(values) if packed == 0xFFFFFFFF else packed
                offset = next(values) if offset == 0xFFFFFFFF else offset
            at += 4 + n
        return packed, offset

    def data(self, name: str) -> tuple[int, int]:
        """First byte and length of a stored member's data."""
        at, size, stored = self.members[name]
        if not stored:
            raise ValueError(f"{name} isn't stored and can't be read by ranges")
        header = self.read(at, LOCAL_SIZE)
        if header[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        n_name, n_extra = struct.unpack_from("<HH", header, 26)
        return at + LOCAL_SIZE + n_name + n_extra, size


# ── records ───────────────────────────────────────────────────────────────

def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _url_text(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, n_bytes: int, refers_to: int | None) -> bytes:
    """A WARC record, gzipped; without ``payload`` a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    page = "null" if page_id is None else page_id
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {DATE}",
             *([] if url is None else [f"WARC-Target-URI: {_url_text(url)}"]),
             *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if payload is None else []),
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(record headers, HTTP headers, payload) of a gzipped record."""
    data = zlib.decompress(data, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = dict(x.split(": ", 1) for x in lines)
    http, _, payload = rest[:int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


class Writer:
    """Streams records into an archive; the file appears when it is closed."""

    def __init__(self, folder: str):
        self.fs, base = open_fs(folder)
        name = f"{uuid.uuid4().hex}.zip"
        self.path, self._path = f"{folder}/{name}", f"{base}/{name}"
        self.fs.create_dir(base, recursive=True)
        self._out = self.fs.open_output_stream(self._path + ".part")
        self._zip = zipfile.ZipFile(self._out, "w", zipfile.ZIP_STORED)
        self._records = self._zip.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)
        self.size, self._index = 0, []

    def add(self, page_id: int | None, url: str | None, data: bytes, digest: str, kind: str) -> None:
        self._records.write(data)
        self._index.append(json.dumps({"page_id": page_id, "url": url, "type": kind, "digest": digest, "offset": self.size, "length": len(data)}))
        self.size += len(data)

    def close(self) -> tuple[str, int]:
        """(path, records)."""
        self._records.close()
        self._zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self._index))
        self._zip.close()
        self._out.close()
        self.fs.move(self._path + ".part", self._path)
        return self.path, len(self._index)


# ── jobs ──────────────────────────────────────────────────────────────────

def mark_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, html, digest, n_bytes, refers_to, revisit) per row of
    ``pages`` (page_id, url, html); a revisit has no html."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(F.encode(html, "utf-8")).alias("digest"),
                        F.octet_length(html).cast("long").alias("n_bytes"))
    groups = cut(rows.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1"))
    total = groups.agg(F.sum("n")).first()[0] or 0
    bound = max(1000, total // HOT_PART)
    hot = groups.where(F.col("n") > bound).select(F.col("digest").alias("hot_digest"), F.col("n_bytes").alias("hot_bytes"), F.col("last").alias("hot_last"))
    rows = rows.join(F.broadcast(hot), (F.col("digest") == F.col("hot_digest")) & (F.col("n_bytes") == F.col("hot_bytes")), "left")
    # rows of a hot group are spread, and their payload is left behind before the shuffle
    is_hot = F.col("hot_digest").isNotNull()
    spread = F.when(is_hot, F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))).otherwise(F.col("digest"))
    gone = is_hot & ~F.col("page_id").eqNullSafe(F.col("hot_last"))
    rows = rows.withColumn("key", spread).withColumn("html", F.when(~gone, F.col("html")))
    warm = groups.where(F.col("n") <= bound).select(F.col("digest").alias("key"), F.col("n_bytes").alias("warm_bytes"), F.col("last"), F.lit(True).alias("warm"))
    rows = rows.join(warm, (rows["key"] == warm["key"]) & (rows["n_bytes"] == warm["warm_bytes"]), "left").drop(warm["key"])
    last = F.when(is_hot, F.col("hot_last")).otherwise(F.col("last"))
    revisit = (is_hot | F.coalesce("warm", F.lit(False))) & ~F.col("page_id").eqNullSafe(last)
    return rows.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "digest", "n_bytes", F.when(revisit, last).alias("refers_to"),
                       revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Writes the pages (page_id, url, html) as archives under ``folder``, a
    shared one; returns the written archives (path, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for r in batch.to_pylist():
                writer = writer or Writer(folder)
                payload = None if r["revisit"] else (r["html"] or "").encode()
                digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                writer.add(r["page_id"], r["url"], record(r["page_id"], r["url"], payload, digest, r["n_bytes"], r["refers_to"]), digest,
                           "revisit" if r["revisit"] else "response")
                if writer.size >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    return cut(mark_revisits(pages, least).mapInArrow(run, "path string, records long"))


RANGE_DDL = "path string, start long, size long, lengths array<int>"


def locate(archives: DataFrame) -> DataFrame:
    """(path, start, size, lengths): byte ranges of consecutive records of the
    archives (path), from their directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = open_fs(path)
                with fs.open_input_file(name) as file:
                    archive = Archive(file)
                    base, size = archive.data(RECORDS)
                    index = archive.read(*archive.data(INDEX)).decode()
                out, last, lengths = [], None, []
                for line in index.split("\n") if index else []:
                    at = json.loads(line)
                    if at["offset"] + at["length"] > size:
                        raise ValueError(f"{path}: the index points behind the records")
                    if last is None or at["offset"] != last[1] or at["offset"] - last[0] >= RANGE_BYTES:
                        if last is not None:
                            out.append((path, base + last[0], last[1] - last[0], lengths))
                        last, lengths = (at["offset"], at["offset"]), []
                    last = (last[0], at["offset"] + at["length"])
                    lengths.append(at["length"])
                if last is not None:
                    out.append((path, base + last[0], last[1] - last[0], lengths))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (
                    pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32())))], names=["path", "start", "size", "lengths"])

    return cut(archives.select("path").mapInArrow(run, RANGE_DDL))


ROW_DDL = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page(urn: str | None) -> int | None:
    page = urn[len("<urn:page:"):-1] if urn else "null"
    return None if page == "null" else int(page)


def read_records(ranges: DataFrame, payload: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to)
    per record of the byte ranges, with ``payload`` also its text, null for
    revisits.  A payload that doesn't have its digest is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fs, name = open_fs(r["path"])
                with fs.open_input_file(name) as file:
                    data = memoryview(file.read_at(r["size"], r["start"]))
                at, out = 0, []
                for n in r["lengths"]:
                    headers, http, body = parse(data[at:at + n])
                    at += n
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = headers["WARC-Type"] == "response"
                    if response and digest32(body) != digest:
                        raise ValueError(f"{r['path']}: a payload isn't what its digest says")
                    n_bytes = len(body) if response else int(http["Content-Length"])
                    out.append((_page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), n_bytes, digest, headers["WARC-Type"],
                                _page(headers.get("WARC-Refers-To")), *([body.decode() if response else None] if payload else [])))
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names[:len(types) if payload else -1])

    # ranges are short rows, so the number of tasks follows the bytes behind them
    tasks = -(-(ranges.agg(F.sum("size")).first()[0] or 1) // TASK_BYTES)
    return ranges.repartition(tasks, "path", "start").mapInArrow(run, ROW_DDL + (", payload string" if payload else ""))


def archive_folder(spark: SparkSession) -> str:
    return shared_dir(spark, "carelake-llm", f"warc-{uuid.uuid4().hex}")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = write_archives(pages, archive_folder(spark), least=0)
    return read_records(locate(archives)).drop("url")
