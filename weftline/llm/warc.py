"""WARC records in ZIP packages, written and read back by ranges.

A package is a ZIP archive that holds two stored members: ``archive/data.warc.gz``, one gzip member a record, and
``indexes/index.cdxj``, a line for each record with its offset and length in the first. Each writing task makes
packages of bounded size in the shared folder and reports their paths; the reports are a table, so what an attempt of a lost
executor left is in no report and is never read. The reader takes the end record, the ZIP64 records and the central
directory from the tail of a package, finds the members, and reads ranges of records by the index.

Records of equal payloads of ``LEAST`` bytes or more are told apart by digest and length: those with the largest
page_id are responses (all of them, if several rows have it), the others revisits that name it. A null
page_id is smaller than any other; rows with null ids alone are responses. A null html is an empty payload, a null url is written
as an empty one. Line ends in a url are percent-encoded. An empty table writes no package and reads as no record.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.settings import shared_dir, written

LEAST = 1000
PACKAGE = 16 << 20
RANGE = 4 << 20
DATE = "1970-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


# --- records ---------------------------------------------------------------------------------------------------


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit (without payload) of the response that ``refers_to`` names."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, dict(line.split(": ", 1) for line in http.decode("latin-1").split("\r\n")[1:]), payload


# --- packages --------------------------------------------------------------------------------------------------


def package(records: list[tuple[int | None, bytes]]) -> bytes:
    """A ZIP archive of compressed records and their index."""
    lines, at = [], 0
    for page_id, blob in records:
        lines.append(json.dumps({"page_id": page_id, "offset": at, "length": len(blob)}))
        at += len(blob)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as f:
            for _, blob in records:
                f.write(blob)
        z.writestr(zipfile.ZipInfo(INDEX), "".join(line + "\n" for line in lines))
    return out.getvalue()


class Package:
    """A ZIP archive read by ranges. ``read(offset, length)`` gives bytes of the archive."""

    def __init__(self, read, size: int):
        self.read, self.size = read, size
        self.members = self._members()

    def _members(self) -> dict[str, tuple[int, int]]:
        """Name to (offset of the local header, size) of the stored members."""
        back = min(self.size, 22 + 0xFFFF + 20)
        tail = self.read(self.size - back, back)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end of central directory")
        count, length, offset = struct.unpack("<HII", tail[at + 10 : at + 20])
        if (count == 0xFFFF or 0xFFFFFFFF in (length, offset)) and tail[at - 20 : at - 16] == b"PK\x06\x07":
            (end,) = struct.unpack("<Q", tail[at - 12 : at - 4])
            record = self.read(end, 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            length, offset = struct.unpack("<QQ", record[40:56])
        found, entries, i = {}, self.read(offset, length), 0
        while entries[i : i + 4] == b"PK\x01\x02":
            flags, method = struct.unpack("<HH", entries[i + 8 : i + 12])
            packed, plain, n_name, n_extra, n_comment = struct.unpack("<IIHHH", entries[i + 20 : i + 34])
            (start,) = struct.unpack("<I", entries[i + 42 : i + 46])
            name = entries[i + 46 : i + 46 + n_name]
            extra = entries[i + 46 + n_name : i + 46 + n_name + n_extra]
            while len(extra) >= 4:
                kind, size = struct.unpack("<HH", extra[:4])
                if kind == 1:  # of the three, those that do not fit in 32 bits, in this order
                    wide = list(struct.unpack(f"<{size // 8}Q", extra[4 : 4 + size // 8 * 8]))
                    plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    start = wide.pop(0) if start == 0xFFFFFFFF else start
                extra = extra[4 + size :]
            if method == 0 and not flags & 1:
                found[name.decode("utf-8" if flags & 0x800 else "cp437")] = (start, packed)
            i += 46 + n_name + n_extra + n_comment
        return found

    def place(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes."""
        start, size = self.members[name]
        n_name, n_extra = struct.unpack("<HH", self.read(start + 26, 4))
        return start + 30 + n_name + n_extra, size

    def records(self) -> Iterator[tuple[dict, bytes]]:
        """Index lines and their records, whose bytes are read in ranges of bounded size."""
        start, _ = self.place(DATA)
        lines = [json.loads(x) for x in self.read(*self.place(INDEX)).splitlines()]
        i = 0
        while i < len(lines):
            first, j = lines[i]["offset"], i + 1
            while j < len(lines) and lines[j]["offset"] + lines[j]["length"] - first <= RANGE and lines[j]["offset"] >= first:
                j += 1
            stretch = self.read(start + first, max(x["offset"] + x["length"] for x in lines[i:j]) - first)
            for x in lines[i:j]:
                at = x["offset"] - first
                yield x, zlib.decompress(stretch[at : at + x["length"]], 31)
            i = j


# --- Spark jobs ------------------------------------------------------------------------------------------------


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        records: list[tuple[int | None, bytes]] = []
        size = 0

        def out() -> pa.RecordBatch:
            name = f"{uuid.uuid4()}.wacz"
            with system.open_output_stream(f"{path}/{name}") as f:
                f.write(package(records))
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(records)], pa.int64())], ["path", "records"])

        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (batch.column(i)[row].as_py() for i in range(5))
                compress = zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = record(page_id, url, html, digest, refers_to)
                records.append((page_id, compress.compress(raw) + compress.flush()))
                size += len(records[-1][1])
                if size > PACKAGE:
                    yield out()
                    records, size = [], 0
        if records:
            yield out()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            system, path = fs.FileSystem.from_uri(uri)
            rows: list[tuple] = []
            with system.open_input_file(path) as f:
                for _, raw in Package(lambda offset, length, f=f: f.read_at(length, offset), f.size()).records():
                    headers, http, payload = parsed(raw)
                    revisit = headers["WARC-Type"] == "revisit"
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and sha1(payload, usedforsecurity=False).hexdigest() != digest:
                        raise ValueError(f"record {headers['WARC-Record-ID']} of {uri} does not match its digest")
                    rows.append((_page(headers["WARC-Record-ID"]), int(http["Content-Length"]) if revisit else len(payload), digest, headers["WARC-Type"], _page(headers.get("WARC-Refers-To"))))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])


def write(pages: DataFrame) -> DataFrame:
    """Packages of the rows (page_id, url, html) in the shared folder: path and number of records."""
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4()}"
    if "://" not in folder:
        folder = f"file://{folder}"
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size"))
    same = rows.where(F.col("size") >= LEAST).groupBy("digest", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").drop("n")
    rows = rows.join(written(same, "same"), ["digest", "size"], "left")
    revisit = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last"))
    rows = rows.select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest", revisit.alias("refers_to"))
    return written(rows.mapInArrow(_write(folder), "path string, records long"), "packages")


def read(packages: DataFrame) -> DataFrame:
    """Records of the packages at ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    n = packages.count()
    return packages.select("path").repartition(max(1, n)).mapInArrow(_read, SCHEMA)


SQL = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, CASE WHEN payload_bytes >= {LEAST} THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last IS DISTINCT FROM page_id AND last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM q
"""
