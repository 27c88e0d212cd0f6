"""Legacy web archives (ARC, versions 1 and 2) to WARC 1.1.

An ARC file is a version block and then documents.  Each has a header line of
space-separated fields, the last of which is the length of the content, then
that many bytes, then a line feed.  The version block's content names the
version and, in its last line, the fields of the header lines that follow:

    1  URL IP-address Archive-date Content-type Archive-length
    2  URL IP-address Archive-date Content-type Result-code Checksum Location
       Offset Filename Archive-length

``write_arcs`` writes pages as such files, ``arc_records`` parses them by
their declared lengths, ``convert`` makes the equivalent WARC files and
``warc_records`` reads those back.  What a WARC record needs and an ARC
document lacks is made from it: the identifier is a UUID of the archive's name
and the document's offset (so a rerun gives the same), the date the 14-digit
archive date, the type ``response``, or ``revisit`` where another document has
the same payload, and SHA-1 digests of payload and block.

Of the documents with equal payloads (SHA-256 and length) of at least
``min_bytes`` the one with the largest page id is the response, the others
revisit it; of several with that id the one of the largest record identifier.
Null ids count as smallest.  A null payload is an empty one.  An empty table
gives no archives and no rows.

Archives are cut at about ``ARCHIVE_BYTES``, so a task reads one of bounded
size at a time (a larger document is an archive of its own), whatever the
partitions hold.  The decision who is a response is one aggregate per payload
digest, combined on the map side; it meets rows of the index, not payloads, in
a join whose hot keys can be split, and then the archives by their names.
Files are written by Spark's text writer (the line separator is the archive's
own record end), so Spark commits them on any store; they are gzip files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm.components import written
from wardstat.llm.ship import ship
from wardstat.session import scratch_path

ARCHIVE_BYTES = 16 << 20
RECORD_BYTES = 8 << 20  # content bytes of one batch of parsed records
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

# --- fixed values: the formats' names ---------------------------------------------
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_END = "\n"
WARC_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# ----------------------------------------------------------------------------------

PAGE_ID = "X-Page-Id"  # a header of the archived response
REFERS_TO_PAGE = "X-Refers-To-Page-Id"  # an extension field of revisits


class ArchiveError(ValueError):
    """An archive that does not keep its format."""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(value: str | None) -> str:
    """A header field without spaces; "-" for none."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value) if value else "-"


# --- writing ARC ------------------------------------------------------------------------


def version_block(version: int, name: str, date: str) -> bytes:
    """The first record of an ARC file."""
    body = f"{version} 0 wardstat\n{ARC_FIELDS[version]}\n".encode()
    return _arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", body, {"Filename": name})


def _arc_record(version: int, url: str, ip: str, date: str, kind: str, content: bytes, more: dict[str, str]) -> bytes:
    known = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Archive-length": str(len(content)), **more}
    head = " ".join(known.get(f, "-") for f in ARC_FIELDS[version].split(" "))
    return head.encode() + b"\n" + content


def http_response(page_id: object, payload: bytes) -> bytes:
    own = "" if page_id is None else f"{PAGE_ID}: {page_id}\r\n"
    return f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{own}\r\n".encode() + payload


def write_arcs(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "20000101000000", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write pages as gzipped ARC files below ``path``, one folder each;
    archives take version 1 and 2 in turn."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    schema = pa.schema([("archive", pa.string()), ("place", pa.int64()), ("record", pa.binary())])

    def run(batches):
        part, number, place, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for row in _slices(batch):
                out = []
                for x in row.to_pylist():
                    if size >= archive_bytes:
                        number, place, size = number + 1, 0, 0
                    name, version = f"p{part:06d}-{number:06d}", 1 + (part + number) % 2
                    if not place:
                        out.append((name, 0, version_block(version, f"{name}.arc.gz", date)))
                    content = http_response(x["id"], (x["html"] or "").encode())
                    more = {"Result-code": "200", "Checksum": base32_sha1(content), "Offset": str(size), "Filename": f"{name}.arc.gz"}
                    record = _arc_record(version, _field(x["url"]), "0.0.0.0", date, "text/html", content, more)
                    place, size = place + 1, size + len(record) + 1
                    out.append((name, place, record))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    records = rows.mapInArrow(run, "archive string, place long, record binary")
    _write_archives(records, path, ARC_END)


def _write_archives(records: DataFrame, path: str, end: str) -> None:
    """(archive, place, record) rows as one gzip file per archive."""
    ordered = records.sortWithinPartitions("archive", "place").select("archive", F.col("record").cast("string").alias("value"))
    ordered.write.partitionBy("archive").option("compression", "gzip").option("lineSep", end).text(path)


def _slices(batch: pa.RecordBatch, limit: int = RECORD_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of about ``limit`` bytes."""
    each = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, each):
        yield batch.slice(at, each)


# --- reading ARC ------------------------------------------------------------------------


class _Bytes:
    """Lines and counted bytes of a gzip (or plain) file held in memory."""

    def __init__(self, data: bytes) -> None:
        zipped = data[:2] == b"\x1f\x8b"
        self.rest, self.held, self.at, self.offset = memoryview(data), b"", 0, 0
        self.unzip = zlib.decompressobj(31) if zipped else None

    def _more(self) -> bool:
        if not len(self.rest):
            return False
        if self.unzip is None:
            fresh, self.rest = bytes(self.rest), self.rest[:0]
        else:
            fresh = self.unzip.decompress(self.rest[: 1 << 16])
            self.rest = self.rest[1 << 16 :]
            while self.unzip.unused_data:  # the next member of the file
                left = self.unzip.unused_data
                self.unzip = zlib.decompressobj(31)
                fresh += self.unzip.decompress(left)
        self.held, self.at = self.held[self.at :] + fresh, 0
        return True

    def some(self) -> bool:
        """Whether a byte is left."""
        while self.at == len(self.held):
            if not self._more():
                return False
        return True

    def take(self, n: int) -> bytes:
        if len(self.held) - self.at < n:
            parts, need = [self.held[self.at :]], n - (len(self.held) - self.at)
            self.held, self.at = b"", 0
            while need > 0:
                if not self._more():
                    raise ArchiveError(f"{need} bytes are missing at {self.offset}")
                part = self.held[:need]
                self.at = len(part)
                parts.append(part)
                need -= len(part)
            out = b"".join(parts)
        else:
            out = self.held[self.at : self.at + n]
            self.at += n
        self.offset += n
        return out

    def line(self) -> bytes | None:
        """The bytes to the next line feed, without it; None at the end."""
        while (end := self.held.find(b"\n", self.at)) < 0:
            if not self._more():
                if self.at < len(self.held):
                    raise ArchiveError(f"a line without an end at {self.offset}")
                return None
        out = self.held[self.at : end]
        self.offset += end + 1 - self.at
        self.at = end + 1
        return out


@dataclass
class ArcRecord:
    offset: int
    url: str
    ip: str
    date: str
    kind: str
    content: bytes

    @property
    def payload(self) -> bytes:
        return self.content[self.head_length :]

    @property
    def head_length(self) -> int:
        """Bytes of the archived response's own headers; 0 without them."""
        if not self.content.startswith(b"HTTP/"):
            return 0
        at = self.content.find(b"\r\n\r\n")
        return len(self.content) if at < 0 else at + 4

    def header(self, name: str) -> str | None:
        for line in self.content[: self.head_length].split(b"\r\n")[1:]:
            key, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            if key.lower() == name.lower():
                return value.strip()
        return None


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The documents of an ARC file, its version block first.  Header lines
    are read by the fields that the version block names.  A URL with a space
    in it is what stands before the other fields."""
    source = _Bytes(data)
    fields: list[str] = []
    while True:
        offset, head = source.offset, source.line()
        if head is None:
            return
        if not head.strip(b"\r"):
            continue  # blank lines between documents
        parts = head.decode("utf-8", "surrogateescape").rstrip("\r").split(" ")
        if not parts[-1].isdigit():
            raise ArchiveError(f"no length in the header line at {offset}")
        content = source.take(int(parts[-1]))
        if not fields:
            if not parts[0].startswith("filedesc://"):
                raise ArchiveError("the file has no version block")
            told = content.decode("utf-8", "replace").split("\n")
            if told[0].split(" ")[0] not in ("1", "2") or len(told) < 2:
                raise ArchiveError(f"unknown version {told[0][:40]!r}")
            fields = told[1].strip().split(" ")
            known = dict(zip(("URL", "IP-address", "Archive-date", "Content-type"), parts))
        else:
            spare = len(parts) - len(fields)
            if spare < 0:
                raise ArchiveError(f"{-spare} fields are missing at {offset}")
            known = dict(zip(fields, [" ".join(parts[: spare + 1]), *parts[spare + 1 :]]))
        yield ArcRecord(offset, known["URL"], known["IP-address"], known["Archive-date"], known["Content-type"], content)
        if source.some() and source.take(1) != b"\n":
            raise ArchiveError(f"the document at {offset} is longer than it says")


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{archive}#{offset}')}>"


def warc_date(date: str) -> str:
    """ISO 8601 of an archive date of 8 to 14 digits."""
    d = (date + "00000000000000")[:14] if date.isdigit() and len(date) >= 8 else "00010101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)


def _archive_name(path: str) -> str:
    return re.search(r"archive=([^/]+)/", path)[1]


_ARC_SCHEMA = (
    "archive string, place long, record_id string, warcinfo_id string, url string, ip string, date string, kind string, page_id string, "
    "payload_bytes long, payload_sha1 string, payload_sha256 string, content binary"
)


def _documents(path: str, data: bytes) -> Iterator[dict]:
    """The documents of one ARC file with what their WARC records need; the
    version block has place 0."""
    name = _archive_name(path)
    for place, r in enumerate(parse_arc(data)):
        payload = r.payload
        yield {
            "archive": name, "place": place, "record_id": record_id(name, r.offset), "warcinfo_id": record_id(name, 0), "url": r.url,
            "ip": r.ip, "date": warc_date(r.date), "kind": r.kind, "page_id": r.header(PAGE_ID), "payload_bytes": len(payload),
            "payload_sha1": base32_sha1(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "content": r.content,
        }


def _sized(rows: Iterator[dict], schema: pa.Schema, column: str) -> Iterator[pa.RecordBatch]:
    """Batches of about ``RECORD_BYTES`` of the column."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[column])
        if size >= RECORD_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def arc_records(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """Every document of the ARC files below ``path``, with or without its
    content."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(spark)
    ddl = _ARC_SCHEMA if content else _ARC_SCHEMA.replace(", content binary", "")
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for batch in batches:
            for path_, data in zip(batch.column("path"), batch.column("content")):
                yield from _sized(_documents(path_.as_py(), data.as_py()), schema, "content" if content else "url")

    return _files(spark, path).select("path", "content").mapInArrow(run, ddl)


# --- WARC -------------------------------------------------------------------------------


def _warc(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogateescape") + block


def warc_record(row: dict) -> bytes:
    """The WARC record of a parsed ARC document; with ``refers_to`` a revisit,
    whose block is the archived headers alone."""
    content = row["content"]
    common = [("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"])]
    if row["place"] == 0:
        told = content.decode("utf-8", "replace").split("\n")
        block = f"software: wardstat\r\nformat: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\ndescription: from ARC version {told[0]}\r\n"
        return _warc("warcinfo", [*common, ("WARC-Filename", f"{row['archive']}.warc.gz"), ("Content-Type", "application/warc-fields")], block.encode())
    http = content.startswith(b"HTTP/")
    common += [
        ("WARC-Target-URI", row["url"]), ("WARC-IP-Address", row["ip"]), ("WARC-Warcinfo-ID", row["warcinfo_id"]),
        ("WARC-Payload-Digest", f"sha1:{row['payload_sha1']}"), ("Content-Type", "application/http;msgtype=response" if http else row["kind"]),
    ]
    if row["refers_to"] is None:
        return _warc("response" if http else "resource", common, content)
    common += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", row["refers_to"]), ("WARC-Refers-To-Target-URI", row["refers_url"]), ("WARC-Refers-To-Date", row["refers_date"])]
    if row["refers_page"] is not None:
        common.append((REFERS_TO_PAGE, row["refers_page"]))
    return _warc("revisit", common, content[: len(content) - row["payload_bytes"]])


_REFERS = ("refers_to", "refers_page", "refers_url", "refers_date")


def revisits(index: DataFrame, min_bytes: int = 0, id_type: str = "long") -> DataFrame:
    """(archive, place, refers_to, refers_page, refers_url, refers_date) of the
    documents that revisit another one."""
    key = ["payload_bytes", "payload_sha256"]
    docs = index.filter((F.col("place") > 0) & (F.col("payload_bytes") >= min_bytes))
    told = [F.col(c).alias(r) for c, r in zip(("record_id", "page_id", "url", "date"), _REFERS)]
    best = F.max(F.struct(F.col("page_id").cast(id_type).alias("id"), *told)).alias("best")
    groups = docs.groupBy(*key).agg(best, F.count(F.lit(1)).alias("n")).filter("n > 1")
    # written, so that the join has a shuffle of its own whose hot partitions can be split
    groups = written(groups.select(*key, "best.*").drop("id"), "arc-payloads")
    return docs.select(*key, "archive", "place", "record_id").join(groups, key).filter("record_id != refers_to").select("archive", "place", *_REFERS)


def convert(spark: SparkSession, arcs: str, path: str, min_bytes: int = 0, id_type: str = "long") -> None:
    """Write the ARC files below ``arcs`` as WARC files below ``path``.

    The files are read twice: for the index of payload digests, and with what
    each one's documents revisit, a list bounded by the archive's size."""
    index = written(arc_records(spark, arcs, content=False), "arc-index")
    told = revisits(index, min_bytes, id_type).groupBy("archive").agg(F.collect_list(F.struct("place", *_REFERS)).alias("told"))
    files = _files(spark, arcs).select("path", "content", F.regexp_extract("path", "archive=([^/]+)/", 1).alias("archive"))
    schema = pa.schema([("archive", pa.string()), ("place", pa.int64()), ("record", pa.binary())])

    def run(batches):
        for batch in batches:
            for path_, data, found in zip(batch.column("path"), batch.column("content"), batch.column("told")):
                refers = {r.pop("place"): r for r in found.as_py() or ()}
                none = dict.fromkeys(_REFERS)
                rows = ({"archive": d["archive"], "place": d["place"], "record": warc_record(d | refers.get(d["place"], none))} for d in _documents(path_.as_py(), data.as_py()))
                yield from _sized(rows, schema, "record")

    rows = files.join(told, "archive", "left").select("path", "content", "told")
    _write_archives(rows.mapInArrow(run, "archive string, place long, record binary"), path, WARC_END)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of a WARC file, by declared lengths;
    field names in lower case."""
    source = _Bytes(data)
    while True:
        first = source.line()
        if first is None:
            return
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ArchiveError(f"no record at {source.offset}")
        fields: dict[str, str] = {}
        while (line := source.line()) is not None and line.strip():
            key, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[key.strip().lower()] = value.strip()
        block = source.take(int(fields["content-length"]))
        if source.take(len(WARC_END)) != WARC_END.encode():
            raise ArchiveError(f"the record before {source.offset} is longer than it says")
        yield fields, block


def warc_records(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of
    every response and revisit below ``path``.  Blocks are checked against
    their digests; a response's payload is measured, a revisit's is the one
    that its headers declare."""
    ship(spark)
    schema = pa.schema([("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])

    def run(batches):
        for batch in batches:
            for data in batch.column("content"):
                rows = []
                for fields, block in parse_warc(data.as_py()):
                    kind = fields["warc-type"]
                    if f"sha1:{base32_sha1(block)}" != fields["warc-block-digest"]:
                        raise ArchiveError(f"{fields['warc-record-id']} is damaged")
                    if kind not in ("response", "revisit"):
                        continue
                    told = ArcRecord(0, "", "", "", "", block)
                    size = len(told.payload) if kind == "response" else int(told.header("Content-Length"))
                    rows.append((told.header(PAGE_ID), size, fields["warc-payload-digest"].removeprefix("sha1:"), kind, fields.get(REFERS_TO_PAGE.lower())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    found = _files(spark, path).select("content").mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Pages through ARC and WARC archives in the shared folder and back."""
    spark, id_type = pages.sparkSession, pages.schema[id_col].dataType.simpleString()
    arcs, warcs = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arcs(pages, arcs, id_col, url_col, html_col)
    convert(spark, arcs, warcs, min_bytes, id_type)
    return warc_records(spark, warcs, id_type).withColumnRenamed("page_id", id_col)
