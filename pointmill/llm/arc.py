"""Legacy archives: pages to ARC files, ARC files to WARC files, WARC files to rows.

The converter reads ARC record by record: the version block at the head of a file names the version
and so the fields of the header lines that follow, and each header line declares its record's
length. From them it makes up what WARC wants: record identifiers, ISO timestamps, types and
digests. A payload that an earlier page has too becomes a revisit of that page's record. Which
page that is, is settled by one aggregate on the digest before the WARC files are written.
"""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointmill.llm.common import dealt, saved
from pointmill.workspace import file_system, qualified, scratch_path

# The fields of a header line by version of the format, and the media type of its records.
ARC_FIELDS = {
    "1": ("url", "ip", "date", "type", "length"),
    "2": ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "file", "length"),
}
ARC_FIELD_NAMES = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_FIRST_DATE = datetime(1999, 1, 1, tzinfo=UTC)
_SAFE = "!#$%&'()*+,/:;=?@[]~-._"
#: Compressed bytes and records after which a task begins another file.
FILE_BYTES = 1 << 24
FILE_RECORDS = 10_000
_PIECE = 1 << 14


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _File:
    """Compressed records of one file, each a member of its own, held until it is written."""

    def __init__(self, folder: str, name: str):
        self.uri, self.members, self.size = f"{folder}/{name}", [], 0

    def add(self, record: bytes) -> int:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.members.append(member)
        at, self.size = self.size, self.size + len(member)
        return at

    def full(self) -> bool:
        return self.size >= FILE_BYTES or len(self.members) >= FILE_RECORDS

    def write(self) -> None:
        files, path = file_system(self.uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        attempt = f"{path}.{TaskContext.get().taskAttemptId()}"
        with files.open_output_stream(attempt) as out:
            for member in self.members:
                out.write(member)
        files.move(attempt, path)


def _members(uri: str) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each member of a compressed file; a plain file is one. Bytes past a member's end are copied in small pieces only."""
    files, path = file_system(uri)
    with files.open_input_stream(path, compression=None, buffer_size=1 << 20) as file:
        piece, at = file.read(_PIECE), 0
        if piece[:2] != b"\x1f\x8b":
            yield 0, piece + file.read()
            return
        while piece:
            unpacker, content, end = zlib.decompressobj(31), [], at
            while piece and not unpacker.eof:
                content.append(unpacker.decompress(piece))
                end += len(piece) - len(unpacker.unused_data)
                piece = unpacker.unused_data or file.read(_PIECE)
            if not unpacker.eof:
                raise ValueError(f"{uri}: the record at {at} is cut off")
            yield at, b"".join(content)
            at = end


def _line(data: bytes, at: int) -> tuple[bytes, int]:
    end = data.find(b"\n", at)
    return (data[at:end], end + 1) if end >= 0 else (data[at:], len(data))


# ARC


def _version_block(name: str, version: str) -> bytes:
    body = f"{version} 0 pages\n{ARC_FIELD_NAMES[version]}\n".encode()
    date = _FIRST_DATE.strftime("%Y%m%d%H%M%S")
    more = " 200 - - 0 " + name if version == "2" else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{more} {len(body)}\n".encode() + body + b"\n"


def write_arc(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """ARC files of pages under path, of both versions in turn; returns a row per file (file, records).

    A record's body is an HTTP response, which keeps the page's id in a header line of its own. NULL html is an empty payload, a
    NULL url is written as "-"; blanks in urls are escaped.
    """
    folder = qualified(pages.sparkSession, path)
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, file = TaskContext.get().partitionId(), 0, None

        def close() -> pa.RecordBatch:
            file.write()
            return pa.RecordBatch.from_pydict({"file": [file.uri], "records": pa.array([len(file.members) - 1], pa.int64())})

        for batch in batches:
            for name, url, html in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html")), strict=True):
                if file is None:
                    version = "12"[(task + number) % 2]
                    file = _File(folder, f"pages-{task:06d}-{number:05d}.arc.gz")
                    file.add(_version_block(file.uri.rpartition("/")[2], version))
                payload = (html or "").encode(errors="replace")
                own = "" if name is None else f"X-Page-Id: {name}\r\n"
                body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                date = (_FIRST_DATE + timedelta(seconds=(name or 0) % 10**9)).strftime("%Y%m%d%H%M%S")
                more = f" 200 {digest(payload)} - {file.size} {file.uri.rpartition('/')[2]}" if version == "2" else ""
                file.add(f"{quote(url or '-', safe=_SAFE)} 0.0.0.0 {date} text/html{more} {len(body)}\n".encode() + body + b"\n")
                if file.full():
                    yield close()
                    file, number = None, number + 1
        if file is not None:
            yield close()

    return saved(rows.mapInArrow(write, "file string, records long"), "arc_manifest")


@dataclass(frozen=True)
class ArcRecord:
    """offset: of the member and the record in it, as one number. payload: what follows the HTTP head."""

    number: int
    fields: dict[str, str]
    head: bytes
    payload: bytes
    page_id: int | None


def read_arc(uri: str) -> Iterator[ArcRecord]:
    """The records of a file after its version block. Empty lines between records are skipped; anything else out of place is an error."""
    version, number = None, 0
    for offset, data in _members(uri):
        at = 0
        while at < len(data):
            line, at = _line(data, at)
            if not line.strip():
                continue
            parts = line.decode("utf-8", "replace").split()
            if not parts[-1].isdigit() or at + int(parts[-1]) > len(data):
                raise ValueError(f"{uri}: no whole record at {offset}")
            body, at = data[at : at + int(parts[-1])], at + int(parts[-1])
            if parts[0].startswith("filedesc:"):
                version = body.split(None, 1)[0].decode()
                if version not in ARC_FIELDS:
                    raise ValueError(f"{uri}: unknown version {version}")
                continue
            if version is None or len(parts) != len(ARC_FIELDS[version]):
                raise ValueError(f"{uri}: the header line at {offset} does not suit version {version}")
            head, cut, payload = body.partition(b"\r\n\r\n") if body.startswith(b"HTTP/") else (b"", b"", body)
            own = [x.split(b":", 1)[1].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"x-page-id:")]
            yield ArcRecord(number, dict(zip(ARC_FIELDS[version], parts, strict=True)), head + cut, payload, int(own[0]) if own else None)
            number += 1


def _catalogue(files: DataFrame) -> DataFrame:
    """(file, number, page_id, digest, length) of each record of ARC files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                rows = [(uri, r.number, r.page_id, digest(r.payload), len(r.payload)) for r in read_arc(uri)]
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "number", "page_id", "digest", "length"])

    return saved(dealt(files.select("file")).mapInArrow(read, "file string, number long, page_id long, digest string, length long"), "arc_catalogue")


# WARC


def record_id(uri: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri}#{number}')}>"


def _iso(date: str) -> str:
    return datetime.strptime(date.ljust(14, "0")[:14], "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _warc_record(kind: str, lines: dict[str, str], block: bytes) -> bytes:
    head = {"WARC-Type": kind, **lines, "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def convert(files: DataFrame, path: str, least_revisit: int = 0) -> DataFrame:
    """WARC files under path, one for each ARC file of files (file); returns a row per file (file, records).

    Of the records with equal payloads of least_revisit bytes at least, the one with the smallest page_id is a response, and the
    others revisit it; records without page_id come last, equal page_ids in the order of files and records.
    """
    folder = qualified(files.sparkSession, path)
    records = _catalogue(files)
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "number")
    first = records.where(F.col("length") >= least_revisit).groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
    again = first.where("n > 1").select("digest", F.col("first.file").alias("first_file"), F.col("first.number").alias("first_number"))
    other = (F.col("file") != F.col("first_file")) | (F.col("number") != F.col("first_number"))
    revisits = records.where(F.col("length") >= least_revisit).join(again, "digest").where(other)
    revisits = saved(revisits.select("file", "number", "first_file", "first_number"), "revisits")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, again in zip(*(batch.column(c).to_pylist() for c in ("file", "again")), strict=True):
                yield one(uri, {r["number"]: (r["first_file"], r["first_number"]) for r in again or ()})

    def one(uri: str, to: dict[int, tuple[str, int]]) -> pa.RecordBatch:
        file = _File(folder, uri.rpartition("/")[2].removesuffix(".gz").removesuffix(".arc") + ".warc.gz")
        info = b"software: pointmill\r\nformat: WARC File Format 1.1\r\n"
        file.add(_warc_record("warcinfo", {"WARC-Record-ID": record_id(uri, -1), "WARC-Date": _iso(_FIRST_DATE.strftime("%Y%m%d")), "Content-Type": "application/warc-fields"}, info))
        for r in read_arc(uri):
            lines = {
                "WARC-Record-ID": record_id(uri, r.number),
                "WARC-Date": _iso(r.fields["date"]),
                "WARC-Target-URI": r.fields["url"],
                "WARC-IP-Address": r.fields["ip"],
                "WARC-Payload-Digest": f"sha1:{digest(r.payload)}",
            }
            kind = "application/http; msgtype=response" if r.head else r.fields["type"]
            if r.number in to:
                lines |= {"WARC-Refers-To": record_id(*to[r.number]), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
                file.add(_warc_record("revisit", lines | {"Content-Type": kind}, r.head))
            else:
                block = r.head + r.payload
                lines |= {"WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Type": kind}
                file.add(_warc_record("response" if r.head else "resource", lines, block))
        file.write()
        return pa.RecordBatch.from_pydict({"file": [file.uri], "records": pa.array([len(file.members) - 1], pa.int64())})

    # Of one file, so FILE_RECORDS at most.
    again = revisits.groupBy("file").agg(F.collect_list(F.struct("number", "first_file", "first_number")).alias("again"))
    listed = dealt(files.select("file").join(again, "file", "left"))
    return saved(listed.mapInArrow(write, "file string, records long"), "warc_manifest")


def read_warc(files: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, record_id, refers_to_record, url, date) of the records but warcinfo.

    payload_bytes is what the HTTP head declares, as a revisit holds no payload; a response's payload is checked against it and
    against its digest.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                rows = []
                for offset, data in _members(uri):
                    head, _, block = data.partition(b"\r\n\r\n")
                    lines = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in head.decode().split("\r\n")[1:])}
                    block = block[: int(lines["content-length"])]
                    if lines["warc-type"] == "warcinfo":
                        continue
                    http, cut, payload = block.partition(b"\r\n\r\n")
                    fields = dict(x.lower().split(": ", 1) for x in http.decode().split("\r\n")[1:]) if cut else {}
                    told = lines["warc-payload-digest"].removeprefix("sha1:")
                    size = int(fields.get("content-length", len(payload)))
                    if lines["warc-type"] != "revisit" and (len(payload) != size or digest(payload) != told):
                        raise ValueError(f"{uri}: the payload at {offset} is not the one its header describes")
                    page = fields.get("x-page-id")
                    rows.append((int(page) if page else None, size, told, lines["warc-type"], lines["warc-record-id"], lines.get("warc-refers-to"), lines["warc-target-uri"], lines["warc-date"]))
                if rows:
                    kinds = (pa.int64(), pa.int64(), *[pa.string()] * 6)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_record", "url", "date"]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to_record string, url string, date string"
    return saved(dealt(files.select("file")).mapInArrow(read, schema), "warc_records")


def round_trip(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least_revisit: int = 0) -> DataFrame:
    """One row per row of pages, as read back from the WARC files: id, payload_bytes, payload_digest, record_type, refers_to, url, date.

    NULL html is an empty payload. Ids are whole numbers; a NULL id stays NULL, and refers_to is then NULL too. Repeated rows
    are records of their own. No pages, no files and no rows.
    """
    spark = pages.sparkSession
    arcs = write_arc(pages, scratch_path(spark, "arc"), id_column, url_column, html_column)
    records = read_warc(convert(arcs, scratch_path(spark, "warc"), least_revisit))
    referred = records.where("refers_to_record IS NOT NULL").select(F.col("refers_to_record").alias("referred")).distinct()
    to = records.join(referred, F.col("record_id") == F.col("referred")).select(F.col("record_id").alias("to_record"), F.col("page_id").alias("refers_to"))
    joined = records.join(to, F.col("refers_to_record") == F.col("to_record"), "left")
    return joined.select(F.col("page_id").alias(id_column), "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "date")
