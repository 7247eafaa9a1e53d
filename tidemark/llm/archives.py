"""Legacy ARC archives and their conversion to WARC.

``write_arc`` stores pages as ARC files of version 1 or 2, ``convert`` turns ARC
files into WARC files, ``read_warc`` reads those back. The converter goes by what
a file declares: its first record names the version and the fields of the header
lines (five in version 1, ten in version 2), and each line the length of what
follows. Header lines are taken apart from the right, as old URLs may hold blanks.

Every ARC record has a WARC equivalent: a record id made from the archive's
declared name and the record's offset (so reruns agree), the date of 12 or 14 digits as a
timestamp, the type by content (the version block: warcinfo; an HTTP message:
response; anything else: resource), and block and payload digests. Of responses
with equal payloads of at least ``least_bytes`` the one with the smallest page id
stays, the others become revisit records with the HTTP header only.

Duplicates are found across all archives by a table of digests (no payload is
shuffled): the first of a digest is an aggregate that combines before the shuffle,
and it is joined back by plain shuffle joins that adaptive execution can split. Tasks
stream records; a record is held at most. Files count from the moment the table
that names them is stored.

Nulls: null html is an empty payload, a null url is named ``urn:page``, a null
page_id comes after all others. Of rows with equal page_id and payload one is the response.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.sources.durable import checkpoint, scratch_path

# The fields that the two versions declare, and the revisit profile.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_BYTES = 100
FILE_BYTES = 256 << 20
PAGE_HEADER = "X-Page-Id"
_BLANK = re.compile(r"[\x00-\x20\x7f]")


@dataclass
class ArcRecord:
    offset: int
    url: str
    ip: str
    date: str
    content_type: str
    body: bytes
    heads_file: bool = False


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes


def _compressed(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def arc_record(version: int, url: str, ip: str, date: str, kind: str, body: bytes, offset: int = 0, name: str = "-") -> bytes:
    middle = [] if version == 1 else ["200", "-", "-", str(offset), name]
    return " ".join([url, ip, date, kind, *middle, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_head(version: int, name: str, date: str) -> bytes:
    block = f"{version} 0 tidemark\n{FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", block, 0, name)


def read_arc(stream) -> Iterator[ArcRecord]:
    """Records of an ARC stream, the version block first."""
    offset, fields = 0, None
    while line := stream.readline():
        if line in (b"\n", b"\r\n"):
            offset += len(line)
            continue
        at = offset
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        offset += len(line)
        # The first line comes before its declaration; its last field is the length in either version.
        length = text.rsplit(" ", 1)[-1]
        if not length.isdigit():
            raise ValueError(f"no ARC header line at {at}: {text[:80]!r}")
        body = stream.read(int(length))
        if len(body) < int(length):
            raise ValueError(f"ARC record at {at} is cut short: {len(body)} of {length} bytes")
        offset += len(body)
        heads_file = fields is None
        if heads_file:
            declared = body.decode("utf-8", "replace").split("\n")
            version = declared[0].split(" ")[0]
            if not version.isdigit() or int(version) not in FIELDS:
                raise ValueError(f"unknown ARC version: {declared[0][:80]!r}")
            # The declaration counts where there is one; some archives leave it out.
            fields = (declared[1] if len(declared) > 1 and declared[1].startswith("URL ") else FIELDS[int(version)]).split()
        parts = text.rsplit(" ", len(fields) - 1)
        if len(parts) != len(fields):
            raise ValueError(f"ARC header line at {at} has {len(parts)} of {len(fields)} fields")
        values = dict(zip(fields, parts))
        yield ArcRecord(at, values["URL"], values["IP-address"], values["Archive-date"], values["Content-type"], body, heads_file)


def timestamp_of(date: str) -> str:
    """ISO 8601 of an ARC date; digits that are missing are the earliest ones."""
    digits = re.sub(r"\D", "", date)[:14]
    digits += "19700101000000"[len(digits):]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def record_id(name: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>"


def split_http(body: bytes) -> tuple[bytes, bytes] | None:
    """Header (with its blank line) and payload of an HTTP message."""
    if not body.startswith(b"HTTP/"):
        return None
    cuts = [(body.find(gap), len(gap)) for gap in (b"\r\n\r\n", b"\n\n")]
    cuts = [c for c in cuts if c[0] >= 0]
    at, n = min(cuts) if cuts else (len(body), 0)
    return body[:at + n], body[at + n:]


def http_field(head: bytes, name: str) -> str | None:
    for line in head.split(b"\n")[1:]:
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def payload_of(record: ArcRecord) -> tuple[str, bytes, bytes]:
    """WARC type, the header that stays in a revisit, and the payload."""
    # Only the first record of a file is its version block, whatever the URLs of the others.
    if record.heads_file:
        return "warcinfo", b"", record.body
    parts = split_http(record.body)
    return ("resource", b"", record.body) if parts is None else ("response", *parts)


def to_warc(record: ArcRecord, name: str, refers_to: tuple[str, str, str] | None = None) -> WarcRecord:
    """The WARC equivalent; ``refers_to`` (id, URL and ARC date of the original) makes it a revisit."""
    kind, head, payload = payload_of(record)
    headers = {
        "WARC-Type": "revisit" if refers_to else kind, "WARC-Record-ID": record_id(name, record.offset), "WARC-Date": timestamp_of(record.date)}
    if kind == "warcinfo":
        headers |= {"WARC-Filename": record.url.removeprefix("filedesc://"), "Content-Type": "application/warc-fields"}
        block = b"software: tidemark\r\nformat: WARC File Format 1.1\r\narc-version-block: " + b" / ".join(record.body.splitlines()) + b"\r\n"
    else:
        headers |= {"WARC-Target-URI": record.url, "WARC-IP-Address": record.ip}
        headers["Content-Type"] = "application/http; msgtype=response" if kind == "response" else record.content_type
        headers["WARC-Payload-Digest"] = f"sha256:{hashlib.sha256(payload).hexdigest()}"
        block = record.body
    if refers_to:
        block = head
        headers |= {
            "WARC-Profile": REVISIT, "WARC-Refers-To": refers_to[0], "WARC-Refers-To-Target-URI": refers_to[1],
            "WARC-Refers-To-Date": timestamp_of(refers_to[2])}
    headers["WARC-Block-Digest"] = "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
    headers["Content-Length"] = str(len(block))
    return WarcRecord(headers, block)


def warc_bytes(record: WarcRecord) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in record.headers.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + record.block + b"\r\n\r\n"


def read_warc_stream(stream) -> Iterator[WarcRecord]:
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[key] = value
        block = stream.read(int(headers["Content-Length"]))
        if len(block) < int(headers["Content-Length"]):
            raise ValueError("WARC record is cut short")
        yield WarcRecord(headers, block)


def _arc_url(url: str | None) -> str:
    return _BLANK.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:page"


def write_arc(pages: DataFrame, folder: str, date: str = "20240101000000", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Stores (page_id, url, html) rows as gzipped ARC files, of version 1 and 2 in turn; a row per file: path, name."""
    files.make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, done, out, size, number = TaskContext.get().partitionId(), [], None, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for page, url, html in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    if out is None:
                        name, path = f"pages-{part:06d}-{number:04d}.arc.gz", files.fresh_name(folder, "arc.gz")
                        version, size = 1 + (part + number) % 2, 0
                        out = files.open_output(path)
                        head = arc_head(version, name, date)
                        size += len(head)
                        out.write(_compressed(head))
                        done.append((path, name))
                    payload = (html or "").encode()
                    number_line = "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number_line}Content-Length: {len(payload)}\r\n\r\n"
                    data = arc_record(version, _arc_url(url), "0.0.0.0", date, "text/html", head.encode() + payload, size, name)
                    out.write(_compressed(data))
                    size += len(data)
                    if size > file_bytes:
                        out.close()
                        out, number = None, number + 1
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.string())], ["path", "name"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return checkpoint(rows.mapInArrow(write, "path string, name string"))


def _opened(path: str):
    raw = files.open_input(path)
    return gzip.open(raw) if path.endswith(".gz") else raw


def index_arc(archives: DataFrame) -> DataFrame:
    """One row per response of all archives: where it is, its WARC id, and size and digest of its payload."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = ["path", "offset", "id", "page_id", "url", "date", "bytes", "digest"]
        for batch in batches:
            for path, name in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                with _opened(path) as stream:
                    for record in read_arc(stream):
                        kind, head, payload = payload_of(record)
                        if kind != "response":
                            continue
                        page = http_field(head, PAGE_HEADER)
                        rows.append((path, record.offset, record_id(name, record.offset), None if page is None else int(page), record.url, record.date,
                                     len(payload), hashlib.sha256(payload).hexdigest()))
                        if len(rows) == 4096:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    schema = "path string, offset bigint, id string, page_id bigint, url string, date string, bytes bigint, digest string"
    return files.task_each(archives.select("path", "name")).mapInArrow(scan, schema)


def convert(archives: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes a gzipped WARC file for each ARC file of (path, name) rows; a row per file: path."""
    files.make_folder(folder)
    index = checkpoint(index_arc(archives))
    large = index.filter(F.col("bytes") >= least_bytes)
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "id", "url", "date")
    first = large.groupBy("digest").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    copies = large.join(first, "digest").filter("id != f.id")
    revisits = copies.groupBy("path").agg(F.collect_list(F.struct("offset", "f.id", "f.url", "f.date")).alias("revisits"))
    work = files.task_each(checkpoint(archives.select("path", "name").join(revisits, "path", "left")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name, revisits in zip(*(c.to_pylist() for c in batch.columns)):
                refers = {r["offset"]: (r["id"], r["url"], r["date"]) for r in revisits or []}
                target = files.fresh_name(folder, "warc.gz")
                with _opened(path) as stream, files.open_output(target) as out:
                    for record in read_arc(stream):
                        out.write(_compressed(warc_bytes(to_warc(record, name, refers.get(record.offset)))))
                yield pa.RecordBatch.from_arrays([pa.array([target])], ["path"])

    return checkpoint(work.mapInArrow(write, "path string"))


def read_warc(archives: DataFrame) -> DataFrame:
    """One row per record that holds or revisits a payload: id, record_type, uri, date, page_id, payload_bytes, payload_digest, refers_to_id."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "record_type", "uri", "date", "page_id", "payload_bytes", "payload_digest", "refers_to_id"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with _opened(path) as stream:
                    for record in read_warc_stream(stream):
                        h = record.headers
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        head, payload = split_http(record.block) or (b"", record.block)
                        page = http_field(head, PAGE_HEADER)
                        if h["WARC-Type"] == "revisit":
                            size, digest = int(http_field(head, "Content-Length") or 0), h["WARC-Payload-Digest"].partition(":")[2]
                        else:
                            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                            if h["WARC-Payload-Digest"] != f"sha256:{digest}":
                                raise ValueError(f"payload of {h['WARC-Record-ID']} in {path} does not match its digest")
                        rows.append((h["WARC-Record-ID"], h["WARC-Type"], h.get("WARC-Target-URI"), h["WARC-Date"], None if page is None else int(page),
                                     size, digest, h.get("WARC-Refers-To")))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

    schema = "id string, record_type string, uri string, date string, page_id bigint, payload_bytes bigint, payload_digest string, refers_to_id string"
    return files.task_each(archives.select("path")).mapInArrow(scan, schema)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Pages through ARC and WARC files and back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    place = lambda kind: files.folder_uri(scratch_path(spark, kind))
    records = checkpoint(read_warc(convert(write_arc(pages, place("arc")), place("warc"))))
    originals = records.filter("record_type = 'response'").select(F.col("id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    revisits = records.filter("record_type = 'revisit'").join(originals, "refers_to_id")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    rest = records.filter("record_type = 'response'").select(*columns, F.lit(None).cast("bigint").alias("refers_to"))
    return rest.unionByName(revisits.select(*columns, "refers_to"))
