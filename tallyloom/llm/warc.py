"""Legacy web archives: ARC files are written, converted to WARC with revisit records, and read back.

An ARC file opens with a version block that names the fields of the header lines after it; version 1 lines have five
fields, version 2 lines ten, and the last is the byte length of the record. Converting parses those lines and lengths
and makes up what WARC wants and ARC lacks: record identifiers, timestamps with punctuation, record types, digests.

Files are written by Spark's text writer, gzip-compressed, with the record separator as line end, into the shared folder, and
read as binary files. A task inflates and parses a file as a stream, so it holds one record at a time besides the
compressed file; files have at most ``FILE_RECORDS`` records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize, scratch_path

# The fields of ARC header lines by version, and WARC's revisit profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT_BYTES = 1000
FILE_RECORDS = 2000
RECORD_END = "\r\n\r\n"
PAGE_HEADER = "X-Page-Id"
_EPOCH = 19960101000000


def _field(value: str | None) -> str:
    """A header line's field: no blanks or control characters, never empty."""
    return quote(value, safe="!#$%&'()*+,/:;=?@[]~-._") if value else "-"


def _arc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ARC records as text; a version block opens each file of ``FILE_RECORDS`` records. Versions alternate by task."""
    part = TaskContext.get().partitionId()
    version = 1 + part % 2
    n = 0
    for batch in batches:
        out = []
        for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if n % FILE_RECORDS == 0:
                name = f"pages-{part:06d}-{n // FILE_RECORDS:05d}.arc"
                body = f"{version} 0 tallyloom\n{ARC_FIELDS[version]}\n"
                line = ["filedesc://" + name, "0.0.0.0", str(_EPOCH), "text/plain"]
                line += ["200", "-", "-", "0", name] if version == 2 else []
                out.append(" ".join([*line, str(len(body))]) + "\n" + body)
            payload = (html or "").encode()
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{PAGE_HEADER}: {'-' if page is None else page}\r\nContent-Length: {len(payload)}\r\n\r\n"
            line = [_field(url), "0.0.0.0", str(_EPOCH + (page or 0) % 60), "text/html"]
            line += ["200", hashlib.md5(payload).hexdigest(), "-", str(n), name] if version == 2 else []
            out.append(" ".join([*line, str(len(head) + len(payload))]) + "\n" + head + (html or ""))
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


class Stream:
    """Bytes of a gzip file (one or many members), inflated as they are asked for."""

    def __init__(self, packed: bytes):
        self.packed, self.at, self.buffer = packed, 0, bytearray()
        self.inflater = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.inflater.eof:
            rest = self.inflater.unused_data
            self.at -= len(rest)
            self.inflater = zlib.decompressobj(31)
        if self.at >= len(self.packed):
            return False
        piece = self.packed[self.at : self.at + (1 << 16)]
        self.at += len(piece)
        self.buffer += self.inflater.decompress(piece)
        return True

    def line(self, end: bytes) -> bytes | None:
        """Up to and without ``end``; None at the end of the file."""
        seen = 0
        while (found := self.buffer.find(end, seen)) < 0:
            seen = max(0, len(self.buffer) - len(end))
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("archive ends inside a header")
                return None
        out = bytes(self.buffer[:found])
        del self.buffer[: found + len(end)]
        return out

    def take(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._more():
                raise ValueError("archive ends inside a record")
        out = bytes(self.buffer[:size])
        del self.buffer[:size]
        return out


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def arc_records(packed: bytes) -> Iterator[dict]:
    """The records of an ARC file. A version block says how the lines after it are read."""
    stream = Stream(packed)
    fields = ARC_FIELDS[1].split()
    while (line := stream.line(b"\n")) is not None:
        if not line.strip():
            continue
        parts = line.decode("utf-8", "replace").split(" ")
        opens = parts[0].startswith("filedesc://")
        if not opens and len(parts) != len(fields):
            raise ValueError(f"header line of {len(parts)} fields, {len(fields)} are declared")
        body = stream.take(int(parts[-1]))
        if opens:
            fields = body.split(b"\n")[1].decode().split()
        named = dict(zip(fields, parts, strict=False)) if not opens else {"URL": parts[0], "Archive-date": parts[2], "Content-type": parts[3]}
        yield {"url": named["URL"], "date": named["Archive-date"], "mime": named["Content-type"], "version": 1 if len(fields) == 5 else 2, "opens": opens, "body": body}


def record_id(*parts: str) -> str:
    """A name-based UUID."""
    h = hashlib.sha1("\n".join(parts).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


_CONVERTED = "record_id string, kind string, page_id long, url string, date string, mime string, head string, payload_bytes long, payload_digest string"


def _converted(with_payload: bool):
    """ARC files to what WARC records are made of. Version blocks become ``warcinfo``, DNS answers ``resource``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _CONVERTED.split(", ")] + ["payload"] * with_payload
        kinds = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), *[pa.string()] * with_payload]
        for batch in batches:
            for packed in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for r in arc_records(packed.as_py()):
                    head, payload = b"", r["body"]
                    kind = "warcinfo" if r["opens"] else "resource" if r["mime"] == "text/dns" else "response"
                    if kind == "response":
                        head, sep, payload = payload.partition(b"\r\n\r\n")
                        head += sep
                    page = _headers(head).get(PAGE_HEADER.lower(), "-")
                    d = r["date"]
                    stamp = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
                    digest = hashlib.sha1(payload).hexdigest()
                    mime = {"warcinfo": "text/plain", "resource": r["mime"], "response": "application/http;msgtype=response"}[kind]
                    row = (record_id(r["url"], stamp, page, digest), kind, None if page == "-" else int(page), r["url"], stamp, mime, head.decode("utf-8", "replace"), len(payload), digest)
                    rows.append((*row, payload.decode("utf-8", "replace")) if with_payload else row)
                    held += len(payload) if with_payload else 200
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def _files(frame: DataFrame, path: str) -> DataFrame:
    return frame.sparkSession.read.format("binaryFile").load(path).select("content")


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One ARC record per row. Null html is an empty payload, a null url is ``-``."""
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = source.mapInArrow(_arc_rows, "value string")
    rows.write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", FILE_RECORDS + 1).text(path)


def write_warc(records: DataFrame, path: str) -> None:
    """WARC records from converted ones; ``refers_id`` set makes a revisit, which carries no payload."""
    revisit = F.col("refers_id").isNotNull()
    block = F.concat("head", F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    lines = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.col("kind")),
        F.lit("\r\nWARC-Record-ID: "), "record_id", F.lit("\r\nWARC-Date: "), "date",
        F.when(F.col("kind") == "warcinfo", F.lit("")).otherwise(F.concat(F.lit("\r\nWARC-Target-URI: "), "url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), "payload_digest", F.lit("\r\nWARC-Block-Digest: sha1:"), F.sha1("block"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), "refers_id")).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: "), "mime", F.lit("\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"), "block",
    )
    out = records.withColumn("block", block).select(lines.alias("value"))
    out.write.option("compression", "gzip").option("lineSep", RECORD_END).option("maxRecordsPerFile", FILE_RECORDS).text(path)


def warc_records(packed: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a WARC file."""
    stream = Stream(packed)
    while (head := stream.line(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = _headers(head)
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != RECORD_END.encode():
            raise ValueError("record longer than declared")
        yield fields, block


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_id"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        for packed in batch.column(0):
            rows = []
            for fields, block in warc_records(packed.as_py()):
                kind = fields["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                head, _, payload = block.partition(b"\r\n\r\n")
                http = _headers(head)
                declared = fields["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(payload).hexdigest() != declared:
                    raise ValueError("payload differs from its digest")
                page = http[PAGE_HEADER.lower()]
                size = len(payload) if kind == "response" else int(http["content-length"])
                rows.append((fields["warc-record-id"], kind, None if page == "-" else int(page), size, declared, fields.get("warc-refers-to")))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_warc(spark_frame: DataFrame, path: str) -> DataFrame:
    """(record_id, record_type, page_id, payload_bytes, payload_digest, refers_id) of the page records in ``path``."""
    return _files(spark_frame, path).mapInArrow(_read_back, "record_id string, record_type string, page_id long, payload_bytes long, payload_digest string, refers_id string")


def convert(frame: DataFrame, arc_path: str, warc_path: str) -> None:
    """ARC files to WARC files. Of equal payloads of ``LEAST_REVISIT_BYTES`` or more, the record of the largest page id
    keeps the payload and the others refer to it. Records of that same id are all responses, and so are those without one."""
    light = _files(frame, arc_path).mapInArrow(_converted(False), _CONVERTED)
    same = light.filter(f"kind = 'response' AND page_id IS NOT NULL AND payload_bytes >= {LEAST_REVISIT_BYTES}")
    kept = same.groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("kept_page"), F.max_by("record_id", F.struct("page_id", "record_id")).alias("kept_id"), F.count("*").alias("copies")
    )
    kept = materialize(kept.filter("copies > 1").drop("copies"), "kept-payloads")
    whole = _files(frame, arc_path).mapInArrow(_converted(True), _CONVERTED + ", payload string")
    joined = whole.join(kept, ["payload_digest", "payload_bytes"], "left")
    other = (F.col("kind") == "response") & (F.col("page_id") != F.col("kept_page"))
    write_warc(joined.withColumn("refers_id", F.when(other, F.col("kept_id"))), warc_path)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per row of ``pages``, as read back from WARC files
    that were converted from ARC files. An empty table gives no rows; repeated rows give a record each."""
    arc, warc = scratch_path(pages.sparkSession, "arc"), scratch_path(pages.sparkSession, "warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    convert(pages, arc, warc)
    back = read_warc(pages, warc)
    originals = back.filter("record_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to")).distinct()
    revisits = back.filter("record_type = 'revisit'").join(originals, "refers_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    firsts = back.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return firsts.select(columns).unionByName(revisits.select(columns))
