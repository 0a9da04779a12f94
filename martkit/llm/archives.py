"""Legacy web archives: ARC files are parsed and rewritten as WARC.

An ARC file begins with a version block, which says which fields the header lines of its records have.  A record is a header
line with the length of what follows, then that many bytes.  ``convert`` gives each record a WARC identifier, time stamp,
type and digests, and turns records whose payload another record has into ``revisit`` records that refer to it.

Archives are written by Spark's text sink (a row is a record, whatever its bytes) and read back whole files at a time, since
only declared lengths say where a record ends; a task's share of the input makes one archive, so ``archives`` sets their size.
Payloads are never shuffled for the search for equal payloads: only digests and identifiers meet.

Defined results: a null payload is empty; a null identifier comes after all others; of equal payloads with one identifier,
the one with the smaller record identifier is the response; a header line that can't be read is skipped up to the next line;
a record that the file cuts off ends where the file does.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_folder
from .common import octets, written

#: Fields of a header line by version (fixed values).
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"),
}
CAPTURED = "20240101000000"
BATCH_BYTES = 8 << 20


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- ARC
def _line(url: str, date: str, mime: str, block: bytes, version: int, offset: int, name: str) -> bytes:
    known = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": mime, "Result-code": "200",
             "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(len(block))}
    return " ".join(known[f] for f in FIELDS[version]).encode()


def _batches(rows: Iterator[tuple], size, make) -> Iterator[pa.RecordBatch]:
    """Batches of at most about ``BATCH_BYTES``."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += size(row)
        if n >= BATCH_BYTES:
            yield make(held)
            held, n = [], 0
    yield make(held)


def write_arc(pages: DataFrame, folder: str, versions: tuple[int, ...] = (1, 2), archives: int | None = None,
              html: str = "html", page_id: str = "page_id", url: str = "url") -> None:
    """One gzipped ARC file per task; tasks take the versions in turn."""
    rows = pages.select(F.col(page_id).cast("string").alias("id"), F.col(url).cast("string").alias("url"), octets(html).alias("body"),
                        F.spark_partition_id().alias("part"))
    rows = rows if archives is None else rows.repartition(archives)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes]]:
        offset = None
        for batch in batches:
            for id_, uri, body, part in zip(*(c.to_pylist() for c in batch.columns)):
                if offset is None:
                    version, name = versions[part % len(versions)], f"part-{part:05d}.arc"
                    about = f"{version} 0 martkit\n{' '.join(FIELDS[version])}\n".encode()
                    start = _line(f"filedesc://{name}", CAPTURED, "text/plain", about, version, 0, name) + b"\n" + about
                    offset = len(start) + 1
                    yield (start,)
                head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n"
                        + (f"X-Page-Id: {id_}\r\n" if id_ is not None else "") + "\r\n").encode()
                safe = re.sub(r"[^!-~]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode("utf-8", "replace")), uri or "urn:none")
                record = _line(safe, CAPTURED, "text/html", head + body, version, offset, name) + b"\n" + head + body
                offset += len(record) + 1
                yield (record,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(records(batches), lambda r: len(r[0]),
                            lambda held: pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], pa.binary())], names=["record"]))
    out = rows.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    out.write.option("compression", "gzip").option("lineSep", "\n").text(folder)


def _unpacked(data: bytes) -> bytes:
    """The content of a file of gzip members, or of a plain file."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join([*out, data])


def arc_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, content) of each record of an ARC file, version blocks apart."""
    at, fields = 0, FIELDS[1]
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        head = data[at:end].decode("utf-8", "replace").rstrip("\r")
        # A version block declares the fields of the lines after it; its own line has those of its version.
        cells = head.rsplit(" ", len(fields) - 1)
        if head.startswith("filedesc:"):
            cells = head.split(" ")
        if len(cells) < 5 or not cells[-1].isdigit():
            at = end + 1
            continue
        content = data[end + 1:end + 1 + int(cells[-1])]
        if head.startswith("filedesc:"):
            version = re.match(rb"(\d+) ", content)
            fields = FIELDS.get(int(version.group(1)), FIELDS[1]) if version else FIELDS[1]
        elif len(cells) == len(fields):
            yield at, dict(zip(fields, cells)), content
        at = end + 1 + len(content)


def _payload(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head (empty if there is none) and payload."""
    if content[:5] != b"HTTP/":
        return b"", content
    head, gap, body = content.partition(b"\r\n\r\n")
    return (head + gap, body) if gap else (content, b"")


def _header(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + name + rb":[ \t]*([^\r\n]*)", head)
    return found.group(1).decode("utf-8", "replace") if found else None


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, uri, date, mime, page_id, digest, head and payload of each record."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                for at, cells, content in arc_records(_unpacked(packed.as_buffer().to_pybytes())):
                    head, payload = _payload(content)
                    date = cells["Archive-date"]
                    yield (f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{at}')}", cells["URL"],
                           f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z", cells["Content-type"],
                           _header(head, b"X-Page-Id"), base32_sha1(payload), head, payload)

    def make(held: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*held)) or [()] * 8
        kinds = [pa.string()] * 6 + [pa.binary()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=_RECORD)
    return files.mapInArrow(lambda b: _batches(records(b), lambda r: len(r[7]) + 500, make),
                            ", ".join(f"{c} string" for c in _RECORD[:6]) + ", head binary, payload binary")


_RECORD = ["record_id", "uri", "date", "mime", "page_id", "digest", "head", "payload"]


# ---------------------------------------------------------------- WARC
def _order(page: Column) -> Column:
    number = page.try_cast("decimal(38,0)")
    return F.struct(page.isNull(), number.isNull(), number, page, F.col("record_id"))


def first_records(records: DataFrame, least_bytes: int) -> DataFrame:
    """record_id, and the record it revisits (first_*), of each record whose payload an earlier one has."""
    index = written(records.where(F.length("payload") >= least_bytes).select("record_id", "uri", "date", "page_id", "digest"), "index")
    firsts = index.groupBy("digest").agg(F.min_by(F.struct("record_id", "uri", "date"), _order(F.col("page_id"))).alias("first"),
                                         F.count("*").alias("n")).where("n > 1").drop("n")
    found = index.join(firsts, "digest").where("record_id <> first.record_id")
    return written(found.select("record_id", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("record_id", "uri", "date")]), "revisits")


def _warc(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC/1.0\r\nWARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r"


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, least_bytes: int = 0) -> None:
    """Rewrite the ARC files of a folder as gzipped WARC files."""
    records = read_arc(spark, arc_folder)
    records = records.join(first_records(records, least_bytes), "record_id", "left")
    cols = [*_RECORD, "first_record_id", "first_uri", "first_date"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes]]:
        info = b"software: martkit\r\nformat: WARC File Format 1.0\r\n"
        yield (_warc("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, warc_folder)}>"),
                                  ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], info),)
        for batch in batches:
            for rid, uri, date, mime, _, digest, head, payload, first, first_uri, first_date in zip(*(c.to_pylist() for c in batch.columns)):
                kind = "revisit" if first else "response" if head else "resource"
                block = head if first else head + payload
                fields = [("WARC-Record-ID", f"<{rid}>"), ("WARC-Date", date), ("WARC-Target-URI", uri),
                          ("Content-Type", "application/http; msgtype=response" if head else mime),
                          ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
                if first:
                    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                               ("WARC-Refers-To", f"<{first}>"), ("WARC-Refers-To-Target-URI", first_uri), ("WARC-Refers-To-Date", first_date)]
                yield (_warc(kind, fields, block),)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(made(batches), lambda r: len(r[0]),
                            lambda held: pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], pa.binary())], names=["record"]))
    out = records.select(*cols).mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    out.write.option("compression", "gzip").option("lineSep", "\n").text(warc_folder)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of a WARC file."""
    at = data.find(b"WARC/")
    while 0 <= at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        block = data[end + 4:end + 4 + int(fields.get("content-length", "0"))]
        yield fields, block
        at = data.find(b"WARC/", end + 4 + len(block))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, record_type, uri, page_id, payload_bytes, payload_digest, refers_to_id and intact (its digests fit)."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    names = ["record_id", "record_type", "uri", "page_id", "payload_bytes", "payload_digest", "refers_to_id", "intact"]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for packed in batch.column(0):
                for fields, block in warc_records(_unpacked(packed.as_buffer().to_pybytes())):
                    kind = fields.get("warc-type", "")
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    head, payload = _payload(block)
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    size = _header(head, b"Content-Length") if kind == "revisit" else str(len(payload))
                    intact = fields.get("warc-block-digest", "").removeprefix("sha1:") == base32_sha1(block) and (
                        kind == "revisit" or digest == base32_sha1(payload))
                    yield (fields.get("warc-record-id", "").strip("<>"), kind, fields.get("warc-target-uri"), _header(head, b"X-Page-Id"),
                           int(size) if size and size.isdigit() else None, digest, fields.get("warc-refers-to", "").strip("<>") or None, intact)

    def make(held: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*held)) or [()] * 8
        kinds = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 2 + [pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
    return files.mapInArrow(lambda b: _batches(records(b), lambda r: 2000, make),
                            "record_id string, record_type string, uri string, page_id string, payload_bytes long, payload_digest string, "
                            "refers_to_id string, intact boolean")


def archived_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages as ARC, convert, read the WARC files back: one row per page, with the page each revisit refers to."""
    spark = pages.sparkSession
    folder = f"{scratch_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_arc(pages, f"{folder}/arc")
    convert(spark, f"{folder}/arc", f"{folder}/warc", least_bytes)
    found = written(read_warc(spark, f"{folder}/warc"), "records")
    kind = pages.schema["page_id"].dataType
    firsts = found.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").cast(kind).alias("refers_to"))
    found = found.join(firsts.join(found.where("record_type = 'revisit'").select("refers_to_id").distinct(), "refers_to_id", "left_semi"),
                       "refers_to_id", "left")
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")
