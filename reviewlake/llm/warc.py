"""Legacy archives: writing and reading ARC, converting it to WARC, reading WARC back.

ARC files open with a record that names the version and the fields of the
header lines; version 1 has five fields, version 2 ten, the declared length
last. The converter reads header lines by the file's own field names, takes as
many bytes as declared, and synthesises for each record what WARC wants: an
identifier made from file name, offset and content, a timestamp from the
14-digit date, a type, and digests of payload and block. Of equal payloads of
at least ``MIN_REVISIT`` bytes the first becomes a response and the others
revisit it.

Archives are written by Spark's text sink, one row per record with the record
separator as line separator, so they appear only when a job commits; strings
are passed through byte for byte. One task reads one file: a file should stay
well below 1 GB (Spark cannot load 2 GB as one value).

Defined results: null html is an empty payload; null page ids sort last and
come back null, null URLs become ``unknown:``; repeated rows are records of
their own; an empty table gives archives without records; a header line that
cannot be parsed, or a length beyond the end, makes one row with ``error`` and
ends that file, since nothing after it can be placed; other columns are never
read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import named, small_batches, stored
from reviewlake.session import scratch_path

MIN_REVISIT = 100
#: Fixed values of the two ARC versions and of the WARC revisit profile.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ID_HEADER = "X-Page-Id"
DATE = "20240101000000"
ROWS = 256


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def one_word(text: str | None) -> str:
    """A URL for a header line: blanks and control characters are percent-coded."""
    if not text:
        return "unknown:"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def arc_header(version: int, url: str, date: str, mime: str, offset: int, name: str, length: int) -> bytes:
    values = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": mime, "Result-code": "200",
              "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(length)}
    return (" ".join(values[f] for f in FIELDS[version].split(" ")) + "\n").encode()


def http_message(payload: bytes, page_id: int | None) -> bytes:
    own = "" if page_id is None else f"{ID_HEADER}: {page_id}\r\n"
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}"
            f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload


def write_records(rows: DataFrame, path: str, separator: str) -> None:
    rows.select(F.col("record").cast("string")).write.text(path, compression="gzip", lineSep=separator)


def write_arc(pages: DataFrame, path: str, version: int, id_col: str = "page_id", url_col: str = "url",
              payload_col: str = "html", date: str = DATE) -> None:
    """One ARC file per partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():05d}.arc"
        first = f"{version} 0 reviewlake\n{FIELDS[version]}\n".encode()
        record = arc_header(version, f"filedesc://{name}", date, "text/plain", 0, name, len(first)) + first
        offset = len(record) + 1
        yield pa.record_batch({"record": pa.array([record], pa.binary())})
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part, out = batch.slice(at, ROWS), []
                for page_id, url, html in zip(*(part[c].to_pylist() for c in ("id", "url", "html"))):
                    block = http_message(html or b"", page_id)
                    record = arc_header(version, one_word(url), date, "text/html", offset, name, len(block)) + block
                    offset += len(record) + 1
                    out.append(record)
                yield pa.record_batch({"record": pa.array(out, pa.binary())})

    rows = pages.select(named(id_col).cast("long").alias("id"), named(url_col).cast("string").alias("url"),
                        named(payload_col).cast("binary").alias("html"))
    write_records(rows.mapInArrow(work, "record binary"), path, "\n")


def unpacked(data: bytes) -> bytes:
    """The content of a file that may be gzip, in one member or one per record."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(data))
        data = member.unused_data
    return b"".join(parts)


def parse_arc(data: bytes) -> Iterator[tuple[int, dict | None, bytes]]:
    """(offset, header fields, block); fields are None for the record at which the file breaks off."""
    at, fields = 0, None
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
        values = line.rsplit(" ", len(fields) - 1) if fields else line.split(" ")
        length = values[-1]
        stop = end + 1 + int(length) if length.isascii() and length.isdigit() else -1
        if end < 0 or stop < 0 or stop > len(data) or fields and len(values) != len(fields):
            yield at, None, data[at:]
            return
        block = data[end + 1:stop]
        if fields is None:
            lines = block.decode("utf-8", "replace").splitlines()
            if len(lines) < 2 or lines[0].split(" ")[0] not in ("1", "2"):
                yield at, None, data[at:]
                return
            fields = lines[1].split(" ")
            yield at, {"URL": values[0], "Archive-date": values[2] if len(values) > 2 else "",
                       "Content-type": "text/plain", "version": lines[0].split(" ")[0]}, block
        else:
            yield at, dict(zip(fields, values)), block
        at = stop


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head (with its blank line) and payload; blocks that are no HTTP message have no head."""
    cut = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -1
    return (b"", block) if cut < 0 else (block[:cut + 4], block[cut + 4:])


def header_value(head: bytes, name: str) -> str | None:
    for line in head.decode("latin-1").split("\r\n"):
        key, colon, value = line.partition(":")
        if colon and key.strip().lower() == name.lower():
            return value.strip()
    return None


def number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?[0-9]+", text) else None


def timestamp(date: str) -> str:
    """14 digits as a WARC date; missing digits count as the earliest, anything else as 1970."""
    digits = date if re.fullmatch(r"[0-9]{4,14}", date) else "1970"
    full = digits + "00000101000000"[len(digits):]
    y, mo, d, h, mi, s = full[:4], full[4:6], full[6:8], full[8:10], full[10:12], full[12:14]
    return f"{y}-{mo}-{d}T{h}:{mi}:{s}Z"


ARC_SCHEMA = ("file string, offset bigint, url string, ip string, date string, mime string, kind string, "
              "page_id bigint, payload_bytes bigint, digest string, record_id string, error string, head binary, "
              "payload binary")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .where("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """Records of all ARC files below ``path``; without ``blocks`` head and payload stay null."""
    schema = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
                         [f.dataType.simpleString()]) for f in spark.createDataFrame([], ARC_SCHEMA).schema])

    def rows(file: str, content: bytes) -> Iterator[dict]:
        for offset, fields, block in parse_arc(unpacked(content)):
            row = {"file": file, "offset": offset}
            if fields is None:
                yield row | {"error": "unreadable header or length", "kind": "error"}
                continue
            head, payload = split_http(block)
            digest = sha256(payload)
            kind = "warcinfo" if "version" in fields else "response" if head else "resource"
            yield row | {
                "url": fields["URL"], "ip": fields.get("IP-address", "0.0.0.0"), "date": timestamp(fields["Archive-date"]),
                "mime": fields["Content-type"], "kind": kind, "page_id": number(header_value(head, ID_HEADER)),
                "payload_bytes": len(payload), "digest": digest,
                "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{offset}#{digest}')}>",
                "head": head if blocks else None, "payload": payload if blocks else None}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = []
                for row in rows(batch["file"][i].as_py(), batch["content"][i].as_py()):
                    held.append(row)
                    if len(held) == ROWS:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return read_files(spark, path).mapInArrow(work, ARC_SCHEMA)


def warc_record(row: dict) -> bytes:
    """One record without the separator after it."""
    revisit = row["refers_to"] is not None
    block = row["head"] + (b"" if revisit else row["payload"])
    kind = "revisit" if revisit else row["kind"]
    mime = {"response": "application/http;msgtype=response", "revisit": "application/http;msgtype=response",
            "warcinfo": "text/plain"}.get(kind, row["mime"])
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {row['date']}"]
    if kind != "warcinfo":
        lines += [f"WARC-Target-URI: {row['url']}", f"WARC-IP-Address: {row['ip']}",
                  f"WARC-Payload-Digest: sha256:{row['digest']}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {row['refers_to']}"]
    lines += [f"WARC-Block-Digest: sha256:{sha256(block)}", f"Content-Type: {mime}", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Writes the WARC files of all ARC files below ``arc_path``; unreadable ends are left out (see ``read_arc``)."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "date", "file", "offset", "record_id")
    first = (read_arc(spark, arc_path, blocks=False)
             .where((F.col("kind") == "response") & (F.col("payload_bytes") >= min_revisit))
             .groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1").select("digest", F.col("first.record_id").alias("first_id")))
    first = stored(first, "warc-first")
    refers = F.when((F.col("kind") == "response") & (F.col("payload_bytes") >= min_revisit)
                    & (F.col("first_id") != F.col("record_id")), F.col("first_id"))
    records = (read_arc(spark, arc_path).where("error is null").join(first, "digest", "left")
               .withColumn("refers_to", refers))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                out = [warc_record(r) for r in batch.slice(at, ROWS).to_pylist()]
                yield pa.record_batch({"record": pa.array(out, pa.binary())})

    write_records(records.mapInArrow(work, "record binary"), warc_path, "\r\n\r\n")


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(named fields, block) of every record; raises where a file is damaged."""
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        stop = end + 4 + int(fields["content-length"])
        block = data[end + 4:stop]
        if fields.get("warc-block-digest", "sha256:" + sha256(block)) != "sha256:" + sha256(block):
            raise ValueError(f"block digest differs at {at}")
        yield fields, block
        at = stop


WARC_SCHEMA = ("record_id string, record_type string, page_id bigint, payload_bytes bigint, payload_digest string, "
               "refers_to_id string, url string")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response, revisit and resource records; a revisit's size and digest are those it declares."""
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("refers_to_id", pa.string()), ("url", pa.string())])

    def row(fields: dict, block: bytes) -> dict:
        head, payload = split_http(block)
        revisit = fields["warc-type"] == "revisit"
        return {"record_id": fields["warc-record-id"], "record_type": fields["warc-type"],
                "page_id": number(header_value(head, ID_HEADER)),
                "payload_bytes": number(header_value(head, "Content-Length")) if revisit else len(payload),
                "payload_digest": fields["warc-payload-digest"].partition(":")[2] if revisit else sha256(payload),
                "refers_to_id": fields.get("warc-refers-to"), "url": fields.get("warc-target-uri")}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows = [row(f, b) for f, b in parse_warc(unpacked(content.as_py())) if f["warc-type"] != "warcinfo"]
                for at in range(0, len(rows), ROWS):
                    yield pa.RecordBatch.from_pylist(rows[at:at + ROWS], schema)

    return read_files(spark, path).mapInArrow(work, WARC_SCHEMA)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Per page, from the WARC files read back: id, payload_bytes, payload_digest, record_type, refers_to.

    Half of the pages take the way through ARC version 1, half through version 2.
    """
    small_batches(pages)
    spark = pages.sparkSession
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    half = F.pmod(F.xxhash64(named(id_col), named(url_col)), F.lit(2))
    for version in FIELDS:
        write_arc(pages.where(half == version - 1), f"{arc}/v{version}", version, id_col, url_col, payload_col)
    convert(spark, arc, out)
    rows = stored(read_warc(spark, out), "warc-rows")
    first = rows.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"),
                                                          F.col("page_id").alias("refers_to"))
    revisits = rows.where("refers_to_id is not null").join(first, "refers_to_id", "left")
    plain = rows.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return revisits.unionByName(plain).select(
        F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
