"""Legacy ARC archives converted to WARC.

An ARC file opens with a version block that names its header fields; every record is a header line
with those fields, the declared length last, and that many bytes. Conversion gives each
record the identifier, timestamp, type and digests that WARC asks for. Records whose payload an
earlier one holds become revisits. Files are written and read by Spark's own writers and readers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkrisk.session import scratch_path, write_scratch

# The header lines of the two versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of an archive file.
IN_FILE = 1000


# --- ARC ----------------------------------------------------------------------------------


def version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 linkrisk\n{FIELDS[version]}\n".encode()
    extra = "200 - - 0 " + name + " " if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {extra}{len(body)}\n".encode() + body


def arc_record(version: int, url: str | None, ip: str, date: str, mime: str, block: bytes, offset: int, name: str) -> bytes:
    """White space in the URL is escaped, a null URL is a hyphen."""
    where = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "-")
    extra = f"200 {hashlib.md5(block).hexdigest()} - {offset} {name} " if version == 2 else ""
    return f"{where} {ip} {date} {mime} {extra}{len(block)}\n".encode() + block


def read_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC file: the fields of its header line by name, ``version`` and ``block``.

    The fields before the declared length are counted from the right, as a URL may hold blanks.
    Raises ValueError where a header line or a declared length does not fit.
    """
    at, names, version = 0, FIELDS[1].split(), 1
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"header line at {at} does not end")
        line = data[at:stop].decode("utf-8", "replace").rstrip("\r")
        opening = line.startswith("filedesc:")
        length = line.rsplit(" ", 1)[-1]
        if not length.isdigit() or stop + 1 + int(length) > len(data):
            raise ValueError(f"declared length of the record at {at} does not fit")
        block = data[stop + 1 : stop + 1 + int(length)]
        if opening:
            first, fields = block.decode("utf-8", "replace").split("\n")[:2]
            version, names = int(first.split()[0]), fields.split()
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"header line at {at} has other fields than version {version}")
        yield {**dict(zip(names, values)), "version": version, "block": block}
        at = stop + 1 + int(length)


def write_arc(pages: DataFrame, path: str, page: str = "html", url: str = "url", key: str = "page_id", date: str = "20240101000000") -> None:
    """Pages as gzipped ARC files, versions 1 and 2 in turn; the block is an HTTP response that names the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count = offset = 0
        name = ""
        for batch in batches:
            out = []
            for id_, where, body in zip(*[c.to_pylist() for c in batch.columns]):
                if count % IN_FILE == 0:
                    number, offset = number + 1, 0
                    name = f"pages-{number}.arc"
                    out.append(version_block(2 - number % 2, name, date))
                    offset += len(out[-1]) + 1
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += "" if id_ is None else f"X-Page-Id: {id_}\r\n"
                out.append(arc_record(2 - number % 2, where, "0.0.0.0", date, "text/html", head.encode() + b"\r\n" + (body or b""), offset, name))
                offset += len(out[-1]) + 1
                count += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).cast("binary").alias("body"))
    records = rows.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    records.write.option("maxRecordsPerFile", IN_FILE + 1).option("compression", "gzip").text(path)


# --- WARC ---------------------------------------------------------------------------------


def sha1(data: bytes) -> str:
    """The bare SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def timestamp(date: str) -> str:
    """An ARC date of 8 to 14 digits as a WARC date; missing digits are the start of the time."""
    full = date[:14] + "00000101000000"[len(date[:14]) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


_CONVERTED = (
    "key string, record_id string, date string, uri string, ip string, type string, mime string, head binary, payload binary, "
    "payload_bytes long, payload_digest string, block_digest string"
)


def convert(path: str, spark) -> DataFrame:
    """The records of all ARC files under a path with what WARC needs; version blocks become warcinfo records.

    An HTTP response is parted into head and payload, other blocks are resources without a head. The
    identifier follows from URL, date, key and block, so converting again gives the same one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _CONVERTED.split(", ")]
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                rows = []
                for r in read_arc(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    block, where = r["block"], r["URL"]
                    head, payload, kind, mime = b"", block, "resource", r["Content-type"]
                    if where.startswith("filedesc:"):
                        kind = "warcinfo"
                    elif block.startswith(b"HTTP/"):
                        cut = block.find(b"\r\n\r\n") + 4
                        head, payload, kind, mime = block[:cut], block[cut:], "response", "application/http;msgtype=response"
                    found = re.search(rb"^X-Page-Id: (\S+)\r$", head, re.M)
                    key = found[1].decode() if found else None
                    whole = sha1(block)
                    id_ = uuid.uuid5(uuid.NAMESPACE_URL, f"{where} {r['Archive-date']} {key} {whole}")
                    rows.append((key, f"<urn:uuid:{id_}>", timestamp(r["Archive-date"]), where, r["IP-address"], kind, mime, head, payload, len(payload), sha1(payload), whole))
                if rows:
                    types = [pa.string()] * 7 + [pa.binary()] * 2 + [pa.int64(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _CONVERTED)


def mark_revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """``records`` with ``first``: the record of equal payload with the smallest key, for those with another key.

    Only digests that stand more than once are joined. Payloads under ``least`` bytes, and records
    without a key, stay what they are.
    """
    order = F.col("key").cast("long")
    able = records.where((F.col("type") == "response") & order.isNotNull() & (F.col("payload_bytes") >= least))
    firsts = (
        able.groupBy(F.col("payload_digest").alias("d"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order.alias("key"), "record_id", "uri", "date")).alias("first"))
        .where("n > 1")
        .select("d", "first")
    )
    firsts = write_scratch(firsts, "archive-firsts")
    joined = records.join(firsts, (F.col("payload_digest") == F.col("d")) & (F.col("type") == "response") & (F.col("payload_bytes") >= least), "left")
    again = F.when(order > F.col("first.key"), F.col("first"))
    return joined.withColumn("first", again).drop("d")


def write_warc(records: DataFrame, path: str) -> None:
    """Converted records as gzipped WARC 1.1 files; a revisit keeps the head and drops the payload."""
    again = F.col("first").isNotNull()
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    fields = [
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.col("type"))),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-IP-Address", F.col("ip")),
        line("Content-Type", F.col("mime")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(~again, line("WARC-Block-Digest", F.concat(F.lit("sha1:"), "block_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("X-Page-Id", F.col("key")),
        F.when(again, line("WARC-Profile", F.lit(PROFILE))),
        line("WARC-Refers-To", F.col("first.record_id")),
        line("WARC-Refers-To-Target-URI", F.col("first.uri")),
        line("WARC-Refers-To-Date", F.col("first.date")),
        line("X-Refers-To-Page-Id", F.col("first.key").cast("string")),
        line("Content-Length", F.octet_length(block).cast("string")),
    ]
    head = F.concat(*[F.coalesce(f, F.lit("")) for f in fields], F.lit("\r\n"))
    record = F.concat(F.encode(head, "utf-8"), block, F.lit(b"\r\n\r"))  # the writer adds the last line end
    rows = records.select(record.cast("string").alias("record"))
    rows.write.option("maxRecordsPerFile", IN_FILE).option("compression", "gzip").text(path)


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by name, block) of each record, by declared lengths."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n") if stop >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        header = dict(line.split(": ", 1) for line in lines[1:])
        length = int(header["Content-Length"])
        if stop + 4 + length + 4 > len(data):
            raise ValueError(f"declared length of the record at {at} does not fit")
        yield header, data[stop + 4 : stop + 4 + length]
        at = stop + 4 + length + 4


_READ = "key long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(path: str, spark) -> DataFrame:
    """What the WARC files under a path say of each page; payloads that are there are measured and checked anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for content in batch.column("content"):
                data = content.as_py()
                for header, block in read_warc(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    kind = header["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    size, digest = int(header["X-Payload-Length"]), header["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response":
                        payload = block[block.find(b"\r\n\r\n") + 4 :]
                        if (len(payload), sha1(payload)) != (size, digest):
                            raise ValueError(f"payload of {header['WARC-Record-ID']} differs from its header")
                    ids = [int(header[n]) if n in header else None for n in ("X-Page-Id", "X-Refers-To-Page-Id")]
                    rows.append((ids[0], size, digest, kind, ids[1]))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=[f.split()[0] for f in _READ.split(", ")])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _READ)


def archive(pages: DataFrame, page: str = "html", url: str = "url", key: str = "page_id", least: int = 0) -> DataFrame:
    """Pages through ARC and WARC files and back: ``key, payload_bytes, payload_digest, record_type, refers_to``.

    A null page has an empty payload. Of equal payloads the record with the smallest integer key is the
    response and the others revisit it; rows with that same key are all responses, and a
    null key is a response and never referred to. Other columns are not read; an empty
    table gives an empty result.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "archive-arc"), scratch_path(spark, "archive-warc")
    write_arc(pages, arc, page, url, key)
    records = convert(arc, spark)
    write_warc(mark_revisits(records, least), warc)
    return read_archives(warc, spark).withColumnRenamed("key", key)
