r"""Legacy web archives (ARC) to WARC, and WARC files read back.

*Input.* Rows of (path, content) as ``spark.read.format("binaryFile")`` gives them, one ARC file a
row. The first block (``filedesc://``) names the version: version 1 has header lines of five fields,
version 2 of ten. A header line is split from its end, by the version's number of fields, and the
record is the number of bytes that its last field declares; nothing is searched for in the content.

*Conversion.* A record becomes a WARC record: an identifier (UUID of its URL, date and content, so
reruns agree), an ISO date, a type (``response`` for an HTTP reply, else ``resource``), and SHA-1
digests of block and payload in base 32. Of records whose payloads of at least ``least`` bytes are
equal, the one of the smallest page id stays; the others become ``revisit`` records that keep
their HTTP header and name the first. The groups are found in a pass that carries no payload, by an
aggregation with map-side combining.

*Files.* Spark's text writer with the record separator as its line separator writes exactly the
record sequence that the format asks for, gzip-compressed, each file headed by a ``warcinfo`` record.
Records are built as bytes, and Spark's cast of bytes to a string and its text writer pass them on as they
are, so HTTP headers and payloads (images, compressed bodies, any charset) come out byte for byte.
``read_warc`` parses them by their declared lengths.

Cases: null content counts as empty, a null URL as ``-``; white space and control characters in a
URL are percent-encoded, as both formats need, and so are bytes of an ARC header line that aren't UTF-8; a null page id ranks last and stays null; rows that
agree in all columns are one record and are all responses; empty tables give no records; truncated or
malformed ARC content ends that file with a row of type ``error`` instead of failing the job.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import batches_by_bytes, materialize, ship, table

#: Fields of a header line by version (fixed values of the format).
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
LAST = (1 << 63) - 1
RECORDS_PER_FILE = 20_000
UNSAFE = re.compile(r"[\x00-\x20\x7f]")
RECORD = ("record_id string, uri string, ip string, date string, type string, media string, page_id long, "
          "payload_bytes long, payload_digest string, block_digest string, head binary, payload binary")


def _percent(e: UnicodeDecodeError) -> tuple[str, int]:
    return "".join(f"%{x:02X}" for x in e.object[e.start:e.end]), e.end


codecs.register_error("channelwise-percent", _percent)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- ARC

def arc_file(name: str, version: int, records: list[tuple[str | None, str, int | None, bytes]]) -> bytes:
    """An ARC file of HTTP replies: (url, 14-digit date, page id, payload)."""
    about = f"{version} 0 channelwise\n{' '.join(FIELDS[version])}\n"
    extra = "200 - - 0 - " if version == 2 else ""
    out = [f"filedesc://{name} 0.0.0.0 20240101000000 text/plain {extra}{len(about)}\n{about}\n".encode()]
    for url, date, page, payload in records:
        own = f"X-Page-Id: {page}\r\n" if page is not None else ""
        head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}"
                f"Content-Length: {len(payload)}\r\n\r\n").encode()
        safe = UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url or "-")
        middle = f"200 - - {sum(map(len, out))} {name} " if version == 2 else ""
        out.append(f"{safe} 0.0.0.0 {date} text/html {middle}{len(head) + len(payload)}\n".encode() + head + payload + b"\n")
    return b"".join(out)


def parse_arc(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields, content) of every record; ValueError where the file breaks its own lengths."""
    line_end = content.find(b"\n")
    first = content[:line_end].decode("utf-8", "replace").split(" ")
    if line_end < 0 or not first[0].startswith("filedesc://") or not first[-1].isdigit():
        raise ValueError("no version block")
    at = line_end + 1 + int(first[-1])
    about = content[line_end + 1:at].split(b"\n")
    version = about[0].split(b" ")[0]
    if not version.isdigit() or int(version) not in FIELDS:
        raise ValueError(f"unknown version {version!r}")
    names = FIELDS[int(version)]
    while True:
        while content[at:at + 1] == b"\n":
            at += 1
        if at >= len(content):
            return
        line_end = content.find(b"\n", at)
        values = content[at:max(line_end, at)].decode("utf-8", "channelwise-percent").rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"bad header line at {at}")
        at, size = line_end + 1, int(values[-1])
        if at + size > len(content):
            raise ValueError(f"truncated record at {at}")
        yield dict(zip(names, values)), content[at:at + size]
        at += size


def convert(fields: dict, block: bytes) -> tuple:
    """A row of RECORD for one ARC record."""
    digits = (re.sub(r"\D", "", fields["Archive-date"]) + "0101000000")[:14] if len(fields["Archive-date"]) < 14 \
        else fields["Archive-date"][:14]
    date = f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"
    head, payload, kind, media, page = b"", block, "resource", fields["Content-type"], None
    if block.startswith(b"HTTP/"):
        top, gap, rest = block.partition(b"\r\n\r\n")
        head, payload, kind, media = top + gap, rest, "response", "application/http; msgtype=response"
        if m := re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head):
            page = int(m.group(1))
    name = "\n".join((fields["URL"], fields["Archive-date"], sha1(block)))
    return (f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}", fields["URL"], fields["IP-address"], date, kind, media,
            page, len(payload), sha1(payload), sha1(block), head, payload)


_TYPES = [pa.string()] * 6 + [pa.int64(), pa.int64()] + [pa.string()] * 2 + [pa.binary()] * 2
_NAMES = [x.split(" ")[0] for x in RECORD.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_TYPES)], _NAMES)


def records(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The converted records of ARC files (path, content), without their payloads if not asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                rows, size = [], 0
                try:
                    for fields, block in parse_arc(content or b""):
                        row = convert(fields, block)
                        rows.append(row if payloads else (*row[:-1], None))
                        size += len(block)
                        if size > 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                except ValueError as e:
                    rows.append((None, path, None, None, "error", str(e), None, 0, None, None, None, None))
                yield _batch(rows)

    return files.select("path", "content").mapInArrow(run, RECORD)


# ---------------------------------------------------------------- WARC

def revisits(found: DataFrame, least: int) -> DataFrame:
    """(record_id, first_id, first_page, first_uri, first_date) of the records that revisit another."""
    rows = found.filter((F.col("payload_bytes") >= least) & (F.col("type") == "response")).select(
        "record_id", "uri", "date", "payload_digest", "payload_bytes", F.coalesce("page_id", F.lit(LAST)).alias("page"))
    group = ["payload_digest", "payload_bytes"]
    shared = rows.groupBy(*group).agg(F.min("page").alias("page"), F.count("*").alias("n")).filter("n > 1")
    # rows that share the smallest page id: the smallest identifier is the first
    first = (rows.join(shared.select(*group, "page"), [*group, "page"]).groupBy(*group, "page")
             .agg(F.min(F.struct("record_id", "uri", "date")).alias("f"))
             .select(*group, F.col("page").alias("first_page"), F.col("f.record_id").alias("first_id"),
                     F.col("f.uri").alias("first_uri"), F.col("f.date").alias("first_date")))
    return rows.join(first, group).filter("record_id != first_id").select(
        "record_id", "first_id", "first_page", "first_uri", "first_date").dropDuplicates(["record_id"])


def warc_record(r: dict) -> bytes:
    """The bytes of one record up to its closing blank lines."""
    again = r["first_id"] is not None
    block = r["head"] if again else r["head"] + r["payload"]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if again else r['type']}", f"WARC-Record-ID: <{r['record_id']}>",
             f"WARC-Date: {r['date']}", f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}",
             f"WARC-Payload-Digest: sha1:{r['payload_digest']}"]
    if again:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{r['first_id']}>",
                  f"WARC-Refers-To-Target-URI: {r['first_uri']}", f"WARC-Refers-To-Date: {r['first_date']}",
                  f"WARC-Block-Digest: sha1:{sha1(block)}"]
        if r["first_page"] != LAST:
            lines.append(f"X-Refers-To-Page: {r['first_page']}")
    else:
        lines.append(f"WARC-Block-Digest: sha1:{r['block_digest']}")
    return "\r\n".join([*lines, f"Content-Type: {r['media']}", f"Content-Length: {len(block)}", "", ""]).encode() + block


def write_warc(files: DataFrame, path: str, least: int = 0) -> None:
    """Convert ARC files (path, content) and write WARC files below ``path``. The records meet their
    revisit decisions in a join by identifier, which Spark broadcasts only if the written table of
    revisits is small."""
    found = records(files, payloads=False).select(
        "record_id", "uri", "date", "type", "page_id", "payload_bytes", "payload_digest")
    decided = materialize(revisits(materialize(found, "digests"), least), "revisits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = "software: channelwise\r\nformat: WARC File Format 1.1\r\n"
        info = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                f"WARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\n"
                f"Content-Length: {len(text)}\r\n\r\n{text}").encode()
        for b in batches_by_bytes(batches, "payload"):
            out = [info] if info else []
            info = None
            out += [warc_record(r) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    joined = records(files).filter("type != 'error'").join(decided, "record_id", "left")
    (joined.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_warc(stream) -> Iterator[tuple[dict, bytes]]:
    """(header, block) of every record of an open WARC file, by declared lengths."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record where one should begin: {line[:40]!r}")
        header = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            header[name.lower()] = value.strip()
        yield header, stream.read(int(header["content-length"]))


def read_warc(spark, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the responses, resources and
    revisits of the WARC files below ``path``. A response's size and digest are those of the payload
    that was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                rows = []
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as stream:
                    for header, block in parse_warc(stream):
                        kind = header["warc-type"]
                        if kind == "warcinfo":
                            continue
                        head, gap, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
                        page = re.search(rb"\r\nX-Page-Id: (-?\d+)", head)
                        size, digest = len(payload), header["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "revisit":
                            size = int(re.search(rb"\r\nContent-Length: (\d+)", head).group(1))
                        else:
                            digest = sha1(payload)
                        refers = header.get("x-refers-to-page")
                        rows.append((int(page.group(1)) if page else None, size, digest, kind, int(refers) if refers else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(
                        [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()])],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def page_archives(pages: DataFrame) -> DataFrame:
    """Stand-in input: the pages as rows of (path, content), ARC files of about 4 MB, of version 1 and 2
    in turn, as ``binaryFile`` would read them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, b in enumerate(batches_by_bytes(batches, "html")):
            rows = [(u, "20240101000000", p, (h or "").encode()) for p, u, h in zip(
                b.column("page_id").to_pylist(), b.column("url").to_pylist(), b.column("html").to_pylist())]
            name = f"pages-{k}.arc"
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array(
                [arc_file(name, 1 + k % 2, rows)], pa.binary())], ["path", "content"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "path string, content binary")


def op9_arc_to_warc(spark, sf_dir: str) -> DataFrame:
    """Every page through an ARC file, converted to WARC files, read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""
    ship(spark)
    path = scratch_path(spark, "llm-warc")
    write_warc(page_archives(table(spark, sf_dir, "pages")), path, least=0)
    return read_warc(spark, path)


#: SQL has no base 32, so the digest is spelled five bits at a time from the hexadecimal SHA-1.
ORACLE_OP9 = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex FROM p),
b AS (
  SELECT page_id, payload_bytes, hex,
         array_to_string(list_transform(range(160), lambda i:
           CAST((instr('0123456789abcdef', hex[CAST(i // 4 + 1 AS INTEGER)]) - 1) >> CAST(3 - i % 4 AS BIGINT) & 1
                AS VARCHAR)), '') AS bits
  FROM d),
e AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(32), lambda k:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(1 + 16 * CAST(bits[5 * k + 1] AS INTEGER)
             + 8 * CAST(bits[5 * k + 2] AS INTEGER) + 4 * CAST(bits[5 * k + 3] AS INTEGER)
             + 2 * CAST(bits[5 * k + 4] AS INTEGER) + CAST(bits[5 * k + 5] AS INTEGER) AS INTEGER)]), '')
           AS payload_digest
  FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = min(page_id) OVER w THEN NULL ELSE min(page_id) OVER w END AS refers_to
FROM e WINDOW w AS (PARTITION BY payload_digest, payload_bytes)
"""
