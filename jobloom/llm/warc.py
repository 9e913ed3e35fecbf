"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

The writer makes one gzip member per record and lets Spark's text sink put them into files, so archives land on
any file system through Spark's own commit protocol. The reader checks every record (gzip checksum,
version line, lengths, end mark, digests). Where a check fails it searches for the next gzip member or version line that passes, goes
on from there, and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.operators.joins import join_small

from .common import scratch, table, written

END = b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
PREFIX = "urn:jobloom:page:"
DATE = "1970-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3
#: bytes of gzip members that are written as one row of the sink, and bytes of a file
BUNDLE_BYTES = 1 << 20
FILE_BYTES = 64 << 20


def base32_sha1(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


_EMPTY = gzip_member(b"")


def record(kind: str, page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One record. A revisit's block has the HTTP headers, with the length of the payload, but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    name = "" if page_id is None else page_id
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{PREFIX}{name}>"), ("WARC-Date", DATE),
              ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
              ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if kind == "revisit":
        fields += [("WARC-Refers-To", f"<{PREFIX}{refers_to}>"), ("WARC-Profile", IDENTICAL)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + END


# ---------------------------------------------------------------- reading


class Damaged(Exception):
    pass


def _parse(data, at: int):
    """The record at ``at`` of plain bytes: (fields, block, end). Raises Damaged."""
    version = VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    stop = data.find(END, version.end() - 2)
    if stop < 0:
        raise Damaged("headers do not end")
    fields = {}
    for line in data[version.end():stop].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if line and not colon:
            raise Damaged("malformed header")
        fields[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise Damaged("no Content-Length")
    begin, end = stop + 4, stop + 4 + int(length)
    if end > len(data):
        raise Damaged("record is cut off")
    if data[end:end + 4] != END:
        raise Damaged("no end of record")
    block = data[begin:end]
    for name, part in (("warc-block-digest", block), ("warc-payload-digest", _payload(fields, block))):
        algorithm, _, digest = fields.get(name, "").partition(":")
        if part is not None and algorithm.lower() == "sha1" and base32_sha1(part) != digest.upper():
            raise Damaged(f"{name} differs")
    return fields, block, end + 4


def _payload(fields: dict, block: bytes):
    """The payload of a record with HTTP headers; None for a revisit."""
    if fields.get("warc-type") == "revisit":
        return None
    if fields.get("content-type", "").startswith("application/http"):
        stop = block.find(END)
        return block[stop + 4:] if stop >= 0 else b""
    return block


def _inflate(data, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at``: its content and its end."""
    d, view, pos, out = zlib.decompressobj(31), memoryview(data), at, []
    try:
        while not d.eof:
            if pos >= len(view):
                raise Damaged("gzip member is cut off")
            chunk = view[pos:pos + 65536]
            out.append(d.decompress(chunk))
            pos += len(chunk)
    except zlib.error as e:
        raise Damaged(f"gzip: {e}") from None
    return b"".join(out), pos - len(d.unused_data)


def _next(data, at: int) -> int:
    """Where a member or a version line may begin, from ``at`` on."""
    found = [x for x in (data.find(MAGIC, at), data.find(b"WARC/1.", at)) if x >= 0]
    return min(found, default=len(data))


def salvage(data: bytes, inside: bool = False) -> Iterator[tuple]:
    """("record", start, end, fields, block) and ("gap", start, end, reason), in order, covering all bytes.

    Works on gzip members, plain records and any mixture. Positions are the file's; those of a record are its member's.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            if not inside and data.startswith(MAGIC, at):
                content, end = _inflate(data, at)
                found = list(salvage(content, True))
                if found and not any(x[0] == "record" for x in found):
                    raise Damaged(found[0][3])
                # a member that holds whole records and damage: its records count, its damage is a gap of the member
                here = [(x[0], at, end, *x[3:]) for x in found]
            else:
                fields, block, end = _parse(data, at)
                here = [("record", at, end, fields, block)]
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            at = _next(data, at + 1)
            continue
        if gap is not None:
            yield "gap", gap, at, reason
            gap = None
        yield from here
        at = end
    if gap is not None:
        yield "gap", gap, len(data), reason


ROWS = T.StructType([T.StructField("archive", T.StringType()), T.StructField("kind", T.StringType()),
                     T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("reason", T.StringType()), T.StructField("record_type", T.StringType()),
                     T.StructField("record_id", T.StringType()), T.StructField("target_uri", T.StringType()),
                     T.StructField("refers_to_id", T.StringType()), T.StructField("payload_digest", T.StringType()),
                     T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())])


def _row(archive: str, found: tuple, with_payload: bool) -> tuple:
    if found[0] == "gap":
        return (archive, *found, *[None] * 7)
    fields, block = found[3], found[4]
    payload = _payload(fields, block)
    digest = fields.get("warc-payload-digest", "").partition(":")[2].upper() or (base32_sha1(payload) if payload is not None else None)
    size = None if payload is None else len(payload)
    if size is None and (m := re.search(rb"(?im)^content-length:\s*([0-9]{1,18})\s*$", block)):
        size = int(m[1])  # a revisit repeats the HTTP headers of what it refers to
    name = lambda key: fields[key].strip("<>") if key in fields else None
    return (archive, "record", found[1], found[2], None, fields.get("warc-type"), name("warc-record-id"), fields.get("warc-target-uri"),
            name("warc-refers-to"), digest, size, payload if with_payload else None)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records (kind ``record``) and quarantined byte ranges (kind ``gap``, with the reason) of all archives in ``path``."""
    names = ROWS.fieldNames()

    def run(batches):
        kinds = pa.schema([(f, {"start": pa.int64(), "end": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}.get(f, pa.string()))
                           for f in names])
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held = [], 0
                for found in salvage(content.as_py() or b""):
                    rows.append(_row(archive, found, with_payload))
                    held += len(found[4]) if with_payload and found[0] == "record" else 200
                    if held > 1 << 23:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, ROWS)


# ---------------------------------------------------------------- writing


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Archive ``pages`` (page_id, url, html): one record per row, equal payloads as revisits of the smallest page_id.

    Files are cut by bytes: the sink gets bundles of members of about ``BUNDLE_BYTES``, and a file so many that ``file_bytes`` holds them even if
    each ended with the largest record of the table; a larger record has a file of its own. So a reader can take any file as one value.
    A null html is an empty payload, a null url has no target. A null page_id is never the smallest unless its group has no other; rows that
    repeat the smallest page_id of a payload are all responses. Very long payloads are kept whole. No rows make no records.
    """
    src = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("sha", F.unhex(F.sha1("payload")))
    groups = src.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"),
                                    F.max(F.octet_length("payload") + F.coalesce(F.octet_length("url"), F.lit(0))).alias("bytes"))
    groups = written(groups, "payloads")
    largest = groups.agg(F.max("bytes")).first()[0] or 0
    # headers and what gzip adds to data that does not shrink are small beside that
    bundles = max(1, file_bytes // (BUNDLE_BYTES + largest + largest // 1000 + 4096))
    rows = join_small(src, groups.filter("n > 1").select("sha", "first"), "sha", "left").select(
        "page_id", "url", "payload", "first",
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))

    def row_of(members):
        # the sink ends each row with a zero byte: that of the last member itself, or of an empty member after it
        data = b"".join(members)
        return pa.RecordBatch.from_arrays([pa.array([data[:-1] if data.endswith(b"\0") else data + _EMPTY[:-1]], pa.binary())], ["members"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for page_id, url, payload, first, revisit in zip(*batch.columns, strict=True):
                member = gzip_member(record("revisit" if revisit.as_py() else "response", page_id.as_py(), url.as_py(), payload.as_py(),
                                            first.as_py() if revisit.as_py() else None))
                held.append(member)
                size += len(member)
                if size >= BUNDLE_BYTES:
                    yield row_of(held)
                    held, size = [], 0
        if held:
            yield row_of(held)

    members = rows.mapInArrow(run, "members binary").select(F.col("members").cast("string").alias("value"))
    members.write.option("lineSep", "\0").option("maxRecordsPerFile", bundles).text(path)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path)
    page = lambda c: F.expr(f"nullif(substring({c}, {len(PREFIX) + 1}), '')").cast(pages.schema["page_id"].dataType)
    return read_archives(spark, path, with_payload=False).filter("kind = 'record'").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to_id").alias("refers_to"))


def op1_warc(spark, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id,
             list_transform(range(8), lambda k: ('0x' || substr(hex, CAST(k * 5 + 1 AS INTEGER), 5))::INTEGER) AS fives FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((fives[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31) AS INTEGER), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
