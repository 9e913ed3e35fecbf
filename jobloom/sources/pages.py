"""Landed listing pages as a table (SRC-1, SRC-2, SRC-3, SNK-7).

Crawling is upstream of this engine; pages arrive either as a Parquet table
``page_id, url, html`` or as raw files (``binaryFile``: ``path, length,
content``). Oversized bodies are rejected by a byte cap before any parsing, so
no task ever holds a page above the cap.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.functions import vocab as V
from jobloom.functions.common import col
from jobloom.functions.text import safe_label


def max_response_bytes(limit: int | None = None) -> int:
    return max(V.MAX_RESPONSE_BYTES_FLOOR, int(limit if limit is not None else V.MAX_RESPONSE_BYTES))


def read_pages(spark: SparkSession, path: str, columns=("page_id", "url", "html")) -> DataFrame:
    """Pages from Parquet; only the needed columns are read."""
    return spark.read.parquet(path).select(*columns)


def read_raw_pages(spark: SparkSession, path: str, glob: str = "*.html", charset: str | None = None,
                   max_bytes: int | None = None) -> DataFrame:
    """Raw page files -> ``url (file path), n_bytes, html``, in ``charset`` or the one that each file shows; files above the byte cap are
    dropped before their content is decoded (use ``rejected_raw_pages`` to list them)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    cap = max_response_bytes(max_bytes)
    return (raw.filter(F.col("length") <= cap)
            .select(F.col("path").alias("url"), F.col("length").alias("n_bytes"),
                    decode_body(F.col("content"), charset, detect=charset is None).alias("html")))


def rejected_raw_pages(spark: SparkSession, path: str, glob: str = "*.html", max_bytes: int | None = None) -> DataFrame:
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return raw.filter(F.col("length") > max_response_bytes(max_bytes)).select("path", "length")


# fixed values: byte order marks and the charsets they stand for
BYTE_ORDER_MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
#: bytes at the beginning of a page in which a meta tag may name its charset
META_BYTES = 1024
_META = r"""(?is)<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([a-z0-9_.:+-]+)"""
_UTF8 = ("utf-8", "utf8", "utf_8", "us-ascii", "ascii")


@F.arrow_udf(T.StringType())
def _decoded(bodies: pa.Array, charsets: pa.Array) -> pa.Array:
    """Bytes in any charset that Python knows -> text, bad bytes as U+FFFD; an unknown charset is read as UTF-8; null for null."""
    out = []
    for body, name in zip(bodies.to_pylist(), charsets.to_pylist(), strict=True):
        if body is None:
            out.append(None)
            continue
        try:
            text = body.decode(name or "utf-8", errors="replace")
        except (LookupError, ValueError, AttributeError):  # no such charset, or not one of text
            text = body.decode("utf-8", errors="replace")
        if not isinstance(text, str):
            text = body.decode("utf-8", errors="replace")
        out.append(text.encode("utf-8", "replace").decode())  # lone surrogates of UTF-7 and the like
    return pa.array(out, pa.string())


def body_charset(body: Column, declared: str | Column | None = None) -> Column:
    """The charset of a body, lower-case: as declared (of the response's header), by its byte order mark, by its meta tag, else UTF-8."""
    given = F.lit(declared) if isinstance(declared, str) else declared
    named = F.lower(F.trim(given)) if given is not None else F.lit(None).cast("string")
    marked = F.lit(None).cast("string")
    for mark, name in reversed(BYTE_ORDER_MARKS):
        marked = F.when(F.substring(body, 1, len(mark)) == F.lit(mark), F.lit(name)).otherwise(marked)
    head = F.decode(F.substring(body, 1, META_BYTES), "ISO-8859-1")
    meta = F.lower(F.regexp_extract(head, _META, 1))
    filled = lambda c: F.when(c != "", c)
    return F.coalesce(filled(named), marked, filled(meta), F.lit("utf-8"))


def decode_body(body: Column, charset: str | Column | None = None, detect: bool = False) -> Column:
    """Bytes -> text (SRC-3), bad bytes replaced by U+FFFD; nothing raises.

    ``charset`` is one name for all rows or a column of names (null: UTF-8); with ``detect`` a row without one is read by its byte order
    mark or meta tag. UTF-8 rows are decoded by a built-in expression, only the others by the charset decoder. A byte order mark is no text.
    """
    if charset is None and not detect:
        return F.make_valid_utf8(body.cast("string"))
    if isinstance(charset, str) and charset.strip().lower() in _UTF8 and not detect:
        return F.make_valid_utf8(body.cast("string"))
    declared = F.lit(charset) if isinstance(charset, str) else charset
    name = body_charset(body, declared) if detect else F.coalesce(F.lower(F.trim(declared)), F.lit("utf-8"))
    own = body
    for mark, _ in BYTE_ORDER_MARKS if detect else ():
        own = F.when(F.substring(body, 1, len(mark)) == F.lit(mark), F.substring(body, len(mark) + 1, 2147483647)).otherwise(own)
    utf8 = name.isin(*_UTF8)
    other = _decoded(F.when(~utf8, own), F.when(~utf8, name))
    return F.when(utf8, F.make_valid_utf8(own.cast("string"))).otherwise(other)


def with_body_cap(pages: DataFrame, html: str | Column = "html", max_bytes: int | None = None) -> DataFrame:
    """Adds ``n_bytes`` and ``accepted`` (body within the byte cap; exactly the cap passes) (SRC-2)."""
    cap = max_response_bytes(max_bytes)
    n = F.octet_length(col(html))
    return pages.withColumn("n_bytes", n).withColumn("accepted", F.coalesce(n <= cap, F.lit(True)))


def cap_body_size(pages: DataFrame, html: str = "html", max_bytes: int | None = None) -> DataFrame:
    """Pages within the byte cap (SRC-2)."""
    cap = max_response_bytes(max_bytes)
    return pages.filter(F.coalesce(F.octet_length(F.col(html)) <= cap, F.lit(True)))


def rejected_pages(pages: DataFrame, html: str = "html", max_bytes: int | None = None) -> DataFrame:
    """The pages over the byte cap, without their bodies (SRC-2)."""
    return with_body_cap(pages, html, max_bytes).filter(~F.col("accepted")).drop("accepted", html)


def land_raw_pages(pages: DataFrame, path: str, label: str | Column = "url", html: str = "html") -> None:
    """Keep a copy of the raw HTML under a storage-safe label (SNK-7); rewrites the labels
    it writes and leaves other labels in place."""
    (pages.select(safe_label(col(label)).alias("label"), col(html).alias("html"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("label").parquet(path))
