"""Producer job: listing pages -> clean, numbered job rows -> Parquet output and messages.

Stages (each a DataFrame, the whole plan is lazy until written):

1. ``gather_records``: pages tagged with their source (SRC-5), job rows per page
   (SET-3) in (source, page, phase, position) order (SET-2);
2. ``clean_records``: the record cleaning of AGG-4, applied twice as the
   producer does (once after gathering, once again when writing);
3. ``numbered``: global 1..n by case-folded title (SRT-1, WIN-1);
4. ``merged`` (SNK-1) and ``batches`` (WIN-2) from the same numbering;
5. ``messages``: one Parquet payload per batch with key ``parquet-batch-{i}``
   (SNK-2, SNK-4), in parts where one would exceed the message cap (SNK-3); ``source_messages``: one per source.

Shuffles: one per cleaning pass (keyed on the job URL, partial aggregation on
the map side), one range shuffle for the numbering, one for packing batches.
Extraction itself is narrow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions import vocab as V
from jobloom.functions.urls import site_origin
from jobloom.operators.extract import extract_jobs
from jobloom.operators.ordering import batch_index, byte_batches, global_index, title_sort_key
from jobloom.operators.sanitize import sanitize_records
from jobloom.plans.payload import PayloadTooLarge, max_payload_bytes, pack_payloads
from jobloom.sources.config import attach_source

RECORD_ORDER = ("source_order", "page_id", "phase", "pos")


def gather_records(pages: DataFrame, sources: DataFrame | None = None, on: str = "origin", **extraction) -> DataFrame:
    """``source, source_order, page_id, phase, pos, position_title, job_url``.

    Without ``sources`` every page is its own source (id = page origin). With
    ``sources`` (``pos, id, url, origin``) pages join on ``on`` (a page column,
    computed as the page origin when absent); the source's ``origin`` resolves
    relative links and ``pos`` orders sources. ``extraction``: ``title_max_chars``, ``keep_all_query_params``.
    """
    keep = ("source", "source_order", "page_id")
    if sources is None:
        o = site_origin(F.col("url"))
        tagged = pages.select("*", o.alias("src_origin"), o.alias("source"), o.alias("source_order"))
        return extract_jobs(tagged, keep=keep, origin="src_origin", **extraction)
    left = pages if on in pages.columns else pages.withColumn(on, site_origin(F.col("url")))
    order = F.col("pos") if "pos" in sources.columns else F.col("id")
    side = sources.select(F.col(on), F.col("id").alias("source"), F.col("origin").alias("src_origin"),
                          order.alias("source_order"))
    tagged = attach_source(left, side, on=on, source_cols=(on, "source", "src_origin", "source_order"))
    return extract_jobs(tagged, keep=keep, origin="src_origin", **extraction)


def clean_records(records: DataFrame, passes: int = 2, order=RECORD_ORDER,
                  title_max_chars: int = V.TITLE_MAX_CHARS, keep_all_query_params: bool = False) -> DataFrame:
    out = records
    for _ in range(passes):
        out = sanitize_records(out, order=list(order), title_max_chars=title_max_chars, keep_all_query_params=keep_all_query_params)
    return out


def numbered(records: DataFrame, index_col: str = "rn") -> DataFrame:
    """Rows numbered 1..n by case-folded title (ties: title, URL, source)."""
    return global_index(records, title_sort_key("position_title", "job_url", "source"), index_col=index_col)


def merged(numbered_records: DataFrame, rn: str = "rn") -> DataFrame:
    """The merged output: ``Index, Position title`` in title order (SNK-1)."""
    return numbered_records.select(F.col(rn).alias("Index"), F.col("position_title").alias("Position title"))


def batches(numbered_records: DataFrame, rows_per_batch: int = V.ROWS_PER_PAYLOAD, rn: str = "rn") -> DataFrame:
    """``batch_no, Index, Position title``: ``Index`` restarts at 1 per batch (WIN-2)."""
    b = batch_index(numbered_records, rows_per_batch, rn=rn)
    return b.select("batch_no", "Index", F.col("position_title").alias("Position title"))


def _kafka_rows(packed: DataFrame, topic: str, name: F.Column, headers: bool, *more: str) -> DataFrame:
    """Sink rows of packed payloads; the key of a further piece or part of a batch has the numbers of both behind."""
    hdr = (F.array(F.struct(F.lit("format").alias("key"), F.lit(b"parquet").cast("binary").alias("value")),
                   F.struct(F.lit("content-type").alias("key"),
                            F.encode(F.lit(V.PAYLOAD_CONTENT_TYPE), "UTF-8").alias("value")))
           if headers else F.lit(None).cast("array<struct<key:string,value:binary>>"))
    piece = F.col("piece") if "piece" in packed.columns else F.lit(0)
    number = F.concat(F.lit("-part-"), piece.cast("string"), F.lit("."), F.col("part").cast("string"))
    key = F.concat(name, F.when((piece > 0) | (F.col("part") > 0), number).otherwise(F.lit("")))
    return packed.select(F.lit(topic).alias("topic"), F.encode(key, "UTF-8").alias("key"), "value", hdr.alias("headers"), *more, "part", "n_rows")


def messages(batch_rows: DataFrame, topic: str, headers: bool = True, max_message_bytes: int | None = None) -> DataFrame:
    """Kafka sink rows ``topic, key, value, headers, batch_no, part, n_rows``: one Parquet
    payload per batch, key ``parquet-batch-{batch_no}``. No payload exceeds the cap: a batch that would goes out in parts."""
    packed = pack_payloads(batch_rows, ["batch_no"], ["Index", "Position title"], max_bytes=max_payload_bytes(max_message_bytes))
    return _kafka_rows(packed, topic, F.concat(F.lit("parquet-batch-"), F.col("batch_no").cast("string")), headers, "batch_no")


def source_messages(records: DataFrame, topic: str, rows_per_batch: int = V.ROWS_PER_PAYLOAD, headers: bool = True,
                    max_message_bytes: int | None = None) -> DataFrame:
    """One message for each source (SNK-4): its titles in title order, ``Index`` 1..n within the source, key
    ``open_positions/{source}``. A source over the row or byte budget goes out in parts, cut by a distributed prefix sum of
    the rows' bytes, so no task holds more than a message. Columns ``topic, key, value, headers, source, piece, part, n_rows``."""
    cap = max_payload_bytes(max_message_bytes)
    size = F.octet_length("position_title") + F.lit(16)
    cut = byte_batches(records, ["source"], title_sort_key("position_title", "job_url"), size, max(1, cap // 2), rows_per_batch, part_col="piece")
    rows = cut.select("source", "piece", "Index", F.col("position_title").alias("Position title"))
    packed = pack_payloads(rows, ["source", "piece"], ["Index", "Position title"], max_bytes=cap)
    return _kafka_rows(packed, topic, F.concat(F.lit(f"{V.TITLE_ONLY_KEY}/"), F.coalesce("source", F.lit(""))), headers, "source", "piece")


def single_message(merged_rows: DataFrame, topic: str, max_message_bytes: int | None = None) -> DataFrame:
    """The whole merged output of a small run as one message with the key ``open_positions`` (SNK-4). A message has a size cap, so one
    task may hold it; an output whose titles alone are far over the cap is refused before any packing (``source_messages`` splits)."""
    cap = max_payload_bytes(max_message_bytes)
    size = merged_rows.agg(F.sum(F.octet_length("Position title"))).first()[0] or 0
    if size > 16 * cap:
        raise PayloadTooLarge(f"the titles have {size} bytes, one message holds {cap}; publish batches instead")
    packed = pack_payloads(merged_rows.withColumn("batch_no", F.lit(0).cast("long")), ["batch_no"], ["Index", "Position title"])
    return _kafka_rows(packed, topic, F.lit(V.TITLE_ONLY_KEY), True, "batch_no")


@dataclass
class ProduceResult:
    records: DataFrame
    merged: DataFrame
    batches: DataFrame


def produce(pages: DataFrame, sources: DataFrame | None = None, rows_per_batch: int = V.ROWS_PER_PAYLOAD,
            on: str = "origin", title_max_chars: int = V.TITLE_MAX_CHARS, keep_all_query_params: bool = False) -> ProduceResult:
    """Plan the whole producer run; callers write ``merged`` and publish ``messages(batches)``."""
    settings = {"title_max_chars": title_max_chars, "keep_all_query_params": keep_all_query_params}
    recs = clean_records(gather_records(pages, sources, on=on, **settings), **settings)
    num = numbered(recs)
    return ProduceResult(records=recs, merged=merged(num), batches=batches(num, rows_per_batch))


def titles_output(titles: DataFrame, order, title: str = "title",
                  title_max_chars: int = V.TITLE_MAX_CHARS) -> DataFrame:
    """Title-only output (AGG-5 + WIN-1): normalized titles, first of each case-folded
    title kept, numbered A-Z: ``Index, Position title``."""
    from jobloom.operators.sanitize import dedupe_titles

    unique = dedupe_titles(titles, order, title=title, title_max_chars=title_max_chars)
    n = global_index(unique, title_sort_key(title), index_col="Index")
    return n.select("Index", F.col(title).alias("Position title"))


def write_merged(merged_rows: DataFrame, path: str, single_file: bool = False) -> None:
    """The sorted two-column Parquet output; overwrite; an empty result keeps the schema.

    Rows are range-partitioned by ``Index`` already, so every file is one sorted
    slice and the part files are in order. ``single_file=True`` writes one file
    through one task -- for outputs known to be small only.
    """
    out = merged_rows.coalesce(1) if single_file else merged_rows
    out.sortWithinPartitions("Index").write.mode("overwrite").parquet(path)
