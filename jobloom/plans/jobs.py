"""Job entry points (UDF-3): the producer run and the consumer run.

    python -m jobloom produce --pages PATH --out PATH [--sources JSON] [--topic T --sink PATH | --bootstrap ...]
    python -m jobloom consume --messages PATH --out PATH [--no-enrich] [--failures PATH]

Settings that the original reads from the environment are keyword arguments
here; a deployment passes them from its own configuration.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from jobloom.functions import vocab as V
from jobloom.plans import produce as PR
from jobloom.functions.urls import site_origin
from jobloom.sinks.kafka import include_headers, publish, publish_options
from jobloom.sources.config import SourceConfigError, load_sources, merged_listings, sources_without_pages
from jobloom.sources.messages import broker_options, consumer_options, read_messages
from jobloom.sources.pages import cap_body_size, read_pages, rejected_pages
from jobloom.streaming.consumer import ConsumerConfig, consume
from jobloom.streaming.storage import record_failure


#: messages (or files of a file stream) of one micro-batch
BATCH_MESSAGES = 10_000


class EmptyRunError(RuntimeError):
    """The run produced no job rows (a failed run)."""


def produce_job(spark: SparkSession, *, pages_path: str, merged_path: str, sources_json: str | None = None,
                fallback_url: str | None = None, rows_per_batch: int = V.ROWS_PER_PAYLOAD,
                max_response_bytes: int | None = None, topic: str | None = None, sink_path: str | None = None,
                kafka: dict | None = None, event_hubs: bool = False, max_message_bytes: int | None = None,
                join_on: str = "url", rejects_path: str | None = None, single_message: bool = False,
                merge_urls: str | None = None, title_max_chars: int = V.TITLE_MAX_CHARS, keep_all_query_params: bool = False) -> dict:
    """Pages -> merged Parquet output (+ batched messages). Returns run counts.

    With ``sources_json`` (or ``fallback_url``) pages are matched to sources on
    ``join_on``; otherwise every page is its own source. Zero rows fail the run. Pages over the byte cap are left
    out, counted and, with ``rejects_path``, listed; a run over one listing (``fallback_url`` alone) fails on them. Sources without
    an accepted page are counted. ``single_message`` publishes the whole output as one message. With ``merge_urls`` (comma-separated) the
    jobs of further listings follow those of ``fallback_url``, first occurrence of a job kept. ``keep_all_query_params`` keeps job URLs
    apart that differ in tracking parameters only.
    """
    landed = read_pages(spark, pages_path)
    pages = cap_body_size(landed, max_bytes=max_response_bytes)
    if merge_urls and not sources_json:
        if not (fallback_url or "").strip():
            raise SourceConfigError("a merge list needs the primary listing URL")
        sources = merged_listings(spark, fallback_url, merge_urls)
    else:
        sources = load_sources(spark, sources_json, fallback_url) if (sources_json or fallback_url) else None
    rejects = rejected_pages(landed, max_bytes=max_response_bytes)
    if rejects_path:
        rejects.write.mode("overwrite").parquet(rejects_path)
        rejects = spark.read.parquet(rejects_path)
    n_rejected = rejects.count()
    if n_rejected and sources is not None and not sources_json:
        raise EmptyRunError(f"{n_rejected} page(s) of the listing are over the byte cap")
    n_failed = 0 if sources is None else sources_without_pages(pages.withColumn(
        "origin", site_origin("url")) if join_on == "origin" else pages, sources, join_on).count()
    result = PR.produce(pages, sources, rows_per_batch=rows_per_batch, on=join_on, title_max_chars=title_max_chars,
                        keep_all_query_params=keep_all_query_params)
    # a count over the checkpointed numbering (cheap); DataFrame.observe upstream of the
    # range sort would count twice, because the sort samples its input in a separate job
    n = result.merged.count()
    if n == 0:
        raise EmptyRunError("no open positions from any source; check the sources and the page markup")
    PR.write_merged(result.merged, merged_path)
    n_batches = 0
    if topic and (sink_path or kafka):
        msgs = PR.single_message(result.merged, topic, max_message_bytes) if single_message else \
            PR.messages(result.batches, topic=topic, max_message_bytes=max_message_bytes)
        opts = publish_options(kafka, event_hubs=event_hubs) if kafka else None
        publish(msgs, options=opts, sink_path=sink_path, with_headers=include_headers(event_hubs),
                max_message_bytes=max_message_bytes)
        n_batches = 1 if single_message else -(-n // rows_per_batch)
    return {"rows": n, "batches": n_batches, "rejected_pages": n_rejected, "failed_sources": n_failed}


def consume_job(spark: SparkSession, *, out_path: str, messages_path: str | None = None,
                kafka: dict | None = None, topic: str | None = None, starting_offsets: str = "earliest",
                enrich: bool = True, failures_path: str | None = None, checkpoint_path: str | None = None,
                max_offsets_per_trigger: int | None = BATCH_MESSAGES, timeout_s: float | None = None, blob_prefix: str | None = None,
                layout: str = "batch", available_now: bool = True, max_messages: int | None = None):
    """Messages (Kafka or a Parquet file stream with the Kafka row shape) -> stored rows. A broker or stream that cannot be
    set up leaves a failure record of the kind ``startup``."""
    try:
        if kafka:
            opts = consumer_options(topic or "", starting_offsets=starting_offsets,
                                    max_offsets_per_trigger=max_offsets_per_trigger, **kafka)
            stream = read_messages(spark, kafka_options=opts)
        else:
            stream = read_messages(spark, path=messages_path, max_files_per_trigger=max_offsets_per_trigger)
    except Exception as exc:
        record_failure(spark, failures_path, "startup", exc)
        raise
    cfg = ConsumerConfig(output_path=out_path, checkpoint_path=checkpoint_path, failures_path=failures_path,
                         enrich=enrich, blob_prefix=blob_prefix, layout=layout, max_messages=max_messages)
    return consume(spark, stream, cfg, available_now=available_now, timeout_s=timeout_s)


def main(argv: list[str] | None = None) -> int:
    from jobloom.session import get_spark

    ap = argparse.ArgumentParser(prog="jobloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("produce")
    p.add_argument("--pages", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--sources")
    p.add_argument("--fallback-url")
    p.add_argument("--merge-urls")
    p.add_argument("--keep-all-query-params", action="store_true")
    p.add_argument("--title-max-chars", type=int, default=V.TITLE_MAX_CHARS)
    p.add_argument("--rows-per-batch", type=int, default=V.ROWS_PER_PAYLOAD)
    p.add_argument("--topic")
    p.add_argument("--sink")
    p.add_argument("--bootstrap")
    p.add_argument("--eventhub-connection-string")
    c = sub.add_parser("consume")
    c.add_argument("--messages")
    c.add_argument("--out", required=True)
    c.add_argument("--topic")
    c.add_argument("--bootstrap")
    c.add_argument("--eventhub-connection-string")
    c.add_argument("--starting-offsets", default="earliest")
    c.add_argument("--no-enrich", action="store_true")
    c.add_argument("--failures")
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--batch-messages", type=int, default=BATCH_MESSAGES)
    c.add_argument("--timeout", type=float)
    c.add_argument("--max-messages", type=int)
    args = ap.parse_args(argv)
    spark = get_spark()
    broker = None
    if getattr(args, "bootstrap", None) or getattr(args, "eventhub_connection_string", None):
        broker = broker_options(eventhub_connection_string=args.eventhub_connection_string,
                                bootstrap_servers=args.bootstrap)
    if args.cmd == "produce":
        stats = produce_job(spark, pages_path=args.pages, merged_path=args.out, sources_json=args.sources,
                            fallback_url=args.fallback_url, rows_per_batch=args.rows_per_batch, topic=args.topic,
                            sink_path=args.sink, kafka=broker, event_hubs=bool(args.eventhub_connection_string),
                            merge_urls=args.merge_urls, title_max_chars=args.title_max_chars, keep_all_query_params=args.keep_all_query_params)
        print(f"wrote {stats['rows']} rows to {args.out}; {stats['batches']} payload message(s)")
    else:
        consume_job(spark, out_path=args.out, messages_path=args.messages, kafka=broker, topic=args.topic,
                    starting_offsets=args.starting_offsets, enrich=not args.no_enrich,
                    failures_path=args.failures, checkpoint_path=args.checkpoint,
                    max_offsets_per_trigger=args.batch_messages, timeout_s=args.timeout,
                    max_messages=args.max_messages)
    return 0


if __name__ == "__main__":
    sys.exit(main())
