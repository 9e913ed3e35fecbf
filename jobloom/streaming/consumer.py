"""Structured Streaming consumer of payload messages (STR-1 .. STR-6).

    messages (Kafka rows) -> drop empty values (FLT-6)
      enrichment off: every value is stored as it came, Parquet or not
      enrichment on:  footers checked -> rows unpacked, enriched, validated, stored;
                      payloads that were enriched before are also kept as they came

Every message, a payload without rows included, has its row in the messages table
(``messages_path``). Delivery (STR-2): the micro-batch is stored before its offsets
are committed. The offset ledger (``ledger.py``) lists what is stored: messages that it holds are passed over, and what a batch
cut off by a failure has left is removed first. So a replay, a run with a new checkpoint and
a run with other batch sizes all leave one copy of each message. Fail-stop (STR-3): bad payloads and validation failures are
written to the failures table, all of them, and fail the query without a commit.

Bounded runs (LIM-1, STR-5): with ``max_messages`` the run ends when that many non-empty messages are stored under this checkpoint, counted in
the ledger. Of the batch that goes beyond, the first ones in (topic, partition, offset) order are stored and
the batch is not committed; a later run with a higher number gets the rest. There is no watermark and no state store.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.operators.enrich import enrich_payload_rows
from jobloom.operators.ordering import global_index
from jobloom.operators.validate import ValidationError, first_violation, label_violations
from jobloom.plans.payload import payload_info, unpack_payloads
from jobloom.sources.messages import nonempty_messages
from jobloom.streaming.failures import FailureListener
from jobloom.streaming.ledger import Ledger
from jobloom.streaming.storage import record_failure, record_failures, store_messages, with_object_name

COORDS = ["topic", "partition", "offset"]
RAW_COLUMNS = ["Index", "Position title", "job_description", "complexity_score", "category", "seniority_level"]


class PayloadError(ValueError):
    """A message value is not a usable producer payload."""


class EnoughMessages(Exception):
    """The run has stored the number of messages it was asked for; its last batch goes beyond and is not committed."""


@dataclass
class ConsumerConfig:
    """``layout``: ``"batch"`` stores each micro-batch under ``topic=/first_message=`` (the first message
    that is new in it; rows keep their partition and offset): few large files. ``"message"`` stores every message under
    ``topic=/partition=/offset=`` like one object per message; at millions of messages
    that is millions of small files, so it is the opt-in layout."""
    output_path: str
    checkpoint_path: str | None = None
    failures_path: str | None = None
    enrich: bool = True
    blob_prefix: str | None = None
    layout: str = "batch"
    messages_path: str | None = None  # default: output_path with "-messages" behind
    ledger_path: str | None = None  # default: output_path with "-ledger" behind
    max_messages: int | None = None  # stop when so many are stored under this checkpoint
    failure_recorded: bool = False  # set when a batch wrote its own failure record
    run: str = field(default="")  # names the run in the ledger: the checkpoint

    def __post_init__(self):
        base = self.output_path.rstrip("/")
        self.messages_path = self.messages_path or f"{base}-messages"
        self.ledger_path = self.ledger_path or f"{base}-ledger"
        self.run = self.run or self.checkpoint_path or uuid.uuid4().hex


def _store(df: DataFrame, cfg: ConsumerConfig, path: str, intervals: DataFrame) -> None:
    df = with_object_name(df, enriched=cfg.enrich, **({"prefix": cfg.blob_prefix} if cfg.blob_prefix else {}))
    df = df.drop("key") if "key" in df.columns else df
    if cfg.layout == "message":
        store_messages(df, path)
    else:
        names = intervals.select("topic", "first_message").distinct()  # a row for each topic
        store_messages(df.join(names, "topic"), path, partition_cols=("topic", "first_message"))


def _admitted(msgs: DataFrame, left: int) -> tuple[DataFrame, bool]:
    """The first ``left`` messages in (topic, partition, offset) order, and whether others remain."""
    if msgs.count() <= left:
        return msgs, False
    if left <= 0:
        return msgs.limit(0), True
    first = global_index(msgs.select(*COORDS), COORDS, index_col="rn").filter(F.col("rn") <= left).select(*COORDS)
    return msgs.join(first, COORDS, "left_semi"), True


def _scored(msgs: DataFrame, cfg: ConsumerConfig, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(enriched rows, messages as they are kept); bad payloads and rows are recorded and raise."""
    info = payload_info(msgs, keep)
    has = lambda c: F.array_contains("payload_columns", c)
    usable = F.col("payload_error").isNull() & (has("complexity_score") | (has("Index") & has("Position title")))
    bad = info.filter(~F.coalesce(usable, F.lit(False))).select(
        *COORDS, F.coalesce("payload_error", F.lit("missing columns")).alias("why"))
    seen = bad.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*COORDS, "why")).alias("first")).first()
    if seen["n"]:
        err = PayloadError(f"{seen['n']} message(s) are not producer payloads; first "
                           f"{tuple(seen['first'][c] for c in COORDS)}: {seen['first']['why']}")
        cfg.failure_recorded = True
        record_failures(bad, cfg.failures_path, "message", err)
        raise err
    out = enrich_payload_rows(unpack_payloads(msgs, RAW_COLUMNS, keep=keep), keep).drop("enriched_before").persist()
    msg = first_violation(label_violations(out, COORDS))
    if msg:
        out.unpersist()
        err = ValidationError(msg)
        cfg.failure_recorded = True
        record_failure(msgs.sparkSession, cfg.failures_path, "validation", err)
        raise err
    before = has("complexity_score")
    return out, info.select(*keep, F.when(before, F.col("value")).alias("value"), before.alias("enriched_before"), "n_rows")


def process_batch(batch: DataFrame, cfg: ConsumerConfig, epoch_id: int | None = None) -> None:
    """Handle one micro-batch (also usable on a bounded DataFrame)."""
    spark = batch.sparkSession
    keep = COORDS + (["key"] if "key" in batch.columns else [])
    ledger = Ledger(spark, cfg.ledger_path, [cfg.output_path, cfg.messages_path])
    ledger.recover()
    msgs = nonempty_messages(batch).select(*keep, "value").persist()
    new, out, more = None, None, False
    try:
        new = ledger.new_messages(msgs)
        if cfg.max_messages is not None:
            new, more = _admitted(new, cfg.max_messages - ledger.stored_count(cfg.run))
        new = new.persist()
        if not new.isEmpty():
            if cfg.enrich:
                out, kept = _scored(new, cfg, keep)
            else:
                kept = new.withColumn("enriched_before", F.lit(None).cast("boolean")).withColumn("n_rows", F.lit(None).cast("long"))
            folder = ledger.begin(new, cfg.run)
            intervals = spark.read.parquet(folder)
            if cfg.enrich:
                _store(out, cfg, cfg.output_path, intervals)
            _store(kept, cfg, cfg.messages_path, intervals)
            ledger.finish(folder)
        if more:
            raise EnoughMessages(f"{cfg.max_messages} messages are stored")
    finally:
        for frame in (msgs, new, out):
            if frame is not None:
                frame.unpersist()


def consume(spark: SparkSession, messages: DataFrame, cfg: ConsumerConfig, available_now: bool = True,
            processing_time: str | None = None, timeout_s: float | None = None):
    """Start the consumer on a streaming ``messages`` frame; with ``available_now`` the
    query processes what is there and stops (a bounded run, STR-5); ``timeout_s`` ends the wait, and the query with it.
    The checkpoint path is required: a restart resumes from it."""
    if not cfg.checkpoint_path:
        raise ValueError("the consumer needs a checkpoint path that outlives the run")
    enough: list[EnoughMessages] = []

    def handle(df, epoch_id):
        try:
            process_batch(df, cfg, epoch_id)
        except EnoughMessages as exc:
            enough.append(exc)
            raise

    listener = FailureListener(spark, cfg.failures_path, skip=lambda: bool(enough) or cfg.failure_recorded)
    spark.streams.addListener(listener)
    try:
        writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", cfg.checkpoint_path)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
            processingTime=processing_time or "10 seconds")
        try:
            query = writer.start()
        except Exception as exc:
            record_failure(spark, cfg.failures_path, "startup", exc)
            raise
        listener.follow(query)
        try:
            if timeout_s and not query.awaitTermination(timeout_s):
                query.stop()
            elif not timeout_s:
                query.awaitTermination()
        except Exception:
            if not enough:  # the listener keeps the record; here the error goes on to the caller
                raise
        return query
    finally:
        listener.settle()
        spark.streams.removeListener(listener)
