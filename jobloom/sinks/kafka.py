"""Publishing payload messages (SNK-4, SNK-5).

``publish`` writes rows ``topic, key, value[, headers]`` with Spark's Kafka sink;
``sink_path`` writes the same frame to Parquet instead (tests, dry runs, or a
landing zone). The messages are first written to the shared scratch folder and the size
check (SNK-3) reads their lengths there: nothing is sent unless every payload fits, and sending
does not pack the payloads again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.plans.payload import PayloadTooLarge, max_payload_bytes
from jobloom.session import scratch_path

THROUGHPUT_DEFAULTS = {
    "kafka.acks": "all",
    "kafka.batch.size": str(256 * 1024),
    "kafka.linger.ms": "50",
    "kafka.buffer.memory": str(64 * 1024 * 1024),
    "kafka.max.in.flight.requests.per.connection": "5",
}
EVENT_HUBS_DEFAULTS = {
    "kafka.max.request.size": "1000000",
    "kafka.metadata.max.age.ms": "180000",
    "kafka.connections.max.idle.ms": "180000",
    "kafka.request.timeout.ms": "60000",
}
#: what a setting may say for yes and for no
ANSWERS = {**dict.fromkeys(("1", "true", "yes", "on"), True), **dict.fromkeys(("0", "false", "no", "off"), False)}
PLAIN = {"off", "false", "uncompressed"}


def compression_type(event_hubs: bool, requested: str | None = None) -> str:
    """The codec asked for; without one gzip, or none on Event Hubs."""
    codec = (requested or "").strip().lower() or ("none" if event_hubs else "gzip")
    return "none" if codec in PLAIN else codec


def include_headers(event_hubs: bool, requested: str | None = None) -> bool:
    """Whether messages carry Parquet headers: as asked for, else everywhere but on Event Hubs."""
    return ANSWERS.get((requested or "").strip().lower(), not event_hubs)


def publish_options(broker: dict[str, str], *, event_hubs: bool, compression: str | None = None,
                    tuned: bool = True, overrides: dict | None = None) -> dict[str, str]:
    """Sink options: broker connection, compression, batching and Event Hubs limits (SNK-5)."""
    opts = dict(broker)
    opts["kafka.compression.type"] = compression_type(event_hubs, compression)
    if tuned:
        opts.update(THROUGHPUT_DEFAULTS)
    if event_hubs:
        opts.update(EVENT_HUBS_DEFAULTS)
    opts.update(overrides or {})
    return opts


def publish(messages: DataFrame, *, options: dict | None = None, topic: str | None = None,
            sink_path: str | None = None, with_headers: bool = True,
            max_message_bytes: int | None = None) -> None:
    """Write payload messages to Kafka (``options``) or to Parquet (``sink_path``).

    An empty frame publishes nothing. ``topic`` overrides the ``topic`` column.
    """
    cols = ["key", "value"] + (["headers"] if with_headers and "headers" in messages.columns else [])
    if "topic" in messages.columns and not topic:
        cols = ["topic"] + cols
    spark, cap = messages.sparkSession, max_payload_bytes(max_message_bytes)
    staged = scratch_path(spark, "staged-messages")
    messages.select(*cols).write.parquet(staged)
    out = spark.read.schema(messages.select(*cols).schema).parquet(staged)
    most = out.agg(F.max(F.octet_length("value"))).first()[0] or 0
    if most > cap:
        raise PayloadTooLarge(f"a payload has {most} bytes, the cap is {cap}; nothing was sent. Fewer rows per batch make smaller payloads")
    if sink_path:
        out.write.mode("append").parquet(sink_path)
        return
    if not options:
        raise ValueError("publish needs Kafka options or a sink path")
    w = out.write.format("kafka").options(**options)
    if topic:
        w = w.option("topic", topic)
    elif "topic" not in out.columns:
        raise ValueError("a topic is required")
    w.save()
