"""Message sources with the Kafka row shape (SRC-7, SRC-8, FLT-6, LIM-1, STR-4, STR-5).

Spark's Kafka source yields ``key binary, value binary, topic string, partition
int, offset long, timestamp timestamp, timestampType int, headers``. The
operators only rely on that shape, so the same plan runs on
``spark.readStream.format("kafka")`` in production and on a file stream of
Parquet files with the same columns in tests (the Kafka connector jar is not
part of plain PySpark).
"""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = ("key binary, value binary, topic string, partition int, offset long, "
                  "timestamp timestamp")
EVENT_HUBS_PORT = 9093
LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


class BrokerConfigError(ValueError):
    """Broker settings cannot be resolved."""


def server_list(text: str | None) -> list[str]:
    """The servers of a comma-separated list; blanks between commas do not count."""
    return [server for server in map(str.strip, (text or "").split(",")) if server]


def connection_host(connection_string: str) -> str:
    """Host and port of the namespace that an Event Hubs connection string (``Key=value;...``) names."""
    fields = {k.strip().lower(): v for k, _, v in (part.partition("=") for part in connection_string.split(";"))}
    endpoint = urlsplit(fields.get("endpoint", "").strip())
    if endpoint.scheme != "sb" or not endpoint.netloc:
        raise BrokerConfigError("the connection string names no Endpoint=sb://... namespace")
    return f"{endpoint.netloc}:{EVENT_HUBS_PORT}"


def broker_options(*, eventhub_connection_string: str | None = None, bootstrap_servers: str | None = None,
                   client_id: str = "jobloom", security_protocol: str | None = None,
                   sasl_mechanism: str | None = None, sasl_username: str | None = None,
                   sasl_password: str | None = None) -> dict[str, str]:
    """``kafka.*`` options shared by the Kafka source and sink (SRC-8); blank settings are left out.

    A connection string signs in with itself as the password over TLS, whatever else is set, and names the server unless
    ``bootstrap_servers`` does.
    """
    given = {name: (value or "").strip() for name, value in {
        "connection": eventhub_connection_string, "servers": bootstrap_servers, "client": client_id,
        "protocol": security_protocol, "mechanism": sasl_mechanism, "user": sasl_username, "password": sasl_password}.items()}
    if given["connection"]:
        given |= {"protocol": "SASL_SSL", "mechanism": "PLAIN", "user": "$ConnectionString", "password": given["connection"],
                  "servers": given["servers"] or connection_host(given["connection"])}
    servers = server_list(given["servers"])
    if not servers:
        raise BrokerConfigError("no broker: give bootstrap servers or an Event Hubs connection string")
    quoted = {name: given[name].replace("\\", "\\\\").replace('"', '\\"') for name in ("user", "password")}
    login = f'{LOGIN_MODULE} required username="{quoted["user"]}" password="{quoted["password"]}";'
    options = {
        "kafka.bootstrap.servers": ",".join(servers),
        "kafka.client.id": given["client"] or "jobloom",
        "kafka.security.protocol": given["protocol"],
        "kafka.sasl.mechanism": given["mechanism"],
        "kafka.sasl.jaas.config": login if given["user"] or given["password"] else "",
    }
    return {name: value for name, value in options.items() if value}


def consumer_options(topic: str, *, starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                     **broker) -> dict[str, str]:
    """Options for ``readStream.format("kafka")`` (SRC-7, STR-4, STR-5). The consumer
    group's committed offsets are the query checkpoint: ``startingOffsets`` applies
    only to a query without a checkpoint, as ``auto_offset_reset`` does for a new group."""
    topic = (topic or "").strip()
    if not topic:
        raise BrokerConfigError("topic is required")
    if starting_offsets not in ("earliest", "latest"):
        raise BrokerConfigError("starting offsets must be earliest or latest")
    opts = {**broker_options(**broker), "subscribe": topic, "startingOffsets": starting_offsets,
            "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def read_messages(spark: SparkSession, *, kafka_options: dict | None = None, path: str | None = None,
                  stream: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages from Kafka (``kafka_options``) or from Parquet files with the Kafka row shape (``path``)."""
    if kafka_options:
        reader = spark.readStream if stream else spark.read
        return reader.format("kafka").options(**kafka_options).load()
    if not path:
        raise BrokerConfigError("give kafka_options or a path")
    if stream:
        r = spark.readStream.schema(MESSAGE_SCHEMA)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
        return r.parquet(path)
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)


def nonempty_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """FLT-6: drop messages with a null or zero-length value (their offsets still advance)."""
    return messages.filter(F.col(value).isNotNull() & (F.octet_length(F.col(value)) > 0))


def first_messages(messages: DataFrame, n: int) -> DataFrame:
    """LIM-1 for a bounded (batch) read: the first ``n`` non-empty messages in
    (topic, partition, offset) order. Streams stop after as many with ``ConsumerConfig(max_messages=...)``."""
    return nonempty_messages(messages).orderBy("topic", "partition", "offset").limit(int(n))
