"""Storage of consumed messages and of failure records (SNK-6, SNK-8).

Rows are stored with dynamic partition overwrite, by micro-batch
(``topic=/first_message=``) or by message (``topic=/partition=/offset=``); which messages a batch
still has to store says the offset ledger. The object name of each message (TXT-6) is
kept as a column.
"""

from __future__ import annotations

import datetime as _dt
import traceback

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions import vocab as V
from jobloom.functions.text import blob_name

PARTITION_COLS = ("topic", "partition", "offset")
FAILURE_SCHEMA = ("kind string, topic string, partition int, offset long, error_type string, "
                  "message string, detail string, at timestamp")


def store_messages(rows: DataFrame, path: str, partition_cols=PARTITION_COLS) -> None:
    """Write rows of whole messages; rewrites only the messages present in ``rows``."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def with_object_name(rows: DataFrame, key: str = "key", enriched: bool = False,
                     prefix: str | None = V.DEFAULT_BLOB_PREFIX) -> DataFrame:
    """Adds ``object_name`` of every row's message, stamped with the batch time."""
    k = F.col(key) if key in rows.columns else F.lit(None).cast("binary")
    return rows.withColumn("object_name", blob_name("topic", "partition", "offset", k, F.current_timestamp(),
                                                    enriched=enriched, prefix=prefix))


def failure_rows(spark: SparkSession, kind: str, exc: BaseException | None = None, message: str | None = None,
                 coords: list[tuple] | None = None, detail: str | None = None) -> DataFrame:
    """Failure records: one per message coordinate (or one without coordinates)."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    etype = type(exc).__name__ if exc is not None else None
    text = message if message is not None else (str(exc) if exc is not None else "")
    detail = "".join(traceback.format_exception(exc)) if exc is not None else detail
    rows = [(kind, t, p, o, etype, text, detail, now) for (t, p, o) in (coords or [(None, None, None)])]
    return spark.createDataFrame(rows, FAILURE_SCHEMA)


def record_failure(spark: SparkSession, path: str | None, kind: str, exc: BaseException | None = None,
                   message: str | None = None, coords: list[tuple] | None = None, detail: str | None = None) -> None:
    """Append failure records (kinds: startup, message, validation, query)."""
    if path:
        failure_rows(spark, kind, exc, message, coords, detail).write.mode("append").parquet(path)


def record_failures(bad: DataFrame, path: str | None, kind: str, exc: BaseException) -> None:
    """Append one failure record per row of ``bad`` (topic, partition, offset, why), however many there are."""
    if path:
        bad.select(F.lit(kind).alias("kind"), "topic", F.col("partition").cast("int").alias("partition"), "offset",
                   F.lit(type(exc).__name__).alias("error_type"), F.lit(str(exc)).alias("message"), F.col("why").alias("detail"),
                   F.current_timestamp().alias("at")).write.mode("append").parquet(path)
