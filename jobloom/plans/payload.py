"""Parquet payloads inside messages: pack rows into one Parquet file per batch and
read them back into rows (SNK-2, SRC-9, SCR-9, SNK-3).

Packing is ``groupBy(batch).applyInArrow``: a batch is at most ``rows_per_batch``
rows by construction (``ordering.batch_index``), so no group is unbounded.
Unpacking is ``mapInArrow`` over message rows: every message is decoded inside
the task that holds it, and only the requested columns are read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.functions import vocab as V

PAYLOAD_FIELDS = {
    "Index": pa.int64(),
    "Position title": pa.string(),
    "job_description": pa.string(),
    "complexity_score": pa.int32(),
    "category": pa.string(),
    "seniority_level": pa.string(),
}


class PayloadTooLarge(ValueError):
    """A payload exceeds the message cap."""


def pack_payloads(rows: DataFrame, batch_cols: Sequence[str], columns: Sequence[str],
                  order_by: str = "Index", max_bytes: int | None = None) -> DataFrame:
    """``batch_cols..., part, n_rows, value``: one Parquet file (bytes) per batch, rows sorted by
    ``order_by``. Columns keep their Arrow types; the file has no index column. With ``max_bytes`` no value is longer: a batch
    whose file is goes into halves until each fits, ``part`` 0, 1, ... in row order; a single row that does not fit fails the job."""
    batch_cols, columns = list(batch_cols), list(columns)
    schema = pa.schema([(c, PAYLOAD_FIELDS.get(c, pa.string())) for c in columns])

    def files(body: pa.Table) -> list[tuple[int, bytes]]:
        buf = io.BytesIO()
        pq.write_table(body, buf)
        if max_bytes is None or buf.tell() <= max_bytes:
            return [(body.num_rows, buf.getvalue())]
        if body.num_rows < 2:
            raise PayloadTooLarge(f"a payload of one row has {buf.tell()} bytes, the cap is {max_bytes}")
        half = body.num_rows // 2
        return files(body.slice(0, half)) + files(body.slice(half))

    def pack(table: pa.Table) -> pa.Table:
        found = files(table.select(columns).sort_by(order_by).cast(schema))
        out = {c: pa.repeat(table.column(c)[0], len(found)) for c in batch_cols}
        out["part"] = pa.array(range(len(found)), pa.int64())
        out["n_rows"] = pa.array([n for n, _ in found], pa.int64())
        out["value"] = pa.array([data for _, data in found], pa.binary())
        return pa.table(out)

    out_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields
                            if f.name in batch_cols] + ["part bigint", "n_rows bigint", "value binary"])
    return rows.select(*batch_cols, *columns).groupBy(*batch_cols).applyInArrow(pack, out_schema)


def unpack_payloads(messages: DataFrame, columns: Sequence[str] = tuple(PAYLOAD_FIELDS),
                    keep: Sequence[str] = ("topic", "partition", "offset"), value: str = "value") -> DataFrame:
    """Rows of the Parquet payload in every message: ``keep..., payload_columns, payload_error,
    columns...``. A column missing from a payload is null; ``payload_columns`` lists the
    columns the payload had; a value that is not Parquet gives one row with
    ``payload_error`` set. Null or empty values give no rows (FLT-6)."""
    keep, columns = list(keep), list(columns)
    kept_fields = [f for f in messages.schema.fields if f.name in keep]
    out_fields = kept_fields + [
        T.StructField("payload_columns", T.ArrayType(T.StringType())),
        T.StructField("payload_error", T.StringType()),
    ] + [T.StructField(c, T.LongType() if PAYLOAD_FIELDS.get(c) == pa.int64() else
                       T.IntegerType() if PAYLOAD_FIELDS.get(c) == pa.int32() else T.StringType())
         for c in columns]
    out_schema = T.StructType(out_fields)
    arrow_out = pa.schema([(f.name, _arrow_type(f.dataType)) for f in out_fields])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(value).to_pylist()
            kept = {k: batch.column(k) for k in keep}
            for i, data in enumerate(values):
                if not data:
                    continue
                head = {k: pa.array([kept[k][i].as_py()], arrow_out.field(k).type) for k in keep}
                try:
                    pf = pq.ParquetFile(io.BytesIO(data))
                    present = pf.schema_arrow.names
                    table = pf.read(columns=[c for c in columns if c in present])
                except Exception as exc:  # not a Parquet file
                    cols = dict(head)
                    cols["payload_columns"] = pa.array([None], pa.list_(pa.string()))
                    cols["payload_error"] = pa.array([f"{type(exc).__name__}: {exc}"], pa.string())
                    for c in columns:
                        cols[c] = pa.nulls(1, arrow_out.field(c).type)
                    yield pa.RecordBatch.from_pydict(cols, schema=arrow_out)
                    continue
                n = table.num_rows
                if n == 0:
                    continue
                cols = {k: pa.repeat(head[k][0], n) if n else head[k] for k in keep}
                cols = {k: v.cast(arrow_out.field(k).type) for k, v in cols.items()}
                cols["payload_columns"] = pa.array([present] * n, pa.list_(pa.string()))
                cols["payload_error"] = pa.nulls(n, pa.string())
                for c in columns:
                    t = arrow_out.field(c).type
                    cols[c] = (table.column(c).combine_chunks().cast(t, safe=False) if c in table.column_names
                               else pa.nulls(n, t))
                yield pa.RecordBatch.from_pydict(cols, schema=arrow_out)

    src = messages.filter(F.col(value).isNotNull() & (F.octet_length(F.col(value)) > 0))
    return src.select(*keep, value).mapInArrow(unpack, out_schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.LongType):
        return pa.int64()
    if isinstance(t, T.IntegerType):
        return pa.int32()
    if isinstance(t, T.BinaryType):
        return pa.binary()
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    if isinstance(t, T.TimestampType):
        return pa.timestamp("us", tz="UTC")
    return pa.string()


def payload_row_counts(messages: DataFrame, keep: Sequence[str] = ("topic", "partition", "offset"),
                       value: str = "value") -> DataFrame:
    """``keep..., n_rows``: row count from the Parquet footer, null when the value is
    not Parquet (nothing but the footer is read)."""
    keep = list(keep)
    kept_fields = [f for f in messages.schema.fields if f.name in keep]
    out_schema = T.StructType(kept_fields + [T.StructField("n_rows", T.LongType())])
    arrow_out = pa.schema([(f.name, _arrow_type(f.dataType)) for f in out_schema.fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for data in batch.column(value).to_pylist():
                try:
                    counts.append(pq.ParquetFile(io.BytesIO(data or b"")).metadata.num_rows)
                except Exception:
                    counts.append(None)
            cols = {k: batch.column(k).cast(arrow_out.field(k).type) for k in keep}
            cols["n_rows"] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_pydict(cols, schema=arrow_out)

    return messages.select(*keep, value).mapInArrow(count, out_schema)


def payload_info(messages: DataFrame, keep: Sequence[str] = ("topic", "partition", "offset"),
                 value: str = "value") -> DataFrame:
    """One row per message, from the Parquet footer alone: ``keep..., value, n_rows, payload_columns, payload_error``.

    A payload without rows has its row here too (``n_rows`` 0); a value that is not Parquet has ``payload_error``.
    """
    keep = list(keep)
    kept_fields = [f for f in messages.schema.fields if f.name in keep]
    out_schema = T.StructType(kept_fields + [
        T.StructField(value, T.BinaryType()), T.StructField("n_rows", T.LongType()),
        T.StructField("payload_columns", T.ArrayType(T.StringType())), T.StructField("payload_error", T.StringType())])
    arrow_out = pa.schema([(f.name, _arrow_type(f.dataType)) for f in out_schema.fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names, errors = [], [], []
            for data in batch.column(value).to_pylist():
                try:
                    footer = pq.ParquetFile(io.BytesIO(data or b""))
                    found = (footer.metadata.num_rows, footer.schema_arrow.names, None)
                except Exception as exc:  # not a Parquet file
                    found = (None, None, f"{type(exc).__name__}: {exc}")
                for column, part in zip((rows, names, errors), found, strict=True):
                    column.append(part)
            cols = {k: batch.column(k).cast(arrow_out.field(k).type) for k in (*keep, value)}
            cols |= {"n_rows": pa.array(rows, pa.int64()), "payload_columns": pa.array(names, pa.list_(pa.string())),
                     "payload_error": pa.array(errors, pa.string())}
            yield pa.RecordBatch.from_pydict(cols, schema=arrow_out)

    return messages.select(*keep, value).mapInArrow(read, out_schema)


def max_payload_bytes(limit: int | None = None) -> int:
    return max(V.MAX_MESSAGE_BYTES_FLOOR, int(limit if limit is not None else V.MAX_MESSAGE_BYTES))


def with_size_check(payloads: DataFrame, limit: int | None = None, value: str = "value") -> DataFrame:
    """Adds ``n_bytes`` and ``fits`` (payload within the message cap, SNK-3)."""
    cap = max_payload_bytes(limit)
    return (payloads.withColumn("n_bytes", F.octet_length(F.col(value)).cast("long"))
            .withColumn("fits", F.col("n_bytes") <= cap))


def check_payload_size(payloads: DataFrame, limit: int | None = None, value: str = "value") -> DataFrame:
    """Fails the job when any payload exceeds the cap; all payloads are checked before
    anything is published."""
    cap = max_payload_bytes(limit)
    ok = F.assert_true(F.octet_length(F.col(value)) <= cap,
                       F.lit(f"payload exceeds the message cap ({cap} bytes); "
                             f"lower the rows per batch or raise the cap"))
    return payloads.filter(ok.isNull())
