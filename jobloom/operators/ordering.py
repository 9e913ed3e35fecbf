"""Global order, 1..n numbering and fixed-size batches (SRT-1, WIN-1, WIN-2, JN-4).

``row_number()`` over an un-partitioned window moves every row into one task.
``global_index`` numbers rows in two passes instead:

1. range-partition on the sort key and sort inside each partition; tag every
   row with its partition id and its position inside the partition;
2. materialize that (reliable checkpoint in ``spark.checkpoint.dir``) so both
   passes see the same partitioning even after an executor is lost;
3. count rows per partition -- one row per partition, so the running offsets
   form a table whose size is bounded by the partition count, never by the data
   -- and broadcast-join the offsets back (JN-4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions import vocab as V
from jobloom.functions.text import casefold
from jobloom.session import checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id = partition id << 33 | row number in partition


def _cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def title_sort_key(title: str = "position_title", *tie_breakers: str) -> list[Column]:
    """Case-folded title in code-point order, then the raw title and tie-breakers (SRT-1)."""
    return [casefold(F.col(title)), F.col(title), *[F.col(t) for t in tie_breakers]]


def global_index(df: DataFrame, order: str | Column | Sequence, index_col: str = "rn",
                 num_partitions: int | None = None) -> DataFrame:
    """Adds ``index_col`` = 1..n following ``order`` (ascending, nulls first).

    ``order`` should be a total order (add tie-breakers) for a deterministic result.
    The range shuffle samples its input in a separate job, which recomputes the
    input back to the previous shuffle; after a keep-first (as in the producer)
    that is only the aggregation's output. Persist an expensive narrow input first.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    order_cols = _cols(order)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(order_cols)])
    okeys = [f"_o{i}" for i in range(len(order_cols))]
    tagged = (keyed.repartitionByRange(n, *okeys)
              .sortWithinPartitions(*okeys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), _POS_BITS))
              .drop(*okeys)
              .checkpoint(eager=True))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_before"))
    numbered = tagged.join(F.broadcast(offsets), "_pid")
    return numbered.select(
        *[F.col(c) for c in df.columns],
        (F.coalesce(F.col("_before"), F.lit(0)) + F.col("_pos") + 1).alias(index_col))


def batch_index(numbered: DataFrame, rows_per_batch: int = V.ROWS_PER_PAYLOAD, rn: str = "rn",
                batch_col: str = "batch_no", index_col: str = "Index") -> DataFrame:
    """Cut a 1..n numbering into batches of ``rows_per_batch``; ``Index`` restarts
    at 1 in every batch (WIN-2)."""
    if rows_per_batch < 1:
        raise ValueError("rows_per_batch must be >= 1")
    r0 = F.col(rn) - 1
    return (numbered.withColumn(batch_col, F.expr(f"(`{rn}` - 1) div {int(rows_per_batch)}"))
            .withColumn(index_col, r0 % rows_per_batch + 1))


def byte_batches(df: DataFrame, group: Sequence[str], order: str | Column | Sequence, size: Column, max_bytes: int,
                 max_rows: int, part_col: str = "part", index_col: str = "Index", num_partitions: int | None = None) -> DataFrame:
    """Adds ``index_col``, 1..n within each ``group`` by ``order``, and ``part_col``, which cuts the group into pieces of consecutive rows.

    A piece has at most ``max_rows`` rows, and fewer than ``max_bytes`` bytes (sums of ``size``) before its last row. A distributed
    prefix sum: rows are dealt over ranges of (group, order), so a group of any size spans many tasks, and only one
    row for each range and group is summed in sequence. Parts increase from 0 and may leave out numbers.
    """
    if max_bytes < 1 or max_rows < 1:
        raise ValueError("a piece needs room for a byte and a row")
    spark, group = df.sparkSession, list(group)
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = [*[F.col(g) for g in group], *_cols(order)]
    keys = [f"_o{i}" for i in range(len(order_cols))]
    tagged = (df.select("*", size.cast("long").alias("_size"), *[c.alias(k) for c, k in zip(order_cols, keys, strict=True)])
              .repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id())
              .drop(*keys).checkpoint(eager=True))
    sums = tagged.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_b"))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                       F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_b").over(earlier), F.lit(0)).alias("_b0"))
    inside = Window.partitionBy("_pid", *group).orderBy("_pos")
    same = [F.col("_pid") == F.col("_p"), *[F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]]
    rows = tagged.withColumn("_r", F.row_number().over(inside)).withColumn("_run", F.sum("_size").over(inside)).join(sums, same)
    return rows.select(
        *[F.col(c) for c in df.columns], (F.col("_n0") + F.col("_r")).alias(index_col),
        F.expr(f"(_n0 + _r - 1) div {int(max_rows)} + (_b0 + _run - _size) div {int(max_bytes)}").alias(part_col))
