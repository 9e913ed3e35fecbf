"""Parallelism of CPU-heavy row work over inputs of few splits.

A file of one row group is one task, however many cores there are. ``spread`` asks for a rebalance where the input, by the sizes
that the optimizer knows, has less than one split for each core. The hint is lazy: planning runs no job, and adaptive execution
chooses the partitions from the bytes it finds. A large input keeps its splits and is not shuffled. Rows are the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _bytes(text: str) -> int:
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    number = text.strip().lower().removesuffix("b")
    return int(number[:-1]) << units[number[-1]] if number[-1:] in units else int(number)


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt out over the cores where its input is smaller than one split for each of them."""
    if df.isStreaming:
        return df
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.hint("rebalance") if size < split * spark.sparkContext.defaultParallelism else df
