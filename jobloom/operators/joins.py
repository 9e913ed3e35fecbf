"""Joins against a side that is usually small, with its size proven before broadcasting.

``join_small`` measures the candidate side in one aggregation (row count and the
byte length of every string/binary column) and hints a broadcast only when the
measured bytes are under the limit; otherwise Spark plans a shuffle join (and
AQE may still convert it at run time). Nothing is broadcast on a guess.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_ROW_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of ``df``: variable-length bytes plus 8 bytes
    per fixed-width field and per row. One aggregation, no collect of rows."""
    var = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("long")
           for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = sum(8 for f in df.schema.fields if not isinstance(f.dataType, (T.StringType, T.BinaryType)))
    per_row = F.lit(_FIXED_ROW_BYTES + fixed)
    for v in var:
        per_row = per_row + v
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(per_row).alias("b")).collect()[0]
    return int(row["b"] or 0)


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str] | Column, how: str = "inner",
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``big.join(small, on, how)``, broadcasting ``small`` only when measured under ``max_bytes``."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti"):
        return big.join(small, on, how)
    side = F.broadcast(small) if measured_bytes(small) <= max_bytes else small
    return big.join(side, on, how)
