"""Keep-first dedupe: for every key keep the row that comes first in a given order.

``dropDuplicates`` keeps an arbitrary row, so it is never used where "first
wins" matters. ``keep_first`` groups by the key and takes ``min_by(row, order)``:
the aggregate runs partially on the map side, so a key that holds a third of all
rows ships one row per input partition to the shuffle, not all of its rows, and
no group is ever collected whole into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def keep_first(df: DataFrame, key: str | Column | Sequence, order: str | Column | Sequence,
               key_name: str = "_key") -> DataFrame:
    """Rows of ``df`` whose key is first seen at the smallest ``order`` (AGG-1, WIN-3).

    ``order`` must be unique per key (add a tie-breaker otherwise). Output keeps
    the columns of ``df``; row order is not defined (sort afterwards).
    """
    keys = _cols(key)
    order_cols = _cols(order)
    named_keys = [k.alias(f"{key_name}{i}") for i, k in enumerate(keys)]
    row = F.struct(*[F.col(c) for c in df.columns])
    first = (df.select(*named_keys, row.alias("_row"), F.struct(*order_cols).alias("_ord"))
             .groupBy(*[f"{key_name}{i}" for i in range(len(keys))])
             .agg(F.min_by("_row", "_ord").alias("_row")))
    return first.select("_row.*")
