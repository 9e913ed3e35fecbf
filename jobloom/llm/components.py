"""Connected components of an edge table, on Spark from end to end (large-star / small-star)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return row["n"], int(row["h"])


#: edges that one task joins by itself
LOCAL_EDGES = 1 << 18


def _forest(batches):
    """Stars (a, b): each vertex of this task's edges with the smallest one that it reaches by them."""
    above: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for x in (a, b):
                above.setdefault(x, x)
            while above[a] != a:
                above[a] = a = above[above[a]]
            while above[b] != b:
                above[b] = b = above[above[b]]
            above[max(a, b)] = min(a, b)
    stars = []
    for v in above:
        root = v
        while above[root] != root:
            root = above[root]
        above[v] = root
        if v != root:
            stars.append((v, root))
    a, b = zip(*stars, strict=True) if stars else ([], [])
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(v, label): every vertex of ``edges`` (long columns a, b) and the smallest vertex it reaches.

    Each task first joins up to about ``local_edges`` edges by itself, so that long paths become stars; stars of different tasks are joined in
    rounds of large-star and small-star steps, aggregations with map-side combining and joins on vertices: a vertex with any number of
    neighbours is never gathered. Loops are ignored. No edges give no rows.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = written(edges, "edges"), None
    tasks = -(-edges.count() // local_edges)
    edges = written(edges.coalesce(max(1, tasks)).mapInArrow(_forest, "a long, b long"), "forests")
    while tasks > 1:
        now = _mark(edges)
        if now == before or now[0] == 0:
            break
        before = now
        # large star: every larger neighbour of u goes to the smallest around u
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    return edges.select(F.col("a").alias("v"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("v"), F.col("b").alias("label")).distinct())
