"""Packing documents into sequences as a cutting-stock problem, by column generation.

1. Each document's ids are cut into full sequences and one remainder; lengths are counted in classes
   (multiples of ``grain`` tokens, rounded up). This histogram, at most capacity / grain numbers, is all that the driver gets.
2. A linear program over patterns (how many pieces of each class share a sequence) is solved by
   column generation: a knapsack dynamic program prices patterns by the duals.
3. Whole parts of the solution are taken as they are; what is left by rounding down is packed largest first, each sequence
   filled up by a subset-sum program.
4. Pieces are ranked within their class by a distributed count, and a rank determines pattern, sequence and slot.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written
from .shingles import slices
from .tokenizing import Encoder, vocabulary

CAPACITY = 2048
GRAIN = 8
END = 1
#: bytes of text encoded at a time
ENCODED = 1 << 22


# ---------------------------------------------------------------- the linear program (driver, bounded)

def _price(duals: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern of sizes 1..room, value and counts by size."""
    best = np.zeros(room + 1)
    pick = np.zeros(room + 1, dtype=np.int64)
    worth = np.concatenate([[0.0], duals])  # size 0: leave one unit empty
    for w in range(1, room + 1):
        value = best[w - 1::-1][:w] + worth[1:w + 1]
        k = int(value.argmax())
        best[w], pick[w] = (value[k], k + 1) if value[k] > best[w - 1] else (best[w - 1], 0)
    counts, w = np.zeros(room, dtype=np.int64), room
    while w > 0:
        if pick[w]:
            counts[pick[w] - 1] += 1
            w -= pick[w]
        else:
            w -= 1
    return best[room], counts


def solve_patterns(demand: np.ndarray, gap: float = 1e-3, rounds: int = 20) -> list[tuple[np.ndarray, float]]:
    """LP optimum (within ``gap``) of the fewest patterns that hold ``demand[s - 1]`` pieces of each size s.

    Revised simplex with one row for each size in demand, starting from patterns of a single size; demands are moved
    by less than a thousandth so that no step stands still. Ends after ``rounds`` steps per row at the latest, at a
    solution that holds all pieces but may need more patterns. Returns (counts by size, how many) of the basis.
    """
    room = len(demand)
    sizes = np.flatnonzero(demand) + 1
    if not len(sizes):
        return []
    rows = sizes - 1
    basis = np.zeros((len(sizes), room), dtype=np.int64)
    per = room // sizes
    basis[np.arange(len(sizes)), rows] = per
    inverse = np.diag(1.0 / per)
    wanted = demand[rows] + np.random.default_rng(0).random(len(rows)) / 1000
    amount = wanted / per
    for _ in range(rounds * len(rows)):
        duals = np.zeros(room)
        duals[rows] = np.maximum(inverse.sum(axis=0), 0)
        value, pattern = _price(duals, room)
        if value <= 1 + gap:  # no solution is below total / value
            break
        used = np.flatnonzero(pattern[rows])
        turn = (inverse[:, used] * pattern[rows][used]).sum(axis=1)
        ok = turn > 1e-9
        if not ok.any():
            break
        ratio = np.full(len(sizes), np.inf)
        ratio[ok] = amount[ok] / turn[ok]
        out = int(np.argmin(ratio))
        amount = amount - ratio[out] * turn
        amount[out] = ratio[out]
        inverse[out] /= turn[out]
        others = np.arange(len(sizes)) != out
        inverse[others] -= np.outer(turn[others], inverse[out])
        basis[out] = pattern
    return [(basis[i], float(max(amount[i], 0))) for i in range(len(sizes))]


def _fill(left: np.ndarray, room: int) -> np.ndarray:
    """One sequence from the pieces left: the largest, then the fullest subset of the rest, large ones first."""
    counts = np.zeros(len(left), dtype=np.int64)
    first = int(np.flatnonzero(left)[-1]) + 1
    counts[first - 1] = 1
    room -= first
    reach = np.full(room + 1, -1, dtype=np.int64)  # the last size used to get there
    reach[0] = 0
    for size in (np.flatnonzero(left)[::-1] + 1):
        if size > room or reach[room] >= 0:
            continue
        have = left[size - 1] - (size == first)
        used = np.zeros(room + 1, dtype=np.int64)
        for w in range(size, room + 1):
            if reach[w] < 0 and reach[w - size] >= 0 and used[w - size] < have:
                reach[w], used[w] = size, used[w - size] + 1
    w = int(np.flatnonzero(reach >= 0)[-1])
    while w > 0:
        counts[reach[w] - 1] += 1
        w -= reach[w]
    return counts


def plan_patterns(demand: np.ndarray, gap: float = 1e-3) -> list[tuple[np.ndarray, int]]:
    """Whole patterns (counts by size, copies) that hold exactly ``demand[s - 1]`` pieces of size s."""
    room = len(demand)
    left = demand.astype(np.int64).copy()
    plan = []
    for pattern, amount in sorted(solve_patterns(demand, gap), key=lambda x: -x[1]):
        used = np.flatnonzero(pattern)
        copies = min([int(amount + 1e-6), *(left[used] // pattern[used])])
        if copies > 0:
            left -= copies * pattern
            plan.append((pattern, copies))
    while left.any():
        pattern = _fill(left, room)
        used = np.flatnonzero(pattern)
        copies = int((left[used] // pattern[used]).min())
        left -= copies * pattern
        plan.append((pattern, copies))
    return plan


# ---------------------------------------------------------------- the pieces (Spark)

def _pieces(path: str, capacity: int, grain: int):
    def run(batches):
        encoder = Encoder.of(path)
        task = TaskContext.get().partitionId()
        ranks = np.zeros(capacity // grain + 1, dtype=np.int64)
        for whole in batches:
            for a, b in slices(whole.column(1), ENCODED):
                batch = whole.slice(a, b - a)
                ids, bounds = encoder.encode(batch.column(1))
                own = bounds[1:] - bounds[:-1] + 1  # with the id that ends a document
                n = (own + capacity - 1) // capacity
                doc = np.repeat(np.arange(len(own)), n)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * capacity
                length = np.minimum(own[doc] - start, capacity)
                end = np.uint32(END).tobytes()
                crc = np.empty(len(doc), dtype=np.int64)
                for i, (d, s, size) in enumerate(zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)):
                    last = s + size == own[d]
                    at = int(bounds[d]) + s
                    value = zlib.crc32(ids[at:at + size - last])
                    crc[i] = zlib.crc32(end, value) if last else value
                size_class = (length + grain - 1) // grain
                order = np.argsort(size_class, kind="stable")
                sorted_class = size_class[order]
                first = np.searchsorted(sorted_class, sorted_class)
                rank = np.empty(len(doc), dtype=np.int64)
                rank[order] = np.arange(len(doc)) - first + ranks[sorted_class]
                ranks += np.bincount(size_class, minlength=len(ranks))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc), pa.array(own[doc]),
                     pa.array(np.full(len(doc), task)), pa.array(size_class), pa.array(rank)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "size_class", "rank"])
    return run


def _slots(plan: list[tuple[np.ndarray, int]], classes: int):
    """Numpy tables: for each class, where the ranks of each pattern begin, its pieces, its first sequence."""
    tables: list[list[tuple[int, int, int]]] = [[] for _ in range(classes + 1)]
    taken, base = np.zeros(classes + 1, dtype=np.int64), 0
    for pattern, copies in plan:
        for s in np.flatnonzero(pattern):
            tables[s + 1].append((taken[s + 1], pattern[s], base))
            taken[s + 1] += copies * pattern[s]
        base += copies
    return [np.array(t, dtype=np.int64).reshape(-1, 3) for t in tables]


def _assign(tables):
    def run(batches):
        for batch in batches:
            size_class, rank = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("size_class", "rank"))
            sequence, slot = np.empty(len(rank), dtype=np.int64), np.empty(len(rank), dtype=np.int64)
            for c in np.unique(size_class):
                at, t = size_class == c, tables[c]
                k = np.searchsorted(t[:, 0], rank[at], side="right") - 1
                past = rank[at] - t[k, 0]
                sequence[at] = t[k, 2] + past // t[k, 1]
                slot[at] = past % t[k, 1]
            keep = [batch.schema.get_field_index(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "size_class")]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(sequence), pa.array(slot)],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "size_class", "sequence_id", "slot"])
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN, vocabulary_path: str | None = None,
         gap: float = 1e-3) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` needs doc_id and text; others are not read. Null and empty texts are one id long, the id that ends a
    document. Null and repeated ids are packed like others, each row by itself. No rows give no pieces. A document is
    cut only where a sequence is full. ``grain`` divides ``capacity``; a smaller one pads less and takes longer to plan.
    """
    path = vocabulary(vocabulary_path)
    id_type = docs.schema["doc_id"].dataType
    own = T.StructType([T.StructField("doc_id", id_type)] + [T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "task", "size_class", "rank")])
    pieces = written(docs.select("doc_id", "text").mapInArrow(_pieces(path, capacity, grain), own), "pieces")

    counts = written(pieces.groupBy("size_class", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    classes = capacity // grain
    demand = np.zeros(classes, dtype=np.int64)
    for row in counts.groupBy("size_class").agg(F.sum("n").alias("n")).collect():  # one row per class
        demand[row["size_class"] - 1] = row["n"]
    earlier = Window.partitionBy("size_class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("size_class", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(counts, ["size_class", "task"]).withColumn("rank", F.col("rank") + F.col("before"))

    placed = T.StructType([T.StructField("doc_id", id_type)] + [T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "size_class", "sequence_id", "slot")])
    ranked = ranked.mapInArrow(_assign(_slots(plan_patterns(demand, gap), classes)), placed)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("size_class"), "slot").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))


def op8_cutting_stock(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
