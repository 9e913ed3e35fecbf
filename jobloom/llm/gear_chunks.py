"""Substring duplicates by content-defined chunking with a gear rolling hash.

A 16-bit gear hash ``h = (h << 1) + G[byte]`` forgets a byte after 16 steps. Chunks end at its local minima: at the (last) smallest hash of
each REACH neighbouring places. So there is a boundary in any REACH places, in periodic text too, and which place it is depends on
the bytes around it alone. Each boundary stands for the window bytes up to it; windows are compared by digest. A repeat of
window + REACH - 1 = LEAST_BYTES bytes or more has REACH places whose windows lie inside it, and thus a boundary whose window every
copy has: none is missed, whatever stands around it. Overlapping windows that other documents have too make a repeated passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .shingles import mixed, slices
from .words import text_bytes

#: every repeat of this many bytes is found
LEAST_BYTES = 96
#: documents without an id are told apart by numbers from here on, far below all ids
NAMELESS = -(1 << 63)
#: one of this many neighbouring places at least is a boundary: chunks of about 21 bytes
REACH = 41
_rng = np.random.default_rng(7)
_GEAR = _rng.integers(0, 1 << 16, 256, dtype=np.uint16)
_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def gear_hash(flat: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: the sum of G[byte k steps ago] << k for k < 16, by doubling."""
    h = _GEAR[flat]
    for k in (1, 2, 4, 8):
        nxt = h.copy()
        nxt[k:] += h[:-k] << np.uint16(k)
        h = nxt
    return h


def chunk_spans(flat: np.ndarray, offsets: np.ndarray, window: int = LEAST_BYTES - REACH + 1) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of all chunks; chunks end with their row at the latest. Places before which a row has fewer than ``window`` bytes are
    no boundaries; as ``window`` is REACH or more, no neighbourhood reaches from one row's places to the next row's."""
    if not len(flat):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    n = len(flat)
    none = np.uint64(1 << 63)
    # smaller for a smaller hash, then for a later place
    key = np.full(n + 2 * (REACH - 1), none)
    key[REACH - 1:REACH - 1 + n] = (gear_hash(flat).astype(np.uint64) << np.uint64(40)) + np.arange(n - 1, -1, -1, dtype=np.uint64)
    size = np.diff(offsets)
    head = np.minimum(size, window - 1)
    key[REACH - 1 + np.repeat(offsets[:-1] - np.cumsum(head) + head, head) + np.arange(int(head.sum()))] = none
    width = 1
    while width < REACH:
        step = min(width, REACH - width)
        key = np.minimum(key[:-step], key[step:])
        width += step
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    at = n - (key[key != none] & np.uint64((1 << 40) - 1)).astype(np.int64)
    ends = np.unique(np.concatenate([at, offsets[offsets > 0]]))
    return np.concatenate([[0], ends[:-1]]), ends


def digests(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digests of spans, which may overlap: differences of running sums of a polynomial, moved to the same power."""
    if not len(starts):
        return np.empty(0, np.uint64)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(flat), _STEP)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[flat] * power[:-1], dtype=np.uint64)])
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(flat), _BACK)]))
    return mixed((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _windows(window: int):
    def run(batches):
        nameless = NAMELESS + (TaskContext.get().partitionId() << 33)
        for batch in batches:
            ids = batch.column(0)
            if ids.null_count:
                own = np.cumsum(np.asarray(ids.is_null())) + nameless
                ids, nameless = pc.if_else(ids.is_null(), pa.array(own), ids), int(own[-1])
            for a, b in slices(batch.column(1)):
                flat, offsets = text_bytes(batch.column(1).slice(a, b - a))
                _, ends = chunk_spans(flat, offsets, window)
                row = np.searchsorted(offsets, ends, side="left") - 1
                whole = ends - offsets[row] >= window
                ends, row = ends[whole], row[whole]
                digest = digests(flat, ends - window, ends)
                # neighbours with equal digests (periodic text) are one row
                new = np.ones(len(ends), dtype=bool)
                new[1:] = (digest[1:] != digest[:-1]) | (row[1:] != row[:-1]) | (ends[1:] - ends[:-1] > window)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(ends))[:len(first)] - 1
                start, row = ends[first] - window, row[first]
                yield pa.RecordBatch.from_arrays([
                    pa.array(digest[first].view(np.int64)), ids.slice(a, b - a).take(pa.array(row)),
                    pa.array(start - offsets[row]), pa.array((ends[last] - start).astype(np.int32))], ["digest", "doc_id", "start", "length"])

    return run


def repeated_passages(docs: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One row per passage that other documents have too: doc_id, start, length (bytes of the UTF-8 text), chunks, first_doc_id
    (the smallest document that has a part of it).

    Every byte of a passage lies in a repeat of ``least_bytes - REACH + 1`` bytes or more. Every repeat of ``least_bytes`` bytes or more is
    reported, short of fewer than REACH bytes at either end. Documents without such a passage have no row. Null and empty texts have no chunks;
    a row with a null doc_id is a document of its own, its passages are reported under a null doc_id, and first_doc_id is null where no document
    with an id has the passage; rows that repeat a doc_id count as one document, and what repeats inside one document alone is no passage. ``docs`` needs
    doc_id (a whole number, above -2^62) and text; other columns are not read. No rows give no rows.
    """
    window = least_bytes - REACH + 1
    if window < REACH:
        raise ValueError(f"least_bytes must be {2 * REACH - 1} or more")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = texts.mapInArrow(_windows(window), "digest long, doc_id long, start long, length int")
    # combined before the shuffle: a digest of any number of rows is one row per task
    shared = chunks.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"),
                                          F.min(F.when(F.col("doc_id") > -(1 << 62), F.col("doc_id"))).alias("first_doc_id")) \
        .filter("least <> last").drop("least", "last")
    found = written(chunks.join(written(shared, "shared-chunks"), "digest").drop("digest"), "repeated-chunks")
    place = Window.partitionBy("doc_id").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    found = found.distinct().withColumn("gap", ~F.coalesce(
        F.max(F.col("start") + F.col("length")).over(place) >= F.col("start"), F.lit(False)))
    found = found.withColumn("run", F.sum(F.col("gap").cast("int")).over(place.rowsBetween(Window.unboundedPreceding, 0)))
    return found.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), (F.max(F.col("start") + F.col("length")) - F.min("start")).alias("length"),
        F.count(F.lit(1)).alias("chunks"), F.min("first_doc_id").alias("first_doc_id")).drop("run") \
        .withColumn("doc_id", F.when(F.col("doc_id") > -(1 << 62), F.col("doc_id")))


def op3_gear_chunks(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
