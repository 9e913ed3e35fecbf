"""Near duplicates by b-bit MinHash, links confirmed on the whole sets.

1. Each set of word shingles gets ``MINIMA`` minima under different hashes. Bands of ``ROWS`` whole minima are the index keys; of each minimum
   only the low ``BITS`` bits are kept, packed as bit planes.
2. Sets under a common band are candidates. Their similarity is estimated from bit counts of the planes: two minima differ where any
   plane differs. Different minima agree in their low bits by chance with a probability of 2^-BITS, so the share m of agreeing ones
   is corrected to (m - 2^-BITS) / (1 - 2^-BITS).
3. Candidates whose estimate is within ``MARGIN`` of the threshold or above are compared on their whole sets, which alone decides. How candidates
   meet without all pairs of a band: ``set_links``. Exact bounds go before: two sets have no more shingles in common than either has
   in common with any other candidate, so a set with many shingles of its own meets no other; and parity sketches of 512 bits differ in no more
   classes than two sets differ in shingles.

What can be lost, for a pair just at the threshold of 0.85: no band in common, (1 - 0.85^6)^42 = 2e-9; an estimate over six standard deviations
too low, 1e-9. More similar pairs are safer. Sets are sets of 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written
from .set_links import SKETCH, filter_bits, jaccard_sql, linked, named_rows, parity_bound, pivoted, priority, similar, spread_evenly, token_sets, with_sketches
from .shingles import mixed, set_digest, shingle_sets, slices

#: words of a shingle, and the least similarity of a link in percent
WIDTH = 3
PERCENT = 85
#: minima, and low bits kept of each
MINIMA = 256
BITS = 4
#: bands of whole minima that are index keys
BANDS, ROWS = 42, 6
#: six standard deviations of the estimate at the threshold
MARGIN = 0.14

WORDS = MINIMA // 64
PLANES = [f"g{p}_{w}" for p in range(BITS) for w in range(WORDS)]
BOUND = (f"100 * {{a}}n >= {PERCENT} * {{b}}n and 100 * {{b}}n >= {PERCENT} * {{a}}n "
         f"and {100 + PERCENT} * least({{a}}shared, {{b}}shared) >= {PERCENT} * ({{a}}n + {{b}}n)")
_DIFFER = " + ".join("bit_count(" + " | ".join(f"({{a}}g{p}_{w} ^ {{b}}g{p}_{w})" for p in range(BITS)) + ")" for w in range(WORDS))
_CHANCE = 2.0 ** -BITS
ESTIMATE = f"((1 - ({_DIFFER}) / {MINIMA}D - {_CHANCE}D) / {1 - _CHANCE}D)"
NEAR = f"{parity_bound(PERCENT)} and {ESTIMATE} >= {PERCENT / 100 - MARGIN:.4f}D"

_rng = np.random.default_rng(20250611)
_XOR = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, MINIMA): least hashes of non-empty sets."""
    out = np.empty((len(sets), MINIMA), dtype=np.uint64)
    if sets:
        tokens = np.concatenate(sets)
        starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
        hashes = np.empty_like(tokens)
        for k in range(MINIMA):
            np.bitwise_xor(tokens, _XOR[k], out=hashes)
            np.multiply(hashes, _FACTOR[k], out=hashes)
            out[:, k] = np.minimum.reduceat(hashes, starts)
    return out


def packed(least: np.ndarray) -> np.ndarray:
    """(sets, BITS * WORDS): the low bits of the minima as bit planes, in the order of ``PLANES``."""
    planes = [np.packbits(((least >> np.uint64(p)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64) for p in range(BITS)]
    return np.concatenate(planes, axis=1) if len(least) else np.empty((0, BITS * WORDS), np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """(sets, BANDS): one key for each band of whole minima."""
    bands = least[:, :BANDS * ROWS].reshape(len(least), BANDS, ROWS)
    return mixed((mixed(bands) * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _signed(width: int):
    """(doc_id, c1, c2, n, bands, planes): planes and bands once a task for each set."""

    def run(batches):
        sent = set()
        for batch in batches:
            for a, b in slices(batch.column(1)):
                found = shingle_sets(batch.column(1).slice(a, b - a), width)
                digests = [set_digest(s) for s in found]
                new = []
                for i, (s, d) in enumerate(zip(found, digests, strict=True)):
                    if len(s) and d not in sent:
                        sent.add(d)
                        new.append(i)
                least = minima([found[i] for i in new])
                at = np.full(len(found), -1)
                at[new] = np.arange(len(new))
                valid = at >= 0
                bands, planes = band_keys(least), packed(least)
                rows = np.maximum(at, 0)
                keys = [k.tobytes() for k in bands]
                columns = [pa.array(planes[rows, k] if len(new) else np.zeros(len(found), np.int64), mask=~valid) for k in range(len(PLANES))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                     pa.array([len(s) for s in found], pa.int64()), pa.array([keys[i] if ok else None for i, ok in zip(rows, valid, strict=True)], pa.binary()),
                     *columns], ["doc_id", "c1", "c2", "n", "bands", *PLANES])

    return run


def _postings(batches):
    """(key, sid, prev): one row for each band of sets (sid, bands), with the key of the band before."""
    for batch in batches:
        if batch.num_rows:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64)
            sid = np.repeat(np.asarray(batch.column(0)), BANDS)
            prev = np.where(np.arange(len(keys)) % BANDS == 0, sid, np.roll(keys, 1))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sid), pa.array(prev)], ["key", "sid", "prev"])


def _shingles(batches):
    """(token, sid): the shingles of sets (sid, tokens)."""
    for batch in batches:
        for sid, tokens in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(tokens.as_buffer(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(np.full(len(x), sid))], ["token", "sid"])


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set has its distinct shingles of ``width`` words, or all
    its words as one with fewer; documents without words (null or empty texts too) have an empty set, link with nothing and are
    their own component. Two link at a Jaccard similarity of ``PERCENT`` or more; component_id is the smallest doc_id
    reachable; kept is whether that is the document's own. Null ids are passed over by the smallest; where a component has null ids only,
    component_id is null and all are kept. Repeated rows are documents of equal sets; rows that repeat the id kept are all kept. Very long texts are
    taken whole. ``docs`` needs doc_id and text; other columns are not read. No rows give no rows.
    """
    texts = docs.select("doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("c1", "c2", "n")), T.StructField("bands", T.BinaryType()),
                           *(T.StructField(c, T.LongType()) for c in PLANES)])
    signed = written(texts.mapInArrow(_signed(width), schema), "signatures")
    sets = signed.filter("bands is not null").dropDuplicates(["c1", "c2"]).withColumn("sid", F.monotonically_increasing_id()).drop("doc_id")
    sets = written(sets, "sets")
    postings = sets.select("sid", "bands").mapInArrow(_postings, "key long, sid long, prev long").select("key", "sid", spread_evenly().alias("pri"), "prev")
    met = pivoted(postings, "shared-bands").select("key", "sid", "prev")
    # whole sets of those under a shared band only
    candidates = written(sets.drop("bands").join(met.select("sid").distinct(), "sid", "left_semi"), "candidate-sets")
    tokens = token_sets(texts, filter_bits(candidates), width, "shingle-sets").filter("tokens is not null").select("c1", "c2", "tokens")
    full = candidates.join(tokens.dropDuplicates(["c1", "c2"]), ["c1", "c2"]).select("sid", "n", "tokens", *PLANES)
    full = written(with_sketches(full), "candidate-shingles")
    # shingles that no other candidate has: a row for each shingle, no join back
    alone = full.select("sid", "tokens").mapInArrow(_shingles, "token long, sid long").groupBy("token").agg(
        F.count(F.lit(1)).alias("sets"), F.min("sid").alias("sid")).filter("sets = 1").groupBy("sid").agg(F.count(F.lit(1)).alias("own"))
    known = full.select("sid", "n").join(alone, "sid", "left").select("sid", "n", F.expr("n - coalesce(own, 0)").alias("shared"))
    known = written(known.filter(f"100 * shared >= {PERCENT} * n").withColumn("pri", priority("n - shared")), "screened-sets")
    busy = pivoted(met.join(known, "sid").select("key", "sid", "pri", "n", "shared", "prev"), "busy-bands")
    labels = linked(busy, full, BOUND, NEAR, similar(PERCENT), [*SKETCH, *PLANES])
    return named_rows(signed, sets, labels).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_bbit_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = jaccard_sql(WIDTH, PERCENT, ", l.doc_id = component_id AS kept")
