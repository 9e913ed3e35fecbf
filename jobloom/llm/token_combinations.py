"""Exact Jaccard join on word shingles with token-combination prefixes.

1. Screen. A document can only have a partner if at least 3/4 of its shingles occur elsewhere. A fixed share
   of the hash space is counted over the whole corpus; a document with too few shared shingles there is out, with certainty.
2. The others' shingles are ordered by document frequency, rare ones first. Rare shingles in the prefix of
   n - ceil(t n) + 1 are indexed singly: if the first common shingle of a linked pair is rare, both have it there. Else all their
   common shingles are frequent. At most D = floor(n / 3) shingles of the two together are not common, so among the first
   2 D + 2 of the merged sequence two common ones are neighbours; adjacent frequent shingles are indexed as
   combinations of two, in the extended prefix of 2 floor(n / 3) + 2.
3. Documents under one key are compared with one pivot of the key, not pair by pair, and then as ``set_links`` says until every pair of
   different components under a key has been compared, mostly once. Exact bounds (sizes, shared shingles, places in the order, and the distance of
   512-bit parity sketches, at most the symmetric difference; under open keys shingles of one set alone are counted apart) drop pairs inside the join.
   What passes is verified on the whole sets.

Sets are compared as sets of 64-bit hashes. Two different shingles of the documents compared share a hash with a probability of about 2^-63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written
from .set_links import SKETCH, filter_bits, jaccard_sql, linked, named_rows, parity_bound, pivoted, priority, similar, token_sets, with_sketches
from .shingles import set_digest, shingle_sets, slices

#: shingles in at most this many documents are indexed singly
RARE = 8
#: share of the hash space that the screen counts
SCREENED = 0.4
#: what links under a key keep: sizes, and enough shared shingles before and after the places of the key
BOUND = ("4 * {a}n >= 3 * {b}n and 4 * {b}n >= 3 * {a}n and 7 * least({a}shared, {b}shared) >= 3 * ({a}n + {b}n) "
         "and 7 * (least({a}place - 1, {b}place - 1) + least({a}n - {a}place + 1, {b}n - {b}place + 1)) >= 3 * ({a}n + {b}n)")
NEAR = parity_bound(75)
SHARPENED = parity_bound(75, alone=True)


_LEFT = T.StructType([T.StructField(c, T.LongType()) for c in ("token", "cls", "w")])
_VOTE = T.StructType([T.StructField("cls", T.LongType()), T.StructField("v", T.LongType())])


def _longs(x) -> pa.Array:
    return pa.array(np.asarray(x).astype(np.uint64, copy=False).view(np.int64))


def _screen_rows(batches):
    """(token, cls, w): w = 1 a shingle of one document here, 0 a shingle that several documents here have (one row for all),
    4 v + 2 a document's balance: shared shingles known here, minus those that it needs."""
    top = np.uint64(int(SCREENED * 2.0 ** 64))
    for batch in batches:
        texts = batch.column(0)
        for a, b in slices(texts):
            seen, tokens, owner, classes, need = set(), [], [], [], []
            for s in shingle_sets(texts.slice(a, b - a)):
                digest = set_digest(s)
                if not len(s) or digest in seen:
                    continue
                seen.add(digest)
                part = s[:int(np.searchsorted(s, top))]
                tokens.append(part)
                owner.append(np.full(len(part), len(classes)))
                need.append(len(part) - len(s) // 4)
                classes.append(digest[0])
            if not classes:
                continue
            token, own, classes = np.concatenate(tokens), np.concatenate(owner), np.array(classes, dtype=np.int64)
            order = np.argsort(token, kind="stable")
            token, own = token[order], own[order]
            head = np.ones(len(token), dtype=bool)
            head[1:] = token[1:] != token[:-1]
            group = np.cumsum(head) - 1
            several = (np.bincount(group) > 1)[group] if len(token) else head
            known = np.bincount(own[several], minlength=len(classes))
            alone, first = ~several, several & head
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([_longs(token[alone]), _longs(token[first]), pa.array(classes)]),
                pa.array(np.concatenate([classes[own[alone]], classes[own[first]], classes])),
                pa.array(np.concatenate([np.ones(alone.sum(), np.int64), np.zeros(first.sum(), np.int64), 4 * (known - need) + 2])),
            ], ["token", "cls", "w"])


def _votes(batches):
    """Rows sorted by token: +1 for each row whose shingle other documents have too, and the balances."""
    held = None  # of the last token so far: token, first class, rows of that class that wait, shared
    for batch in batches:
        token, cls, w = (np.asarray(c) for c in batch.columns)
        if not len(token):
            continue
        balance = w % 4 == 2
        out_c, out_v = [cls[balance]], [(w[balance] - 2) // 4]
        token, cls, w = token[~balance], cls[~balance], w[~balance]
        if len(token):
            head = np.ones(len(token), dtype=bool)
            head[1:] = token[1:] != token[:-1]
            start = np.flatnonzero(head)
            group = np.cumsum(head) - 1
            shared = (np.maximum.reduceat(cls, start) != np.minimum.reduceat(cls, start)) | (np.minimum.reduceat(w, start) == 0)
            if held and held[0] == token[0]:
                shared[0] = shared[0] or held[3] or bool((cls[group == 0] != held[1]).any())
                if shared[0] and held[2]:
                    out_c.append(np.array([held[1]]))
                    out_v.append(np.array([held[2]]))
                    held = (*held[:2], 0, True)
            last = group == len(start) - 1
            waiting = held[2] if held and held[0] == token[-1] else 0
            held = (token[-1], cls[-1], 0 if shared[-1] else waiting + int(last.sum()), bool(shared[-1]))
            hit = shared[group] & (w == 1)
            out_c.append(cls[hit])
            out_v.append(np.ones(int(hit.sum()), dtype=np.int64))
        c, at = np.unique(np.concatenate(out_c), return_inverse=True)
        v = np.zeros(len(c), dtype=np.int64)
        np.add.at(v, at, np.concatenate(out_v))
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(v)], ["cls", "v"])


def _screen(texts: DataFrame) -> DataFrame:
    """(c1): digests of the sets that may have a partner. Copies of a set vote alike, so the sign of the sum is that of one."""
    rows = texts.mapInArrow(_screen_rows, _LEFT).repartition("token").sortWithinPartitions("token")
    return written(rows.mapInArrow(_votes, _VOTE).groupBy("cls").agg(F.sum("v").alias("v")).filter("v >= 0").select(F.col("cls").alias("c1")), "screened")


def _unpacked(batches):
    """(token, sid, n): the shingles of sets (sid, n, tokens)."""
    for batch in batches:
        for sid, n, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            x = np.frombuffer(tokens.as_buffer(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(np.full(len(x), sid)), pa.array(np.full(len(x), n))], ["token", "sid", "n"])


def _keys(sets: DataFrame, rare: int) -> DataFrame:
    """The index: (key, sid, pri, n, shared, place, prev)."""
    tokens = sets.select("sid", "n", "tokens").mapInArrow(_unpacked, "token long, sid long, n long")
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    order = Window.partitionBy("sid").orderBy("df", "token")
    ranked = tokens.join(counts, "token").select(
        "sid", "n", "token", "df", F.row_number().over(order).alias("rank"), F.lead("token").over(order).alias("next"),
        F.count(F.lit(1)).over(Window.partitionBy("sid")).alias("shared"))
    ranked = ranked.filter("4 * shared >= 3 * n").withColumn("place", F.expr("n - shared + rank"))
    single = F.expr(f"df <= {rare} and place <= n div 4 + 1")
    double = F.expr(f"df > {rare} and next is not null and place + 1 <= 2 * (n div 3) + 2")
    keyed = ranked.filter(single | double).withColumn("key", F.when(double, F.xxhash64("token", "next")).otherwise(F.col("token")))
    return keyed.select("key", "sid", priority("n - shared").alias("pri"), "n", "shared", "place", F.coalesce(F.lag("key").over(order), F.col("sid")).alias("prev"))


def jaccard_components(docs: DataFrame, rare: int = RARE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set has its distinct shingles of 5 words, or all
    its words as one with fewer; documents without words (null or empty texts too) have an empty set, link with nothing and are
    their own component. Two link at a Jaccard similarity of 0.75 or more; component_id is the smallest doc_id
    reachable. Null ids are passed over by the smallest (null if there is no other); repeated rows are documents of
    equal sets. Very long texts are taken whole. ``docs`` needs doc_id and text; other columns are not read. No rows give no rows.
    """
    texts = docs.select("doc_id", "text")
    screened = _screen(texts.select("text"))
    shingled = token_sets(texts, filter_bits(screened), 5, "shingle-sets")
    sets = shingled.filter("tokens is not null").join(screened, "c1", "left_semi") \
        .dropDuplicates(["c1", "c2"]).select(F.monotonically_increasing_id().alias("sid"), "c1", "c2", "n", "tokens")
    sets = written(with_sketches(sets), "sets")
    labels = linked(pivoted(_keys(sets, rare), "keys"), sets.select("sid", "n", "tokens", *SKETCH), BOUND, NEAR, similar(75), SKETCH, SHARPENED)
    return named_rows(shingled, sets, labels)


def op9_token_combinations(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


SQL = jaccard_sql(5, 75)
