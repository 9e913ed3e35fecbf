"""One-permutation MinHash with optimal densification and packed low-order bits (DataFrame functions only).

Every shingle is hashed once; its top bits choose one of ``BINS`` bins, and the least hash of a bin is its value. An empty bin
takes the value of the first bin that is not empty in a random order of its own, the same in every document. The fingerprint keeps
the 8 low-order bits of each bin, packed as hex. A likeness takes chance agreement out:
(share of equal codes - 1/256) / (1 - 1/256), not below 0.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_totals, table, written

BIN_BITS = 7
BINS = 1 << BIN_BITS
WIDTH = 5
#: places of a bin's order tried one by one; the rest of the order is searched only if all of them are empty
TRIES = 8


def _orders(seed: int = 5) -> tuple[str, str]:
    """SQL arrays: where each bin's order begins and its odd step, which visits every bin once."""
    rng = random.Random(seed)
    begin, step = [rng.randrange(BINS) for _ in range(BINS)], [rng.randrange(BINS // 2) * 2 + 1 for _ in range(BINS)]
    return tuple(f"array({','.join(map(str, x))})" for x in (begin, step))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add column ``out``: the fingerprint of ``text`` (no nulls); the empty string for a text without words.

    Shingles are runs of 5 words, or all the words of a text with fewer.
    """
    kept = df.columns
    begin, step = _orders()
    place = lambda t: f"get(codes, (get({begin}, b) + {t} * get({step}, b)) & {BINS - 1})"
    tries = ", ".join(place(t) for t in range(TRIES))
    rest = f"get(filter(transform(sequence({TRIES}, {BINS - 1}), t -> {place('t')}), c -> c is not null), 0)"
    words = "regexp_extract_all(%s, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)" % text
    shingle = "xxhash64(" + ", ".join(f"get(words, i + {k})" for k in range(WIDTH)) + ")"
    bin_of = lambda x: f"cast(shiftrightunsigned({x}, {64 - BIN_BITS}) as int)"
    df = df.selectExpr("*", f"transform({words}, w -> xxhash64(w)) as words")
    df = df.selectExpr(*kept, f"sort_array(case when size(words) >= {WIDTH} then transform(sequence(0, size(words) - {WIDTH}), i -> {shingle}) "
                              "when size(words) > 0 then array(xxhash64(words)) else cast(array() as array<bigint>) end) as hashes")
    df = df.selectExpr(*kept, f"filter(hashes, (x, i) -> i = 0 or {bin_of('x')} <> {bin_of('get(hashes, i - 1)')}) as least")
    df = df.selectExpr(*kept, "least", f"transform(least, x -> {bin_of('x')}) as bins")
    df = df.selectExpr(*kept, f"case when size(least) > 0 then transform(sequence(0, {BINS - 1}), "
                              "b -> cast(get(least, cast(array_position(bins, b) as int) - 1) & 255 as int)) end as codes")
    df = df.selectExpr(*kept, f"transform(codes, (c, b) -> coalesce(c, {tries}, {rest})) as codes")
    return df.selectExpr(*kept, f"coalesce(array_join(transform(codes, c -> substring(hex(c + 256), 2, 2)), ''), '') as {out}")


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprints. Two texts without words are alike, one without is like no other."""
    same = f"size(filter(sequence(0, {BINS - 1}), i -> substring({a}, 2 * i + 1, 2) = substring({b}, 2 * i + 1, 2)))"
    share = f"greatest(0D, ({same} / {BINS}D - 1 / 256D) / (1 - 1 / 256D))"
    return F.expr(f"case when {a} = {b} then 1D when {a} = '' or {b} = '' then 0D else {share} end")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document,
    in descending doc_id, nulls last, after the last the first. Rows that repeat doc_id and text are one document in
    that order and each get its row; those that repeat only doc_id follow each other. Null texts are empty. A single document
    is its own next one. Very long texts are fingerprinted whole. ``docs`` needs doc_id and text; other columns are not read. No rows give no rows.
    """
    id_type = docs.schema["doc_id"].dataType
    src = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("t"))
    src = src.select("id", F.xxhash64("t").alias("h"), F.char_length("t").alias("n"), "t")
    # the order of documents, without their texts: each one's predecessor
    value = F.when(F.col("id") != "", F.col("id")).cast(id_type)
    order = [F.desc_nulls_last("value"), F.asc("h"), F.asc("n")]
    ranked = running_totals(src.select("id", "h", "n").distinct().select("*", value.alias("value"), F.lit(1).alias("one")), "one", order)
    ranked = written(ranked.select("id", "h", "n", F.col("before").alias("place")), "document-order")
    total = max(ranked.count(), 1)
    before = ranked.select(*[F.col(c).alias(f"{c}_before") for c in ("id", "h", "n")], ((F.col("place") + 1) % total).alias("place"))
    order = written(ranked.join(before, "place").drop("place"), "predecessors")

    # one shuffle of the texts serves both sides of the second join, which sends each text's beginning to its predecessor
    key = ["id", "h", "n"]
    texts = with_fingerprint(src, "t", "code").join(order, key)
    heads = texts.select(F.col("id_before").alias("id"), F.col("h_before").alias("h"), F.col("n_before").alias("n"),
                         F.expr("substring(t, 1, n_before div 2)").alias("head"), F.col("code").alias("next_code"))
    heads = heads.groupBy(*key).agg(F.first("head").alias("head"), F.first("next_code").alias("next_code"))
    both = texts.join(heads, key).select("id", "n", "code", "next_code", F.expr("concat(substring(t, 1, n - n div 2), head)").alias("edited"))
    both = with_fingerprint(both, "edited", "edited_code")
    return both.select(F.when(F.col("id") != "", F.col("id")).cast(id_type).alias("doc_id"), F.col("n").cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), F.col("code").alias("fingerprint"),
                       F.col("edited_code").alias("edited_fingerprint"), likeness("code", "edited_code").alias("near_edited"),
                       likeness("code", "next_code").alias("near_next"))


def op5_one_permutation(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
