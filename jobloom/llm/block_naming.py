"""Exact duplicates by deterministic block naming (DataFrame functions only).

Each normalised text is cut into blocks of a fixed number of bytes. The distinct blocks of the
corpus are sorted within their hash buckets and numbered: a block's name is an integer. Then adjacent names are
paired and the distinct pairs sorted and numbered, until every document has one integer. Equal
(length, integer) means equal text, without any hash deciding it.

Rows find the name of a block through a 128-bit address instead of carrying the block's bytes through
a second shuffle. That no two different blocks share an address is checked on the table of names;
if two ever do, the naming is done again with another seed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, join_salted, table, written

BLOCK_BYTES = 4096
SEEDS = 8


def _blocks(src: DataFrame, block_bytes: int, seed: int, fields: str) -> DataFrame:
    cut = (f"transform(sequence(0, greatest(cast(ceil(n_bytes / {block_bytes}) as int), 1) - 1), "
           f"i -> substring(bytes, i * {block_bytes} + 1, {block_bytes}))")
    named = f"transform({cut}, (b, i) -> struct(i as pos, xxhash64({seed}, b) as h1, xxhash64(b, {seed}) as h2{fields}))"
    return src.selectExpr("* except (bytes)", f"inline({named})")


def _named_blocks(src: DataFrame, block_bytes: int, seed: int) -> DataFrame:
    """(h1, h2, name): one row per distinct block."""
    blocks = _blocks(src.select("bytes", "n_bytes"), block_bytes, seed, ", b as block").select("h1", "h2", "block")
    # sorted in its hash bucket, the set of blocks alone fixes the names, also when a task runs again
    names = blocks.distinct().sortWithinPartitions("block").select(
        "h1", "h2", F.monotonically_increasing_id().alias("name"))
    return written(names, "block-names")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. The row with the largest id of a group stays.
    Null text counts as empty; all empty texts are equal. A null id is smaller than any other. Of rows that repeat the
    largest id of their group exactly one stays. Very long texts are taken whole, as many blocks.
    Other columns are not read. An empty table gives none.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    src = src.select("doc_id", "norm", F.col("norm").cast("binary").alias("bytes"), F.octet_length("norm").alias("n_bytes"))
    for seed in range(SEEDS):
        names = _named_blocks(src, block_bytes, seed)
        if names.groupBy("h1", "h2").count().filter("count > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"different blocks shared an address under each of {SEEDS} seeds")

    rows = src.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_bytes",
                      F.sha2("norm", 256).alias("text_sha256"), "bytes")
    rows = written(_blocks(rows, block_bytes, seed, ""), "document-blocks")
    heads = rows.filter("pos = 0").select("row", "doc_id", "n_bytes", "text_sha256")
    state = rows.withColumn("width", F.greatest(F.ceil(F.col("n_bytes") / block_bytes), F.lit(1)).cast("int"))
    state = join_salted(state, names, ["h1", "h2"], ["row"]).select("row", "pos", "width", "name")
    state = written(state, "names-0")
    widest = state.agg(F.max("width")).first()[0] or 1
    done, level = [state.filter("width = 1").select("row", "name")], 0
    while widest > 1:
        level += 1
        state, widest = _pair_names(state.filter("width > 1"), level), (widest + 1) // 2
        done.append(state.filter("width = 1").select("row", "name"))
    identity = done[0]
    for more in done[1:]:
        identity = identity.unionByName(more)

    found = written(heads.join(identity, "row"), "identities")
    groups = found.groupBy("n_bytes", "name").agg(F.max(F.struct("doc_id", "row")).alias("keep"),
                                                  F.count(F.lit(1)).alias("group_size"))
    # the rows of a large group of copies are dealt out, not sent to one task
    return join_salted(found, groups, ["n_bytes", "name"], ["row"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def _pair_names(state: DataFrame, level: int) -> DataFrame:
    """Name each adjacent pair; an odd last name is paired with -1."""
    pairs = state.groupBy("row", F.expr("pos div 2").cast("int").alias("pos")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        F.expr("cast((max(width) + 1) div 2 as int)").alias("width"))
    pairs = written(pairs, f"pairs-{level}")
    names = pairs.select("a", "b").distinct().sortWithinPartitions("a", "b").withColumn(
        "name", F.monotonically_increasing_id())
    names = written(names, f"pair-names-{level}")
    return written(pairs.join(names, ["a", "b"]).select("row", "pos", "width", "name"), f"names-{level}")


def op6_block_naming(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
