"""Mixing sources to target weights.

Documents get hash-random keys, are range-sorted within their source, and a distributed prefix sum of
their word counts finds the one place where the source's budget is used up. That place (a key) is all that
the last pass needs: it compares each row with its source's cut, so no text is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.operators.joins import join_small

from .common import WORD, running_totals, table, written
from .words import count_words, first_words

WEIGHTS = (1, 2, 3)
#: a source is repeated at most this many times
MOST = 3
SOURCE = ["src_null", "src"]


def _key(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _source() -> list[Column]:
    """Two columns without nulls, in the order of sources: code points, null last."""
    return [F.col("source").isNull().alias("src_null"), F.coalesce("source", F.lit("")).alias("src")]


def source_targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(src_null, src, source_size, target): one row per source.

    The budget is the size of everything. A source's share goes by its weight but ends at ``most`` times its
    size; what it can't use is shared anew by weight until no source is above. Each round is one
    aggregate over the table of sources and brings two sums to the driver.
    """
    totals = written(sized.groupBy(*SOURCE).agg(F.sum("size").alias("source_size")), "source-sizes")
    ranked = running_totals(totals.withColumn("one", F.lit(1)), "one", SOURCE).drop("one")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    ranked = written(ranked.withColumn("weight", weight.cast("long")).drop("before"), "source-ranks")
    budget = ranked.agg(F.sum("source_size")).first()[0] or 0
    full, left, rest = F.lit(False), budget, None
    while True:
        row = ranked.agg(F.sum(F.when(full, F.col("source_size") * most)).alias("used"),
                         F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if (row["used"] or 0, row["weight"]) == (budget - left, rest):
            break
        left, rest = budget - (row["used"] or 0), row["weight"]
        if not rest:
            break
        full = F.expr(f"cast(source_size * {most} as decimal(19,0)) * {rest} < cast(weight as decimal(19,0)) * {left}")
    share = F.col("weight") * F.lit(left) / F.lit(rest or 1)
    return ranked.select(*SOURCE, "source_size",
                         F.when(full, (F.col("source_size") * most).cast("double")).otherwise(share).alias("target"))


def mix_plan(sized: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """One row per source: its target, its whole passes, and the cut of the last pass in the order of keys.

    ``sized`` has doc_id, src_null, src, size. Rows that repeat doc_id and size share a place in
    the order; if the cut falls there they get equal parts of what is left.
    """
    sources = source_targets(sized, weights, most)
    budget = F.floor("target").cast("long")
    sources = written(sources.select(
        "*", F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as long) div source_size")).otherwise(0).alias("passes"),
        F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0).alias("left")), "source-targets")
    places = sized.groupBy(*SOURCE, "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"))
    places = places.select("*", _key(seed).alias("key"), (F.col("rows") * F.col("size")).alias("words"))
    placed = running_totals(places, "words", ["key", "doc_id", "size"], SOURCE)
    cut = join_small(placed, sources.select(*SOURCE, "left"), SOURCE) \
        .filter("before <= left and left < before + words") \
        .select(*SOURCE, F.struct("key", "doc_id", "size").alias("cut"), F.expr("(left - before) div rows").alias("cut_words"))
    return written(sources.drop("left").join(cut, SOURCE, "left"), "mix-plan")


def _taken(seed: int) -> tuple[Column, Column]:
    """(words the last pass takes of this row, whole passes)."""
    place = F.struct(_key(seed).alias("key"), F.col("doc_id"), F.col("size"))
    last = F.when(place < F.col("cut"), F.col("size")).when(place == F.col("cut"), F.col("cut_words")).otherwise(F.lit(0))
    return last.cast("long"), F.col("passes")


def mixed_sizes(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    ``docs`` needs doc_id, text, source; others are not read. Null text has size 0; a null source is a source of its own, the
    last; null ids are ids like any other. Very long texts count whole. No rows give no rows. Reruns agree row by row.
    """
    sized = written(docs.select("doc_id", *_source(), count_words("text").alias("size")), "sizes")
    last, passes = _taken(seed)
    return join_small(sized, mix_plan(sized, weights, most, seed), SOURCE).select(
        "doc_id", "size", "source_size", "target", (passes * F.col("size") + last).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: a document comes once for each pass that takes it
    whole (one without words may come once more), and once more with its first words only if its source's budget ends inside it (its ``n_chars``,
    if there is such a column, is then that of the shorter text). Extra columns stay as they are."""
    sized = written(docs.select("doc_id", *_source(), count_words("text").alias("size")), "sizes")
    plan = mix_plan(sized, weights, most, seed)
    own = [F.col(f"`{c}`") for c in docs.columns]
    # all columns of a document travel in one struct, so that none can clash with what the mix adds
    mark = "mix_" + "_" * max(len(c) for c in docs.columns)
    work = join_small(docs.select(F.struct(*own).alias("row"), "doc_id", *_source()), plan, SOURCE).withColumn("key", _key(seed))
    # only rows with the key of the cut need their words counted; 0 stands for a whole copy
    size = F.when(F.col("key") == F.col("cut.key"), F.size(F.regexp_extract_all(
        F.coalesce("row.text", F.lit("")), F.lit(WORD), F.lit(0)))).otherwise(F.lit(0)).cast("long")
    work = work.withColumn("size", size)
    place = F.struct("key", "doc_id", "size")
    whole, none = F.array(F.lit(0).cast("long")), F.array().cast("array<long>")
    last = F.when((place < F.col("cut")) | ((place == F.col("cut")) & (F.col("cut_words") >= F.col("size"))), whole) \
        .when((place == F.col("cut")) & (F.col("cut_words") > 0), F.array(F.col("cut_words").cast("long"))).otherwise(none)
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), F.col("passes").cast("int")), last)
    work = work.select("row", F.explode(copies).alias(mark))
    is_cut = F.col(mark) > 0
    work = work.select("row", first_words(F.when(is_cut, F.col("row.text")), F.when(is_cut, F.col(mark))).alias(mark))
    out = []
    for field in docs.schema.fields:
        value = F.col("row").getField(field.name)
        if field.name == "text":
            value = F.coalesce(F.col(mark), value)
        elif field.name == "n_chars":
            value = F.coalesce(F.char_length(mark).cast(field.dataType), value)
        out.append(value.alias(field.name))
    return work.select(*out)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed_sizes(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, coalesce(sum(3 * source_size) OVER b, 0)::BIGINT AS used, sum(w) OVER a AS rest,
         (SELECT sum(source_size) FROM s)::BIGINT AS budget, row_number() OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST) AS k
  FROM s WINDOW b AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                a AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT used, rest, budget, k FROM o WHERE 3 * source_size * rest >= w * (budget - used) ORDER BY k LIMIT 1),
t AS (
  SELECT o.source, o.source_size,
         CASE WHEN o.k < level.k THEN (3 * o.source_size)::DOUBLE
              ELSE (o.w * (level.budget - level.used))::DOUBLE / level.rest::DOUBLE END AS target
  FROM o, level),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS passes,
         CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT % t.source_size ELSE 0 END AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('0:' || d.doc_id::VARCHAR), d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (passes * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM p
"""
