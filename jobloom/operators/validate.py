"""Checks that enrichment kept every producer row and produced valid labels (AGG-8, JN-3).

The two sides are compared as multisets of ``(coordinates..., Index, title)``, null matching null: each producer row counts +1, each
enriched row -1, and equal rows cancel in one aggregation that combines on the map side. An Index that half of all rows share, or a
null one, costs no more than another. What does not cancel is paired within its Index in the order of the titles: a pair is a changed title,
a row without partner a lost or added row. The pairing numbers the rest over ranges, so it has no hot group either. The checks, in
the order a failure is reported:

 1 row count      rows per payload differ
 2 Index          a producer row has no enriched row with the same Index (or back)
 3 Position title key text differs after string cast and strip
 4 score missing  ``complexity_score`` null or not numeric
 5 score range    outside [0, 100]
 6 category blank 7 category unknown 8 seniority blank 9 seniority unknown

A null label is compared as the text ``None``: it is "unknown", not "blank".
``violations`` returns the failing rows; ``assert_valid`` aggregates all rule
counts in one pass and raises ``ValidationError`` for the first failing rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import vocab as V
from jobloom.functions.text import unicode_strip
from jobloom.operators.joins import join_small
from jobloom.operators.ordering import global_index
from jobloom.session import checkpoint_dir

KEYS = ("Index", "Position title")
LABELS = ("complexity_score", "category", "seniority_level")


class ValidationError(ValueError):
    """Enriched rows do not match the producer rows or carry invalid values."""


RULES = {
    1: ("row count", "the two sides have different numbers of rows"),
    2: ("Index", "rows whose Index has no partner on the other side"),
    3: ("Position title", "titles that are not those of the producer"),
    4: ("score missing", "complexity_score holds no number"),
    5: ("score range", "complexity_score lies outside 0 to 100"),
    6: ("category blank", "category is blank"),
    7: ("category unknown", "category is none of the known ones"),
    8: ("seniority blank", "seniority_level is blank"),
    9: ("seniority unknown", "seniority_level is none of the known ones"),
}


def _as_text(c: Column) -> Column:
    return unicode_strip(F.coalesce(c.cast("string"), F.lit("None")))


def _score() -> Column:
    """The score as a number; null where it is null, not numeric or NaN."""
    number = F.col("complexity_score").cast("string").try_cast("double")
    return F.when(~F.isnan(number), number)


def _label_checks() -> list[tuple[int, Column, Column]]:
    """Checks 6-9: blank ignores outer white space, the allowed sets do not."""
    out = []
    for no, name, allowed in ((6, "category", V.ALLOWED_CATEGORIES), (8, "seniority_level", V.ALLOWED_SENIORITY)):
        text = F.coalesce(F.col(name).cast("string"), F.lit("None"))
        blank = unicode_strip(text) == ""
        out += [(no, blank, F.lit("")), (no + 1, ~blank & ~text.isin(*allowed), text)]
    return out


def _require(side: str, df: DataFrame, columns: Sequence[str]) -> None:
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValidationError(f"the {side} rows lack {', '.join(map(repr, lacking))}")


def _key_type(producer: DataFrame, enriched: DataFrame):
    """How Index values are compared: integers by value, others as text, like a string cast."""
    integral = ("tinyint", "smallint", "int", "bigint")
    if dict(producer.dtypes)["Index"] in integral and dict(enriched.dtypes)["Index"] in integral:
        return lambda c: c.cast("long")
    return _as_text


def _row(coords: Sequence[str], rule: int, value: Column, index: Column) -> list[Column]:
    return [*[F.col(c) for c in coords], index.cast("long").alias("Index"), F.lit(rule).alias("rule_no"), F.lit(RULES[rule][0]).alias("rule"), value.alias("value")]


def _unmatched(rest: DataFrame, coords: Sequence[str], sign: int) -> DataFrame:
    """The rows of one side that did not cancel, numbered 1.. within (coordinates, Index) in the order of their titles."""
    group = [*coords, "_k"]
    rows = rest.filter(F.col("_net") * sign > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_net") * sign))).drop("_net")
    rows = global_index(rows, [*group, "_t", "_copy"], index_col="_rn")
    starts = rows.groupBy(*group).agg(F.min("_rn").alias("_start"))
    starts = starts.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(group)], "_start")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(group)])
    return join_small(rows, starts, same).select(*group, "_i", "_t", (F.col("_rn") - F.col("_start")).alias("_nth"))


def violations(producer: DataFrame, enriched: DataFrame, coords: Sequence[str] = ()) -> DataFrame:
    """One row per failed check: ``coords..., Index, rule_no, rule, value``. The rows that do not cancel are checkpointed while the
    plan is built: nothing is numbered where all rows match."""
    _require("producer", producer, KEYS)
    _require("enriched", enriched, KEYS + LABELS)
    coords = list(coords)
    key = _key_type(producer, enriched)
    side = lambda d, sign: d.select(
        *coords, key(F.col("Index")).alias("_k"), F.col("Index").cast("string").try_cast("long").alias("_i"), _as_text(F.col("Position title")).alias("_t"),
        F.lit(sign).cast("long").alias("_n"))
    counted = side(producer, 1).unionByName(side(enriched, -1)).groupBy(*coords, "_k", "_t").agg(F.sum("_n").alias("_net"), F.min("_i").alias("_i"))
    checkpoint_dir(producer.sparkSession)
    rest = counted.filter("_net <> 0").checkpoint(eager=True)
    out = label_violations(enriched, coords)
    # (1) rows per payload on each side
    sides = (producer.select(*coords, F.lit(1).alias("_p"), F.lit(0).alias("_e"))
             .unionByName(enriched.select(*coords, F.lit(0).alias("_p"), F.lit(1).alias("_e"))))
    counts = sides.groupBy(*coords).agg(F.sum("_p").alias("_np"), F.sum("_e").alias("_ne")).filter("_np <> _ne")
    out = out.unionByName(counts.select(*_row(coords, 1, F.concat_ws(" vs ", F.col("_np").cast("string"), F.col("_ne").cast("string")), F.lit(None))))
    if rest.isEmpty():
        return out
    # (2), (3): the n-th row of an Index that is left on one side against the n-th on the other
    p, e = _unmatched(rest, coords, 1), _unmatched(rest, coords, -1)
    e = e.select(*[F.col(c).alias(f"_e{c}") for c in e.columns])
    pairs = p.join(e, [F.col(c).eqNullSafe(F.col(f"_e{c}")) for c in [*coords, "_k"]] + [F.col("_nth") == F.col("_e_nth")], "full")
    pairs = pairs.select(*[F.coalesce(c, f"_e{c}").alias(c) for c in coords], F.coalesce("_i", "_e_i").alias("_index"),
                         _as_text(F.coalesce("_k", "_e_k")).alias("_key"), "_t", "_e_t", (F.col("_nth").isNotNull() & F.col("_e_nth").isNotNull()).alias("_both"))
    changed = pairs.filter("_both").select(*_row(coords, 3, F.concat_ws(" vs ", "_t", "_e_t"), F.col("_index")))
    single = pairs.filter("not _both").select(*_row(coords, 2, F.col("_key"), F.col("_index")))
    return out.unionByName(changed).unionByName(single)


def assert_valid(producer: DataFrame, enriched: DataFrame, coords: Sequence[str] = ()) -> None:
    """Raise ``ValidationError`` naming the first failing check; one aggregation pass."""
    msg = first_violation(violations(producer, enriched, coords))
    if msg:
        raise ValidationError(msg)


def label_violations(enriched: DataFrame, coords: Sequence[str] = ()) -> DataFrame:
    """Checks 4-9 alone: row-local, no join, no shuffle.

    When the enriched rows are a projection of the producer rows (as in
    ``enrich``), keys and row counts are preserved by construction and only the
    label checks can fail; a streaming consumer runs this form per micro-batch.
    """
    _require("enriched", enriched, KEYS + LABELS)
    score = _score()
    checks = [
        (4, score.isNull(), F.col("complexity_score").cast("string")),
        (5, score.isNotNull() & ((score < 0) | (score > 100)), F.col("complexity_score").cast("string")),
        *_label_checks(),
    ]
    found = F.filter(F.array(*[
        F.when(c, F.struct(F.lit(n).alias("rule_no"), F.lit(RULES[n][0]).alias("rule"), v.alias("value")))
        for n, c, v in checks]), lambda x: x.isNotNull())
    return enriched.select(*coords, F.col("Index").cast("long").alias("Index"), F.explode(found).alias("_v")) \
        .select(*coords, "Index", "_v.rule_no", "_v.rule", "_v.value")


def first_violation(violation_rows: DataFrame) -> str | None:
    """Message of the lowest failing rule (one aggregation), or None when all checks pass."""
    summary = violation_rows.groupBy("rule_no").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(F.col("Index").isNull().alias("no_index"), "Index", "value")).alias("first"))
    first = summary.orderBy("rule_no").limit(1).collect()
    if not first:
        return None
    r = first[0]
    where = "" if r["first"]["Index"] is None else f"first at Index {r['first']['Index']}, "
    return f"{RULES[r['rule_no']][1]}: {r['n']} row(s), {where}value {r['first']['value']!r}"
