"""Enrichment projection (SCR-8): complexity score, category and seniority per row.

One narrow ``select`` -- no Python, and no shuffle but for an input of few splits (``spread``). The
text, the hits of the one scan over it and the explicit years
are computed in an earlier projection and referenced, so the scan runs
once per row (the optimizer does not inline a non-trivial expression that is
used twice), and a rule's own pattern only where the scan found one of its terms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions import scoring as S
from jobloom.functions.text import combined_text
from jobloom.operators.spread import spread

INDEX, TITLE, DESCRIPTION, TEXT = "Index", "Position title", "job_description", "combined_text"
ENRICHED_COLUMNS = (INDEX, TITLE, "complexity_score", "category", "seniority_level")


def with_combined_text(df: DataFrame) -> DataFrame:
    """Adds ``combined_text`` from the title and, when present, the description (TXT-4)."""
    if TEXT in df.columns:
        return df
    desc = F.col(DESCRIPTION) if DESCRIPTION in df.columns else None
    return df.withColumn(TEXT, combined_text(F.col(TITLE), desc))


def require_columns(df: DataFrame, cols: Sequence[str], what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; got {df.columns}")


LOWER, HITS = "_text_lc", "_rule_hits"


def score_parts(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Adds the four signals: ``leadership``, ``explicit_years``, ``inferred_years``, ``skills``
    (and ``_text_lc`` and ``_rule_hits``, the lower-cased text and what the one scan found in it)."""
    t = F.col(text)
    df = df.withColumn(LOWER, F.lower(t)) if LOWER not in df.columns else df
    lc, hits = F.col(LOWER), F.col(HITS)
    df = df.withColumn(HITS, S.rule_hits(lc))
    return (df.withColumn("leadership", S.leadership_score(t, lc, hits))
              .withColumn("explicit_years", S.max_years(t, hits))
              .withColumn("skills", S.count_skills(t, lc, hits))
              .withColumn("inferred_years", S.inferred_years(t, F.col("explicit_years"), lc, hits)))


def enrich(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep..., Index, Position title, complexity_score, category, seniority_level``.

    Needs ``Index`` and ``Position title``; ``combined_text`` is built when absent.
    Every other column is dropped, the title is passed through unchanged.
    """
    require_columns(df, [INDEX, TITLE], "enrich")
    src = with_combined_text(spread(df))
    parts = score_parts(src.select(*keep, INDEX, TITLE, TEXT))
    t, lc, hits = F.col(TEXT), F.col(LOWER), F.col(HITS)
    return parts.select(
        *keep, INDEX, TITLE,
        S.complexity_score(F.col("leadership"), F.col("explicit_years"), F.col("inferred_years"),
                           F.col("skills")).alias("complexity_score"),
        S.category(t, lc, hits).alias("category"),
        S.seniority_level(t, lc, hits).alias("seniority_level"),
    )


def enrich_payload_rows(unpacked: DataFrame, coords: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """SCR-9 over unpacked message rows (``plans.payload.unpack_payloads``), decided per message:

    * a payload that already has ``complexity_score`` keeps its values unchanged;
    * otherwise the text is the title, plus the description when the payload has
      a ``job_description`` column, and the rows are scored.

    Output: ``coords..., Index, Position title, complexity_score, category,
    seniority_level, enriched_before``. A payload that is not Parquet or lacks
    ``Index``/``Position title`` fails the job, as a bad message stops a consumer.
    """
    coords = list(coords)
    optional = {DESCRIPTION: "string", "complexity_score": "int", "category": "string", "seniority_level": "string"}
    for name, dtype in optional.items():
        if name not in unpacked.columns:
            unpacked = unpacked.withColumn(name, F.lit(None).cast(dtype))
    cols = F.col("payload_columns")
    has = lambda c: F.coalesce(F.array_contains(cols, c), F.lit(False))
    done = has("complexity_score")
    ok = F.col("payload_error").isNull() & (done | (has(INDEX) & has(TITLE)))
    checked = unpacked.filter(F.assert_true(ok, F.concat(
        F.lit("payload is not a producer Parquet payload (needs Index and Position title): "),
        F.coalesce(F.col("payload_error"), F.array_join(cols, ",")))).isNull())
    title = combined_text(F.col(TITLE))
    text = F.when(done, F.lit(None).cast("string")).when(
        has(DESCRIPTION), combined_text(F.col(TITLE), F.col(DESCRIPTION))).otherwise(title)
    parts = score_parts(checked.withColumn(TEXT, text).withColumn("enriched_before", done))
    t, lc = F.col(TEXT), F.col(LOWER)
    fresh_score = S.complexity_score(F.col("leadership"), F.col("explicit_years"), F.col("inferred_years"),
                                     F.col("skills"))
    return parts.select(
        *coords, INDEX, TITLE,
        F.when(F.col("enriched_before"), F.col("complexity_score")).otherwise(fresh_score).alias("complexity_score"),
        F.when(F.col("enriched_before"), F.col("category")).otherwise(S.category(t, lc)).alias("category"),
        F.when(F.col("enriched_before"), F.col("seniority_level")).otherwise(S.seniority_level(t, lc))
        .alias("seniority_level"),
        "enriched_before")
