"""Record cleaning before output: re-normalize, drop empty titles, keep-first dedupe.

* ``sanitize_records`` (AGG-4): dedupe key is the lower-cased canonical URL; a
  record without URL uses ``nourl:{source}:{casefold(title)}``; a URL that cannot
  be made canonical uses ``{lower(strip(url))}|{source}|{casefold(title)}``. The
  same title under two URLs is two jobs. The stored ``job_url`` is the original.
* ``dedupe_titles`` (AGG-5): title-only input, dedupe on the case-folded title.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import vocab as V
from jobloom.functions.common import built_once
from jobloom.functions.text import casefold, normalize_title, unicode_strip
from jobloom.functions.urls import canonical_url
from jobloom.operators.dedupe import keep_first


def record_key(title: Column, job_url: Column, source: Column,
               keep_all_query_params: bool = False) -> Column:
    jid = F.coalesce(job_url, F.lit(""))
    src = F.coalesce(source.cast("string"), F.lit(""))
    folded = casefold(title)
    canon = canonical_url(jid, keep_all_query_params)
    return (F.when(jid == "", F.concat(F.lit("nourl:"), src, F.lit(":"), folded))
            .when(canon.isNull(), F.concat(F.lower(unicode_strip(jid)), F.lit("|"), src, F.lit("|"), folded))
            .otherwise(F.lower(canon)))


def sanitize_records(records: DataFrame, order: str | Column | Sequence,
                     title: str = "position_title", url: str = "job_url", source: str | None = "source",
                     title_max_chars: int = V.TITLE_MAX_CHARS,
                     keep_all_query_params: bool = False) -> DataFrame:
    """Clean job records and keep the first record per job (AGG-4).

    ``order`` gives "first" (e.g. source position, page, phase, position). Output
    has the input columns with ``title`` normalized and ``url`` as a string.
    """
    has_source = bool(source and source in records.columns)
    title_col = built_once(("normalize_title", title, title_max_chars),
                           lambda: normalize_title(F.col(title), title_max_chars))
    key = built_once(("record_key", title, url, source if has_source else None, keep_all_query_params),
                     lambda: record_key(F.col(title), F.col(url),
                                        F.col(source) if has_source else F.lit(None).cast("string"),
                                        keep_all_query_params))
    # title cleaning and the URL key are CPU-heavy and run before the shuffle
    cleaned = (records
               .withColumn(title, title_col)
               .filter(F.col(title) != "")
               .withColumn(url, F.coalesce(F.col(url).cast("string"), F.lit(""))))
    if has_source:
        cleaned = cleaned.withColumn(source, F.col(source).cast("string"))
    return keep_first(cleaned, key, order)


def dedupe_titles(titles: DataFrame, order: str | Column | Sequence, title: str = "title",
                  title_max_chars: int = V.TITLE_MAX_CHARS) -> DataFrame:
    """Normalized, non-empty titles, first of each case-folded title kept (AGG-5)."""
    cleaned = (titles.withColumn(title, normalize_title(F.col(title), title_max_chars))
               .filter(F.col(title) != ""))
    return keep_first(cleaned, casefold(F.col(title)), order)
