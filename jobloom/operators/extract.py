"""Job-link extraction from landed listing pages (SET-3 and its parts).

All work for one page happens inside that page's row with array functions, so
extraction is a narrow, shuffle-free projection over the ``pages`` table: the
only bound on a row is the page-size cap applied when pages are read.

Per page, in document order:

1. anchors ``<a ... href=...>...</a>`` outside comments, scripts and styles;
2. keep links that may point at a job page (FLT-2) with a slug (FLT-3) and a
   canonical URL after joining to the site origin (URL-4, URL-1, FLT-4);
3. ``/career/<slug>`` occurrences anywhere in the raw HTML (AGG-3);
4. anchors first, then slugs (SET-1): first occurrence of each lower-cased
   canonical URL wins (AGG-2, JN-2) -- an anchor whose text is empty still
   claims its URL;
5. anchor text becomes a normalized title (TXT-1), a slug a title-cased one
   (TXT-2); rows with an empty title are dropped (FLT-5).

Pages whose markup needs a parser (nested anchors, unusual character references and the like, see ``markup.py``) have their anchors
read by a tokenizer with a stack; all other pages stay in built-in expressions.

Step 4 sorts the candidates by (key, phase, position), keeps each element
whose key differs from its predecessor, and sorts back by (phase, position):
O(n log n) per page, no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import vocab as V
from jobloom.functions.common import built_once, let
from jobloom.functions.text import html_unescape, normalize_title, title_from_slug, unicode_strip
from jobloom.functions.urls import canonical_join, is_job_href, job_slug, site_origin, split_url
from jobloom.operators.markup import needs_parser, parsed_anchors
from jobloom.operators.spread import spread

# Markup whose text is not page text: comments, scripts, styles. Replaced by an
# empty tag so that text on both sides stays two separate text nodes.
HIDDEN_MARKUP = (r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)"
                 r"|<style\b[^>]*>.*?(?:</style\s*>|\z)")
# An anchor runs from an opening <a ...> to the first </a> after it, or to the end of the page (later <a> starts
# inside are text of the same anchor). As one lazy regex that is quadratic for
# unclosed anchors, so extraction splits on the closing tags instead: in every
# piece, the anchor is the first opening tag to the end. In an opening tag a quote counts only behind "=", and
# a quoted value may hold ">"; possessive quantifiers, and no "<" outside quotes, keep the match linear.
ANCHOR_CLOSE = r"(?i)</a\s*>"
ANCHOR_OPEN = r"""<a(?:[\s/][^<>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^<>=]*+)*+)?>"""
ANCHOR_FROM_OPEN = "(?is)(" + ANCHOR_OPEN + ".*)$"
ANCHOR_HREF = (r"""(?is)^<a(?:[^<>=]*?=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)?)*?[^<>=]*?"""
               r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
OPEN_INNER = "(?is)^" + ANCHOR_OPEN + "(.*)$"
# a tag inside an anchor: quotes behind "=" may hold ">"
TAG = r"""<[a-zA-Z/!?](?:[^<>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^<>=]*+)*+)?>"""


def career_slug_pattern(marker: str = V.JOB_PATH_MARKER) -> str:
    # ASCII slug: starts and ends with a letter or digit, may hold '_' and '-'
    return r"(?iu)/" + marker + r"/([a-z0-9](?:[a-z0-9_-]*[a-z0-9])?)/?"


def anchor_text(inner_html: Column) -> Column:
    """Visible text of an anchor: text nodes decoded, stripped, joined by one space."""
    pieces = F.transform(F.split(inner_html, TAG, -1), lambda p: unicode_strip(html_unescape(p)))
    return F.array_join(F.filter(pieces, lambda p: p != ""), " ")


def _anchor_href(a: Column) -> Column:
    quoted = [F.regexp_extract(a, ANCHOR_HREF, i) for i in (1, 2, 3)]
    has_href = F.regexp_like(a, F.lit(ANCHOR_HREF))
    raw = F.when(quoted[0] != "", quoted[0]).when(quoted[1] != "", quoted[1]).otherwise(quoted[2])
    return F.when(has_href, unicode_strip(html_unescape(raw)))


def anchor_spans(visible_html: Column) -> Column:
    """array<string>: every anchor as its opening tag plus inner HTML (no closing tag),
    in document order; linear in the page length."""
    pieces = F.split(visible_html, ANCHOR_CLOSE, -1)
    opened = F.transform(pieces, lambda p: F.regexp_extract(p, ANCHOR_FROM_OPEN, 1))
    return F.filter(opened, lambda a: a != "")


def nonblank(html: Column) -> Column:
    """FLT-1: page text is not null, empty or only white space."""
    return F.coalesce(F.regexp_like(html, F.lit(r"(?U)\S")), F.lit(False))


def _pieces(visible_html: Column) -> Column:
    return F.split(visible_html, ANCHOR_CLOSE, -1)


def with_anchors(pages: DataFrame, html: str, most_texts: int | None = None) -> DataFrame:
    """Adds ``_anchors``: array<struct<pos, href, inner, lo, hi>> of the page's anchors in document order, and ``_texts``: the text nodes of a
    page that was parsed; the text of an anchor is nodes [lo, hi) there, else still in ``inner``."""
    raw = F.coalesce(F.col(html), F.lit(""))
    df = pages.withColumn("_visible", F.regexp_replace(raw, HIDDEN_MARKUP, "<!>"))
    df = df.withColumn("_spans", anchor_spans(F.col("_visible")))
    df = df.withColumn("_parsed", parsed_anchors(F.when(needs_parser(F.col("_visible"), F.col("_spans"), _pieces(F.col("_visible"))), raw), most_texts))
    read = F.transform(F.col("_spans"), lambda a, i: F.struct(
        i.alias("pos"), _anchor_href(a).alias("href"), F.regexp_extract(a, OPEN_INNER, 1).alias("inner"),
        F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi")))
    parsed = F.transform(F.col("_parsed.anchors"), lambda a, i: F.struct(
        i.alias("pos"), a["href"].alias("href"), F.lit("").alias("inner"), a["lo"].alias("lo"), a["hi"].alias("hi")))
    return df.withColumn("_anchors", F.when(F.col("_parsed").isNotNull(), parsed).otherwise(read)) \
        .withColumn("_texts", F.col("_parsed.texts")).drop("_visible", "_spans", "_parsed")


def _text_of(inner: Column, lo: Column, hi: Column) -> Column:
    nodes = F.slice(F.col("_texts"), lo + 1, hi - lo)
    return F.when(lo.isNotNull(), F.array_join(nodes, " ")).otherwise(anchor_text(inner))


def _candidate_columns(marker: str, keep_all: bool) -> dict:
    """The per-page arrays as Columns over ``_html``, ``_anchors`` and ``_base_parts`` (built once)."""
    html = F.coalesce(F.col("_html"), F.lit(""))
    base = F.col("_base_parts")  # split_url(origin + "/"), parsed once per page
    anchor_links = F.filter(F.col("_anchors"), lambda x: x["href"].isNotNull() & is_job_href(x["href"], marker))
    job_links = F.filter(F.transform(F.col("anchor_links"), lambda x: F.struct(
        x["pos"].alias("pos"), x["href"].alias("href"), x["inner"].alias("inner"), x["lo"].alias("lo"), x["hi"].alias("hi"),
        job_slug(x["href"], marker).alias("slug"),
        canonical_join(base, x["href"], keep_all).alias("url"))),
        lambda x: x["slug"].isNotNull() & x["url"].isNotNull())
    raw_slugs = F.regexp_extract_all(html, F.lit(career_slug_pattern(marker)), F.lit(1))
    slugs = F.filter(raw_slugs, lambda s: ~F.lower(s).isin(*V.NOT_A_SLUG))
    slug_links = F.transform(F.col("slugs"), lambda s, i: F.struct(
        i.alias("pos"), s.alias("slug"),
        canonical_join(base, F.concat(F.lit(marker + "/"), s, F.lit("/"))).alias("url")))
    return {"anchor_links": anchor_links, "job_links": job_links, "slugs": slugs, "slug_links": slug_links}


def page_candidates(pages: DataFrame, html: str = "html", origin: str | Column | None = None,
                    url: str = "url", marker: str = V.JOB_PATH_MARKER, title_max_chars: int = V.TITLE_MAX_CHARS,
                    keep_all_query_params: bool = False) -> DataFrame:
    """Adds per-page arrays: ``anchor_links`` (candidates after FLT-2), ``job_links``
    (after FLT-3/FLT-4, with key and canonical URL), ``slugs`` and ``slug_links``.

    ``origin`` defaults to the origin of the page's own URL.
    """
    origin_col = (site_origin(F.col(url)) if origin is None
                  else (F.col(origin) if isinstance(origin, str) else origin))
    cols = built_once(("page_candidates", marker, keep_all_query_params), lambda: _candidate_columns(marker, keep_all_query_params))
    base = F.concat(F.regexp_replace(origin_col, "/+$", ""), F.lit("/"))
    df = spread(pages).withColumn("_html", F.col(html)).withColumn("_base_parts", split_url(base))
    # a title keeps title_max_chars characters: more text nodes than that, each a character at least, cannot matter
    df = with_anchors(df, "_html", max(1, title_max_chars) + 64)
    for name in ("anchor_links", "job_links", "slugs", "slug_links"):
        df = df.withColumn(name, cols[name])
    return df.drop("_html", "_anchors", "_base_parts")


def unique_slugs(slugs: Column) -> Column:
    """First occurrence of every slug compared case-insensitively (AGG-3):
    array<struct<pos, slug>> in document order."""
    keyed = F.array_sort(F.transform(slugs, lambda s, i: F.struct(F.lower(s).alias("key"), i.alias("pos"),
                                                                   s.alias("slug"))))
    firsts = let(keyed, lambda k: F.filter(k, lambda x, i: F.when(i == 0, F.lit(True)).otherwise(
        k[i - 1]["key"] != x["key"])))
    return F.array_sort(F.transform(firsts, lambda x: F.struct(x["pos"].alias("pos"), x["slug"].alias("slug"))))


def _first_per_key(col: str) -> Column:
    return F.filter(F.col(col), lambda x, i: F.when(i == 0, F.lit(True)).otherwise(
        F.col(col)[i - 1]["key"] != x["key"]))


def _row_columns(title_max_chars: int) -> dict:
    anchor_c = F.transform(F.col("job_links"), lambda x: F.struct(
        F.lower(x["url"]).alias("key"), F.lit(0).alias("phase"), x["pos"].alias("pos"),
        x["url"].alias("url"), x["inner"].alias("text"), x["lo"].alias("lo"), x["hi"].alias("hi")))
    slug_c = F.transform(F.col("slug_links"), lambda x: F.struct(
        F.lower(x["url"]).alias("key"), F.lit(1).alias("phase"), x["pos"].alias("pos"),
        x["url"].alias("url"), x["slug"].alias("text"), F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi")))
    by_key = F.array_sort(F.concat(anchor_c, F.filter(slug_c, lambda x: x["url"].isNotNull())))
    firsts = F.transform(_first_per_key("_by_key"), lambda x: F.struct(
        x["phase"].alias("phase"), x["pos"].alias("pos"), x["url"].alias("job_url"), x["text"].alias("text"), x["lo"].alias("lo"), x["hi"].alias("hi")))
    titled = F.transform(F.array_sort(firsts), lambda x: F.struct(
        x["phase"].alias("phase"), x["pos"].alias("pos"),
        F.when(x["phase"] == 0, normalize_title(_text_of(x["text"], x["lo"], x["hi"]), title_max_chars))
        .otherwise(title_from_slug(x["text"])).alias("position_title"),
        x["job_url"].alias("job_url")))
    return {"by_key": by_key, "titled": titled}


def extract_pages(pages: DataFrame, html: str = "html", origin: str | Column | None = None,
                  url: str = "url", marker: str = V.JOB_PATH_MARKER,
                  title_max_chars: int = V.TITLE_MAX_CHARS, include_slugs: bool = True, keep_all_query_params: bool = False) -> DataFrame:
    """Per page: the ordered job rows (``rows``: phase, pos, position_title, job_url)
    plus the arrays behind the counters of AGG-6. Blank pages give no rows (FLT-1).
    ``include_slugs=False`` gives the anchor rows alone (AGG-2)."""
    df = page_candidates(pages.filter(nonblank(F.col(html))), html, origin, url, marker, title_max_chars, keep_all_query_params)
    if not include_slugs:
        df = df.withColumn("slug_links", F.array().cast(df.schema["slug_links"].dataType))
    cols = built_once(("extract_rows", title_max_chars), lambda: _row_columns(title_max_chars))
    df = df.withColumn("_by_key", cols["by_key"])
    titled = cols["titled"]
    df = df.withColumn("rows", F.filter(titled, lambda r: r["position_title"] != ""))
    return df.drop("_by_key", "_texts")


def extract_jobs(pages: DataFrame, keep: list[str] | tuple = ("page_id",), **kw) -> DataFrame:
    """Job rows of every page in page then document order (SET-3):
    ``keep..., phase, pos, position_title, job_url``; ``phase`` 0 = anchor, 1 = slug scan."""
    df = extract_pages(pages, **kw)
    return df.select(*keep, F.inline("rows"))


def extract_titles(pages: DataFrame, keep: list[str] | tuple = ("page_id",), **kw) -> DataFrame:
    """Titles alone, one for each job of a page in the order they are found: ``keep..., nth, position_title``."""
    df = extract_pages(pages, **kw)
    return df.select(*keep, F.posexplode(F.transform("rows", lambda r: r["position_title"])).alias("nth", "position_title"))


def extract_metrics(pages: DataFrame, html: str = "html", keep: list[str] | tuple = ("page_id",),
                    **kw) -> DataFrame:
    """Per-page extraction counters (AGG-6) and the short-page warning flag."""
    df = extract_pages(pages, html=html, **kw)
    rows = F.col("rows")
    from_anchors = F.size(F.filter(rows, lambda r: r["phase"] == 0))
    return df.select(
        *keep,
        F.length(F.col(html)).alias("html_chars"),
        F.size(F.array_distinct(F.transform(F.col("slugs"), F.lower))).alias("unique_slugs"),
        F.size("anchor_links").alias("anchor_candidates"),
        from_anchors.alias("rows_from_anchors"),
        F.size(rows).alias("total_rows"),
        ((F.length(F.col(html)) < V.SHORT_PAGE_CHARS) & (F.size(rows) < V.SHORT_PAGE_ROWS)).alias("short_page"),
    )


def page_anchors(pages: DataFrame, html: str = "html", keep: list[str] | tuple = ("page_id", "url")) -> DataFrame:
    """Every anchor outside comments/scripts/styles as a row:
    ``keep..., pos, href (decoded, stripped; null without href), text``."""
    rows = with_anchors(spread(pages), html).select(*keep, "_texts", F.explode("_anchors").alias("_a"))
    return rows.select(*keep, F.col("_a.pos").alias("pos"), F.col("_a.href").alias("href"),
                       _text_of(F.col("_a.inner"), F.col("_a.lo"), F.col("_a.hi")).alias("text"))
