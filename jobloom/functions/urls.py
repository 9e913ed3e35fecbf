"""URL cleaning as Column expressions: split, canonical form, origin, join, slug.

Parsing follows the generic split of RFC 3986 with the rules of Python's
``urllib.parse`` (scheme = letter then letters/digits/``+-.``; ``//`` starts the
authority; ``;params`` of the last path segment; tab/CR/LF removed). ``parse_url``
is not used: under ANSI mode it raises on inputs such as spaces that browsers and
Python accept. Invalid URLs give null instead of raising, so a caller filters or
falls back per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions import vocab as V
from jobloom.functions.common import let
from jobloom.functions.text import unicode_strip

_SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _part(u: Column, i: int) -> Column:
    return F.regexp_extract(u, _SPLIT, i)


def split_url(url) -> Column:
    """struct<scheme, has_netloc, netloc, path, query, fragment> of a URL string.

    ``scheme`` is lower-cased; ``has_netloc`` distinguishes ``//`` with an empty
    authority from no authority; a URL that is ``//host...`` gets scheme ``https``.
    """
    u = F.regexp_replace(unicode_strip(_col(url)), r"[\t\r\n]", "")
    u = let(u, lambda v: F.when(v.startswith("//"), F.concat(F.lit("https:"), v)).otherwise(v))
    return let(u, lambda v: F.struct(
        F.lower(_part(v, 1)).alias("scheme"),
        F.regexp_replace(v, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "").startswith("//").alias("has_netloc"),
        _part(v, 2).alias("netloc"),
        _drop_params(_part(v, 3)).alias("path"),
        _part(v, 4).alias("query"),
        _part(v, 5).alias("fragment"),
        _part(v, 3).alias("raw_path"),
    ))


def _drop_params(path: Column) -> Column:
    # ``;params`` of the last segment are not part of the path
    return F.regexp_replace(path, ";[^/]*$", "")


def _netloc_ok(netloc: Column) -> Column:
    opened, closed = netloc.contains("["), netloc.contains("]")
    balanced = (opened & closed) | (~opened & ~closed)
    bracket_ok = ~opened | F.regexp_like(
        netloc, F.lit(r"\[(?:[0-9A-Fa-f:.]+|[vV][0-9A-Fa-f]+\.[^\]]+)\]"))
    return balanced & bracket_ok


def _decode_component(s: Column) -> Column:
    # '+' is a space; a '%' that begins no escape stands for itself, bytes that are no UTF-8 for U+FFFD
    whole = F.regexp_replace(s, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.make_valid_utf8(F.url_decode(whole))


def _encode_component(s: Column) -> Column:
    # form encoding with '~' kept and '*' escaped
    return F.replace(F.replace(F.url_encode(s), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def strip_tracking(query, keep_all: bool = False) -> Column:
    """Drop ``utm_*``, ``fbclid``, ``gclid``, ``_ga``, ``mc_eid`` from a query (URL-2).

    Pairs are decoded, filtered on the lower-cased key, sorted by (key, value) and
    re-encoded; blank values are kept. ``keep_all`` returns the query unchanged.
    """
    q = F.coalesce(_col(query), F.lit(""))
    if keep_all:
        return q
    tokens = F.filter(F.split(q, "&"), lambda t: t != "")
    pairs = F.transform(tokens, lambda t: F.struct(
        _decode_component(F.substring_index(t, "=", 1)).alias("k"),
        _decode_component(F.when(F.instr(t, "=") > 0, F.substr(t, F.instr(t, "=") + 1))
                          .otherwise(F.lit(""))).alias("v")))

    def tracked(p):
        kl = F.lower(p["k"])
        cond = kl.isin(*V.TRACKING_QUERY_KEYS)
        for prefix in V.TRACKING_QUERY_PREFIXES:
            cond = cond | kl.startswith(prefix)
        return cond

    kept = F.array_sort(F.filter(pairs, lambda p: ~tracked(p)))
    encoded = F.transform(kept, lambda p: F.concat(_encode_component(p["k"]), F.lit("="),
                                                   _encode_component(p["v"])))
    return F.array_join(encoded, "&")


def _scheme(p: Column) -> Column:
    return F.when(p["scheme"] == "", F.lit("https")).otherwise(p["scheme"])


def _canonical_from_parts(scheme: Column, netloc: Column, path: Column, query: Column, ok: Column,
                          keep_all_query_params: bool = False) -> Column:
    """Canonical URL from parsed parts (path without params); null unless ``ok`` and http(s)
    with a host."""
    path = F.when(path == "", F.lit("/")).when(
        (path != "/") & path.endswith("/"), F.regexp_replace(path, "/+$", "")).otherwise(path)
    valid = ok & (netloc != "") & scheme.isin("http", "https") & _netloc_ok(netloc)
    tail = F.when(query == "", F.lit("")).otherwise(
        let(strip_tracking(query, keep_all_query_params),
            lambda qs: F.when(qs != "", F.concat(F.lit("?"), qs)).otherwise(F.lit(""))))
    return F.when(valid, F.concat(scheme, F.lit("://"), F.lower(netloc), path, tail))


def _not_special(raw: Column) -> Column:
    lowered = F.lower(raw)
    bad = F.lit(False)
    for prefix in V.NON_HTTP_PREFIXES:
        bad = bad | lowered.startswith(prefix)
    return (raw != "") & ~bad


def canonical_url(url, keep_all_query_params: bool = False) -> Column:
    """Stable job URL for dedupe (URL-1), null when not an http(s) URL with a host.

    Scheme and host lower-cased (port and user info kept), path case kept,
    ``;params`` and fragment dropped, trailing slashes removed except for ``/``,
    empty path -> ``/``, tracking query keys removed. Compare URLs with
    ``lower(canonical_url(u))``; store the canonical form as is.
    """
    def body(raw: Column) -> Column:
        return let(split_url(raw), lambda p: _canonical_from_parts(
            _scheme(p), p["netloc"], p["path"], p["query"], _not_special(raw) & p["has_netloc"],
            keep_all_query_params))
    return let(unicode_strip(F.coalesce(_col(url), F.lit(""))), body)


def canonical_join(base_parts: Column, href, keep_all_query_params: bool = False) -> Column:
    """``canonical_url(resolve_href(base, href))`` computed from the parts of the base
    (``split_url(base)``, parsed once per page) and of the link, without building and
    re-parsing the joined URL string."""
    def body(x: Column) -> Column:
        h, hp, bp = x["h"], x["hp"], base_parts
        h_has_scheme = F.regexp_like(h, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:"))
        scheme = F.when(h_has_scheme, hp["scheme"]).otherwise(bp["scheme"])
        h_params = F.regexp_like(hp["raw_path"], F.lit(";[^/]*$"))
        base_segs = let(F.split(bp["path"], "/", -1), lambda bs: F.when(
            F.try_element_at(bs, F.lit(-1)) != "", F.slice(bs, 1, F.size(bs) - 1)).otherwise(bs))
        rel = let(F.concat(base_segs, F.split(hp["path"], "/", -1)), lambda r: F.when(
            F.size(r) > 2,
            F.concat(F.slice(r, 1, 1), F.filter(F.slice(r, 2, F.size(r) - 2), lambda s: s != ""),
                     F.slice(r, -1, 1))).otherwise(r))
        segs = F.when(hp["path"].startswith("/"), F.split(hp["path"], "/", -1)).otherwise(rel)
        joined = F.array_join(_resolve_dots(segs), "/")
        return (
            F.when(h == "", _canonical_from_parts(_scheme(bp), bp["netloc"], bp["path"], bp["query"],
                                                  bp["has_netloc"], keep_all_query_params))
            .when(scheme != bp["scheme"], _canonical_from_parts(_scheme(hp), hp["netloc"], hp["path"], hp["query"],
                                                                _not_special(h) & hp["has_netloc"],
                                                                keep_all_query_params))
            .when(hp["has_netloc"] & (hp["netloc"] != ""),
                  _canonical_from_parts(scheme, hp["netloc"], hp["path"], hp["query"], F.lit(True),
                                        keep_all_query_params))
            .when((hp["path"] == "") & ~h_params,
                  _canonical_from_parts(scheme, bp["netloc"], bp["path"],
                                        F.when(hp["query"] != "", hp["query"]).otherwise(bp["query"]),
                                        F.lit(True), keep_all_query_params))
            .otherwise(let(joined, lambda j: _canonical_from_parts(
                scheme, bp["netloc"],
                F.when(j == "", F.lit("/")).when(~j.startswith("/"), F.concat(F.lit("/"), j)).otherwise(j),
                hp["query"], F.lit(True), keep_all_query_params))))
    h0 = unicode_strip(F.coalesce(_col(href), F.lit("")))
    return let(h0, lambda h: let(F.struct(h.alias("h"), split_url(h).alias("hp")), body))


def site_origin(url) -> Column:
    """``scheme://host`` lower-cased (URL-3); null without host or for non-http(s)."""
    def body(p: Column) -> Column:
        scheme = _scheme(p)
        valid = p["has_netloc"] & (p["netloc"] != "") & scheme.isin("http", "https")
        return F.when(valid, F.concat(scheme, F.lit("://"), F.lower(p["netloc"])))
    return let(split_url(_col(url)), body)


def listing_url_ok(url) -> Column:
    """True when the listing URL has a host and an http(s) (or no) scheme (URL-6)."""
    return F.coalesce(site_origin(url).isNotNull(), F.lit(False))


def _resolve_dots(segments: Column) -> Column:
    resolved = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1))
                              .otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)))
    tail_dot = F.try_element_at(segments, F.lit(-1)).isin(".", "..")
    return F.when(tail_dot, F.array_append(resolved, F.lit(""))).otherwise(resolved)


def _unparse(sch, netloc, path, query, fragment, params=None) -> Column:
    if params is not None:
        path = F.when(params != "", F.concat(path, F.lit(";"), params)).otherwise(path)
    return let(path, lambda pth: F.concat(
        sch, F.lit("://"), netloc,
        F.when((pth != "") & ~pth.startswith("/"), F.concat(F.lit("/"), pth)).otherwise(pth),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit(""))))


def resolve_href(base, href) -> Column:
    """Join a link to its base URL the way ``urljoin`` does (URL-4).

    The base is the site origin plus ``/``, so relative paths resolve against the
    root; ``//host`` links keep their host, links with another scheme are kept.
    """
    h0 = unicode_strip(F.coalesce(_col(href), F.lit("")))
    pair = F.struct(_col(base).alias("b"), h0.alias("h"))

    def body(x: Column) -> Column:
        def with_parts(y: Column) -> Column:
            b, h, bp, hp = x["b"], x["h"], y["bp"], y["hp"]
            h_has_scheme = F.regexp_like(h, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:"))
            scheme = F.when(h_has_scheme, hp["scheme"]).otherwise(bp["scheme"])
            h_params = F.when(F.regexp_like(hp["raw_path"], F.lit(";[^/]*$")),
                              F.regexp_extract(hp["raw_path"], ";([^/]*)$", 1)).otherwise(F.lit(""))
            h_path = hp["path"]
            base_segs = let(F.split(bp["path"], "/", -1), lambda bs: F.when(
                F.try_element_at(bs, F.lit(-1)) != "", F.slice(bs, 1, F.size(bs) - 1)).otherwise(bs))
            rel = let(F.concat(base_segs, F.split(h_path, "/", -1)), lambda r: F.when(
                F.size(r) > 2,
                F.concat(F.slice(r, 1, 1), F.filter(F.slice(r, 2, F.size(r) - 2), lambda s: s != ""),
                         F.slice(r, -1, 1))).otherwise(r))
            segs = F.when(h_path.startswith("/"), F.split(h_path, "/", -1)).otherwise(rel)
            joined = let(F.array_join(_resolve_dots(segs), "/"),
                         lambda j: F.when(j == "", F.lit("/")).otherwise(j))
            no_path = (h_path == "") & (h_params == "")
            return (
                F.when(h == "", b)
                .when(scheme != bp["scheme"], h)
                .when(hp["has_netloc"] & (hp["netloc"] != ""),
                      _unparse(scheme, hp["netloc"], h_path, hp["query"], hp["fragment"], h_params))
                .when(no_path, _unparse(scheme, bp["netloc"], bp["path"],
                                        F.when(hp["query"] != "", hp["query"]).otherwise(bp["query"]),
                                        hp["fragment"]))
                .otherwise(_unparse(scheme, bp["netloc"], joined, hp["query"], hp["fragment"], h_params)))
        return let(F.struct(split_url(x["b"]).alias("bp"), split_url(x["h"]).alias("hp")), with_parts)
    return let(pair, body)


def job_slug(href, marker: str = V.JOB_PATH_MARKER) -> Column:
    """Path segment after the first segment equal to ``career`` (URL-5), else null.

    Query and fragment are ignored; ``career``/``careers`` are not slugs.
    """
    path = F.regexp_extract(F.coalesce(_col(href), F.lit("")), r"^([^#?]*)", 1)
    parts = F.filter(F.split(path, "/", -1), lambda p: p != "")

    def body(ps: Column) -> Column:
        idx = F.array_position(F.transform(ps, F.lower), F.lit(marker.lower()))
        slug = let(idx, lambda i: F.when((i > 0) & (i < F.size(ps)), F.try_element_at(ps, (i + 1).cast("int"))))
        return let(slug, lambda sl: F.when(~F.lower(sl).isin(*V.NOT_A_SLUG), sl))
    return let(parts, body)


def is_job_href(href, marker: str = V.JOB_PATH_MARKER) -> Column:
    """Link that may point at one job page (FLT-2)."""
    def body(h: Column) -> Column:
        bad = h == ""
        for prefix in V.NON_HTTP_PREFIXES + ("#",):
            bad = bad | h.startswith(prefix)
        good = h.contains(f"/{marker}/") | (h.startswith(f"{marker}/") & ~h.startswith(f"{marker}s/"))
        return ~bad & good
    return let(F.lower(unicode_strip(F.coalesce(_col(href), F.lit("")))), body)
