"""DuckDB SQL that recomputes every registered query independently.

The patterns come from the same rule vocabulary as the Spark code, rendered for
RE2 (``rule_patterns("re2")``). Deliberate differences from the Spark side:

* RE2's ``\\b``, ``\\w``, ``\\d`` are ASCII while the word-scoring rules treat
  letters of every script as word characters. All non-ASCII characters in the
  test texts are letters, so the oracle maps them to ``x`` before those rules.
* DuckDB has no full case folding; ``lower`` plus ``ß -> ss`` covers the
  alphabet of the test tables.
* No entity decoding: the anchors of the test pages hold no ``&``.
"""

from __future__ import annotations

from jobloom.functions import vocab as V
from jobloom.functions.scoring import rule_patterns
from jobloom.operators import extract as EX
from jobloom.plans.fixtures import EXTRAS, LEVELS, MESSAGE_PARTITIONS, MESSAGE_ROWS, MESSAGE_TOPIC, ROLES

P = rule_patterns("re2")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def ascii_letters(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x00-\\x7F]', 'x', 'g')"


def first_match(text: str, rules, default) -> str:
    lit = q if isinstance(default, str) else str
    arms = " ".join(f"WHEN regexp_matches({text}, {q(p)}) THEN {lit(v)}" for v, p in rules)
    return f"CASE {arms} ELSE {lit(default)} END"


def job_title(key: str) -> str:
    return (f"trim({lst(LEVELS)}[{key} % {len(LEVELS)} + 1] || ' ' || "
            f"{lst(ROLES)}[{key} % {len(ROLES)} + 1])")


JOBS = (f"SELECT p_partkey AS \"Index\", {job_title('p_partkey')} AS \"Position title\", "
        f"{lst(EXTRAS)}[p_partkey % {len(EXTRAS)} + 1] AS job_description FROM part")
DOC_JOBS = (f"SELECT doc_id AS \"Index\", {job_title('doc_id')} AS \"Position title\", "
            f"text AS job_description FROM documents")


# ------------------------------------------------------------------ enrichment
def scored(source_sql: str, with_description: bool, keep: str = "") -> str:
    """SELECT of keep, Index, Position title, the four signals, score, category, seniority."""
    title = strip("coalesce(CAST(\"Position title\" AS VARCHAR), 'None')")
    desc = strip("coalesce(CAST(job_description AS VARCHAR), 'None')")
    text = f"{title} || chr(10) || {desc}" if with_description else title
    years_items = ", ".join(
        f"regexp_extract_all(ta, {q(p)}, {g})"
        for p in P["years"] for g in range(1, p.count("(") - p.count("(?") + 1))
    k = f"{keep}, " if keep else ""
    return f"""
    WITH src AS ({source_sql}),
    t AS (SELECT {k}"Index", "Position title", {text} AS t FROM src),
    ta AS (SELECT *, {ascii_letters('t')} AS ta FROM t),
    s1 AS (SELECT *,
        CAST(CASE WHEN t = '' THEN {V.LEADERSHIP_EMPTY_TEXT}
             ELSE {first_match('lower(ta)', P['leadership'], V.LEADERSHIP_DEFAULT)} END AS INTEGER) AS leadership,
        CAST(least(coalesce(list_max(list_transform(flatten([{years_items}]),
             lambda x: TRY_CAST(x AS INTEGER))), 0), {V.YEARS_CAP}) AS INTEGER) AS explicit_years,
        CAST(len(list_distinct(list_transform(regexp_extract_all(ta, {q(P['skills'])}, 0),
             lambda x: lower(x)))) AS INTEGER) AS skills
      FROM ta),
    s2 AS (SELECT *,
        CAST(CASE WHEN t = '' OR explicit_years > 0 THEN 0
             ELSE {first_match('lower(ta)', P['inferred'], V.INFERRED_YEARS_DEFAULT)} END AS INTEGER) AS inferred_years
      FROM s1)
    SELECT {k}"Index", "Position title", leadership, explicit_years, inferred_years, skills,
        CAST(least({V.SCORE_CAP}, leadership + least(greatest(explicit_years, inferred_years) * {V.YEARS_WEIGHT},
             {V.YEARS_POINTS_CAP}) + least(skills * {V.SKILL_WEIGHT}, {V.SKILL_POINTS_CAP})) AS INTEGER)
             AS complexity_score,
        {first_match('lower(t)', P['category'], V.CATEGORY_DEFAULT)} AS category,
        {first_match('lower(t)', P['seniority'], V.SENIORITY_DEFAULT)} AS seniority_level
    FROM s2"""


ENRICHED = 'SELECT "Index", "Position title", complexity_score, category, seniority_level FROM ({})'

# ------------------------------------------------------------------ URLs and text
SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
NONPRINT = (r"[\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}\x{7F}-\x{9F}\p{Cf}\p{Co}\p{Cs}\p{Zl}\p{Zp}"
            r"\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]")
CAREER = "SELECT page_id, url, replace(html, 'href=\"/', 'href=\"/career/') AS html FROM pages"


def url_parts(inner: str, url: str, p: str) -> str:
    """Adds {p}raw, {p}scheme, {p}netloc, {p}path (params dropped), {p}path0, {p}query,
    {p}fragment, {p}has_netloc to the rows of ``inner``."""
    raw = strip(f"coalesce({url}, '')")
    sp = q(SPLIT)
    return f"""(SELECT *, CASE WHEN {p}s0 = '' THEN 'https' ELSE {p}s0 END AS {p}scheme,
                regexp_replace({p}path0, ';[^/]*$', '') AS {p}path
       FROM (SELECT *, lower(regexp_extract({p}u, {sp}, 1)) AS {p}s0,
                    regexp_extract({p}u, {sp}, 2) AS {p}netloc,
                    regexp_extract({p}u, {sp}, 3) AS {p}path0,
                    regexp_extract({p}u, {sp}, 4) AS {p}query,
                    regexp_extract({p}u, {sp}, 5) AS {p}fragment,
                    starts_with(regexp_replace({p}u, {q(SCHEME)}, ''), '//') AS {p}has_netloc
             FROM (SELECT *, CASE WHEN starts_with({p}c, '//') THEN 'https:' || {p}c ELSE {p}c END AS {p}u
                   FROM (SELECT *, {raw} AS {p}raw,
                                regexp_replace({raw}, '[\\t\\r\\n]', '', 'g') AS {p}c FROM {inner}))))"""


def strip_tracking_sql(query: str) -> str:
    def dec(x):
        return f"url_decode(replace({x}, '+', ' '))"

    def enc(x):
        return f"replace(url_encode({x}), '%20', '+')"

    keys = ", ".join(q(k) for k in V.TRACKING_QUERY_KEYS)
    prefixes = " OR ".join(f"starts_with(lower(kv.k), {q(x)})" for x in V.TRACKING_QUERY_PREFIXES)
    value = "CASE WHEN instr(t, '=') > 0 THEN substr(t, instr(t, '=') + 1) ELSE '' END"
    name = "split_part(t, '=', 1)"
    pairs = (f"list_transform(list_filter(string_split(coalesce({query}, ''), '&'), lambda t: t <> ''), "
             f"lambda t: {{'k': {dec(name)}, 'v': {dec(value)}}})")
    kept = f"list_filter({pairs}, lambda kv: NOT (lower(kv.k) IN ({keys}) OR {prefixes}))"
    return (f"array_to_string(list_transform(list_sort({kept}), "
            f"lambda kv: {enc('kv.k')} || '=' || {enc('kv.v')}), '&')")


def canonical_sql(inner: str, url: str, keep: str, p: str = "_c_", out: str = "canonical_url") -> str:
    bad = " OR ".join(f"starts_with(lower({p}raw), {q(x)})" for x in V.NON_HTTP_PREFIXES)
    bracket = r"[[](?:[0-9A-Fa-f:.]+|[vV][0-9A-Fa-f]+[.][^]]+)[]]"
    netloc_ok = (f"((NOT contains({p}netloc, '[') AND NOT contains({p}netloc, ']')) OR "
                 f"(contains({p}netloc, '[') AND contains({p}netloc, ']') AND "
                 f"regexp_matches({p}netloc, {q(bracket)})))")
    return f"""SELECT {keep}, CASE WHEN {p}raw <> '' AND NOT ({bad}) AND {p}has_netloc AND {p}netloc <> ''
                 AND {p}scheme IN ('http', 'https') AND {netloc_ok}
            THEN {p}scheme || '://' || lower({p}netloc) || {p}path2
                 || CASE WHEN {p}q2 <> '' THEN '?' || {p}q2 ELSE '' END END AS {out}
    FROM (SELECT *, CASE WHEN {p}path = '' THEN '/'
                         WHEN {p}path <> '/' AND ends_with({p}path, '/') THEN regexp_replace({p}path, '/+$', '')
                         ELSE {p}path END AS {p}path2,
                 {strip_tracking_sql(p + 'query')} AS {p}q2
          FROM {url_parts(inner, url, p)})"""


def origin_expr(p: str) -> str:
    return (f"CASE WHEN {p}has_netloc AND {p}netloc <> '' AND {p}scheme IN ('http', 'https') "
            f"THEN {p}scheme || '://' || lower({p}netloc) END")


# written out for this dialect: an opening tag with quoted values, the anchor up to its end, its inner text, its href
A_OPEN = r"""<a(?:[\s/][^<>=]*(?:=\s*(?:"[^"]*"|'[^']*')?[^<>=]*)*)?>"""
TAG = r"""<[a-zA-Z/!?](?:[^<>=]*(?:=\s*(?:"[^"]*"|'[^']*')?[^<>=]*)*)?>"""
A_WHOLE = "(?is)" + A_OPEN + r".*?(?:</a\s*>|\z)"
A_INNER = "(?is)^" + A_OPEN + r"(.*?)(?:</a\s*>)?\z"
A_HREF = (r"""(?is)^<a(?:[^<>=]*?=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)?)*?[^<>=]*?"""
          r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def anchors_sql(pages_sql: str, extra: str = "") -> str:
    hr = q(A_HREF)
    pick = (f"CASE WHEN regexp_extract(a, {hr}, 1) <> '' THEN regexp_extract(a, {hr}, 1) "
            f"WHEN regexp_extract(a, {hr}, 2) <> '' THEN regexp_extract(a, {hr}, 2) "
            f"ELSE regexp_extract(a, {hr}, 3) END")
    href = f"CASE WHEN regexp_matches(a, {hr}) THEN {strip(pick)} END"
    text = (f"array_to_string(list_filter(list_transform(regexp_split_to_array("
            f"regexp_extract(a, {q(A_INNER)}, 1), {q(TAG)}), lambda x: {strip('x')}), "
            f"lambda x: x <> ''), ' ')")
    ex = f"{extra}, " if extra else ""
    return f"""(SELECT page_id, url, {ex}pos, {href} AS href, {text} AS text
      FROM (SELECT page_id, url, {ex}unnest(al) AS a, CAST(generate_subscripts(al, 1) - 1 AS INTEGER) AS pos
            FROM (SELECT page_id, url, {ex}regexp_extract_all(regexp_replace(coalesce(html, ''),
                      {q(EX.HIDDEN_MARKUP)}, '<!>', 'g'), {q(A_WHOLE)}, 0) AS al FROM ({pages_sql}))))"""


def is_job_href_sql(href: str) -> str:
    h = "lower(" + strip(f"coalesce({href}, '')") + ")"
    bad = " OR ".join(f"starts_with({h}, {q(x)})" for x in V.NON_HTTP_PREFIXES + ("#",))
    return (f"(NOT ({h} = '' OR {bad}) AND (contains({h}, '/career/') OR "
            f"(starts_with({h}, 'career/') AND NOT starts_with({h}, 'careers/'))))")


def job_slug_sql(href: str) -> str:
    parts = (f"list_filter(string_split(regexp_extract(coalesce({href}, ''), '^([^#?]*)', 1), '/'), "
             f"lambda x: x <> '')")
    idx = f"list_position(list_transform({parts}, lambda x: lower(x)), 'career')"
    slug = f"CASE WHEN {idx} IS NOT NULL AND {idx} < len({parts}) THEN {parts}[{idx} + 1] END"
    return f"CASE WHEN lower({slug}) NOT IN ('career', 'careers') THEN {slug} END"


def resolve_sql(base: str, href: str, inner: str, keep: str, out: str = "resolved") -> str:
    """urljoin(base, href) for an http(s) base URL."""
    b = url_parts(inner, base, "_b_")
    h = url_parts(b, href, "_h_")
    hp = "_h_path"
    params = ("CASE WHEN regexp_matches(_h_path0, ';[^/]*$') "
              "THEN regexp_extract(_h_path0, ';([^/]*)$', 1) ELSE '' END")
    base_segs = ("CASE WHEN string_split(_b_path, '/')[-1] <> '' THEN string_split(_b_path, '/')[1:-2] "
                 "ELSE string_split(_b_path, '/') END")
    rel = f"list_concat({base_segs}, string_split({hp}, '/'))"
    rel_f = (f"CASE WHEN len({rel}) > 2 THEN list_concat({rel}[1:1], list_filter({rel}[2:-2], lambda x: x <> ''), "
             f"{rel}[-1:]) ELSE {rel} END")
    segs = f"CASE WHEN starts_with({hp}, '/') THEN string_split({hp}, '/') ELSE {rel_f} END"
    dots = (f"list_reduce({segs}, lambda acc, x: CASE WHEN x = '..' THEN acc[1:len(acc) - 1] "
            f"WHEN x = '.' THEN acc ELSE list_append(acc, x) END, []::VARCHAR[])")
    dots = f"CASE WHEN ({segs})[-1] IN ('.', '..') THEN list_append({dots}, '') ELSE {dots} END"
    joined = f"array_to_string({dots}, '/')"

    def unparse(netloc, path, query, frag, par="''"):
        pth = f"(CASE WHEN {par} <> '' THEN {path} || ';' || {par} ELSE {path} END)"
        pth = f"(CASE WHEN {pth} <> '' AND NOT starts_with({pth}, '/') THEN '/' || {pth} ELSE {pth} END)"
        return (f"_sch || '://' || {netloc} || {pth} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END "
                f"|| CASE WHEN {frag} <> '' THEN '#' || {frag} ELSE '' END")

    base_query = "CASE WHEN _h_query <> '' THEN _h_query ELSE _b_query END"
    rel_path = f"CASE WHEN {joined} = '' THEN '/' ELSE {joined} END"
    return f"""SELECT {keep}, CASE
        WHEN _h_raw = '' THEN _b_raw
        WHEN _sch <> _b_scheme THEN _h_raw
        WHEN _h_has_netloc AND _h_netloc <> '' THEN {unparse('_h_netloc', hp, '_h_query', '_h_fragment', '_par')}
        WHEN {hp} = '' AND _par = '' THEN {unparse('_b_netloc', '_b_path', base_query, '_h_fragment')}
        ELSE {unparse('_b_netloc', rel_path, '_h_query', '_h_fragment', '_par')}
      END AS {out}
    FROM (SELECT *, CASE WHEN regexp_matches(_h_raw, {q(SCHEME)}) THEN _h_scheme ELSE _b_scheme END AS _sch,
                 {params} AS _par FROM {h})"""


def normalize_sql(x: str) -> str:
    t = f"replace(coalesce({x}, ''), chr(160), ' ')"
    t = f"nfc_normalize(regexp_replace({t}, {q(NONPRINT)}, '', 'g'))"
    t = strip(f"regexp_replace({t}, '\\s+', ' ', 'g')")
    t = strip(f"regexp_replace({t}, {q('(?i)' + V.TITLE_SUFFIX)}, '')")
    return f"rtrim(substr({t}, 1, {V.TITLE_MAX_CHARS}))"


DIRTY = f"""SELECT "Index" AS id, CASE WHEN "Index" % 7 = 0 THEN upper(d) ELSE d END AS title FROM (
    SELECT "Index", '  ' || t2 || chr(160) || ' View Position ' AS d FROM (
      SELECT "Index", CASE WHEN "Index" % 13 = 0 THEN regexp_replace(t1, '^([^ ]*) ', '\\1' || chr(8201))
                      ELSE t1 END AS t2 FROM (
        SELECT "Index", CASE WHEN "Index" % 11 = 0 THEN replace("Position title", ' ', chr(8203) || ' ')
                        ELSE "Position title" END AS t1 FROM ({JOBS}))))"""


def title_case_sql(x: str) -> str:
    t = strip(f"regexp_replace({x}, '[-_]+', ' ', 'g')")
    return (f"array_to_string(list_transform(regexp_extract_all({t}, '[A-Za-z]+|[^A-Za-z]+', 0), "
            f"lambda r: upper(r[1]) || lower(r[2:])), '')")


def casefold_sql(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def safe_sql(x: str, strip_us: bool, limit: int, default: str) -> str:
    s = f"regexp_replace(coalesce({x}, ''), '[^a-zA-Z0-9._-]+', '_', 'g')"
    if strip_us:
        s = f"regexp_replace({s}, '^_+|_+$', '', 'g')"
    s = f"left({s}, {limit})"
    return f"CASE WHEN {s} = '' THEN {q(default)} ELSE {s} END"


def blob_names_sql() -> str:
    ts = ("strftime(epoch_ms(1735689600000 + \"offset\" * 1001), '%Y%m%dT%H%M%S') || "
          "lpad(CAST((\"offset\" * 1001) % 1000 AS VARCHAR), 3, '0') || 'Z'")
    key = safe_sql("'jobs ' || CAST(\"offset\" AS VARCHAR) || '!'", True, V.KEY_NAME_MAX, "message")
    topic = safe_sql(q(MESSAGE_TOPIC), False, V.TOPIC_NAME_MAX, "topic")
    tail = (f"{topic} || '/' || {ts} || '_p' || CAST(\"offset\" % {MESSAGE_PARTITIONS} AS VARCHAR) || '_o' || "
            f"CAST(\"offset\" AS VARCHAR) || '_' || {key}")
    return (f"SELECT \"offset\", {q(V.DEFAULT_BLOB_PREFIX)} || {tail} || '.parquet' AS raw_name, "
            f"'pre/fix/' || {tail} || '_enriched.parquet' AS enriched_name "
            f"FROM (SELECT DISTINCT p_partkey // {MESSAGE_ROWS} AS \"offset\" FROM part)")


# ------------------------------------------------------------------ extraction
SLUG_P = q(EX.career_slug_pattern().replace("(?iu)", "(?i)"))


def pages_with_origin(pages_sql: str) -> str:
    return (f"(SELECT page_id, url, html, origin FROM (SELECT *, {origin_expr('_g_')} AS origin "
            f"FROM {url_parts('(' + pages_sql + ')', 'url', '_g_')}) "
            f"WHERE regexp_matches(coalesce(html, ''), '\\S'))")


def job_links_sql(pages_o: str) -> str:
    cand = f"(SELECT * FROM {anchors_sql(pages_o, 'origin')} WHERE {is_job_href_sql('href')})"
    with_slug = f"(SELECT *, {job_slug_sql('href')} AS slug FROM {cand})"
    resolved = "(" + resolve_sql("origin || '/'", "href", with_slug, "page_id, pos, href, text, slug") + ")"
    canon = "(" + canonical_sql(resolved, "resolved", "page_id, pos, text, slug", p="_k_", out="job_url") + ")"
    return f"(SELECT page_id, pos, text, job_url FROM {canon} WHERE slug IS NOT NULL AND job_url IS NOT NULL)"


def slugs_sql(pages_o: str) -> str:
    raw = (f"(SELECT page_id, origin, unnest(sl) AS slug, generate_subscripts(sl, 1) AS rpos FROM "
           f"(SELECT page_id, origin, regexp_extract_all(coalesce(html, ''), {SLUG_P}, 1) AS sl FROM {pages_o}))")
    return (f"(SELECT page_id, origin, slug, CAST(row_number() OVER (PARTITION BY page_id ORDER BY rpos) - 1 "
            f"AS INTEGER) AS pos FROM {raw} WHERE lower(slug) NOT IN ('career', 'careers'))")


def slug_links_sql(pages_o: str) -> str:
    resolved = "(" + resolve_sql("origin || '/'", "'career/' || slug || '/'", slugs_sql(pages_o),
                                 "page_id, pos, slug") + ")"
    return "(" + canonical_sql(resolved, "resolved", "page_id, pos, slug", p="_k_", out="job_url") + ")"


def extract_sql(pages_sql: str, include_slugs: bool = True) -> str:
    po = pages_with_origin(pages_sql)
    slug_part = (f" UNION ALL SELECT page_id, 1 AS phase, pos, job_url, slug AS text FROM {slug_links_sql(po)} "
                 f"WHERE job_url IS NOT NULL") if include_slugs else ""
    return f"""SELECT page_id, phase, pos, position_title, job_url FROM (
      SELECT page_id, phase, pos,
             CASE WHEN phase = 0 THEN {normalize_sql('text')} ELSE {title_case_sql('text')} END AS position_title,
             job_url
      FROM (SELECT * FROM (SELECT page_id, 0 AS phase, pos, job_url, text FROM {job_links_sql(po)}{slug_part})
            QUALIFY row_number() OVER (PARTITION BY page_id, lower(job_url) ORDER BY phase, pos) = 1))
    WHERE position_title <> ''"""


def metrics_sql(pages_sql: str) -> str:
    po = pages_with_origin(pages_sql)
    cand = f"(SELECT page_id, count(*) AS n FROM {anchors_sql(po, 'origin')} WHERE {is_job_href_sql('href')} GROUP BY page_id)"
    us = f"(SELECT page_id, count(DISTINCT lower(slug)) AS n FROM {slugs_sql(po)} GROUP BY page_id)"
    rows = (f"(SELECT page_id, count(*) FILTER (WHERE phase = 0) AS a, count(*) AS t "
            f"FROM ({extract_sql(pages_sql)}) GROUP BY page_id)")
    return f"""SELECT p.page_id, CAST(length(p.html) AS INTEGER) AS html_chars,
        CAST(coalesce(us.n, 0) AS INTEGER) AS unique_slugs, CAST(coalesce(cand.n, 0) AS INTEGER) AS anchor_candidates,
        CAST(coalesce(r.a, 0) AS INTEGER) AS rows_from_anchors, CAST(coalesce(r.t, 0) AS INTEGER) AS total_rows,
        length(p.html) < {V.SHORT_PAGE_CHARS} AND coalesce(r.t, 0) < {V.SHORT_PAGE_ROWS} AS short_page
      FROM {po} p LEFT JOIN {cand} cand ON cand.page_id = p.page_id LEFT JOIN {us} us ON us.page_id = p.page_id
      LEFT JOIN {rows} r ON r.page_id = p.page_id"""


# ------------------------------------------------------------------ sources, keep-first, order
BATCH_ROWS = 500
BODY_CAP = 8192
RECORDS = f"""SELECT d.id, 'src' || CAST(d.id % 4 AS VARCHAR) AS source, d.title AS position_title,
       CASE WHEN d.id % 5 = 0 THEN NULL WHEN d.id % 17 = 0 THEN 'mailto:x' ELSE p.url END AS job_url
    FROM ({DIRTY}) d LEFT JOIN pages p ON p.page_id = d.id % (SELECT greatest(count(*), 1) FROM pages)"""


def sanitize_sql(inner: str, cols: str, order: str) -> str:
    """One cleaning pass: normalize title, drop empty, first row per record key by ``order``.
    ``cols`` lists the columns of ``inner`` to carry besides position_title and job_url."""
    staged = (f"(SELECT {cols}, {normalize_sql('position_title')} AS _t, coalesce(job_url, '') AS _ju "
              f"FROM ({inner}))")
    canon = canonical_sql(f"(SELECT * FROM {staged} WHERE _t <> '')", "_ju", f"{cols}, _t, _ju",
                          p="_z_", out="_canon")
    src = "coalesce(CAST(source AS VARCHAR), '')"
    key = (f"CASE WHEN _ju = '' THEN 'nourl:' || {src} || ':' || {casefold_sql('_t')} "
           f"WHEN _canon IS NULL THEN lower({strip('_ju')}) || '|' || {src} || '|' || {casefold_sql('_t')} "
           f"ELSE lower(_canon) END")
    return (f"SELECT {cols}, _t AS position_title, _ju AS job_url FROM ({canon}) "
            f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1")


def numbered_sql(inner: str, ties: str) -> str:
    return (f"SELECT *, row_number() OVER (ORDER BY {casefold_sql('position_title')}, position_title, {ties}) "
            f"AS rn FROM ({inner})")


CLEAN = sanitize_sql(sanitize_sql(RECORDS, "id, source", "id"), "id, source", "id")
PAGE_ORIGIN = (f"SELECT page_id, url, html, {origin_expr('_w_')} AS origin "
               f"FROM {url_parts('(' + CAREER + ')', 'url', '_w_')}")
SOURCE_RECORDS = (f"SELECT o.origin AS source, o.origin AS source_order, e.page_id, e.phase, e.pos, "
                  f"e.position_title, e.job_url FROM ({extract_sql(CAREER)}) e "
                  f"JOIN ({PAGE_ORIGIN}) o ON o.page_id = e.page_id")
REC_ORDER = "source_order, page_id, phase, pos"
REC_COLS = "source, source_order, page_id, phase, pos"
PRODUCED = numbered_sql(sanitize_sql(sanitize_sql(SOURCE_RECORDS, REC_COLS, REC_ORDER), REC_COLS, REC_ORDER),
                        "job_url, source")


def listing_urls_sql() -> str:
    parts = (f"list_concat([url], string_split(' ' || url || ' ,, ' || _v_origin || ', ' || url, ','))")
    exploded = (f"SELECT page_id, {strip('v0')} AS v, i FROM (SELECT page_id, unnest(parts) AS v0, "
                f"generate_subscripts(parts, 1) AS i FROM (SELECT page_id, {parts} AS parts FROM "
                f"(SELECT *, {origin_expr('_v_')} AS _v_origin FROM {url_parts('pages', 'url', '_v_')})))")
    firsts = f"SELECT * FROM ({exploded}) WHERE v <> '' QUALIFY row_number() OVER (PARTITION BY page_id, v ORDER BY i) = 1"
    return (f"SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, "
            f"v AS listing_url FROM ({firsts})")


def source_entries_sql() -> str:
    text = strip("'  ' || coalesce(url, '') || chr(9)")
    entries = f"(SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'ftp://old.test/' ELSE {text} END AS u FROM pages)"
    own, quote = origin_expr("_v_"), "chr(39)"
    return (f"SELECT page_id AS pos, CASE WHEN page_id % 3 = 1 THEN 'p' || page_id ELSE own END AS id, u AS url, "
            f"CASE WHEN page_id % 4 = 0 THEN 'https://given.test:81' ELSE own END AS origin, "
            f"CASE WHEN u = '' THEN 'the url is blank' WHEN own IS NULL THEN 'url ' || {quote} || u || {quote} || ' is no http or https address' END AS fault "
            f"FROM (SELECT page_id, u, {own} AS own FROM {url_parts(entries, 'u', '_v_')})")


def group3() -> dict[str, str]:
    return {
        "cap_body_size": (f"SELECT page_id, CAST(strlen(html) AS INTEGER) AS n_bytes, "
                          f"coalesce(strlen(html) <= {BODY_CAP}, true) AS accepted FROM pages"),
        "rejected_pages": f"SELECT page_id, url, CAST(strlen(html) AS INTEGER) AS n_bytes FROM pages WHERE strlen(html) > {BODY_CAP}",
        "failed_sources": (f"SELECT CAST(page_id AS VARCHAR) AS id, url FROM pages WHERE url NOT IN "
                           f"(SELECT url FROM pages WHERE coalesce(strlen(html) <= {BODY_CAP}, true))"),
        "publish_single": (f"SELECT 'open_positions/' || source AS key, row_number() OVER (PARTITION BY source ORDER BY rn) AS \"Index\", "
                           f"position_title AS \"Position title\" FROM ({PRODUCED})"),
        "listing_urls": listing_urls_sql(),
        "source_entries": source_entries_sql(),
        "attach_source": f"SELECT page_id, origin AS source FROM ({PAGE_ORIGIN}) WHERE origin IS NOT NULL",
        "source_records": f"SELECT source, page_id, phase, pos, position_title, job_url FROM ({SOURCE_RECORDS})",
        "run_counts": (f"SELECT source, count(*) AS n FROM ("
                       f"{sanitize_sql(sanitize_sql(SOURCE_RECORDS, REC_COLS, REC_ORDER), REC_COLS, REC_ORDER)}) "
                       f"GROUP BY source"),
        "sanitize_records": f"SELECT id, source, position_title, job_url FROM ({sanitize_sql(RECORDS, 'id, source', 'id')})",
        "dedupe_titles": (f"SELECT row_number() OVER (ORDER BY {casefold_sql('t')}, t) AS \"Index\", "
                          f"t AS \"Position title\" FROM (SELECT * FROM (SELECT id, {normalize_sql('title')} AS t "
                          f"FROM ({DIRTY})) WHERE t <> '' "
                          f"QUALIFY row_number() OVER (PARTITION BY {casefold_sql('t')} ORDER BY id) = 1)"),
        "global_index": f"SELECT rn AS \"Index\", position_title AS \"Position title\" FROM ({numbered_sql(CLEAN, 'job_url, source, id')})",
        "batch_index": (f"SELECT (rn - 1) // {BATCH_ROWS} AS batch_no, (rn - 1) % {BATCH_ROWS} + 1 AS \"Index\", "
                        f"position_title AS \"Position title\" FROM ({numbered_sql(CLEAN, 'job_url, source, id')})"),
        "produce_merged": f"SELECT rn AS \"Index\", position_title AS \"Position title\" FROM ({PRODUCED})",
        "produce_batches": (f"SELECT (rn - 1) // {BATCH_ROWS} AS batch_no, "
                            f"'parquet-batch-' || CAST((rn - 1) // {BATCH_ROWS} AS VARCHAR) AS key, "
                            f"count(*) AS n_rows FROM ({PRODUCED}) GROUP BY 1, 2"),
    }


# ------------------------------------------------------------------ messages, validation
MSG_ROWS = (f"SELECT {q(MESSAGE_TOPIC)} AS topic, CAST((p_partkey // {MESSAGE_ROWS}) % {MESSAGE_PARTITIONS} "
            f"AS INTEGER) AS partition, p_partkey // {MESSAGE_ROWS} AS \"offset\", "
            f"p_partkey % {MESSAGE_ROWS} + 1 AS \"Index\", {job_title('p_partkey')} AS \"Position title\", "
            f"{lst(EXTRAS)}[p_partkey % {len(EXTRAS)} + 1] AS job_description FROM part")
MSG_COORDS = "topic, partition, \"offset\""
LAST = f"(SELECT max(p_partkey) // {MESSAGE_ROWS} FROM part)"
FAULTY = f"""SELECT "Index",
    CASE WHEN "Index" % 10 = 5 THEN "Position title" || ' (edited)' ELSE "Position title" END AS "Position title",
    CAST(CASE WHEN "Index" % 10 = 1 THEN 101 WHEN "Index" % 10 = 2 THEN NULL ELSE complexity_score END AS INTEGER)
      AS complexity_score,
    CASE WHEN "Index" % 10 = 3 THEN 'Legal' WHEN "Index" % 10 = 7 THEN ' ' || category || ' ' ELSE category END AS category,
    CASE WHEN "Index" % 10 = 4 THEN ' ' WHEN "Index" % 10 = 8 THEN ' ' || seniority_level ELSE seniority_level END AS seniority_level
  FROM (SELECT *, unnest(CASE WHEN "Index" % 50 = 0 THEN [1, 2] ELSE [1] END) FROM ({scored(JOBS, True)})) WHERE "Index" % 10 <> 6"""


def violations_sql() -> str:
    txt = lambda x: strip(f"coalesce(CAST({x} AS VARCHAR), 'None')")
    raw = lambda x: f"coalesce(CAST({x} AS VARCHAR), 'None')"
    cats = ", ".join(q(c) for c in V.ALLOWED_CATEGORIES)
    sens = ", ".join(q(c) for c in V.ALLOWED_SENIORITY)
    score = "TRY_CAST(CAST(e.complexity_score AS VARCHAR) AS DOUBLE)"
    both, there = "p.nth IS NOT NULL AND e.nth IS NOT NULL", "e.nth IS NOT NULL"
    checks = [
        (2, "Index", "p.nth IS NULL OR e.nth IS NULL", txt("coalesce(p.\"Index\", e.\"Index\")")),
        (3, "Position title", f"{both} AND {txt('p.\"Position title\"')} <> {txt('e.\"Position title\"')}",
         f"{txt('p.\"Position title\"')} || ' vs ' || {txt('e.\"Position title\"')}"),
        (4, "score missing", f"{there} AND ({score} IS NULL OR isnan({score}))", "CAST(e.complexity_score AS VARCHAR)"),
        (5, "score range", f"NOT isnan({score}) AND ({score} < 0 OR {score} > 100)", "CAST(e.complexity_score AS VARCHAR)"),
        (6, "category blank", f"{there} AND {txt('e.category')} = ''", "''"),
        (7, "category unknown", f"{there} AND {txt('e.category')} <> '' AND {raw('e.category')} NOT IN ({cats})", raw("e.category")),
        (8, "seniority blank", f"{there} AND {txt('e.seniority_level')} = ''", "''"),
        (9, "seniority unknown", f"{there} AND {txt('e.seniority_level')} <> '' AND {raw('e.seniority_level')} NOT IN ({sens})",
         raw("e.seniority_level")),
    ]
    arms = " UNION ALL ".join(
        f"SELECT CAST(coalesce(p.\"Index\", e.\"Index\") AS BIGINT) AS \"Index\", {n} AS rule_no, {q(rule)} AS rule, {v} AS value "
        f"FROM j p FULL OUTER JOIN f e ON p.\"Index\" IS NOT DISTINCT FROM e.\"Index\" AND p.nth = e.nth WHERE {c}"
        for n, rule, c, v in checks)
    nth = f"row_number() OVER (PARTITION BY \"Index\" ORDER BY {txt('\"Position title\"')}) AS nth"
    return f"""WITH j AS (SELECT "Index", "Position title", {nth} FROM ({JOBS})), f AS (SELECT *, {nth} FROM ({FAULTY})),
      n AS (SELECT (SELECT count(*) FROM j) AS np, (SELECT count(*) FROM f) AS ne)
    SELECT CAST(NULL AS BIGINT) AS "Index", 1 AS rule_no, 'row count' AS rule,
           CAST(np AS VARCHAR) || ' vs ' || CAST(ne AS VARCHAR) AS value FROM n WHERE np <> ne
    UNION ALL {arms}"""


def group4() -> dict[str, str]:
    empties = (f"SELECT {q(MESSAGE_TOPIC)} AS topic, 0 AS partition, {LAST} + 1 AS \"offset\" UNION ALL "
               f"SELECT {q(MESSAGE_TOPIC)}, 0, {LAST} + 2")
    enriched = ENRICHED.replace('SELECT "Index"', f'SELECT {MSG_COORDS}, "Index"')
    return {
        "unpack_payloads": f"SELECT {MSG_COORDS}, \"Index\", \"Position title\", job_description FROM ({MSG_ROWS})",
        "payload_row_counts": (f"SELECT {MSG_COORDS}, count(*) AS n_rows FROM ({MSG_ROWS}) GROUP BY ALL "
                               f"UNION ALL SELECT topic, partition, \"offset\", NULL FROM ({empties})"),
        "nonempty_messages": f"SELECT DISTINCT {MSG_COORDS} FROM ({MSG_ROWS})",
        "payload_sizes": ("SELECT page_id, CAST(10 * strlen(html) AS BIGINT) AS n_bytes, 10 * strlen(html) <= 1048576 AS fits, "
                          "10 * strlen(html) <= 1024 AS fits_least FROM pages"),
        "max_messages": (f"SELECT * FROM (SELECT DISTINCT {MSG_COORDS} FROM ({MSG_ROWS})) "
                         f"ORDER BY partition, \"offset\" LIMIT 10"),
        "enrich_payloads": enriched.format(scored(MSG_ROWS, True, keep=MSG_COORDS)),
        "violations": violations_sql(),
        "validation_summary": f"SELECT rule_no, rule, count(*) AS n FROM ({violations_sql()}) GROUP BY ALL",
        "consume_redelivered": f"SELECT DISTINCT {MSG_COORDS}, CAST(1 AS BIGINT) AS copies FROM ({MSG_ROWS})",
        "consume_bounded": (f"SELECT * FROM (SELECT DISTINCT {MSG_COORDS} FROM ({MSG_ROWS})) QUALIFY row_number() OVER (ORDER BY topic, partition, \"offset\") "
                            f"<= (SELECT count(*) // 2 FROM (SELECT DISTINCT {MSG_COORDS} FROM ({MSG_ROWS})))"),
        "failure_records": (f"SELECT DISTINCT 'message' AS kind, {MSG_COORDS}, 'PayloadError' AS error_type FROM ({MSG_ROWS}) WHERE \"offset\" % 5 = 0"),
        "consume_stream": enriched.format(scored(MSG_ROWS, True, keep=MSG_COORDS)),
    }


def group5() -> dict[str, str]:
    label = safe_sql(origin_expr("_l_"), True, V.LABEL_NAME_MAX, "listing")
    return {
        "read_pages": "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages",
        "decode_body": "SELECT page_id, CAST(length(html) AS INTEGER) AS n_chars, true AS same FROM pages",
        "decode_charsets": ("SELECT page_id, CAST(length(html) + CASE WHEN page_id % 4 = 3 THEN 1 ELSE 0 END AS INTEGER) AS n_chars, "
                            "page_id % 4 <> 3 AS same, page_id % 4 = 3 OR suffix(html, chr(65533)) AS replaced FROM pages"),
        "write_merged": f"SELECT rn AS \"Index\", position_title AS \"Position title\" FROM ({PRODUCED})",
        "publish_messages": (f"SELECT {q(MESSAGE_TOPIC)} AS topic, "
                             f"'parquet-batch-' || CAST((rn - 1) // {BATCH_ROWS} AS VARCHAR) AS key, "
                             f"count(*) AS n_rows FROM ({PRODUCED}) GROUP BY 1, 2"),
        "land_raw_pages": (f"SELECT {label} AS label, count(*) AS n FROM {url_parts('pages', 'url', '_l_')} "
                           f"GROUP BY 1"),
        "sql_scores": (f"SELECT \"Index\", leadership, explicit_years, inferred_years, skills, category, "
                       f"seniority_level FROM ({scored(JOBS, True)})"),
    }


def oracle() -> dict[str, str]:
    titles_only = f'SELECT "Index", "Position title" FROM ({JOBS})'
    career_anchors = anchors_sql(CAREER)
    with_origin = f"(SELECT *, {origin_expr('_o_')} AS _o_origin FROM {url_parts(career_anchors, 'url', '_o_')})"
    resolved = "(" + resolve_sql("_o_origin || '/'", "href", with_origin, "page_id, pos, href") + ")"
    slug_p = q(EX.career_slug_pattern().replace("(?iu)", "(?i)"))
    out = {
        "enrich_titles": ENRICHED.format(scored(titles_only, False)),
        "enrich_descriptions": ENRICHED.format(scored(JOBS, True)),
        "complexity_parts": (f'SELECT "Index", leadership, explicit_years, inferred_years, skills, '
                             f'complexity_score FROM ({scored(JOBS, True)})'),
        "category_counts": f"SELECT category, count(*) AS n FROM ({scored(JOBS, True)}) GROUP BY category",
        "seniority_counts": (f"SELECT seniority_level, count(*) AS n FROM ({scored(JOBS, True)}) "
                             f"GROUP BY seniority_level"),
        "enrich_documents": ENRICHED.format(scored(DOC_JOBS, True)),
        "canonical_urls": canonical_sql("pages", "url", "page_id, url"),
        "strip_tracking": (f"SELECT page_id, _s_query AS query, {strip_tracking_sql('_s_query')} AS kept_query "
                           f"FROM {url_parts('pages', 'url', '_s_')}"),
        "site_origins": (f"SELECT page_id, {origin_expr('_s_')} AS origin, "
                         f"coalesce({origin_expr('_s_')} IS NOT NULL, false) AS listing_ok "
                         f"FROM {url_parts('pages', 'url', '_s_')}"),
        "job_slugs": (f"SELECT page_id, pos, href, {is_job_href_sql('href')} AS is_job_href, "
                      f"{job_slug_sql('href')} AS slug FROM {career_anchors}"),
        "resolve_hrefs": canonical_sql(resolved, "resolved", "page_id, pos, href, resolved"),
        "normalize_titles": (f"SELECT id, {normalize_sql('title')} AS title, "
                             f"{normalize_sql(normalize_sql(normalize_sql('title')))} AS title3 FROM ({DIRTY})"),
        "title_from_slugs": (f"SELECT page_id, pos, slug, {title_case_sql('slug')} AS title FROM ("
                             f"SELECT page_id, unnest(sl) AS slug, generate_subscripts(sl, 1) - 1 AS pos FROM ("
                             f"SELECT page_id, regexp_extract_all(html, {slug_p}, 1) AS sl FROM ({CAREER})))"),
        "casefold_texts": (f"SELECT page_id, pos, text, {casefold_sql('text')} AS folded "
                           f"FROM {anchors_sql('SELECT page_id, url, html FROM pages')}"),
        "safe_names": (f"SELECT page_id, {safe_sql('url', True, V.KEY_NAME_MAX, 'message')} AS key_name, "
                       f"{safe_sql('url', False, V.TOPIC_NAME_MAX, 'topic')} AS topic_name, "
                       f"{safe_sql('url', True, V.LABEL_NAME_MAX, 'listing')} AS label FROM pages"),
        "blob_names": blob_names_sql(),
        "nonblank_pages": "SELECT page_id, coalesce(regexp_matches(html, '\\S'), false) AS nonblank FROM pages",
        "page_links": f"SELECT page_id, pos, position_title, job_url FROM ({extract_sql(CAREER, False)})",
        "slug_scan": (f"SELECT page_id, pos, slug FROM {slugs_sql(pages_with_origin(CAREER))} "
                      f"QUALIFY row_number() OVER (PARTITION BY page_id, lower(slug) ORDER BY pos) = 1"),
        "unseen_slugs": (f"SELECT page_id, pos, position_title, job_url FROM ({extract_sql(CAREER)}) "
                         f"WHERE phase = 1"),
        "extract_jobs": extract_sql(CAREER),
        "extract_titles": (f"SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY phase, pos) - 1 AS INTEGER) AS nth, position_title "
                           f"FROM ({extract_sql(CAREER)})"),
        "extract_metrics": metrics_sql(CAREER),
        **group3(),
        **group4(),
        **group5(),
        "produce_enriched": ENRICHED.replace('SELECT "Index"', 'SELECT batch_no, "Index"').format(
            scored(f"SELECT (rn - 1) // {BATCH_ROWS} AS batch_no, (rn - 1) % {BATCH_ROWS} + 1 AS \"Index\", "
                   f"position_title AS \"Position title\" FROM ({PRODUCED})", False, keep="batch_no")),
    }
    return out
