"""Text cleaning as Column expressions: titles, case folding, names for storage.

Unicode work stays in the JVM: NFC and full case folding call ICU4J (bundled
with Spark) through ``reflect``, entity decoding calls commons-text. Each
reflective call is skipped for pure-ASCII input, where it is the identity (NFC)
or equals ``lower`` (case folding), and guarded against null input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions import vocab as V
from jobloom.functions.common import let

# fixed values: the characters with the Unicode property White_Space
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")
_ASCII_ONLY = r"^[\x00-\x7F]*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _reflect(cls: str, method: str, *args: Column) -> Column:
    return F.reflect(F.lit(cls), F.lit(method), *args)


def unicode_strip(c) -> Column:
    """Strip leading/trailing Unicode white space; linear in the text, runs of inner white space included."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def unicode_rstrip(c) -> Column:
    return F.rtrim(_col(c), F.lit(WHITE_SPACE))


def nfc(c) -> Column:
    """Unicode NFC composition."""
    return let(_col(c), lambda v: F.when(v.isNull(), F.lit(None).cast("string"))
               .when(F.regexp_like(v, F.lit(_ASCII_ONLY)), v)
               .otherwise(_reflect("com.ibm.icu.text.Normalizer", "compose", v, F.lit(False))))


def casefold(c) -> Column:
    """Full Unicode case folding (``str.casefold``): ``ß`` -> ``ss``, ``ς`` -> ``σ``.

    Note: ``lower(upper(x))`` is not a substitute; the optimizer rewrites it to ``lower(x)``.
    """
    return let(_col(c), lambda v: F.when(v.isNull(), F.lit(None).cast("string"))
               .when(F.regexp_like(v, F.lit(_ASCII_ONLY)), F.lower(v))
               .otherwise(_reflect("com.ibm.icu.lang.UCharacter", "foldCase", v, F.lit(True))))


def html_unescape(c) -> Column:
    """Decode character references: named HTML 4 entities, ``&apos;``, decimal and hex."""
    return let(_col(c), lambda v: F.when(v.isNull(), F.lit(None).cast("string"))
               .when(~v.contains("&"), v)
               .otherwise(_reflect("org.apache.commons.text.StringEscapeUtils", "unescapeHtml4",
                                   F.replace(v, F.lit("&apos;"), F.lit("&#39;")))))


def normalize_title(c, max_chars: int = V.TITLE_MAX_CHARS) -> Column:
    """One pass of position-title cleaning (TXT-1).

    null -> ''; NBSP -> space; drop non-printable characters (control, format,
    unassigned, line/paragraph separators and every space separator except ' ')
    but keep tab/LF/CR; NFC; collapse white space and trim; remove one trailing
    "View Position" (case-insensitive, no word boundary); cut to ``max_chars``.
    """
    max_chars = max(1, int(max_chars))
    t = F.coalesce(_col(c), F.lit(""))
    t = F.regexp_replace(t, "\u00a0", " ")
    t = F.regexp_replace(t, r"[\p{C}\p{Z}&&[^ \t\n\r]]", "")
    t = nfc(t)
    t = unicode_strip(F.regexp_replace(t, r"(?U)\s+", " "))
    t = unicode_strip(F.regexp_replace(t, "(?iU)" + V.TITLE_SUFFIX, ""))
    # t has no outer white space, so cutting and right-stripping is a no-op when short
    return unicode_rstrip(F.substring(t, 1, max_chars))


def title_from_slug(c) -> Column:
    """Readable title from a URL slug (TXT-2): ``-``/``_`` runs -> space, strip, title case.

    Title case follows Python's rule (a letter is upper-cased when the character
    before it is not a cased letter), so ``b2b-sales`` -> ``B2B Sales``; plain
    ``initcap`` would give ``B2b``. Each run of cased letters is ``initcap``-ed.
    """
    t = unicode_strip(F.regexp_replace(_col(c), "[-_]+", " "))
    runs = F.regexp_extract_all(t, F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def combined_text(title, description=None) -> Column:
    """Text the scorers read (TXT-4): stripped title [+ LF + stripped description].

    A null becomes the text ``None`` first, as a string cast of a missing value does.
    """
    t = unicode_strip(F.coalesce(_col(title).cast("string"), F.lit("None")))
    if description is None:
        return t
    d = unicode_strip(F.coalesce(_col(description).cast("string"), F.lit("None")))
    return F.concat(t, F.lit("\n"), d)


def _unsafe_to_underscore(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-zA-Z0-9._-]+", "_")


def _strip_underscores(c: Column) -> Column:
    return F.regexp_replace(c, r"\A_+|_+\z", "")


def safe_key(key) -> Column:
    """Storage-safe message key (TXT-5): bytes decoded with replacement, max 100 chars."""
    text = let(_col(key), lambda k: F.when(k.isNull() | (F.octet_length(k) == 0), F.lit("message")).otherwise(
        F.make_valid_utf8(k.cast("string"))))
    s = F.substring(_strip_underscores(_unsafe_to_underscore(text)), 1, V.KEY_NAME_MAX)
    return let(s, lambda v: F.when(v == "", F.lit("message")).otherwise(v))


def safe_topic(topic) -> Column:
    """Storage-safe topic (TXT-5): not stripped of ``_``, max 80 chars."""
    s = F.substring(_unsafe_to_underscore(F.coalesce(_col(topic), F.lit(""))), 1, V.TOPIC_NAME_MAX)
    return let(s, lambda v: F.when(v == "", F.lit("topic")).otherwise(v))


def safe_label(label) -> Column:
    """Storage-safe page label (TXT-5): stripped of ``_``, max 80 chars."""
    s = F.substring(_strip_underscores(_unsafe_to_underscore(F.coalesce(_col(label), F.lit("")))),
                    1, V.LABEL_NAME_MAX)
    return let(s, lambda v: F.when(v == "", F.lit("listing")).otherwise(v))


def blob_prefix(prefix: str | None = V.DEFAULT_BLOB_PREFIX) -> str:
    p = (prefix if prefix is not None else V.DEFAULT_BLOB_PREFIX).strip()
    return p + "/" if p and not p.endswith("/") else p


def blob_name(topic, partition, offset, key, ts, enriched: bool | Column = False,
              prefix: str | None = V.DEFAULT_BLOB_PREFIX) -> Column:
    """Object name of a stored message (TXT-6):
    ``{prefix}{topic}/{yyyyMMddTHHmmssSSS}Z_p{partition}_o{offset}_{key}[_enriched].parquet``.
    """
    suffix = (F.when(enriched, F.lit("_enriched")).otherwise(F.lit(""))
              if isinstance(enriched, Column) else F.lit("_enriched" if enriched else ""))
    return F.concat(
        F.lit(blob_prefix(prefix)), safe_topic(topic), F.lit("/"),
        F.date_format(_col(ts), "yyyyMMdd'T'HHmmssSSS'Z'"),
        F.lit("_p"), _col(partition).cast("string"), F.lit("_o"), _col(offset).cast("string"),
        F.lit("_"), safe_key(key), suffix, F.lit(".parquet"))
