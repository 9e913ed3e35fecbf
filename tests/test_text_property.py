"""JVM-side text primitives against the Python standard-library functions they emulate."""

import html
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobloom.functions import text as TX

# Latin (with decomposed accents), Greek, Cyrillic, ligatures, special cases and
# white space that every Unicode version in play agrees on
ALPHABET = (list("aAbBzZ09 _-.") + ["\u00df", "\u1e9e", "\ufb01", "\ufb02", "\u0130", "\u0131", "\u017f",
            "\u03a3", "\u03c3", "\u03c2", "\u0391", "\u03b1", "\u0416", "\u0436", "\u0401", "\u0451",
            "\u00e9", "e\u0301", "\u00c5", "A\u030a", "\u212b"]
            + ["\t", "\n", "\r", "\u00a0", "\u2009", "\u3000", "\u2028"])
texts = st.lists(st.sampled_from(ALPHABET), max_size=16).map("".join)


def run(spark, values, col_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return {r["i"]: r["r"] for r in df.select("i", col_fn(F.col("v")).alias("r")).collect()}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=30, max_size=60))
def test_casefold_nfc_strip(spark, values):
    folded = run(spark, values, TX.casefold)
    composed = run(spark, values, TX.nfc)
    stripped = run(spark, values, TX.unicode_strip)
    for i, v in enumerate(values):
        assert folded[i] == v.casefold(), repr(v)
        assert composed[i] == unicodedata.normalize("NFC", v), repr(v)
        assert stripped[i] == v.strip(), repr(v)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(list("abcXYZ09 ")), max_size=14).map("".join), min_size=30, max_size=60))
def test_title_case(spark, values):
    titled = run(spark, values, TX.title_from_slug)
    for i, v in enumerate(values):
        assert titled[i] == v.strip().title(), repr(v)


def test_unescape_matches_stdlib_for_html4_entities(spark):
    values = ["&amp;&lt;&gt;&quot;&apos;", "&eacute;&Agrave;&nbsp;&copy;&euro;&hellip;", "&#65;&#x42;&#x1F600;",
              "a & b", "&unknown;", "&amp;amp;"]
    got = run(spark, values, TX.html_unescape)
    for i, v in enumerate(values):
        assert got[i] == html.unescape(v), v
