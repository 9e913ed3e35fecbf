"""URL and title functions on the hand-checked cases of the reference tests."""

import pytest
from pyspark.sql import functions as F

from jobloom.functions import text as TX
from jobloom.functions import urls as U


def one(spark, col_fn, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col_fn(F.col("v")).alias("r")).collect()[0]["r"]


@pytest.mark.parametrize("url,expected", [
    ("https://Jobs-Site.example/career/foo/?utm_source=Email&utm_medium=mail", "https://jobs-site.example/career/foo"),
    ("https://jobs-site.example/career/foo/", "https://jobs-site.example/career/foo"),
    ("https://jobs-site.example/career/foo", "https://jobs-site.example/career/foo"),
    ("//Host.example/a/b/?b=2&a=1&fbclid=x#frag", "https://host.example/a/b?a=1&b=2"),
    ("http://h.example:8080/x;jsessionid=1", "http://h.example:8080/x"),
    ("https://h.example", "https://h.example/"),
    ("https://h.example//", "https://h.example"),
    ("https://h.example/?q=a b&z=~*", "https://h.example/?q=a+b&z=~%2A"),
    ("  https://h.example/a?Gclid=1&x=  ", "https://h.example/a?x="),
    ("mailto:x", None), ("javascript:void(0)", None), ("ftp://h.example/a", None),
    ("/career/a", None), ("", None), (None, None), ("https://[::1/x", None),
])
def test_canonical_url(spark, url, expected):
    assert one(spark, U.canonical_url, url) == expected


@pytest.mark.parametrize("href,slug", [
    ("https://jobs-site.example/career/one/", "one"), ("https://jobs-site.example/Career/two/", "two"),
    ("career/three/", "three"), ("/career/", None), ("/careers/x", None), ("/career/careers/", None),
    ("/career/x?y=/career/z", "x"), ("/en/career/foo", "foo"), ("/?next=/career/x", None),
])
def test_job_slug(spark, href, slug):
    assert one(spark, U.job_slug, href) == slug


@pytest.mark.parametrize("href,ok", [
    ("/career/a", True), ("career/a", True), ("careers/a", False), ("mailto:a/career/b", False),
    ("#/career/x", False), ("  /CAREER/x ", True), ("/careers/", False), ("", False),
])
def test_is_job_href(spark, href, ok):
    assert one(spark, U.is_job_href, href) is ok


@pytest.mark.parametrize("href,expected", [
    ("career/three/", "https://jobs-site.example/career/three/"),
    ("/career/a/../b", "https://jobs-site.example/career/b"),
    ("../../career/x", "https://jobs-site.example/career/x"),
    ("//other.example/career/x", "https://other.example/career/x"),
    ("http://other.example/career/x", "http://other.example/career/x"),
    ("?q=1", "https://jobs-site.example/?q=1"),
    ("./career/./y/.", "https://jobs-site.example/career/y/"),
])
def test_resolve_href(spark, href, expected):
    df = spark.createDataFrame([(href,)], "h string")
    got = df.select(U.resolve_href(F.lit("https://jobs-site.example/"), F.col("h")).alias("r")).collect()[0]["r"]
    assert got == expected


@pytest.mark.parametrize("url,origin", [
    ("https://Jobs-Site.example/Careers", "https://jobs-site.example"), ("//a.example/x", "https://a.example"),
    ("ftp://a.example/x", None), ("a.example/x", None),
])
def test_site_origin(spark, url, origin):
    assert one(spark, U.site_origin, url) == origin


@pytest.mark.parametrize("raw,title", [
    ("Alpha View Position", "Alpha"), ("Interview Position", "Inter"),
    ("X View Position View Position", "X View Position"), ("  a b  ", "a b"),
    ("thin\u2009space", "thinspace"), ("zero\u200bwidth", "zerowidth"), ("Café", "Café"),
    ("tab\tand\nnewline", "tab and newline"), (None, ""), ("VIEW   POSITION", ""),
])
def test_normalize_title(spark, raw, title):
    assert one(spark, TX.normalize_title, raw) == title


def test_normalize_title_cut(spark):
    df = spark.createDataFrame([("abc def",)], "v string")
    assert df.select(TX.normalize_title(F.col("v"), 4).alias("r")).collect()[0]["r"] == "abc"


@pytest.mark.parametrize("slug,title", [
    ("json-only-role", "Json Only Role"), ("lead_engineer_role", "Lead Engineer Role"),
    ("b2b-sales", "B2B Sales"), ("--x__y--", "X Y"),
])
def test_title_from_slug(spark, slug, title):
    assert one(spark, TX.title_from_slug, slug) == title


@pytest.mark.parametrize("s,folded", [("Straße", "strasse"), ("ΣΑΣ", "σασ"), ("ABC", "abc"), ("ﬁ", "fi")])
def test_casefold(spark, s, folded):
    assert one(spark, TX.casefold, s) == folded


def test_safe_names(spark):
    df = spark.createDataFrame([("bad/name!topic", b"weird key!"), ("", None), ("__", b"__")],
                               "t string, k binary")
    got = df.select(TX.safe_topic("t").alias("t"), TX.safe_key("k").alias("k"),
                    TX.safe_label("t").alias("l")).collect()
    assert (got[0]["t"], got[0]["k"]) == ("bad_name_topic", "weird_key")
    assert (got[1]["t"], got[1]["k"], got[1]["l"]) == ("topic", "message", "listing")
    assert (got[2]["t"], got[2]["k"]) == ("__", "message")


def test_blob_name_layout(spark):
    df = spark.createDataFrame([("my-topic", 2, 99, b"key-1")], "topic string, p int, o long, k binary")
    ts = F.timestamp_millis(F.lit(1735732800123))
    r = df.select(TX.blob_name("topic", "p", "o", "k", ts, prefix="prefix/").alias("a"),
                  TX.blob_name("topic", "p", "o", F.lit(None).cast("binary"), ts, enriched=True,
                               prefix="  pre/fix  ").alias("b")).collect()[0]
    assert r["a"] == "prefix/my-topic/20250101T120000123Z_p2_o99_key-1.parquet"
    assert r["b"].startswith("pre/fix/my-topic/") and r["b"].endswith("_message_enriched.parquet")
    assert TX.blob_prefix(None) == "careers-parquet/" and TX.blob_prefix("") == ""


def test_canonical_join_equals_join_then_canonical(spark):
    hrefs = ["", "career/three/", "/career/a/../b", "../../career/x", "//other.example/career/x",
             "http://other.example/career/x", "?q=1&utm_source=z", "#frag", "./career/./y/.", "mailto:x",
             "HTTPS://Up.Example/A/?b=2&a=1", "/career/x;jsessionid=1?x=1", ";p", "/a//b/", "https:/x", "//",
             "///x", "career/a?", "  /career/z#t ", "https://[::1]/career/a", "https://[bad/x", "a/b/..", "/.."]
    rows = [(b, h) for b in ("https://jobs-site.example/", "http://h.example/", "https://h.example/sub/") for h in hrefs]
    df = spark.createDataFrame(rows, "b string, h string")
    got = df.select(U.canonical_url(U.resolve_href(F.col("b"), F.col("h"))).alias("two_step"),
                    U.canonical_join(U.split_url(F.col("b")), F.col("h")).alias("joined")).collect()
    assert all(r["two_step"] == r["joined"] for r in got)


@pytest.mark.parametrize("raw,text", [("R&amp;D", "R&D"), ("it&apos;s", "it's"), ("&amp;apos;", "&apos;"),
                                      ("&#233;t&#xE9;", "été"), ("caf&eacute;", "café"), ("plain", "plain")])
def test_html_unescape(spark, raw, text):
    assert one(spark, TX.html_unescape, raw) == text


def test_keep_all_query_params(spark):
    df = spark.createDataFrame([("https://H.example/a/?utm_source=x&b=2&a=1",)], "u string")
    r = df.select(U.canonical_url("u").alias("clean"), U.canonical_url("u", keep_all_query_params=True).alias("all"),
                  U.canonical_join(U.split_url(F.lit("https://h.example/")), F.col("u"), True).alias("joined")
                  ).collect()[0]
    assert r["clean"] == "https://h.example/a?a=1&b=2"
    assert r["all"] == r["joined"] == "https://h.example/a?utm_source=x&b=2&a=1"


def test_safe_key_with_invalid_utf8(spark):
    df = spark.createDataFrame([(b"\xffkey\xfe!",), (b"\xe2\x82",)], "k binary")
    got = [r[0] for r in df.select(TX.safe_key("k")).collect()]
    # bytes decode with replacement, unsafe runs become "_", the ends are stripped
    assert got == ["key", "message"]
