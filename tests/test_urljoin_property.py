"""``resolve_href`` against the standard library's ``urllib.parse.urljoin`` on generated links."""

from urllib.parse import urljoin

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobloom.functions import urls as U

PIECES = ["", "career", "Career", "a", "b-c", "..", ".", "x;p=1", "?q=1", "?utm_source=x&b=2", "#f", "//h.example",
          "http:", "https:", "/", "//", "mailto:x", "%41", "a b"]
hrefs = st.lists(st.sampled_from(PIECES), min_size=1, max_size=6).map(lambda xs: "".join(
    p if i == 0 or p.startswith(("?", "#", "/", ";")) else "/" + p for i, p in enumerate(xs)))
BASES = ["https://jobs-site.example/", "http://h.example/", "https://h.example/sub/"]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(hrefs, min_size=20, max_size=60))
def test_resolve_href_matches_urljoin(spark, links):
    rows = [(b, h.strip()) for b in BASES for h in links]
    df = spark.createDataFrame(rows, "b string, h string")
    got = df.select("b", "h", U.resolve_href(F.col("b"), F.col("h")).alias("r")).collect()
    for r in got:
        assert r["r"] == urljoin(r["b"], r["h"]), (r["b"], r["h"])


URL_PIECES = ["http:", "HTTPS:", "//", "Host.Example", ":8080", "user@", "/", "career", "a;b", "?", "q=1&r", "#",
              "frag", "x", "1a:", "ftp:", "..", " ", "\t"]
urls = st.lists(st.sampled_from(URL_PIECES), min_size=1, max_size=8).map("".join)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(urls, min_size=20, max_size=60))
def test_split_url_matches_urlsplit(spark, values):
    from urllib.parse import urlsplit

    df = spark.createDataFrame([(v,) for v in values], "u string")
    got = df.select("u", U.split_url(F.col("u")).alias("p")).collect()
    for r in got:
        s = r["u"].strip()
        ref = urlsplit("https:" + s if s.startswith("//") else s)
        p = r["p"]
        assert (p["scheme"], p["netloc"], p["raw_path"], p["query"], p["fragment"]) == \
            (ref.scheme, ref.netloc, ref.path, ref.query, ref.fragment), s
