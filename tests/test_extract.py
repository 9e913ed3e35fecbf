"""Job-link extraction from pages."""

import pytest

from jobloom.operators import extract as EX

ORIGIN = "https://jobs-site.example"


def jobs_of(spark, html, origin=ORIGIN):
    pages = spark.createDataFrame([(1, origin + "/Careers", html)], "page_id long, url string, html string")
    rows = EX.extract_jobs(pages).orderBy("phase", "pos").collect()
    return [(r["position_title"], r["job_url"]) for r in rows]


@pytest.mark.parametrize("href", ["/CAREER/night-shift", "career/night-shift/", "https://jobs-site.example/Career/night-shift?utm_source=x",
                                  "//jobs-site.example/career/night-shift#apply"])
def test_spellings_of_a_link(spark, href):
    (title, url), *more = jobs_of(spark, f"<ul><li><a class=x href='{href}'> Night\n Shift <b>Nurse</b></a></ul>")
    assert title == "Night Shift Nurse" and url.lower() == "https://jobs-site.example/career/night-shift"
    assert all(u.lower() != url.lower() for _, u in more)


def test_links_outside_anchors_take_their_title_from_the_url(spark):
    html = """<script>window.posts = ["/career/tram_driver-2", "/career/b2b-sales/"]; /career/Tram_driver-2</script><p>/career/</p>"""
    assert jobs_of(spark, html) == [("Tram Driver 2", f"{ORIGIN}/career/tram_driver-2"), ("B2B Sales", f"{ORIGIN}/career/b2b-sales")]


def test_blank_page_gives_nothing(spark):
    assert jobs_of(spark, "   \n ") == []


def test_empty_title_anchor_blocks_its_url(spark):
    html = '<a href="/career/a/"> </a><a href="/career/a">Later</a><a href="/career/b/">B</a>'
    # the first anchor claims /career/a with an empty title: no row for it, and the
    # second anchor and the slug scan cannot add it back
    assert jobs_of(spark, html) == [("B", "https://jobs-site.example/career/b")]


def test_slug_scan_adds_other_urls(spark):
    html = '<a href="/en/career/foo">Foo EN</a><a href="/?next=/career/x">Next</a>'
    got = jobs_of(spark, html)
    assert got[0] == ("Foo EN", "https://jobs-site.example/en/career/foo")
    assert ("Foo", "https://jobs-site.example/career/foo") in got
    assert ("X", "https://jobs-site.example/career/x") in got


def test_comments_hide_anchors_but_not_slugs(spark):
    html = '<!-- <a href="/career/hidden/">Hidden</a> --><a href="/career/shown/">Shown<!-- x --> now</a>'
    assert jobs_of(spark, html) == [("Shown now", "https://jobs-site.example/career/shown"),
                                    ("Hidden", "https://jobs-site.example/career/hidden")]


def test_tracking_variants_are_one_job(spark):
    html = ('<a href="/career/a/?utm_source=x">First</a><a href="https://JOBS-SITE.example/career/a#top">Second</a>')
    assert jobs_of(spark, html) == [("First", "https://jobs-site.example/career/a")]


def test_entities_and_nested_markup_in_text(spark):
    html = '<a class="x" href=\'/career/r&amp;d/\'><span>R&amp;D</span> <b>Lead</b> View Position</a>'
    # the raw-HTML slug scan stops at '&' and adds the slug "r" as its own job
    assert jobs_of(spark, html) == [("R&D Lead", "https://jobs-site.example/career/r&d"),
                                    ("R", "https://jobs-site.example/career/r")]


def test_metrics(spark):
    html = ('<a href="/career/a/">A</a><a href="/career/a/">A again</a><a href="/jobs">x</a>'
            '<a href="/career/">list</a>/career/b/ /career/B/ /career/careers/')
    pages = spark.createDataFrame([(1, ORIGIN, html)], "page_id long, url string, html string")
    m = EX.extract_metrics(pages).collect()[0]
    assert m["anchor_candidates"] == 3          # FLT-2 passes /career/a twice and /career/
    assert m["unique_slugs"] == 2               # a, b (B is the same slug; careers is skipped)
    assert m["rows_from_anchors"] == 1 and m["total_rows"] == 2
    assert m["short_page"] is True


@pytest.mark.parametrize("parts", [1, 3])
def test_extraction_does_not_depend_on_partitioning(spark, parts):
    from tests.conftest import SF_SMOKE
    from jobloom.plans.fixtures import career_pages

    pages = career_pages(spark, SF_SMOKE)
    base = sorted(map(tuple, EX.extract_jobs(pages).collect()))
    again = sorted(map(tuple, EX.extract_jobs(pages.repartition(parts)).collect()))
    assert base == again and base


@pytest.mark.parametrize("html, found", [
    # a nested anchor keeps its own title and is text of the outer one, which is open to the end of the page
    ('<a href="/career/a/">A <a href="/career/b/">B</a> tail', [("A B tail", "a"), ("B", "b")]),
    ('<a href="/career/z/">Z <i>x</i><a href="/career/in-z/">Inner role</a></a>', [("Z x Inner role", "z"), ("Inner role", "in-z")]),
    # the end of an element around an anchor closes it
    ('<div><a href="/career/a/">A</div> more</a> end', [("A", "a")]),
    ('<li><a href="/career/a/">A<li><a href="/career/b/">B</li> c</li> d', [("A B c", "a"), ("B", "b")]),
    ('<a href="/career/self/" />Text', []),  # an empty anchor claims its URL
    # quotes in tags inside an anchor
    ('<a href="/career/q/"><img alt="a > b">Great Role</a>', [("Great Role", "q")]),
    ("<a href='/career/q/'><b data-x='</a>'>Bold</b> < 3 y</a>", [("Bold < 3 y", "q")]),
    # character references of HTML 5, without semicolon, by number
    ('<a href="/career/r1/">C&num; &NotEqualTilde; R&amp D</a>', [("C# \u2242\u0338 R& D", "r1")]),
    ('<a href="/career/r2/">A &copy B&reg;&nosuch; &copyright</a>', [("A \u00a9 B\u00ae&nosuch &copyright", "r2")]),
    ('<a href="/career/r3/">&#128;&#x41;&#0; &#66 C</a>', [("\u20acA\ufffd B C", "r3")]),
    ('<a href="/career/r4?a=1&amp;b=2">x</a>', [("x", "r4?a=1&b=2"), ("R4", "r4")]),
])
def test_markup_that_needs_a_parser(spark, html, found):
    assert jobs_of(spark, html) == [(t, f"{ORIGIN}/career/{s}") for t, s in found]


def test_parser_and_built_in_reading_agree(spark):
    """On pages that do not need the parser both give the same anchors."""
    from pyspark.sql import functions as F

    from jobloom.operators.markup import parsed_anchors
    from jobloom.plans.fixtures import career_pages
    from tests.conftest import SF_SMOKE

    pages = career_pages(spark, SF_SMOKE).union(spark.createDataFrame(
        [(-1, "u", '<A HREF = "/career/caps">Caps &amp; more&nbsp;</A ><a>none</a><p>x<a class=x href=/career/q >1 <b>2</b> <br>3</a>')], "page_id long, url string, html string"))
    read = sorted((r["page_id"], r["pos"], r["href"], r["text"]) for r in EX.page_anchors(pages).collect())
    rows = pages.select("page_id", parsed_anchors(F.col("html")).alias("p")).select("page_id", "p.texts", F.posexplode("p.anchors").alias("pos", "a"))
    rows = rows.selectExpr("page_id", "pos", "a.href", "array_join(slice(texts, a.lo + 1, a.hi - a.lo), ' ')").collect()
    assert read == sorted(tuple(r) for r in rows) and len(read) > 50


def test_titles_only(spark):
    html = '<a href="/career/b/">Beta</a><a href="/career/a/">Alpha</a>/career/c-d'
    pages = spark.createDataFrame([(1, ORIGIN, html), (2, ORIGIN, " ")], "page_id long, url string, html string")
    assert [tuple(r) for r in EX.extract_titles(pages).collect()] == [(1, 0, "Beta"), (1, 1, "Alpha"), (1, 2, "C D")]


@pytest.mark.parametrize("html, found", [
    ('<a title="a > b" href="/career/gt-role/">Great Role</a>', [("Great Role", "gt-role")]),
    ("<a data-x='</b> href=\"/career/no\"' href=/career/yes>Yes</a>", [("Yes", "yes"), ("No", "no")]),
    ('<a-card href="/career/card/">Card <a href="/career/real/">Real</a>', [("Real", "real"), ("Card", "card")]),
    ('<a href="/career/first/">First</a> and <a href="/career/open/">Open <b>end', [("First", "first"), ("Open end", "open")]),
    ('<a class=5" href="/career/inch/">Inch</a><a href="/career/two">Two</a>', [("Inch", "inch"), ("Two", "two")]),
    ('<a>none</a><A HREF = "/career/caps">Caps</A >', [("Caps", "caps")]),
])
def test_opening_tags(spark, html, found):
    assert jobs_of(spark, html) == [(t, f"{ORIGIN}/career/{s}") for t, s in found]


def test_an_opening_tag_that_never_ends_is_cheap(spark):
    import time

    start = time.perf_counter()
    assert jobs_of(spark, "<a x = " * 30000 + '</a><a href="/career/z">Z</a>')[-1][0] == "Z"
    assert time.perf_counter() - start < 60


def test_many_unclosed_anchors_stay_linear(spark):
    import time

    html = '<p>' + '<a href="/career/x/">x ' * 20000 + '</p><a href="/career/last/">Last</a>'
    t0 = time.perf_counter()
    got = jobs_of(spark, html)
    assert time.perf_counter() - t0 < 60
    assert got[0][0].startswith("x x x") and got[0][1] == "https://jobs-site.example/career/x"
    # "Last" is text of the first anchor (cut to 2000 characters); no anchor claims
    # /career/last, so the slug scan adds it
    assert len(got[0][0]) <= 2000 and got[1:] == [("Last", "https://jobs-site.example/career/last")]


@pytest.mark.parametrize("html,expected", [
    ('<A HREF="/career/up/">Upper</A>', [("Upper", "https://jobs-site.example/career/up")]),
    ("<a href='/career/sq/'>Single</a>", [("Single", "https://jobs-site.example/career/sq")]),
    ('<a href=/career/bare/ class=x>Bare</a>', [("Bare", "https://jobs-site.example/career/bare")]),
    ('<a\n  class="c"\n  href = "/career/nl/"\n>New\nline</a >', [("New line", "https://jobs-site.example/career/nl")]),
    ('<a data-href="/jobs" href="/career/real/">Real</a>', [("Real", "https://jobs-site.example/career/real")]),
    ('<script>var s = \'<a href="/career/js/">JS</a>\';</script>', [("Js", "https://jobs-site.example/career/js")]),
    ('<abbr href="/career/no/">Abbr</abbr>', [("No", "https://jobs-site.example/career/no")]),
    ('<a name="top">Top</a><a href="">Empty</a>', []),
])
def test_markup_variants(spark, html, expected):
    # anchors in scripts and non-anchor tags are not links; the slug scan still sees their URLs
    assert jobs_of(spark, html) == expected
