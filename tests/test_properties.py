"""Invariants over generated inputs: score range, label domains, row and key preservation."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from jobloom.functions import vocab as V
from jobloom.operators.enrich import enrich
from jobloom.operators.validate import assert_valid

WORDS = ([t.replace("\\", "") for _, ts in V.LEADERSHIP_TIERS for t in ts] + ["5+ years", "3-5 years", "10 yrs"]
         + ["python", "c++", "ux", "qa ", "manager", "engineer", "designer", "sales", "intern", "é", "ß"])
texts = st.lists(st.one_of(st.sampled_from(WORDS), st.text(max_size=8)), max_size=12).map(" ".join)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=40))
def test_enrichment_invariants(spark, titles):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "Index long, `Position title` string")
    out = enrich(df)
    rows = out.collect()
    assert len(rows) == len(titles)
    for r in rows:
        s = r["complexity_score"]
        assert s == 10 or 11 <= s <= 100
        assert r["category"] in V.ALLOWED_CATEGORIES and r["seniority_level"] in V.ALLOWED_SENIORITY
        assert r["Position title"] == titles[r["Index"]]
    assert_valid(df, out)
