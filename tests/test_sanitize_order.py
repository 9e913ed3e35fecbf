"""Record cleaning, title dedupe, global numbering and batches."""

import pytest
from pyspark.sql import functions as F

from jobloom.operators import ordering as ORD
from jobloom.operators import sanitize as SAN


def recs(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "id long, position_title string, job_url string, source string")


def test_same_title_different_urls_kept(spark):
    df = recs(spark, [("Same", "https://jobs-site.example/career/a/", None),
                      ("SAME", "https://jobs-site.example/career/b/", None),
                      ("Other", "https://jobs-site.example/career/c/", None)])
    assert SAN.sanitize_records(df, "id").count() == 3


def test_same_url_with_tracking_first_wins(spark):
    df = recs(spark, [("First", "https://jobs-site.example/career/a/", None),
                      ("Second pass", "https://Jobs-Site.example/career/a?utm_source=x", None)])
    out = SAN.sanitize_records(df, "id").collect()
    assert [(r["position_title"], r["job_url"]) for r in out] == [("First", "https://jobs-site.example/career/a/")]


def test_keys_without_and_with_bad_urls(spark):
    df = recs(spark, [("Dev", None, "s1"), ("dev", "", "s1"), ("Dev", None, "s2"),
                      ("Ops", "mailto:x", "s1"), ("OPS", " MAILTO:X ", "s1"), ("  ", "https://a.example/x", "s1"),
                      ("Ops View Position", "mailto:x", "s2")])
    out = sorted((r["id"], r["position_title"], r["job_url"]) for r in SAN.sanitize_records(df, "id").collect())
    assert out == [(0, "Dev", ""), (2, "Dev", ""), (3, "Ops", "mailto:x"), (6, "Ops", "mailto:x")]


def test_dedupe_titles_case_insensitive_first_wins(spark):
    df = spark.createDataFrame([(0, "Engineer"), (1, "engineer"), (2, "Designer"), (3, "  ")], "id long, title string")
    out = SAN.dedupe_titles(df, "id").collect()
    assert sorted(r["title"] for r in out) == ["Designer", "Engineer"]


def _numbered(spark, titles, parts=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "id long, title string")
    if parts:
        df = df.repartition(parts)
    n = ORD.global_index(df, ORD.title_sort_key("title", "id"), index_col="rn", num_partitions=4)
    return [(r["rn"], r["title"]) for r in n.orderBy("rn").collect()]


def test_global_index_is_a_case_folded_order(spark):
    got = _numbered(spark, ["b", "Straße", "A", "strasse", "a", "ß"])
    assert [i for i, _ in got] == [1, 2, 3, 4, 5, 6]
    # casefold: ß -> ss, which sorts before strasse; equal folds fall back to the raw title
    assert [t for _, t in got] == ["A", "a", "b", "ß", "Straße", "strasse"]


def test_global_index_independent_of_input_partitioning(spark):
    titles = [f"T{i % 37:02d}-{i}" for i in range(500)]
    assert _numbered(spark, titles) == _numbered(spark, titles, parts=7) == _numbered(spark, titles, parts=1)


def test_batches_restart_index(spark):
    df = spark.range(1, 6).select(F.col("id").alias("rn"))
    got = [(r["batch_no"], r["Index"]) for r in ORD.batch_index(df, 2).orderBy("rn").collect()]
    assert got == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1)]
    with pytest.raises(ValueError, match=">= 1"):
        ORD.batch_index(df, 0)


def test_cleaning_independent_of_input_partitioning(spark):
    from jobloom.plans.fixtures import records
    from tests.conftest import SF_SMOKE

    recs = records(spark, SF_SMOKE)
    base = sorted(map(tuple, SAN.sanitize_records(recs, "id").collect()))
    for parts in (1, 5, 13):
        again = sorted(map(tuple, SAN.sanitize_records(recs.repartition(parts), "id").collect()))
        assert again == base
