"""The producer and consumer jobs end to end on the test tables."""

import json

import pytest

from jobloom.plans.jobs import EmptyRunError, consume_job, produce_job
from tests.conftest import SF_SMOKE


def test_produce_then_consume(spark, tmp_path):
    from jobloom.plans.fixtures import career_pages

    pages_path = str(tmp_path / "pages")
    career_pages(spark, SF_SMOKE).write.parquet(pages_path)
    stats = produce_job(spark, pages_path=pages_path, merged_path=str(tmp_path / "merged"), topic="jobs",
                        sink_path=str(tmp_path / "topic"), rows_per_batch=100)
    merged = spark.read.parquet(str(tmp_path / "merged"))
    assert merged.count() == stats["rows"] > 0
    assert sorted(r[0] for r in merged.select("Index").collect()) == list(range(1, stats["rows"] + 1))
    sent = spark.read.parquet(str(tmp_path / "topic"))
    assert sent.count() == stats["batches"] == -(-stats["rows"] // 100)
    msgs = sent.selectExpr("topic", "0 AS partition", "CAST(substring_index(CAST(key AS STRING), '-', -1) AS BIGINT)"
                           " AS offset", "key", "value", "CAST(NULL AS TIMESTAMP) AS timestamp")
    msgs.write.parquet(str(tmp_path / "msgs"))
    consume_job(spark, out_path=str(tmp_path / "stored"), messages_path=str(tmp_path / "msgs"),
                checkpoint_path=str(tmp_path / "ck"), failures_path=str(tmp_path / "fail"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    assert stored.count() == stats["rows"]
    assert set(r[0] for r in stored.select("category").distinct().collect()) <= {
        "Engineering", "Product", "Design", "Operations", "Other"}


def test_empty_run_fails(spark, tmp_path):
    pages_path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "https://a.example/", "<p>no jobs</p>")], "page_id long, url string, html string") \
        .write.parquet(pages_path)
    with pytest.raises(EmptyRunError):
        produce_job(spark, pages_path=pages_path, merged_path=str(tmp_path / "m"),
                    sources_json=json.dumps([{"id": "a", "url": "https://a.example/"}]))


def test_merge_list_and_settings_reach_the_job(spark, tmp_path):
    pages_path = str(tmp_path / "pages")
    spark.createDataFrame([
        (1, "https://a.example/list", '<a href="/career/x?utm_source=1">First listing of the job</a><a href="/career/y?utm_source=1">Y one</a>'),
        (2, "https://b.example/list", '<a href="https://a.example/career/x">X again</a><a href="/career/y?utm_source=2">Y of b</a>'),
        (3, "https://c.example/list", '<a href="/career/z">Not listed</a>')], "page_id long, url string, html string").write.parquet(pages_path)

    def titles(**settings):
        out = str(tmp_path / f"merged-{len(list(tmp_path.iterdir()))}")
        stats = produce_job(spark, pages_path=pages_path, merged_path=out, fallback_url="https://a.example/list", **settings)
        rows = [r["Position title"] for r in spark.read.parquet(out).orderBy("Index").collect()]
        assert stats["rows"] == len(rows)
        return rows

    merge = " https://b.example/list, https://a.example/list,, https://gone.example/list"
    # without tracking parameters the link of the second listing is the job of the first; the slug scan reads it as one of the second's own
    assert titles(merge_urls=merge) == ["First listing of the job", "X", "Y of b", "Y one"]
    # with them the slug scan of a page finds other URLs than its anchors
    assert titles(merge_urls=merge, keep_all_query_params=True) == ["First listing of the job", "X", "X", "Y", "Y", "Y of b", "Y one"]
    assert "First li" in titles(merge_urls=merge, title_max_chars=8)
    with pytest.raises(ValueError, match="no http"):
        titles(merge_urls="ftp://x.example")


def test_no_message_is_over_the_cap(spark, tmp_path):
    """Batches and sources whose payload would be over the cap go out in parts; all rows arrive once, in order."""
    from pyspark.sql import functions as F

    from jobloom.plans import payload as PL
    from jobloom.plans import produce as PR

    rows = spark.range(1200).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
        F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit(" title "), F.col("id")).alias("position_title"), F.col("id").cast("string").alias("job_url"))
    cap = 20000
    sent = PR.source_messages(rows, "t", rows_per_batch=500, max_message_bytes=cap).persist()
    sizes = sent.select("source", F.octet_length("value").alias("b"), "n_rows").collect()
    assert max(r["b"] for r in sizes) <= cap and max(r["n_rows"] for r in sizes) <= 500 and sum(r["source"] == "hot" for r in sizes) > 5
    back = PL.unpack_payloads(sent, ["Index", "Position title"], keep=["source"]).orderBy("source", "Index").collect()
    want = {}
    for r in rows.collect():
        want.setdefault(r["source"], []).append(r["position_title"])
    assert [(r["source"], r["Index"], r["Position title"]) for r in back] == [(s, i + 1, t) for s in sorted(want) for i, t in enumerate(sorted(want[s]))]
    batches = rows.select(F.lit(0).cast("long").alias("batch_no"), F.col("job_url").cast("long").alias("Index"), F.col("position_title").alias("Position title"))
    parts = PR.messages(batches, "t", max_message_bytes=cap).select(F.col("key").cast("string").alias("key"), F.octet_length("value").alias("b"), "n_rows").collect()
    assert len(parts) > 3 and max(r["b"] for r in parts) <= cap and sum(r["n_rows"] for r in parts) == 1200 and len({r["key"] for r in parts}) == len(parts)
    with pytest.raises(Exception, match="one row"):
        PL.pack_payloads(batches, ["batch_no"], ["Index", "Position title"], max_bytes=10).collect()
    sent.unpersist()
