"""Plan shape and skew behaviour that matter at cluster scale."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from jobloom.operators.dedupe import keep_first
from tests.conftest import SF_SMOKE


def physical(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_key_keep_first_is_exact_and_partial(spark):
    # one key holds a third of all rows
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        (F.lit(n) - F.col("id")).alias("ord"), F.col("id")).repartition(16)
    out = keep_first(df, "k", "ord")
    plan = physical(out)
    assert "partial_min_by" in plan  # collapsed per map partition before the shuffle
    hot = out.filter("k = 'hot'").collect()
    assert len(hot) == 1 and hot[0]["id"] == max(i for i in range(n) if i % 3 == 0)
    assert out.count() == 1 + (n - n // 3)


def test_no_cartesian_or_nested_loop_joins(spark):
    qs = E.queries()
    for name in ("extract_jobs", "sanitize_records", "violations", "enrich_payloads", "produce_merged",
                 "attach_source", "run_counts"):
        plan = physical(qs[name](spark, SF_SMOKE))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_extraction_is_narrow_and_pruned(spark):
    plan = physical(E.queries()["extract_jobs"](spark, SF_SMOKE))
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in plan


def test_enrichment_reads_only_needed_columns(spark):
    plan = physical(E.queries()["enrich_documents"](spark, SF_SMOKE))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "hashpartitioning" not in plan


def test_few_splits_are_rebalanced_without_a_job(spark):
    """A small input is dealt out by a lazy hint, a large one keeps its splits; building the plan runs no job for that."""
    from jobloom.operators.spread import spread

    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    spark.sparkContext.setJobGroup("plan-only", "plans")
    dealt = spread(docs)
    assert "REBALANCE" in physical(dealt)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        assert "REBALANCE" not in physical(spread(docs))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["doc_id"] for r in dealt.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
