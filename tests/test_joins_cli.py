"""Measured broadcast decision and the command line."""

import contextlib
import io
import os
import subprocess
import sys

from jobloom.operators.joins import join_small, measured_bytes

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_measured_bytes_and_broadcast_decision(spark):
    small = spark.createDataFrame([("k1", "abc"), ("k2", "de")], "k string, v string")
    assert measured_bytes(small) == 2 * 16 + len("k1abc") + len("k2de")
    big = spark.range(1000).selectExpr("concat('k', CAST(id % 3 AS STRING)) AS k", "id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our hint may broadcast
    try:
        assert "BroadcastHashJoin" in plan_of(join_small(big, small, "k"))
        assert "BroadcastHashJoin" not in plan_of(join_small(big, small, "k", max_bytes=10))
        assert join_small(big, small, "k", max_bytes=10).count() == join_small(big, small, "k").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_cli_produce(spark, tmp_path):
    from jobloom.plans.fixtures import career_pages
    from tests.conftest import SF_SMOKE

    pages = str(tmp_path / "pages")
    career_pages(spark, SF_SMOKE).write.parquet(pages)
    out, sink = str(tmp_path / "merged"), str(tmp_path / "topic")
    res = subprocess.run([sys.executable, "-m", "jobloom", "produce", "--pages", pages, "--out", out,
                          "--topic", "jobs", "--sink", sink, "--rows-per-batch", "100"],
                         cwd=ROOT, capture_output=True, text=True, timeout=600,
                         env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"})
    assert res.returncode == 0, res.stderr[-2000:]
    assert "payload message(s)" in res.stdout
    assert spark.read.parquet(out).count() > 0 and spark.read.parquet(sink).count() > 0
