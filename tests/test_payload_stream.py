"""Parquet payloads in messages and the streaming consumer."""

import io
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from jobloom.operators.enrich import enrich_payload_rows
from jobloom.plans import payload as PL
from jobloom.sources import messages as MSG
from jobloom.streaming.consumer import ConsumerConfig, consume, process_batch

SCHEMA = "topic string, partition int, offset long, key binary, value binary"


def parquet_bytes(table: pa.Table) -> bytes:
    buf = io.BytesIO()
    pq.write_table(table, buf)
    return buf.getvalue()


def msg_df(spark, values):
    return spark.createDataFrame([("jobs", 0, i, b"k", v) for i, v in enumerate(values)], SCHEMA)


def test_pack_unpack_round_trip(spark):
    rows = spark.createDataFrame([(b, i, f"T{b}-{i}") for b in range(3) for i in range(1, 5)],
                                 "batch_no long, Index long, `Position title` string")
    packed = PL.pack_payloads(rows, ["batch_no"], ["Index", "Position title"])
    assert sorted((r["batch_no"], r["n_rows"]) for r in packed.collect()) == [(0, 4), (1, 4), (2, 4)]
    back = PL.unpack_payloads(packed, ["Index", "Position title"], keep=["batch_no"])
    assert sorted(map(tuple, back.select("batch_no", "Index", "Position title").collect())) == \
        sorted(map(tuple, rows.collect()))
    one = pq.read_table(io.BytesIO(packed.filter("batch_no = 0").collect()[0]["value"]))
    assert one.column_names == ["Index", "Position title"] and one.schema.field("Index").type == pa.int64()


def test_scored_payloads_stay_and_descriptions_count(spark):
    raw = pa.table({"Index": [4], "Position title": ["Accountant"], "job_description": ["Head of payroll, 12 years, SQL and Excel"]})
    bare = raw.drop_columns(["job_description"])
    kept = pa.table({"Index": [4], "Position title": ["Accountant"], "complexity_score": pa.array([3], pa.int32()),
                     "category": ["Anything"], "seniority_level": [None]})
    out = enrich_payload_rows(PL.unpack_payloads(msg_df(spark, [parquet_bytes(t) for t in (raw, bare, kept)]))).orderBy("offset").collect()
    assert [r["enriched_before"] for r in out] == [False, False, True]
    assert out[0]["complexity_score"] > out[1]["complexity_score"]
    assert (out[2]["complexity_score"], out[2]["category"], out[2]["seniority_level"]) == (3, "Anything", None)


def test_payload_without_key_columns_fails(spark):
    for names in (["Index", "title"], ["Position title", "job_description"]):
        bad = parquet_bytes(pa.table({n: [1] if n == "Index" else ["v"] for n in names}))
        with pytest.raises(Exception, match="needs Index and Position title"):
            enrich_payload_rows(PL.unpack_payloads(msg_df(spark, [bad]))).collect()


def test_row_counts_and_empty_messages(spark):
    ok = parquet_bytes(pa.table({"Index": [1, 2], "Position title": ["a", "b"]}))
    df = msg_df(spark, [ok, b"not a parquet file", b"", None])
    counts = [r["n_rows"] for r in PL.payload_row_counts(df).orderBy("offset").collect()]
    assert counts == [2, None, None, None]
    assert MSG.nonempty_messages(df).count() == 2


def _write_messages(spark, path, values, start=0):
    spark.createDataFrame([("jobs", 0, start + i, b"k", v, None) for i, v in enumerate(values)],
                          SCHEMA + ", timestamp timestamp").write.mode("append").parquet(path)


def test_consumer_stream_equals_batch_and_replay_is_idempotent(spark, tmp_path):
    payloads = [parquet_bytes(pa.table({"Index": [1, 2], "Position title": [f"Senior Dev {i}", "Intern"]}))
                for i in range(3)]
    inp = str(tmp_path / "in")
    _write_messages(spark, inp, payloads + [b""])
    cfg = ConsumerConfig(output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "ck"),
                         failures_path=str(tmp_path / "fail"))
    consume(spark, MSG.read_messages(spark, path=inp), cfg)
    stored = spark.read.parquet(cfg.output_path)
    assert stored.count() == 6
    expected = enrich_payload_rows(PL.unpack_payloads(MSG.read_messages(spark, path=inp, stream=False)))
    cols = ["partition", "offset", "Index", "complexity_score", "category", "seniority_level"]
    assert sorted(map(tuple, stored.select(*cols).collect())) == sorted(map(tuple, expected.select(*cols).collect()))
    # replaying the same micro-batch overwrites its own output: no duplicates
    process_batch(MSG.read_messages(spark, path=inp, stream=False), cfg, epoch_id=0)
    assert spark.read.parquet(cfg.output_path).count() == 6
    # a restart with the checkpoint reads only new messages
    _write_messages(spark, inp, payloads[:1], start=10)
    consume(spark, MSG.read_messages(spark, path=inp), cfg)
    assert spark.read.parquet(cfg.output_path).count() == 8


def test_a_new_checkpoint_never_overwrites_other_messages(spark, tmp_path):
    out = str(tmp_path / "out")
    for run, start in enumerate((0, 10)):  # both streams begin with epoch 0
        inp = str(tmp_path / f"in{run}")
        _write_messages(spark, inp, [parquet_bytes(pa.table({"Index": [1], "Position title": ["x"]}))] * 3, start=start)
        consume(spark, MSG.read_messages(spark, path=inp), ConsumerConfig(output_path=out, checkpoint_path=str(tmp_path / f"ck{run}")))
    assert sorted(r["offset"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 10, 11, 12]
    with pytest.raises(ValueError, match="checkpoint"):
        consume(spark, MSG.read_messages(spark, path=inp), ConsumerConfig(output_path=out))


def test_every_message_is_stored(spark, tmp_path):
    empty = parquet_bytes(pa.table({"Index": pa.array([], pa.int64()), "Position title": pa.array([], pa.string())}))
    done = parquet_bytes(pa.table({"Index": [1], "Position title": ["x"], "salary": [5], "complexity_score": pa.array([9], pa.int32()),
                                   "category": ["Design"], "seniority_level": ["Mid"]}))
    fresh = parquet_bytes(pa.table({"Index": [1, 2], "Position title": ["x", "y"]}))
    cfg = ConsumerConfig(output_path=str(tmp_path / "out"))
    process_batch(msg_df(spark, [empty, done, fresh, b""]), cfg)
    stored = {r["offset"]: r for r in spark.read.parquet(str(tmp_path / "out-messages")).collect()}
    assert {o: (r["n_rows"], r["enriched_before"]) for o, r in stored.items()} == {0: (0, False), 1: (1, True), 2: (2, False)}
    assert bytes(stored[1]["value"]) == done and stored[2]["value"] is None  # scored before: kept as it came, with all its columns
    assert spark.read.parquet(cfg.output_path).count() == 3


def test_all_bad_messages_are_recorded(spark, tmp_path):
    cfg = ConsumerConfig(output_path=str(tmp_path / "out"), failures_path=str(tmp_path / "fail"))
    lacking = parquet_bytes(pa.table({"Index": pa.array([], pa.int64())}))
    with pytest.raises(Exception, match="150 message"):
        process_batch(msg_df(spark, [b"junk"] * 149 + [lacking]), cfg)
    assert sorted(r["offset"] for r in spark.read.parquet(cfg.failures_path).collect()) == list(range(150))


def test_consumer_fail_stop_records_failure(spark, tmp_path):
    inp = str(tmp_path / "in")
    _write_messages(spark, inp, [b"garbage"])
    cfg = ConsumerConfig(output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "ck"),
                         failures_path=str(tmp_path / "fail"))
    with pytest.raises(Exception, match="not producer payloads"):
        consume(spark, MSG.read_messages(spark, path=inp), cfg)
    fails = spark.read.parquet(cfg.failures_path)
    assert [(r["kind"], r["offset"]) for r in fails.collect()] == [("message", 0)]  # recorded once
    assert not os.path.exists(cfg.output_path)


@pytest.mark.parametrize("layout", ["message", "batch"])
def test_consumer_without_enrichment_stores_values_as_they_came(spark, tmp_path, layout):
    values = [parquet_bytes(pa.table({"any": [1]})), b"not parquet at all", b"\x00\xff"]
    cfg = ConsumerConfig(output_path=str(tmp_path / "out"), messages_path=str(tmp_path / "raw"), enrich=False, layout=layout)
    process_batch(msg_df(spark, values + [b""]), cfg)
    stored = sorted((r["offset"], bytes(r["value"]), r["object_name"]) for r in spark.read.parquet(cfg.messages_path).collect())
    assert [v for _, v, _ in stored] == values and all(n.endswith("_k.parquet") for *_, n in stored)


def test_consumer_several_micro_batches(spark, tmp_path):
    inp = str(tmp_path / "in")
    for f in range(3):  # three files -> three epochs with maxFilesPerTrigger=1
        _write_messages(spark, inp, [parquet_bytes(pa.table({"Index": [1, 2, 3], "Position title": ["a", "b", "c"]}))],
                        start=10 * f)
    cfg = ConsumerConfig(output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "ck"))
    consume(spark, MSG.read_messages(spark, path=inp, max_files_per_trigger=1), cfg)
    out = spark.read.parquet(cfg.output_path)
    assert sorted(r[0] for r in out.select("first_message").distinct().collect()) == ["0-0", "0-10", "0-20"]
    assert sorted(r[0] for r in out.select("offset").distinct().collect()) == [0, 10, 20]
    assert out.count() == 9
