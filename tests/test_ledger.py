"""The offset ledger: one copy of each message over runs, failures, merges; bounded runs; records of failed queries."""

import time

import pytest

from jobloom.plans.jobs import consume_job
from jobloom.sources import messages as MSG
from jobloom.streaming import consumer as C
from jobloom.streaming import ledger as L
from jobloom.streaming.consumer import ConsumerConfig, consume, process_batch
from jobloom.streaming.failures import FailureListener

SCHEMA = "topic string, partition int, offset long, key binary, value binary, timestamp timestamp"


def _batch(spark, coords, topic="jobs"):
    return spark.createDataFrame([(topic, p, o, b"k", f"{p}:{o}".encode(), None) for p, o in coords], SCHEMA)


def _config(tmp_path, run, **more):
    return ConsumerConfig(output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / f"ck-{run}"), enrich=False, **more)


def _stored(spark, cfg):
    return sorted((r["topic"], r["partition"], r["offset"], bytes(r["value"])) for r in spark.read.parquet(cfg.messages_path).collect())


def _expected(*coords, topic="jobs"):
    return sorted((topic, p, o, f"{p}:{o}".encode()) for p, o in set(coords))


def test_another_run_with_other_batches_keeps_every_message(spark, tmp_path):
    a = [(0, 0), (0, 1), (1, 0), (1, 1)]
    process_batch(_batch(spark, a), _config(tmp_path, "a"))
    b = [(0, 0), (1, 5)]
    process_batch(_batch(spark, b), _config(tmp_path, "b"))
    assert _stored(spark, _config(tmp_path, "b")) == _expected(*a, *b)
    c = [(0, 3), (1, 5), (1, 2), (1, 3), (0, 3)]  # between stored offsets, and one message twice
    process_batch(_batch(spark, c), _config(tmp_path, "c"))
    process_batch(_batch(spark, [(0, 0)], topic="other"), _config(tmp_path, "c"))
    assert _stored(spark, _config(tmp_path, "c")) == sorted(_expected(*a, *b, *c) + _expected((0, 0), topic="other"))


@pytest.mark.parametrize("fails", ["before", "after"])
def test_a_batch_cut_off_leaves_nothing_behind(spark, tmp_path, monkeypatch, fails):
    cfg = _config(tmp_path, "a")
    process_batch(_batch(spark, [(0, 0), (0, 1)]), cfg)

    def broken(*a, **k):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        if fails == "before":
            m.setattr(C, "store_messages", broken)
        else:
            m.setattr(L.Ledger, "finish", broken)
        with pytest.raises(RuntimeError):
            process_batch(_batch(spark, [(0, o) for o in range(2, 9)]), cfg)
    process_batch(_batch(spark, [(0, 0), (0, 3), (0, 4)]), _config(tmp_path, "b"))
    assert _stored(spark, cfg) == _expected((0, 0), (0, 1), (0, 3), (0, 4))
    process_batch(_batch(spark, [(0, o) for o in range(2, 9)]), cfg)
    assert _stored(spark, cfg) == _expected(*((0, o) for o in range(9)))


def test_merged_ledgers_say_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "MERGE_AT", 2)
    cfg = _config(tmp_path, "a")
    for k in range(5):
        process_batch(_batch(spark, [(0, 2 * k), (0, 2 * k + 1), (1, 10 * k)]), cfg)
    ledger = L.Ledger(spark, cfg.ledger_path)
    assert len(ledger.stored_folders()) <= 2 and ledger.stored_count(cfg.run) == 15
    # as if the run had ended between writing the merged copy and dropping the others
    with monkeypatch.context() as m:
        m.setattr(L.Ledger, "_drop", lambda *a: None)
        ledger.merge(ledger.stored_folders())
    assert ledger.stored_count(cfg.run) == 15
    ledger._fs.delete(ledger._path(f"{ledger.stored_folders()[0]}/{L.MARK}"), True)  # a folder whose removal stopped half-way
    process_batch(_batch(spark, [(0, o) for o in range(12)] + [(1, 40), (1, 41)]), cfg)
    assert _stored(spark, cfg) == _expected(*((0, o) for o in range(12)), *((1, 10 * k) for k in range(5)), (1, 41))


@pytest.mark.parametrize("layout", ["batch", "message"])
def test_exactly_n_messages_over_batches_and_a_restart(spark, tmp_path, layout):
    inp = str(tmp_path / "in")
    for f in range(4):
        batch = _batch(spark, [(0, 10 * f + i) for i in range(3)]).unionByName(
            spark.createDataFrame([("jobs", 0, 10 * f + 5, b"k", b"", None)], SCHEMA))  # an empty one does not count
        batch.coalesce(1).write.mode("append").parquet(inp)
        time.sleep(0.05)  # files are read in the order of their times

    def run(n):
        cfg = _config(tmp_path, "a", max_messages=n, layout=layout, failures_path=str(tmp_path / "fail"))
        consume(spark, MSG.read_messages(spark, path=inp, max_files_per_trigger=1), cfg)
        return [o for _, _, o, _ in _stored(spark, cfg)]

    assert run(2) == [0, 1]
    assert run(2) == [0, 1]
    assert run(7) == [0, 1, 2, 10, 11, 12, 20]
    assert run(9) == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    assert run(100) == [0, 1, 2, 10, 11, 12, 20, 21, 22, 30, 31, 32]
    assert not (tmp_path / "fail").exists()


def test_failed_queries_leave_one_record(spark, tmp_path, monkeypatch):
    def records(name):
        return [(r["kind"], r["message"]) for r in spark.read.parquet(str(tmp_path / name)).collect()]

    inp = str(tmp_path / "in")
    _batch(spark, [(0, 0)]).write.parquet(inp)

    def broken(*a, **k):
        raise RuntimeError("broker is gone")

    monkeypatch.setattr(C, "process_batch", broken)
    cfg = _config(tmp_path, "a", failures_path=str(tmp_path / "seen"))
    with pytest.raises(Exception, match="broker is gone"):
        consume(spark, MSG.read_messages(spark, path=inp), cfg)
    found = records("seen")
    assert len(found) == 1 and found[0][0] == "query"

    # a query that nobody waits for
    listener = FailureListener(spark, str(tmp_path / "unseen"))
    spark.streams.addListener(listener)
    try:
        query = MSG.read_messages(spark, path=inp).writeStream.foreachBatch(broken).option("checkpointLocation", str(tmp_path / "ck2")).start()
        for _ in range(300):
            if listener.ended.get(str(query.runId)) and listener.ended[str(query.runId)].is_set():
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert str(query.runId) in listener.started
    found = records("unseen")
    assert len(found) == 1 and found[0][0] == "query"


def test_startup_failures_are_recorded(spark, tmp_path):
    for k, settings in enumerate([{"kafka": {"bootstrap_servers": ""}, "topic": "t"}, {"kafka": {"bootstrap_servers": "x:1"}, "topic": " "}, {}]):
        path = str(tmp_path / f"fail{k}")
        with pytest.raises(Exception):  # noqa: B017
            consume_job(spark, out_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "ck"), failures_path=path, **settings)
        assert [r["kind"] for r in spark.read.parquet(path).collect()] == ["startup"]
