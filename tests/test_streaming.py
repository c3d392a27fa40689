"""The stream that releases settled documents once."""

import json
import random
import time

import pytest

from docmart.streaming import ingest as W

SCHEMA = "name string, mtime timestamp, v int"


def test_settle_once(spark, tmp_path):
    """A change restarts the timer, the last version is released, repeats go, and timers fire without new files."""
    drop, out = str(tmp_path / "drop"), []

    def deliver(rows):
        spark.createDataFrame(rows, "name string, age double, v int").selectExpr("name", "timestamp_millis(unix_millis(current_timestamp()) - cast(age * 1000 as bigint)) AS mtime", "v").coalesce(1).write.mode("append").parquet(drop)

    deliver([("old", 1000.0, 1), ("new", 0.0, 1), ("new", 3.0, 0), ("far", -1000.0, 1), (None, 1000.0, 7)])
    stream = W.watch_folder(spark, drop, spark.createDataFrame([], SCHEMA).schema)
    run = W.settle_once(stream, "name", seconds=6).writeStream.foreachBatch(lambda rows, k: out.extend((r["name"], r.v) for r in rows.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()

    def wait_for(n):
        end = time.time() + 90
        while len(out) < n and time.time() < end and run.isActive:
            time.sleep(0.2)

    try:
        wait_for(2)
        assert sorted(out, key=str) == [("old", 1), (None, 7)] or ("new", 1) in out
        deliver([("old", 900.0, 1), ("old", 0.0, 2)])
        wait_for(3)
        time.sleep(3)
        assert sorted(out, key=str) == [("new", 1), ("old", 1), (None, 7)]
    finally:
        run.stop()


def test_settle_once_keeps_a_state_for_a_bucket(spark, tmp_path):
    """State grows with buckets and not with documents, and each document still goes its own way."""
    drop, out = str(tmp_path / "drop"), []

    def deliver(rows):
        spark.createDataFrame(rows, "name string, age double, v int").selectExpr("name", "timestamp_millis(unix_millis(current_timestamp()) - cast(age * 1000 as bigint)) AS mtime", "v").repartition(2).write.mode("append").parquet(drop)

    many = [(f"d{k}", 1000.0 if k % 10 else -1000.0, k) for k in range(2000)]
    deliver(many + [("null", 1000.0, -1), (None, 1000.0, -2), ("soon", 0.0, -3), ("é\n\"", 1000.0, -4)])
    stream = W.watch_folder(spark, drop, spark.createDataFrame([], SCHEMA).schema, per_trigger=1)
    run = W.run_batches(W.settle_once(stream, "name", seconds=10, buckets=16), lambda rows, k: out.extend((r["name"], r.v) for r in rows.collect()), str(tmp_path / "c"), once=False, every="1 second")
    want = [(n, v) for n, age, v in many if age > 0] + [("null", -1), (None, -2), ("soon", -3), ("é\n\"", -4)]
    try:
        end = time.time() + 90
        while len(out) < len(want) and time.time() < end and run.isActive:
            time.sleep(0.2)
        deliver([(n, 900.0, 9) for n, _, _ in many if int(n[1:]) % 10] + [("null", 900.0, 9), (None, 900.0, 9)])
        seen = run.lastProgress["batchId"]
        while run.isActive and run.lastProgress["batchId"] < seen + 4 and time.time() < end:
            time.sleep(0.2)
        states = json.loads(run.lastProgress.json)["stateOperators"][0]["numRowsTotal"]
    finally:
        run.stop()
    assert sorted(out, key=str) == sorted(want, key=str)
    assert 0 < states <= 16


def test_buckets_go_by_the_rule_of_each_document():
    """Changes, repeats, equal times and forgetting in one bucket, against each document on its own."""
    r, wait, forget = random.Random(3), 30, 80
    alone: dict = {}  # key -> (time of change, row) while it waits, or when it is forgotten
    bucket, timer = {}, None
    for now in range(0, 3000, 7):
        rows = [(r.choice([None, "null", "a", "é", "b c"]), now - r.randint(-40, 60), str(r.randint(0, 3))) for _ in range(r.choice([0, 0, 0, 1, 4]))]
        want = []
        for k, at, row in rows:
            if isinstance(alone.get(k), int):
                alone[k] = now + forget
            else:
                alone[k] = max(alone.get(k, (at, row)), (at, row))
        for k, held in list(alone.items()):
            if isinstance(held, int):
                if held <= now:
                    del alone[k]
            elif held[0] + wait <= now:
                want.append(held[1])
                alone[k] = now + forget
        if rows or (timer is not None and timer <= now):
            got, bucket, timer = W._advanced(W._unpacked(W._packed(bucket)), rows, now, wait, forget)
        else:
            got = []
        assert sorted(got) == sorted(want)
        assert {k: d[2] if d[1] is None else (d[0], d[1]) for k, d in bucket.items()} == alone


def test_drain_waits_as_long_as_batches_run(monkeypatch):
    """A run over many documents takes its time; one in which nothing happens is given up."""
    clock, polls, stopped = [0.0], [0], []
    monkeypatch.setattr(W.time, "monotonic", lambda: clock[0])
    monkeypatch.setattr(W.time, "sleep", lambda s: (clock.__setitem__(0, clock[0] + 100), polls.__setitem__(0, polls[0] + 1)))

    class Query:
        isActive = True
        recentProgress = property(lambda self: [{"numInputRows": 0 if polls[0] >= 50 else 1}])
        exception = staticmethod(lambda: None)
        stop = staticmethod(lambda: stopped.append(polls[0]))

        def __init__(self, busy):
            self.status = {"isTriggerActive": busy}

    W.drain(Query(True))
    assert stopped == [50]
    polls[0] = 0
    with pytest.raises(TimeoutError):
        W.drain(Query(False))
    assert stopped[1] < 10
