"""Live state and silence alerts of runs: a feed that stops, a restart, a new checkpoint."""

import time

import pytest
from pyspark.sql import functions as F

from capturelake.streaming import monitor

EVENTS = "run_id string, seq long, ts timestamp, stage string, iteration long, total long"


@pytest.fixture
def timers(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set(name, before)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def add(spark, path, n, rows):
    d = spark.createDataFrame([(r, s, t, g, i, k) for r, s, t, g, i, k in rows], "run_id string, seq long, t double, stage string, iteration long, total long")
    d.select("run_id", "seq", F.timestamp_micros((F.col("t") * 1e6).cast("long")).alias("ts"), "stage", "iteration", "total").coalesce(1).write.parquet(f"{path}/{n}")


def until(check, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if check():
            return
        time.sleep(0.3)
    raise AssertionError("it did not come about")


FIRST = [("a", 1, 100.0, "train", 1, 10), ("a", 2, 101.0, "train", 3, 10), ("a", 3, 102.0, "train", 2, 10), ("b", 1, 50.0, "load", None, None), ("b", 2, 60.0, "train", 11, 10), (None, 1, 1.0, "x", 1, 1), ("c", 1, None, "x", 1, 1)]
SECOND = [("a", 4, 110.0, "train", 7, 10), ("a", 5, 120.0, "render", 1, 4), ("a", 6, 120.0, "render", 2, 4)]


def test_alerts_and_restart(spark, tmp_path, timers):
    feed, table, checkpoint = f"{tmp_path}/feed", f"{tmp_path}/table", f"{tmp_path}/check"
    add(spark, feed, 0, FIRST)
    source = lambda: spark.readStream.schema(EVENTS).option("recursiveFileLookup", True).parquet(feed)
    begin = lambda where: monitor.snapshot(monitor.monitor_runs(source(), silence_sec=3.0), table, where, {"processingTime": "500 milliseconds"})
    now = lambda: {r.run_id: r for r in monitor.read_snapshot(spark, table).collect()}
    query = begin(checkpoint)
    try:
        until(lambda: set(now()) == {"a", "b"})
        # Nothing more comes: both runs are reported once by their timers alone.
        until(lambda: {r.kind for r in now().values()} == {"silent"})
        a = now()["a"]
        assert (a.stage, a.iteration, a.total, a.elapsed_sec, a.stage_elapsed_sec, a.accepted, a.refused) == ("train", 3, 10, 2.0, 2.0, 2, 1) and a.silent_sec >= 3.0
        b = now()["b"]
        assert (b.stage, b.iteration, b.total, b.elapsed_sec, b.stage_elapsed_sec, b.accepted, b.refused) == ("train", None, None, 10.0, 0.0, 0, 1)
    finally:
        query.stop()
    # A restart goes on from the state; a run that is heard again is no longer silent, the other stays as it was.
    add(spark, feed, 1, SECOND)
    query = begin(checkpoint)
    try:
        until(lambda: now()["a"].kind == "progress")
        a = now()["a"]
        assert (a.stage, a.iteration, a.total, a.run_started, a.elapsed_sec, a.stage_elapsed_sec, a.accepted, a.refused) == ("render", 2, 4, 100.0, 20.0, 0.0, 5, 1)
        assert now()["b"].updated_ms == b.updated_ms
        until(lambda: now()["a"].kind == "silent")
    finally:
        query.stop()
    assert len(monitor.versions(spark, table)) <= 2
    # A new checkpoint reads the feed anew and finds the table there.
    before = monitor.versions(spark, table)[-1]
    query = begin(f"{tmp_path}/other")
    try:
        until(lambda: monitor.versions(spark, table)[-1] > before and now()["a"].kind == "progress")
        assert set(now()) == {"a", "b"}
    finally:
        query.stop()
    twin = {r.run_id: r for r in monitor.current_runs(spark.read.schema(EVENTS).option("recursiveFileLookup", True).parquet(feed)).collect()}
    got = now()
    for r, t in twin.items():
        assert all(getattr(got[r], f) == getattr(t, f) for f in ("stage", "iteration", "total", "run_started", "stage_started", "last_event", "elapsed_sec", "stage_elapsed_sec", "accepted", "refused")), (got[r], t)
    assert set(twin) == {"a", "b"}


def test_snapshot_of_nothing(spark, tmp_path):
    assert monitor.read_snapshot(spark, f"{tmp_path}/none").count() == 0 and monitor.versions(spark, f"{tmp_path}/none") == []
    assert monitor.current_runs(spark.createDataFrame([], EVENTS)).count() == 0
