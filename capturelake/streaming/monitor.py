"""Current state of every run and alerts for silent ones, from a live feed of progress events.

One stateful processor for each run keeps its stage, last accepted iteration, start times and a processing-time timer. Each batch with
events of a run gives one row of its current state; a run that sends nothing for ``silence_sec`` gives one alert by the timer, without any
event, and another only after it has been heard again. State that isn't touched for ``keep_days`` goes. ``snapshot`` keeps the latest row of each
run as a small table.

The caller sets ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, which timers need.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROWS = "run_id string, kind string, stage string, iteration long, total long, run_started double, stage_started double, last_event double, elapsed_sec double, stage_elapsed_sec double, accepted long, refused long, silent_sec double, updated_ms long"
_STATE = "stage string, iteration long, total long, run_started double, stage_started double, last_event double, accepted long, refused long, heard_ms long, timer_ms long"
_FIELDS = [f.split(" ")[0] for f in _STATE.split(", ")]


class RunMonitor(StatefulProcessor):
    """State of one run. Events: stage, iteration, total, at (seconds), seq; those of a batch are taken in order of (at, seq)."""

    def __init__(self, silence_sec: float, keep_days: float):
        self.silence_ms, self.ttl = int(silence_sec * 1000), timedelta(days=keep_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", _STATE, int(self.ttl.total_seconds() * 1000))

    def _row(self, key, kind: str, s: dict, now: int, silent: float | None) -> pd.DataFrame:
        row = {"run_id": key[0], "kind": kind, **{f: s[f] for f in ("stage", "iteration", "total", "run_started", "stage_started", "last_event", "accepted", "refused")}, "elapsed_sec": s["last_event"] - s["run_started"], "stage_elapsed_sec": s["last_event"] - s["stage_started"], "silent_sec": silent, "updated_ms": now}
        names = [f.split(" ")[0] for f in ROWS.split(", ")]
        return pd.DataFrame([[row[n] for n in names]], columns=names).astype({n: "Int64" for n in ("iteration", "total")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        t = pd.concat(list(rows)).sort_values(["at", "seq"], kind="stable")
        found = self.state.get() if self.state.exists() else None
        s = dict(zip(_FIELDS, found, strict=True)) if found else None
        for stage, iteration, total, at in zip(t["stage"], t["iteration"], t["total"], t["at"], strict=True):
            if s is None:
                s = {"stage": stage, "iteration": None, "total": None, "run_started": at, "stage_started": at, "last_event": at, "accepted": 0, "refused": 0, "heard_ms": 0, "timer_ms": 0}
            if stage != s["stage"]:
                s |= {"stage": stage, "iteration": None, "total": None, "stage_started": at}
            s["last_event"] = max(s["last_event"], at)
            # An event without an iteration tells the stage only.
            if not pd.isna(iteration):
                ok = not pd.isna(total) and 1 <= iteration <= total and iteration > (s["iteration"] or 0)
                s |= {"iteration": int(iteration), "total": int(total)} if ok else {}
                s["accepted" if ok else "refused"] += 1
        now = timerValues.getCurrentProcessingTimeInMs()
        if s["timer_ms"] > 0:
            self.handle.deleteTimer(s["timer_ms"])
        s |= {"heard_ms": now, "timer_ms": now + self.silence_ms}
        self.handle.registerTimer(s["timer_ms"])
        self.state.update(tuple(s[f] for f in _FIELDS))
        yield self._row(key, "progress", s, now, None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        s = dict(zip(_FIELDS, self.state.get(), strict=True))
        now = timerValues.getCurrentProcessingTimeInMs()
        self.state.update(tuple((s | {"timer_ms": 0})[f] for f in _FIELDS))
        yield self._row(key, "silent", s, now, (now - s["heard_ms"]) / 1000.0)

    def close(self) -> None:
        pass


def monitor_runs(events: DataFrame, silence_sec: float = 900.0, keep_days: float = 7.0) -> DataFrame:
    """Rows of each run's current state and of alerts (``kind`` progress or silent), as a stream in update mode.

    events: run_id, seq, ts, stage, iteration, total. An iteration counts if it lies in 1..total and above the stage's last one; a new stage begins
    anew. ``elapsed_sec`` and ``stage_elapsed_sec`` run from the first event to the last, ``silent_sec`` is processing time. A null run or time has no
    row. A run that is heard again after its state went is a new run.
    """
    d = events.where("run_id IS NOT NULL AND ts IS NOT NULL").select(F.col("run_id").cast("string").alias("run_id"), F.col("seq").cast("long").alias("seq"), (F.unix_micros("ts") / 1e6).alias("at"), "stage", F.col("iteration").cast("double").alias("iteration"), F.col("total").cast("double").alias("total"))
    return d.groupBy("run_id").transformWithStateInPandas(RunMonitor(silence_sec, keep_days), ROWS, "Update", "ProcessingTime")


def current_runs(events: DataFrame) -> DataFrame:
    """The batch twin: each run's state after all its events, without alerts."""
    from pyspark.sql import Window

    d = events.where("run_id IS NOT NULL AND ts IS NOT NULL").withColumn("at", F.unix_micros("ts") / 1e6)
    order = Window.partitionBy("run_id").orderBy("at", "seq")
    d = d.withColumn("new", F.coalesce(~F.col("stage").eqNullSafe(F.lag("stage").over(order)), F.lit(True)) | (F.row_number().over(order) == 1))
    d = d.withColumn("part", F.sum(F.col("new").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    within = Window.partitionBy("run_id", "part").orderBy("at", "seq").rowsBetween(Window.unboundedPreceding, -1)
    valid = F.coalesce((F.col("iteration") >= 1) & (F.col("iteration") <= F.col("total")), F.lit(False))
    # The greatest valid iteration so far is the last accepted one.
    d = d.withColumn("valid", valid).withColumn("accepted", F.col("valid") & (F.col("iteration") > F.coalesce(F.max(F.when(F.col("valid"), F.col("iteration"))).over(within), F.lit(0))))
    stages = d.groupBy("run_id", "part").agg(F.first("stage").alias("stage"), F.min("at").alias("stage_started"), F.max_by(F.struct("iteration", "total"), F.when(F.col("accepted"), F.col("iteration"))).alias("last"), F.count_if("accepted").alias("accepted"), F.count_if(F.col("iteration").isNotNull() & ~F.col("accepted")).alias("refused"), F.min("at").alias("first"), F.max("at").alias("last_event"))
    runs = stages.groupBy("run_id").agg(F.max_by(F.struct("stage", "stage_started", "last"), "part").alias("now"), F.min("first").alias("run_started"), F.max("last_event").alias("last_event"), F.sum("accepted").alias("accepted"), F.sum("refused").alias("refused"))
    return runs.select(F.col("run_id").cast("string").alias("run_id"), "now.stage", F.col("now.last.iteration").cast("long").alias("iteration"), F.col("now.last.total").cast("long").alias("total"), "run_started", "now.stage_started", "last_event", (F.col("last_event") - F.col("run_started")).alias("elapsed_sec"), (F.col("last_event") - F.col("now.stage_started")).alias("stage_elapsed_sec"), "accepted", "refused")


def _store(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[str]:
    """Whole versions of a snapshot, the oldest first."""
    fs, p = _store(spark, path)
    if not fs.exists(p(path)):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p(path)) if s.isDirectory())
    return [n for n in names if n.startswith("v") and fs.exists(p(f"{path}/{n}/_SUCCESS"))]


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of each run; none before the first version."""
    found = versions(spark, path)
    return spark.read.schema(ROWS).parquet(f"{path}/{found[-1]}") if found else spark.createDataFrame([], ROWS)


def snapshot(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Start a query that keeps the latest row of each run at ``path`` (read it by ``read_snapshot``).

    A version is a folder that counts from its _SUCCESS file on. The next one merges the newest and the batch; then older ones than that go, so
    a reader of the one before still has its files. The newest version is found in the store and not by the batch number, so a
    new checkpoint goes on with the same table, and a batch that runs twice merges to the same rows.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found = versions(spark, path)
        every = batch
        if found:
            every = spark.read.schema(ROWS).parquet(f"{path}/{found[-1]}").unionByName(batch)
        names = [c for c in every.columns if c != "run_id"]
        latest = every.groupBy("run_id").agg(F.max_by(F.struct(*names), F.struct("updated_ms", "kind")).alias("r")).select("run_id", *[f"r.{n}" for n in names])
        if batch.isEmpty():
            return
        following = int(found[-1][1:13]) + 1 if found else 0
        latest.write.parquet(f"{path}/v{following:012d}-{uuid.uuid4().hex[:8]}")
        fs, p = _store(spark, path)
        for name in found[:-1]:
            fs.delete(p(f"{path}/{name}"), True)

    writer = rows.writeStream.foreachBatch(merge).outputMode("update").option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
