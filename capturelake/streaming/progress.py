"""Live feeds as Structured Streaming: marker lines, progress, exposure and attempt ledgers.

State is kept per run by applyInPandasWithState. Each function takes a streaming (or, where no state is
kept, any) DataFrame and returns one; the caller starts the query. Batch twins are in operators.telemetry and operators.runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.markers import parse_shape_marker
from ..operators.telemetry import PHASES

#: Rows of a state's output that are made at once.
SLICE = 1 << 16


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """Complete lines of the log files that appear below ``path``; carriage returns part lines too. The run is the file's name."""
    d = spark.readStream.text(path).select(F.col("value"), F.regexp_extract("_metadata.file_name", r"^([^.]*)", 1).alias("run_id"))
    return d.select("run_id", F.explode(F.split("value", "\r")).alias("line")).where("line <> ''")


def stream_markers(lines: DataFrame, marker: str) -> DataFrame:
    return parse_shape_marker(lines, marker)


def stream_progress(events: DataFrame, stale: str | None = None) -> DataFrame:
    """Accepted events (run_id, seq, iteration): within 1..total and above the run's last accepted iteration.

    With ``stale`` (a watermark delay on ``ts`` set by the caller) nothing changes here; the state is one number a run.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else 0
        t = pd.concat(list(batches)).sort_values("seq", kind="stable")
        keep = []
        for iteration, total in zip(t["iteration"], t["total"], strict=True):
            ok = 1 <= iteration <= total and iteration > last
            last = int(iteration) if ok else last
            keep.append(ok)
        state.update((last,))
        yield t.loc[keep, ["run_id", "seq", "iteration"]]

    d = events.select("run_id", "seq", F.col("iteration").cast("long").alias("iteration"), F.col("total").cast("long").alias("total"))
    return d.groupBy("run_id").applyInPandasWithState(step, "run_id long, seq long, iteration long", "last long", "append", GroupStateTimeout.NoTimeout)


RECORDS = "run_id long, seq long, phase string, iteration long, total long, elapsed_seconds double, returncode long, error_type string"


def stream_records(events: DataFrame) -> DataFrame:
    """Recorded progress of all phases, like ``telemetry.progress_records``: the state of a run is its last recorded iteration.

    events: run_id, seq, phase, iteration, total, elapsed, returncode, error_type; those of one batch are taken in order of ``seq``, those without are dropped.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else 0
        t = pd.concat(list(batches)).sort_values("seq", kind="stable")
        inside = t["phase"].eq("iteration") & t["iteration"].between(1, t["total"])
        valid = t["iteration"].where(inside)
        best = valid.cummax().ffill().shift().fillna(last).clip(lower=last)
        state.update((int(max(last, valid.max())) if inside.any() else last,))
        kept = t[t["phase"].ne("iteration") | (inside & (valid > best))].drop(columns="_group")
        yield kept.astype({n: "Int64" for n in ("run_id", "seq", "iteration", "total", "returncode")})

    c = F.col
    only = lambda phase, name, kind: F.when(c("phase") == phase, c(name)).cast(kind).alias(name)
    elapsed = F.round(F.greatest(F.coalesce(c("elapsed").cast("double"), F.lit(0.0)), F.lit(0.0)), 6)
    d = events.where(c("phase").isin("iteration", *PHASES) & c("seq").isNotNull()).select(c("run_id").cast("long").alias("run_id"), c("seq").cast("long").alias("seq"), "phase", only("iteration", "iteration", "long"), c("total").cast("long").alias("total"), elapsed.alias("elapsed_seconds"), only("child_exited", "returncode", "long"), only("parent_error", "error_type", "string"), c("run_id").alias("_group"))
    return d.groupBy("_group").applyInPandasWithState(step, RECORDS, "last long", "append", GroupStateTimeout.NoTimeout)


def stream_exposure(events: DataFrame) -> DataFrame:
    """Running count of each camera and cameras seen so far (run_id, iteration, camera); out-of-sequence events are marked.

    The state of a run is the next iteration and one count for each of its cameras. A run's new events are held as two numbers each, as they
    must be sorted, and go out in slices of ``SLICE`` rows.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        following, names, counts = state.get if state.exists else (1, [], [])
        code = {name: n for n, name in enumerate(names)}
        parts = []
        for b in batches:
            own, found = pd.factorize(b["camera"], use_na_sentinel=False)
            to = [code.setdefault(None if pd.isna(c) else c, len(code)) for c in found]
            parts.append((b["iteration"].astype("int64").to_numpy(), np.array(to, np.int32)[own]))
        at, camera = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(at, kind="stable")
        at, camera = at[order], camera[order]
        total = np.bincount(camera, minlength=len(code))
        before = np.zeros(len(code), np.int64)
        before[: len(counts)] = counts
        by = np.argsort(camera, kind="stable")
        count = np.empty(len(at), np.int64)
        count[by] = np.arange(1, len(at) + 1) - (np.cumsum(total) - total - before)[camera[by]]
        seen = len(names) + np.cumsum(count == 1)
        good = at == np.append(following, at[:-1] + 1)
        state.update((int(at[-1]) + 1, list(code), (before + total).tolist()))
        label = np.array([*code, ""], object)[:-1]
        for lo in range(0, len(at), SLICE):
            one = slice(lo, lo + SLICE)
            yield pd.DataFrame({"run_id": key[0], "iteration": at[one], "camera": label[camera[one]], "exposure_count": count[one], "cumulative_unique_count": seen[one], "in_sequence": good[one]})

    d = events.select("run_id", F.col("iteration").cast("long").alias("iteration"), "camera")
    kind = "run_id long, iteration long, camera string, exposure_count long, cumulative_unique_count long, in_sequence boolean"
    return d.groupBy("run_id").applyInPandasWithState(step, kind, "next long, names array<string>, counts array<long>", "append", GroupStateTimeout.NoTimeout)


def stream_heartbeat(events: DataFrame, minutes: int = 15) -> DataFrame:
    """Last event time of each run in sliding event-time windows; a run without a row in the newest window is silent."""
    return events.withWatermark("ts", f"{minutes} minutes").groupBy(F.window("ts", f"{minutes} minutes"), "run_id").agg(F.max("ts").alias("last_seen"), F.count("*").alias("events"))


def stream_orphans(requests: DataFrame, results: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Requests with their result's status, null once the watermark passes without one: run_id, stage, attempt, started_at, status."""
    a = requests.withWatermark("started_at", delay).alias("a")
    b = results.withWatermark("finished_at", delay).alias("b")
    same = F.expr(f"a.run_id = b.run_id AND a.stage = b.stage AND a.attempt = b.attempt AND b.finished_at BETWEEN a.started_at AND a.started_at + INTERVAL {delay}")
    return a.join(b, same, "left_outer").select("a.run_id", "a.stage", "a.attempt", "a.started_at", "b.status")


def progress_snapshot(accepted: DataFrame, path: str, checkpoint: str):
    """Start a query that keeps the latest iteration of each run as a small Parquet table at ``path``."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.groupBy("run_id").agg(F.max("iteration").alias("iteration"))
        if number:
            new = spark.read.parquet(f"{path}/{number - 1}").unionByName(new).groupBy("run_id").agg(F.max("iteration").alias("iteration"))
        new.write.mode("overwrite").parquet(f"{path}/{number}")

    return accepted.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
