"""Frame selection and its evidence, for many videos at once: the key is ``video_id``."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.staging import scene_join, staged

FRAME_ORDER = ("timestamp_sec", "frame_index", "frame_id")


def scored_frames(frames: DataFrame, max_over: float = 0.35, max_under: float = 0.35, duplicate_threshold: int = 2) -> DataFrame:
    """quality_score, reasons and eligible for each frame; columns that frames lack count as missing."""
    have = lambda n: F.col(n) if n in frames.columns else F.lit(None)
    score = X.frame_quality_score(have("sharpness").cast("double"), have("overexposed_ratio").cast("double"), have("underexposed_ratio").cast("double"), have("motion_score").cast("double"), have("coverage_score").cast("double"))
    reasons = X.hard_reject_reasons(have("reject_reasons").cast("array<string>"), have("overexposed_ratio").cast("double"), have("underexposed_ratio").cast("double"), have("duplicate_score").cast("int"), max_over, max_under, duplicate_threshold)
    d = frames.withColumn("quality_score", score).withColumn("reasons", reasons)
    path = F.col("path").isNotNull() if "path" in frames.columns else F.lit(True)
    return d.withColumn("eligible", (F.size("reasons") == 0) & path)


def previous_frame_delta(frames: DataFrame) -> DataFrame:
    """Time since the frame before, and change of its sharpness."""
    w = Window.partitionBy("video_id").orderBy(*FRAME_ORDER)
    return frames.withColumn("gap_sec", F.col("timestamp_sec") - F.lag("timestamp_sec").over(w)).withColumn("sharpness_delta", F.abs(F.col("sharpness") - F.lag("sharpness").over(w)))


def selection_gaps(selected: DataFrame, durations: DataFrame, key: str = "video_id") -> DataFrame:
    """Greatest internal and boundary gap of the selected frames; durations: (key, duration_sec)."""
    w = Window.partitionBy(key).orderBy("timestamp_sec")
    d = selected.withColumn("gap", F.col("timestamp_sec") - F.lag("timestamp_sec").over(w))
    d = d.groupBy(key).agg(F.count("*").alias("selected_count"), F.coalesce(F.max("gap"), F.lit(0.0)).alias("max_internal_gap_sec"), F.min("timestamp_sec").alias("first"), F.max("timestamp_sec").alias("last"))
    d = durations.join(d, key, "left").withColumn("selected_count", F.coalesce("selected_count", F.lit(0)))
    boundary = F.coalesce(F.greatest(F.col("first"), F.greatest(F.lit(0.0), F.col("duration_sec") - F.col("last"))), F.lit(0.0))
    d = d.withColumn("max_boundary_gap_sec", boundary).withColumn("max_internal_gap_sec", F.coalesce("max_internal_gap_sec", F.lit(0.0)))
    return d.withColumn("max_time_gap_sec", F.greatest("max_internal_gap_sec", "max_boundary_gap_sec")).drop("first", "last")


def segment_quality(frames: DataFrame, windows: DataFrame, max_gap_sec: float) -> DataFrame:
    """Counts, greatest gap with both ends and failure reasons of each (video_id, segment_id).

    ``frames`` has selected and bridge flags; ``windows`` (video_id, segment_id, start_sec, end_sec) lists all segments.
    """
    key = ["video_id", "segment_id"]
    w = Window.partitionBy(*key).orderBy("timestamp_sec")
    gaps = frames.where("selected").withColumn("gap", F.col("timestamp_sec") - F.lag("timestamp_sec").over(w)).groupBy(*key).agg(F.max("gap").alias("gap"), F.min("timestamp_sec").alias("first"), F.max("timestamp_sec").alias("last"))
    counts = frames.groupBy(*key).agg(F.count("*").alias("total_frames"), F.count_if("selected").alias("selected_frames"), F.count_if(~F.col("selected")).alias("rejected_frames"), F.count_if(F.col("selected") & F.col("bridge")).alias("bridge_frames"))
    d = windows.join(counts, key, "left").join(gaps, key, "left").fillna(0, ["total_frames", "selected_frames", "rejected_frames", "bridge_frames"])
    gap = F.coalesce(F.greatest(F.col("gap"), F.col("first") - F.col("start_sec"), F.col("end_sec") - F.col("last")), F.lit(0.0))
    d = d.withColumn("max_selected_gap_sec", F.bround(gap, 3)).withColumn("component_count", F.when(F.col("selected_frames") > 0, 1).otherwise(0))
    reasons = X.violations(no_selected_frames=F.col("selected_frames") == 0, max_selected_gap_sec=F.col("max_selected_gap_sec") > max_gap_sec)
    return d.select(*key, "total_frames", "selected_frames", "rejected_frames", "bridge_frames", "component_count", "max_selected_gap_sec", reasons.alias("failed_reasons"))


def video_quality_rollup(segments: DataFrame) -> DataFrame:
    """Sums and maxima over a video's segments, its failed segments and status."""
    failed = F.sort_array(F.collect_list(F.when(F.size("failed_reasons") > 0, F.col("segment_id"))))
    d = segments.groupBy("video_id").agg(F.sum("selected_frames").alias("selected_frames"), F.sum("bridge_frames").alias("bridge_frames"), F.max("component_count").alias("component_count"), F.max("max_selected_gap_sec").alias("max_selected_gap_sec"), failed.alias("failed_segments"))
    return d.withColumn("status", F.when(F.size("failed_segments") > 0, "failed").otherwise("passed"))


def reject_reason_counts(frames: DataFrame) -> DataFrame:
    return frames.select("video_id", F.explode("reasons").alias("reason")).groupBy("video_id", "reason").agg(F.count("*").alias("frames"))


def dense_reindex(rows: DataFrame, key: list[str], order: list[str], name: str = "new_index") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)


def dense_positions(rows: DataFrame, key: str, width: int = 4096) -> DataFrame:
    """``rows`` of a distinct integer key with their position (from 0) in its order: counts of ranges first, then within each."""
    d = rows.withColumn("_range", F.floor(F.col(key) / width))
    counts = d.groupBy("_range").agg(F.count("*").alias("n"))  # one row for each range: small enough for one window
    starts = counts.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("start"))
    d = d.withColumn("_at", F.row_number().over(Window.partitionBy("_range").orderBy(key)))
    return d.join(starts.hint("merge"), "_range").select(*rows.columns, (F.col("start") + F.col("_at") - 1).alias("position"))


def not_increasing(rows: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value isn't above that of the row before, in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("previous", F.lag(value).over(w)).where(F.col(value) <= F.col("previous"))


def contiguous_runs(rows: DataFrame, key: list[str], position: str = "position") -> DataFrame:
    """Runs of consecutive positions: run_start, run_end, run_length."""
    island = F.col(position) - F.row_number().over(Window.partitionBy(*key).orderBy(position))
    d = rows.select(*key, position).distinct().withColumn("island", island)
    return d.groupBy(*key, "island").agg(F.min(position).alias("run_start"), F.max(position).alias("run_end"), F.count("*").alias("run_length")).drop("island")


def longest_runs(runs: DataFrame, key: list[str]) -> DataFrame:
    """Length, earliest start and number of a key's longest runs."""
    d = runs.withColumn("top", F.max("run_length").over(Window.partitionBy(*key))).where("run_length = top")
    return d.groupBy(*key).agg(F.max("run_length").alias("longest_run"), F.min("run_start").alias("first_start"), F.count("*").alias("ties"))


def duplicate_keys(rows: DataFrame, key: list[str], position: Column) -> DataFrame:
    """Keys of several rows: copies, first and last position. All are partial sums, so a very common key is no large array."""
    d = rows.groupBy(*key).agg(F.count("*").alias("copies"), F.min(position).alias("first_position"), F.max(position).alias("last_position"))
    return d.where("copies > 1")


def key_set_status(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """Each key of either side once, with status matched, missing (only expected) or unexpected (only actual)."""
    e, a = expected.select(*key).distinct().withColumn("_e", F.lit(1)), actual.select(*key).distinct().withColumn("_a", F.lit(1))
    d = e.join(a, key, "full_outer")
    return d.select(*key, F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").otherwise("matched").alias("status"))


def frames_outside_window(frames: DataFrame, windows: DataFrame) -> DataFrame:
    """Selected frames outside of their segment's window, or of an unknown segment."""
    d = frames.where("selected").join(windows, ["video_id", "segment_id"], "left")
    bad = F.when(F.col("start_sec").isNull(), "unknown_segment").when(~F.col("timestamp_sec").between(F.col("start_sec"), F.col("end_sec")), "outside_window")
    return d.withColumn("violation", bad).where("violation IS NOT NULL")


def reconcile(computed: DataFrame, declared: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """One row for each field that differs between two tables, missing rows with nulls."""
    c = computed.select(*key, *[F.col(f).cast("string").alias(f"c_{f}") for f in fields])
    d = declared.select(*key, *[F.col(f).cast("string").alias(f"d_{f}") for f in fields])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"c_{f}").alias("computed"), F.col(f"d_{f}").alias("declared")) for f in fields])
    both = c.join(d, key, "full_outer").select(*key, F.explode(F.filter(each, lambda x: ~x["computed"].eqNullSafe(x["declared"]))).alias("x"))
    return both.select(*key, "x.field", "x.computed", "x.declared")


#: Frames of a bucket of ``nearest_anchor`` where times are even.
BUCKET = 256


def nearest_anchor(frames: DataFrame, anchors: DataFrame) -> DataFrame:
    """The nearest eligible frame of each (video_id, anchor); several anchors may share a frame.

    Ties go to the better, then earlier frame. An as-of join: frames and anchors of a video are dealt into buckets of time and sorted there
    together, so each anchor sees the frames right before and after it; where its bucket has none on a side, it takes the last or first
    frame of the nearest bucket that has one. Work follows the number of frames and anchors, and a long video is many tasks. Null
    anchors and times take no part; a repeated anchor has one row; a video without eligible frames has none.
    """
    c = F.col
    f = frames.where("eligible AND timestamp_sec IS NOT NULL").select("video_id", c("timestamp_sec").cast("double").alias("at"), "quality_score", "frame_index", "frame_id")
    f = f.groupBy("video_id", "at").agg(F.min(F.struct((-c("quality_score")).alias("worse"), "at", "frame_index", "frame_id")).alias("f"))  # the best of equal times
    spans = f.groupBy("video_id").agg(F.min("at").alias("t0"), F.max("at").alias("t1"), F.ceil(F.count("*") / BUCKET).alias("buckets"))
    wide = c("t1") > c("t0")
    bucket = F.when(wide, F.least(F.greatest(F.floor((c("at") - c("t0")) / (c("t1") - c("t0")) * c("buckets")), F.lit(0)), c("buckets") - 1)).otherwise(0).cast("long").alias("bucket")
    spans = staged(spans, "video-spans")
    a = anchors.where("anchor IS NOT NULL").select("video_id", c("anchor").cast("double").alias("at"), F.lit(None).cast(f.schema["f"].dataType).alias("f")).distinct()
    both = f.withColumn("is_anchor", F.lit(False)).unionByName(a.withColumn("is_anchor", F.lit(True)))
    both = scene_join(both, spans, "video_id").select("video_id", "at", "f", "is_anchor", bucket)
    own = Window.partitionBy("video_id", "bucket")
    seen = lambda order: F.last("f", ignorenulls=True).over(own.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("before", seen(["at", "is_anchor"])).withColumn("after", seen([F.desc("at"), "is_anchor"]))
    # Slim rows, one for each bucket that has frames or anchors: the last frame before it and the first one after.
    ends = both.groupBy("video_id", "bucket").agg(F.min_by("f", F.when(~c("is_anchor"), c("at"))).alias("first"), F.max_by("f", F.when(~c("is_anchor"), c("at"))).alias("last"))
    far = lambda name, order: F.last(name, ignorenulls=True).over(Window.partitionBy("video_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select("video_id", "bucket", far("last", c("bucket")).alias("earlier"), far("first", F.desc("bucket")).alias("later"))
    d = both.where("is_anchor").select("video_id", "bucket", c("at").alias("anchor"), "before", "after").join(ends.hint("merge"), ["video_id", "bucket"])
    option = lambda n: F.when(c(n).isNotNull(), F.struct(F.abs(c(f"{n}.at") - c("anchor")).alias("away"), c(n).alias("f")))
    d = d.withColumn("before", F.coalesce("before", "earlier")).withColumn("after", F.coalesce("after", "later"))
    best = F.array_min(F.array_compact(F.array(option("before"), option("after"))))
    return d.withColumn("best", best).select("video_id", "anchor", c("best.f.frame_id").alias("frame_id"), c("best.f.at").alias("timestamp_sec"))


def _greedy(times: np.ndarray, rank: np.ndarray, anchors: np.ndarray) -> list[int]:
    """Index of the frame that each anchor takes: the nearest free one, of equally near ones that of the least rank.

    Frames of one time are a queue by rank. Times whose queue is empty are passed over by links that are shortened on the way, so all
    anchors together take hardly more steps than there are times and anchors.
    """
    at = np.unique(times)
    order = np.lexsort((rank, times))
    sorted_times = times[order]
    head = np.searchsorted(sorted_times, at, "left").tolist()
    ends = np.searchsorted(sorted_times, at, "right").tolist()
    at, n, ranks = at.tolist(), len(at), rank[order].tolist()
    down, up = list(range(-1, n - 1)), list(range(1, n + 1))

    def free(place: int, links: list[int]) -> int:
        """The first place with a free frame from ``place`` on along the links, or one outside."""
        root = place
        while 0 <= root < n and head[root] >= ends[root]:
            root = links[root]
        while 0 <= place < n and place != root:
            links[place], place = root, links[place]
        return root

    chosen = []
    for anchor, place in zip(anchors.tolist(), np.searchsorted(np.array(at), anchors, "left").tolist(), strict=True):
        p, q = free(place - 1, down), free(place, up)
        away = min(abs(at[p] - anchor) if p >= 0 else math.inf, abs(at[q] - anchor) if q < n else math.inf)
        if away == math.inf:
            break
        options = []
        while p >= 0 and abs(at[p] - anchor) == away:  # after rounding several times may be equally near
            options.append(p)
            p = free(p - 1, down)
        while q < n and abs(at[q] - anchor) == away:
            options.append(q)
            q = free(q + 1, up)
        best = min(options, key=lambda x: ranks[head[x]])
        chosen.append(int(order[head[best]]))
        head[best] += 1
    return chosen


#: Reason of the one row of a video that has frames, but none that may be selected.
REFUSED = "all_frames_rejected"


def select_frames(frames: DataFrame, durations: DataFrame, target_fps: float = 2.0, min_frames: int = 4, max_frames: int = 300) -> DataFrame:
    """Selected frames of each video: temporal_coverage anchors, then quality_fill, then budget_fallback.

    ``frames`` come from scored_frames. Every anchor takes the nearest frame that is still free, so a pick depends on the
    ones before it; that greedy step runs per video, all videos side by side. A video without an eligible frame is refused: it has one row, with a
    null frame and the reason all_frames_rejected. Frames without a time, or of a video without a duration, take no part.
    """
    kind = "video_id long, frame_id long, timestamp_sec double, quality_score double, selection_reason string"

    def pick(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(list(FRAME_ORDER), kind="stable").reset_index(drop=True)
        duration, eligible = float(t["duration_sec"].iloc[0]), t["eligible"].to_numpy(bool)
        if not eligible.any():
            return pd.DataFrame({"video_id": t["video_id"].iloc[:1], "frame_id": pd.array([None], "Int64"), "timestamp_sec": [None], "quality_score": [None], "selection_reason": [REFUSED]})
        least = min(min_frames, len(t))
        budget = min(max(min_frames, min(max_frames, math.ceil(duration * target_fps))), len(t))
        by_rank = np.lexsort((np.arange(len(t)), -t["quality_score"].to_numpy(float)))  # frames are in order of their ties
        rank = np.empty(len(t), np.int64)
        rank[by_rank] = np.arange(len(t))
        why = np.full(len(t), None, object)
        may = np.flatnonzero(eligible)
        anchors = duration * np.arange(budget) / max(1, budget - 1)
        why[may[_greedy(t["timestamp_sec"].to_numpy(float)[may], rank[may], anchors)]] = "temporal_coverage"
        count = int((why != None).sum())  # noqa: E711
        for rule, open_, size in (("quality_fill", eligible, budget), ("budget_fallback", t["has_path"].to_numpy(bool), least)):
            more = [i for i in by_rank[open_[by_rank]].tolist() if why[i] is None][: max(0, size - count)] if count < size else []
            why[more] = rule
            count += len(more)
        out = t.assign(selection_reason=why)
        return out.loc[out["selection_reason"].notna(), ["video_id", "frame_id", "timestamp_sec", "quality_score", "selection_reason"]]

    path = F.col("path").isNotNull() if "path" in frames.columns else F.lit(True)
    d = frames.where("timestamp_sec IS NOT NULL").join(durations.where("duration_sec IS NOT NULL").hint("merge"), "video_id").select("video_id", "frame_id", "frame_index", F.col("timestamp_sec").cast("double").alias("timestamp_sec"), "quality_score", F.coalesce("eligible", F.lit(False)).alias("eligible"), path.alias("has_path"), "duration_sec")
    return d.groupBy("video_id").applyInPandas(pick, kind)
