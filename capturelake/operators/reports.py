"""Declared against recomputed: coverage reports of videos and lists of names in a declared order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from .frames import reconcile

#: Frames of one segment are searched for gaps by parts of so many seconds, which bounds a task by the rate of frames.
PART_SEC = 60
SEGMENT = ["video_id", "segment_id"]
COUNTS = ["position", "total_frames", "selected_frames", "rejected_frames", "bridge_frames", "component_count", "max_selected_gap_sec", "failed_reasons"]
SUMMARY = ["selected_frames", "bridge_frames", "component_count", "max_selected_gap_sec", "failed_segments", "status"]


def selected_gaps(frames: DataFrame) -> DataFrame:
    """(video_id, segment_id, gap, first, last) of selected frames, in order of time; gap is null where there is one frame only.

    A segment is cut into parts of ``PART_SEC`` seconds; greatest gaps within parts are found first, then those between the ends of
    parts, of which there is one row each. Frames without a time or a selection take no part.
    """
    d = frames.where("selected AND timestamp_sec IS NOT NULL").select(*SEGMENT, F.col("timestamp_sec").cast("double").alias("t"))
    d = d.withColumn("part", F.floor(F.col("t") / PART_SEC))
    inner = d.withColumn("gap", F.col("t") - F.lag("t").over(Window.partitionBy(*SEGMENT, "part").orderBy("t")))
    parts = inner.groupBy(*SEGMENT, "part").agg(F.max("gap").alias("gap"), F.min("t").alias("first"), F.max("t").alias("last"))
    between = F.col("first") - F.lag("last").over(Window.partitionBy(*SEGMENT).orderBy("part"))
    return parts.withColumn("gap", F.greatest("gap", between)).groupBy(*SEGMENT).agg(F.max("gap").alias("gap"), F.min("first").alias("first"), F.max("last").alias("last"))


def coverage_segments(frames: DataFrame, segments: DataFrame, settings: DataFrame) -> DataFrame:
    """What a coverage report must say of each declared segment: (video_id, segment_id) and ``COUNTS``, failed_reasons as text.

    frames: video_id, segment_id, timestamp_sec, selected, bridge. segments: video_id, segment_id, position, start_sec, end_sec, one
    row each. settings: video_id, selection_max_gap_sec, one row a video; a limit that is missing or not positive is the reason
    ``selection_max_gap_sec``. The greatest gap includes both ends of the window; a selected frame outside of it is the reason ``outside_window``. Frames of unknown
    segments are not counted (``frames_outside_window`` lists them).
    """
    c = F.col
    counts = frames.groupBy(*SEGMENT).agg(F.count("*").alias("total_frames"), F.count_if("selected").alias("selected_frames"), F.count_if(~c("selected")).alias("rejected_frames"), F.count_if(c("selected") & c("bridge")).alias("bridge_frames"))
    d = segments.join(counts.hint("merge"), SEGMENT, "left").join(selected_gaps(frames).hint("merge"), SEGMENT, "left").join(settings.select("video_id", "selection_max_gap_sec").hint("merge"), "video_id", "left")
    d = d.fillna(0, ["total_frames", "selected_frames", "rejected_frames", "bridge_frames"])
    before, after = c("first") - c("start_sec"), c("end_sec") - c("last")
    d = d.withColumn("max_selected_gap_sec", F.bround(F.coalesce(F.greatest("gap", before, after), F.lit(0.0)), 3))
    limit = c("selection_max_gap_sec")
    reasons = X.violations(no_selected_frames=c("selected_frames") == 0, max_selected_gap_sec=c("max_selected_gap_sec") > limit, outside_window=F.least(before, after) < 0, selection_max_gap_sec=~F.coalesce(X.is_finite(limit.cast("double")) & (limit > 0), F.lit(False)))
    return d.select(*SEGMENT, c("position").cast("long").alias("position"), *COUNTS[1:5], F.when(c("selected_frames") > 0, 1).otherwise(0).cast("long").alias("component_count"), "max_selected_gap_sec", F.array_join(reasons, ",").alias("failed_reasons"))


def coverage_summary(segments: DataFrame) -> DataFrame:
    """``SUMMARY`` of each video from its ``coverage_segments``; failed segments are named in the manifest's order."""
    failed = F.array_sort(F.collect_list(F.when(F.col("failed_reasons") != "", F.struct("position", "segment_id"))))
    d = segments.groupBy("video_id").agg(F.sum("selected_frames").alias("selected_frames"), F.sum("bridge_frames").alias("bridge_frames"), F.max("component_count").alias("component_count"), F.max("max_selected_gap_sec").alias("max_selected_gap_sec"), F.array_join(F.transform(failed, lambda x: x["segment_id"]), ",").alias("failed_segments"))
    return d.withColumn("status", F.when(F.col("failed_segments") != "", "failed").otherwise("passed"))


def coverage_report_violations(frames: DataFrame, segments: DataFrame, settings: DataFrame, reported: DataFrame, summaries: DataFrame) -> DataFrame:
    """(video_id, segment_id, field, computed, declared) wherever a coverage report or a manifest's summary says something else.

    ``reported`` has (video_id, segment_id) and ``COUNTS``, where position is the segment's place in the report: so another order is a
    difference in ``position``. A segment that one side lacks differs in all its fields. ``summaries`` has video_id and ``SUMMARY``; its rows have no segment_id.
    """
    computed = coverage_segments(frames, segments, settings)
    each = reconcile(computed, reported, SEGMENT, COUNTS)
    whole = reconcile(coverage_summary(computed), summaries, ["video_id"], SUMMARY)
    return each.unionByName(whole.withColumn("segment_id", F.lit(None).cast(computed.schema["segment_id"].dataType)))


def coverage_frame_violations(frames: DataFrame, policy: str = "coverage_v1") -> DataFrame:
    """Frames (any columns, and selected, bridge, policy, selected_by_policy) that break a rule of the policy, with their violations."""
    c = F.col
    bad = X.violations(policy=~c("policy").eqNullSafe(policy), selected_by_policy=~c("selected_by_policy").eqNullSafe(c("selected")), bridge=c("bridge").isNull(), rejected_bridge=F.coalesce(c("bridge") & ~c("selected"), F.lit(False)))
    return frames.withColumn("violations", bad).where(F.size("violations") > 0)


def name_order_status(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """Each name of either list of a key once: matched, moved, missing, unexpected or repeated, with its first place on either side.

    Both tables have the key, ``name`` and ``position`` (its place in the list). A name that a side has twice is ``repeated``, whatever its places.
    The lists are equal if all rows are matched. One shuffle of partial sums; a null name is a name of its own.
    """
    side = lambda d, mine, other: d.select(*key, "name", F.col("position").cast("long").alias(mine), F.lit(None).cast("long").alias(other), F.lit(mine).alias("_side"))
    both = side(expected, "expected_position", "actual_position").unionByName(side(actual, "actual_position", "expected_position"))
    n = lambda s: F.count_if(F.col("_side") == s)
    d = both.groupBy(*key, "name").agg(F.min("expected_position").alias("expected_position"), F.min("actual_position").alias("actual_position"), n("expected_position").alias("_e"), n("actual_position").alias("_a"))
    status = F.when(F.col("_e") == 0, "unexpected").when(F.col("_a") == 0, "missing").when(F.greatest("_e", "_a") > 1, "repeated").when(~F.col("expected_position").eqNullSafe(F.col("actual_position")), "moved").otherwise("matched")
    return d.select(*key, "name", "expected_position", "actual_position", status.alias("status"))
