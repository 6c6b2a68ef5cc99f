"""Training telemetry: marker summaries, losses, exposure and progress, keyed by ``run_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import finite_or_null
from ..functions.markers import parse_markers
from .quantiles import exact_percentiles, joined

POSE = "frame string, accepted boolean, success boolean, rejection_reasons array<string>, inlier_ratio double, reprojection_rmse_px double, grid_coverage double, rotation_step_deg double, translation_step double, translation_step_ratio double"
DEPTH = "frame string, result string, reason string, correlation double, inlier_ratio double"
CONVERSION = "point_count double, finite_scale_count double"
LOSS = "total double, finite boolean"


def first_record_per_key(rows: DataFrame, key: list[str], order: str, value) -> DataFrame:
    """The value of the earliest row of each key."""
    return rows.groupBy(*key).agg(F.min_by(value, order).alias("first"))


def pose_summary(lines: DataFrame, any_attempt: bool = False) -> DataFrame:
    """Attempts and accepted cameras of each run. A camera is accepted if its first record is (or any, on demand)."""
    d = parse_markers(lines, "POSE_TELEMETRY", POSE).select("run_id", "seq", "record.*")
    accepted = F.coalesce("accepted", "success", F.size("rejection_reasons") == 0, F.lit(False))
    d = d.withColumn("ok", accepted)
    per_frame = d.where("frame IS NOT NULL").groupBy("run_id", "frame").agg(F.min_by("ok", "seq").alias("first"), F.bool_or("ok").alias("any"))
    cameras = per_frame.where("any" if any_attempt else "first").groupBy("run_id").agg(F.sort_array(F.collect_list("frame")).alias("accepted_frames"))
    fin = lambda c: finite_or_null(F.col(c))
    s = d.groupBy("run_id").agg(
        F.count("*").alias("attempt_count"), F.count_if(~F.col("ok")).alias("rejected_attempt_count"), F.min(fin("inlier_ratio")).alias("min_inlier_ratio"), F.max(fin("reprojection_rmse_px")).alias("max_reprojection_rmse_px"),
        F.min(fin("grid_coverage")).alias("min_grid_coverage"), F.max(fin("rotation_step_deg")).alias("max_rotation_step_deg"), F.max(fin("translation_step")).alias("max_translation_step"), F.max(fin("translation_step_ratio")).alias("max_translation_step_ratio"),
    )
    d = s.join(cameras.hint("merge"), "run_id", "left").withColumn("accepted_frames", F.coalesce("accepted_frames", F.array().cast("array<string>")))
    return d.withColumn("accepted_camera_count", F.size("accepted_frames"))


def depth_summary(lines: DataFrame) -> DataFrame:
    """Aligned, missing and rejected depth maps, least correlation and mean inlier ratio of each run."""
    d = parse_markers(lines, "VDA_TELEMETRY", DEPTH).select("run_id", "record.*")
    count = lambda v: F.count_if(F.col("result") == v).alias(v)
    return d.groupBy("run_id").agg(count("aligned"), count("missing"), count("rejected"), F.min(finite_or_null(F.col("correlation"))).alias("min_correlation"), F.avg(finite_or_null(F.col("inlier_ratio"))).alias("mean_inlier_ratio"))


def conversion_summary(lines: DataFrame) -> DataFrame:
    d = parse_markers(lines, "CONVERSION_TELEMETRY", CONVERSION).select("run_id", "record.*")
    good = F.coalesce((F.col("point_count") >= 0) & (F.col("finite_scale_count") == F.col("point_count")), F.lit(False))
    return d.groupBy("run_id").agg(F.count("*").alias("record_count"), F.bool_and(good).alias("all_scales_finite"))


def loss_summary(lines: DataFrame) -> DataFrame:
    d = parse_markers(lines, "LOSS_TELEMETRY", LOSS).select("run_id", "record.*")
    total = finite_or_null(F.col("total"))
    return d.groupBy("run_id").agg(F.coalesce(F.bool_or(~F.col("finite")), F.lit(False)).alias("has_nonfinite"), F.count("*").alias("record_count"), F.max(total).alias("max_total"), F.min(total).alias("min_total"))


def loss_values(lines: DataFrame) -> DataFrame:
    """(run_id, kind, total) from markers (telemetry) and from ``Loss=`` text (text)."""
    marked = parse_markers(lines, "LOSS_TELEMETRY", LOSS).select("run_id", F.lit("telemetry").alias("kind"), F.col("record.total").alias("total"))
    each = F.explode(F.regexp_extract_all("line", F.lit(r"Loss=([-+0-9.eE]+)"), 1))
    text = lines.where("NOT startswith(line, 'LOSS_TELEMETRY ')").select("run_id", F.lit("text").alias("kind"), each.alias("t")).select("run_id", "kind", F.expr("try_cast(t AS DOUBLE)").alias("total"))
    return marked.unionByName(text)


def loss_stats(values: DataFrame) -> DataFrame:
    """Percentiles, maximum and share above 10 of each run's losses: of telemetry where there is any, else of text."""
    d = values.where(finite_or_null(F.col("total")).isNotNull())
    # Both kinds are summed up side by side, so no window holds a run's values; a run's telemetry is then taken before its text.
    c, both = F.col, ["run_id", "kind"]
    sums = d.groupBy(*both).agg(F.count("*").alias("sample_count"), F.max("total").alias("loss_max"), F.avg((c("total") > 10).cast("double")).alias("loss_gt_10_ratio"))
    q = exact_percentiles(d, both, {f"loss_q{p}": (c("total"), p / 100) for p in (50, 95, 99)})
    names = ["sample_count", "loss_q50", "loss_q95", "loss_q99", "loss_max", "loss_gt_10_ratio"]
    taken = joined(sums, q, both).where(c("kind").isin("telemetry", "text")).groupBy("run_id").agg(F.min_by(F.struct(*names, c("kind").alias("source")), "kind").alias("s"))
    return taken.select("run_id", *[f"s.{n}" for n in (*names, "source")])


def predicted_exposure(runs: DataFrame) -> DataFrame:
    """What floor and ceiling of exposures (camera_count, iterations) imply."""
    n, k = F.col("camera_count"), F.col("iterations")
    d = runs.withColumn("complete_rounds", F.expr("iterations div camera_count")).withColumn("partial_round_size", k % n)
    return d.withColumns({
        "min_exposure_count": F.col("complete_rounds"), "max_exposure_count": F.col("complete_rounds") + F.when(F.col("partial_round_size") > 0, 1).otherwise(0),
        "camera_count_at_max_exposure": F.col("partial_round_size"), "camera_count_at_min_exposure": n - F.col("partial_round_size"),
        "predicted_unique_camera_count": F.least(n, k), "predicted_zero_exposure_camera_count": F.greatest(F.lit(0), n - k), "predicted_coverage_fraction": F.least(F.lit(1.0), k / n.cast("double")),
    })


def exposure_counts(events: DataFrame, cameras: DataFrame) -> DataFrame:
    """Exposures of each contracted camera (run_id, camera), and whether the run keeps floor and ceiling."""
    counts = events.groupBy("run_id", "camera").agg(F.count("*").alias("exposures"))
    d = cameras.join(counts, ["run_id", "camera"], "left").withColumn("exposures", F.coalesce("exposures", F.lit(0)))
    run = Window.partitionBy("run_id")
    d = d.withColumn("total", F.sum("exposures").over(run)).withColumn("cameras", F.count("*").over(run))
    low = F.expr("total div cameras")
    return d.withColumn("within_floor_ceiling", F.col("exposures").between(low, low + F.when(F.col("total") % F.col("cameras") > 0, 1).otherwise(0)))


def running_exposure(events: DataFrame) -> DataFrame:
    """Running count of each camera, cameras seen so far, and whether iterations run without a gap."""
    own, run = Window.partitionBy("run_id", "camera").orderBy("iteration"), Window.partitionBy("run_id").orderBy("iteration")
    d = events.withColumn("exposure_count", F.row_number().over(own))
    d = d.withColumn("cumulative_unique_count", F.sum(F.when(F.col("exposure_count") == 1, 1).otherwise(0)).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    return d.withColumn("in_sequence", F.col("iteration") == F.row_number().over(run))


def monotonic_progress(events: DataFrame) -> DataFrame:
    """Events whose iteration is within 1..total and above all accepted before; others never exceed that maximum."""
    valid = F.when(F.col("iteration").between(1, F.col("total")), F.col("iteration"))
    before = Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    d = events.withColumn("best", F.coalesce(F.max(valid).over(before), F.lit(0)))
    return d.where(valid > F.col("best")).drop("best")


#: Phases of a run's progress that are always recorded; ``iteration`` is recorded where it goes on.
PHASES = ("child_started", "child_exited", "parent_error")
#: Events of a run are compared by blocks of so many sequence numbers, so that a long run is many tasks.
BLOCK = 1 << 16


def progress_records(events: DataFrame) -> DataFrame:
    """Recorded progress (run_id, seq, phase, iteration, total, elapsed_seconds, returncode, error_type) of events in order of ``seq``.

    Starts, exits and errors of the parent are recorded with what belongs to them; an iteration only if it is within 1..total and above
    all that the run has recorded. Other phases and events without ``seq`` are not. Elapsed seconds are at least 0. Greatest iterations of blocks of ``seq`` are
    found first and handed on, then each block goes through its own events.
    """
    c = F.col
    valid = F.when((c("phase") == "iteration") & c("iteration").between(1, c("total")), c("iteration").cast("long"))
    d = events.where(c("phase").isin("iteration", *PHASES) & c("seq").isNotNull()).withColumn("_valid", valid).withColumn("_block", F.floor(c("seq") / BLOCK))
    blocks = d.groupBy("run_id", "_block").agg(F.max("_valid").alias("_top"))
    before = Window.partitionBy("run_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(c("run_id").alias("_run"), c("_block").alias("_of"), F.max("_top").over(before).alias("_so_far"))
    d = d.join(blocks.hint("merge"), c("run_id").eqNullSafe(c("_run")) & (c("_block") == c("_of")))
    own = Window.partitionBy("run_id", "_block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    best = F.greatest(F.max("_valid").over(own), c("_so_far"))  # null where there is nothing before
    d = d.withColumn("_best", F.coalesce(best, F.lit(0))).where((c("phase") != "iteration") | (c("_valid") > c("_best")))
    elapsed = F.round(F.greatest(F.coalesce(c("elapsed").cast("double"), F.lit(0.0)), F.lit(0.0)), 6)
    only = lambda phase, name, kind: F.when(c("phase") == phase, c(name)).cast(kind).alias(name)
    return d.select("run_id", "seq", "phase", only("iteration", "iteration", "long"), c("total").cast("long").alias("total"), elapsed.alias("elapsed_seconds"), only("child_exited", "returncode", "long"), only("parent_error", "error_type", "string"))


def heartbeat_alerts(events: DataFrame, seconds: int = 900) -> DataFrame:
    """Gaps of more than ``seconds`` between a run's events."""
    w = Window.partitionBy("run_id").orderBy("ts", "seq")
    d = events.withColumn("gap_sec", (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))) / 1e6)
    return d.where(F.col("gap_sec") > seconds)


def anchor_schedule(runs: DataFrame, every: int = 100) -> DataFrame:
    """Iterations every, 2 * every, ... below a run's iterations."""
    steps = F.when(F.col("iterations") > every, F.sequence(F.lit(every).cast("long"), F.col("iterations").cast("long") - 1, F.lit(every).cast("long"))).otherwise(F.array().cast("array<long>"))
    return runs.select("run_id", F.explode(steps).alias("iteration"))


def anchor_event_check(runs: DataFrame, events: DataFrame) -> DataFrame:
    """Planned and seen anchors that have no counterpart, and events whose counts don't add up."""
    plan = anchor_schedule(runs).withColumn("_plan", F.lit(True))
    d = plan.join(events.withColumn("_seen", F.lit(True)).hint("merge"), ["run_id", "iteration"], "full_outer")
    wrong = F.col("after") != F.col("before") + F.col("added") - F.col("deleted")
    return d.withColumn("violation", F.when(F.col("_seen").isNull(), "missing").when(F.col("_plan").isNull(), "unplanned").when(wrong, "counts")).where("violation IS NOT NULL").select("run_id", "iteration", "violation")


def distance_floor_stats(distances: DataFrame, voxel: float, least: float = 1e-7) -> DataFrame:
    """Nonpositive distances and the range before and after clamping to [least, voxel], by scene."""
    after = F.greatest(F.lit(least), F.least(F.lit(voxel), F.col("distance")))
    return distances.groupBy("scene_id").agg(F.count_if(F.col("distance") <= 0).alias("nonpositive_count"), F.min("distance").alias("min_before"), F.max("distance").alias("max_before"), F.min(after).alias("min_after"), F.max(after).alias("max_after"), F.count_if(finite_or_null(F.log(F.sqrt(after))).isNotNull()).alias("finite_scale_count"))


def residency_violations(rows: DataFrame) -> DataFrame:
    """Rows of (run_id, phase, counters) that break the rules of streamed residency."""
    from ..functions.expressions import violations

    v = violations(negative_counter=(F.col("transfers") < 0) | (F.col("bytes") < 0), errors=F.col("errors") != 0, peak=(F.col("strategy") == "streaming") & (F.col("peak_frames") > 1), bytes_without_transfers=(F.col("bytes") > 0) != (F.col("transfers") > 0))
    return rows.withColumn("violations", v).where(F.size("violations") > 0)


def compare_training_evidence(runs: DataFrame) -> DataFrame:
    """Two runs side by side (pair_id, side a or b): equal vertices, anchors and losses known on both."""
    side = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    d = runs.groupBy("pair_id").agg(side("a", "vertices").alias("vertices_a"), side("b", "vertices").alias("vertices_b"), side("a", "anchors").alias("anchors_a"), side("b", "anchors").alias("anchors_b"), side("a", "loss_points").alias("losses_a"), side("b", "loss_points").alias("losses_b"))
    return d.select("pair_id", "vertices_a", "vertices_b", F.col("vertices_a").eqNullSafe(F.col("vertices_b")).alias("vertices_equal"), (F.col("anchors_a").isNotNull() & F.col("anchors_b").isNotNull()).alias("anchors_available"), ((F.coalesce("losses_a", F.lit(0)) > 0) & (F.coalesce("losses_b", F.lit(0)) > 0)).alias("loss_points_found"))
