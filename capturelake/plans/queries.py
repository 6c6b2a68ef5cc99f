"""Registered queries over the driver's tables, each with SQL of the same rows where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import markers
from ..operators import clouds, depth, frames, gates, images, runs, sparse, telemetry, trajectory
from ..sources.bindings import bind, duckdb_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of views: its parameters name them."""

    def register(f):
        names = f.__code__.co_varnames[: f.__code__.co_argcount]
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[bind(spark, sf_dir, n) for n in names])
        if sql is not None:
            ORACLES[f.__name__] = duckdb_with(sql)
        return f

    return register


def r6(c):
    return F.round(c, 6)


# ---- frames

SCORE = """round(0.45 * (1 - exp(-greatest(sharpness, 0) / 100)) + 0.25 * least(greatest(1 - greatest(least(greatest(overexposed_ratio, 0), 1), least(greatest(underexposed_ratio, 0), 1)), 0), 1) + 0.15 * least(greatest(motion_score, 0), 1) + 0.15 * 0.5, 9)"""
SCORED = f"scored AS (SELECT *, {SCORE} AS quality_score, overexposed_ratio > 0.35 AS o, underexposed_ratio > 0.35 AS u, duplicate_score <= 2 AS d, NOT (overexposed_ratio > 0.35 OR underexposed_ratio > 0.35 OR duplicate_score <= 2) AS eligible FROM b_frames)"
SELECTED = "sel AS (SELECT user_id AS video_id, event_type AS segment_id, event_id AS frame_id FROM events)"


@query(f"WITH {SCORED} SELECT video_id, frame_id, round(quality_score, 4) AS quality_score, eligible FROM scored")
def frame_quality_score(b_frames):
    return frames.scored_frames(b_frames).select("video_id", "frame_id", F.round("quality_score", 4).alias("quality_score"), "eligible")


@query(f"WITH {SCORED}, e AS (SELECT video_id, 'overexposed' AS reason FROM scored WHERE o UNION ALL SELECT video_id, 'underexposed' FROM scored WHERE u UNION ALL SELECT video_id, 'duplicate' FROM scored WHERE d) SELECT video_id, reason, count(*) AS frames FROM e GROUP BY ALL")
def hard_reject_reasons(b_frames):
    return frames.reject_reason_counts(frames.scored_frames(b_frames))


@query("SELECT video_id, frame_id, round(timestamp_sec - lag(timestamp_sec) OVER w, 6) AS gap_sec, round(abs(sharpness - lag(sharpness) OVER w), 6) AS sharpness_delta FROM b_frames WINDOW w AS (PARTITION BY video_id ORDER BY timestamp_sec, frame_index, frame_id)")
def previous_frame_delta(b_frames):
    return frames.previous_frame_delta(b_frames).select("video_id", "frame_id", r6("gap_sec").alias("gap_sec"), r6("sharpness_delta").alias("sharpness_delta"))


@query(f"""WITH {SCORED}, dur AS (SELECT video_id, max(timestamp_sec) + 1 AS duration_sec FROM b_frames GROUP BY 1),
g AS (SELECT *, timestamp_sec - lag(timestamp_sec) OVER (PARTITION BY video_id ORDER BY timestamp_sec) AS gap FROM scored WHERE eligible),
a AS (SELECT video_id, count(*) AS n, coalesce(max(gap), 0) AS gi, min(timestamp_sec) AS f, max(timestamp_sec) AS l FROM g GROUP BY 1)
SELECT video_id, coalesce(n, 0) AS selected_count, round(coalesce(gi, 0), 6) AS max_internal_gap_sec, round(coalesce(greatest(f, greatest(0, duration_sec - l)), 0), 6) AS max_boundary_gap_sec, round(greatest(coalesce(gi, 0), coalesce(greatest(f, greatest(0, duration_sec - l)), 0)), 6) AS max_time_gap_sec FROM dur LEFT JOIN a USING (video_id)""")
def selection_gaps(b_frames):
    durations = b_frames.groupBy("video_id").agg((F.max("timestamp_sec") + 1).alias("duration_sec"))
    d = frames.selection_gaps(frames.scored_frames(b_frames).where("eligible"), durations)
    return d.select("video_id", "selected_count", *[r6(c).alias(c) for c in ("max_internal_gap_sec", "max_boundary_gap_sec", "max_time_gap_sec")])


def _segments(b_segments):
    windows = b_segments.groupBy("video_id", "segment_id").agg(F.min("timestamp_sec").alias("start_sec"), F.max("timestamp_sec").alias("end_sec"))
    return frames.segment_quality(b_segments, windows, 20_000.0)


SEGMENTS = """w AS (SELECT video_id, segment_id, min(timestamp_sec) AS s, max(timestamp_sec) AS e, count(*) AS total_frames, count_if(selected) AS selected_frames, count_if(NOT selected) AS rejected_frames, count_if(selected AND bridge) AS bridge_frames FROM b_segments GROUP BY 1, 2),
g AS (SELECT video_id, segment_id, timestamp_sec, timestamp_sec - lag(timestamp_sec) OVER (PARTITION BY video_id, segment_id ORDER BY timestamp_sec) AS gap FROM b_segments WHERE selected),
a AS (SELECT video_id, segment_id, max(gap) AS gap, min(timestamp_sec) AS f, max(timestamp_sec) AS l FROM g GROUP BY 1, 2),
q AS (SELECT w.*, CASE WHEN selected_frames > 0 THEN 1 ELSE 0 END AS component_count, round(coalesce(greatest(a.gap, a.f - w.s, w.e - a.l), 0), 3) AS max_selected_gap_sec FROM w LEFT JOIN a USING (video_id, segment_id))"""


@query(f"WITH {SEGMENTS} SELECT video_id, segment_id, total_frames, selected_frames, rejected_frames, bridge_frames, component_count, max_selected_gap_sec, concat_ws(',', CASE WHEN selected_frames = 0 THEN 'no_selected_frames' END, CASE WHEN max_selected_gap_sec > 20000 THEN 'max_selected_gap_sec' END) AS failed_reasons FROM q")
def segment_quality(b_segments):
    return _segments(b_segments).withColumn("failed_reasons", F.array_join("failed_reasons", ","))


@query(f"WITH {SEGMENTS}, v AS (SELECT video_id, CAST(sum(selected_frames) AS BIGINT) AS selected_frames, CAST(sum(bridge_frames) AS BIGINT) AS bridge_frames, max(component_count) AS component_count, max(max_selected_gap_sec) AS max_selected_gap_sec, coalesce(string_agg(segment_id, ',' ORDER BY segment_id) FILTER (WHERE selected_frames = 0 OR max_selected_gap_sec > 20000), '') AS failed_segments FROM q GROUP BY 1) SELECT *, CASE WHEN failed_segments = '' THEN 'passed' ELSE 'failed' END AS status FROM v")
def video_quality_rollup(b_segments):
    return frames.video_quality_rollup(_segments(b_segments)).withColumn("failed_segments", F.array_join("failed_segments", ","))


@query(f"WITH {SCORED} SELECT video_id, frame_id, row_number() OVER (PARTITION BY video_id ORDER BY timestamp_sec, frame_index) - 1 AS new_index FROM scored WHERE eligible")
def dense_reindex(b_frames):
    return frames.dense_reindex(frames.scored_frames(b_frames).where("eligible"), ["video_id"], ["timestamp_sec", "frame_index"]).select("video_id", "frame_id", F.col("new_index").cast("long").alias("new_index"))


@query("WITH p AS (SELECT *, lag(iteration) OVER (PARTITION BY run_id ORDER BY seq) AS previous FROM b_progress) SELECT run_id, seq, iteration, previous FROM p WHERE iteration <= previous")
def strictly_increasing(b_progress):
    return frames.not_increasing(b_progress, ["run_id"], ["seq"], "iteration").select("run_id", "seq", "iteration", "previous")


@query(f"WITH {SCORED}, i AS (SELECT DISTINCT video_id, frame_index - row_number() OVER (PARTITION BY video_id ORDER BY frame_index) AS g, frame_index FROM scored WHERE eligible), r AS (SELECT video_id, min(frame_index) AS s, count(*) AS n FROM i GROUP BY video_id, g) SELECT video_id, max(n) AS longest_run, min(CASE WHEN n = m THEN s END) AS first_start, count_if(n = m) AS ties FROM (SELECT *, max(n) OVER (PARTITION BY video_id) AS m FROM r) GROUP BY video_id")
def contiguous_runs(b_frames):
    r = frames.contiguous_runs(frames.scored_frames(b_frames).where("eligible"), ["video_id"], "frame_index")
    return frames.longest_runs(r, ["video_id"]).withColumn("first_start", F.col("first_start").cast("long"))


@query("SELECT o_custkey AS camera_id, count(*) AS copies, min(o_orderkey) AS first_position, max(o_orderkey) AS last_position FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(orders):
    return frames.duplicate_keys(orders, ["o_custkey"], F.col("o_orderkey")).select(F.col("o_custkey").alias("camera_id"), "copies", "first_position", "last_position")


@query("WITH e AS (SELECT DISTINCT k FROM b_keys WHERE side = 'expected'), a AS (SELECT DISTINCT k FROM b_keys WHERE side = 'actual') SELECT coalesce(e.k, a.k) AS k, CASE WHEN a.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'unexpected' ELSE 'matched' END AS status FROM e FULL JOIN a ON e.k = a.k")
def exact_name_set(b_keys):
    return frames.key_set_status(b_keys.where("side = 'expected'"), b_keys.where("side = 'actual'"), ["k"])


@query("WITH w AS (SELECT user_id AS video_id, event_type AS segment_id, quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi FROM events WHERE event_type <> 'error' GROUP BY ALL) SELECT video_id, frame_id, CASE WHEN lo IS NULL THEN 'unknown_segment' ELSE 'outside_window' END AS violation FROM (SELECT user_id AS video_id, event_type AS segment_id, event_id AS frame_id, value AS timestamp_sec FROM events) f LEFT JOIN w USING (video_id, segment_id) WHERE lo IS NULL OR NOT (timestamp_sec BETWEEN lo AND hi)")
def frames_in_segment_window(events):
    f = events.select(F.col("user_id").alias("video_id"), F.col("event_type").alias("segment_id"), F.col("event_id").alias("frame_id"), F.col("value").alias("timestamp_sec"), F.lit(True).alias("selected"))
    w = f.where("segment_id <> 'error'").groupBy("video_id", "segment_id").agg(F.percentile("timestamp_sec", F.lit(0.1)).alias("start_sec"), F.percentile("timestamp_sec", F.lit(0.9)).alias("end_sec"))
    return frames.frames_outside_window(f, w).select("video_id", "frame_id", "violation")


@query(f"WITH {SEGMENTS}, d AS (SELECT video_id, segment_id, total_frames, CASE WHEN video_id % 7 = 0 THEN selected_frames + 1 ELSE selected_frames END AS sf FROM q WHERE video_id % 11 <> 0) SELECT q.video_id, q.segment_id, x.field, x.computed, x.declared FROM q LEFT JOIN d USING (video_id, segment_id), LATERAL (VALUES ('total_frames', CAST(q.total_frames AS VARCHAR), CAST(d.total_frames AS VARCHAR)), ('selected_frames', CAST(q.selected_frames AS VARCHAR), CAST(d.sf AS VARCHAR))) x(field, computed, declared) WHERE computed IS DISTINCT FROM declared")
def reconcile_quality_report(b_segments):
    q = _segments(b_segments)
    declared = q.where("video_id % 11 <> 0").withColumn("selected_frames", F.when(F.col("video_id") % 7 == 0, F.col("selected_frames") + 1).otherwise(F.col("selected_frames")))
    return frames.reconcile(q, declared, ["video_id", "segment_id"], ["total_frames", "selected_frames"])


@query(f"""WITH {SCORED}, d AS (SELECT video_id, max(timestamp_sec) AS m FROM b_frames GROUP BY 1), a AS (SELECT video_id, n * m / 9 AS anchor FROM d, (SELECT unnest(generate_series(0, 9)) AS n)),
r AS (SELECT a.video_id, a.anchor, s.frame_id, row_number() OVER (PARTITION BY a.video_id, a.anchor ORDER BY abs(s.timestamp_sec - a.anchor), -s.quality_score, s.timestamp_sec, s.frame_index, s.frame_id) AS k FROM a JOIN scored s ON s.video_id = a.video_id AND s.eligible)
SELECT video_id, round(anchor, 6) AS anchor, frame_id FROM r WHERE k = 1""")
def nearest_anchor(b_frames):
    anchors = b_frames.groupBy("video_id").agg(F.max("timestamp_sec").alias("m")).select("video_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda n: n * F.col("m") / 9)).alias("anchor"))
    d = frames.nearest_anchor(frames.scored_frames(b_frames), anchors)
    return d.select("video_id", r6("anchor").alias("anchor"), "frame_id")


@query(f"""WITH RECURSIVE {SCORED}, b AS (SELECT video_id, max(timestamp_sec) + 1 AS d, least(greatest(4, least(60, CAST(ceil((max(timestamp_sec) + 1) * 1e-4) AS BIGINT))), count(*)) AS budget, least(4, count(*)) AS fewest, count_if(eligible) AS n FROM scored GROUP BY 1),
pick AS (SELECT video_id, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS chosen FROM b UNION ALL
  SELECT x.video_id, x.k + 1, list_append(x.chosen, x.best.frame_id) FROM (SELECT p.video_id, p.k, p.chosen, min({{'away': abs(s.timestamp_sec - b.d * p.k / greatest(1, b.budget - 1)), 'q': -s.quality_score, 't': s.timestamp_sec, 'i': s.frame_index, 'frame_id': s.frame_id}}) AS best
    FROM pick p JOIN b ON b.video_id = p.video_id AND p.k < b.budget JOIN scored s ON s.video_id = p.video_id AND s.eligible AND NOT list_contains(p.chosen, s.frame_id) GROUP BY ALL) x),
f AS (SELECT video_id, arg_max(chosen, k) AS chosen FROM pick GROUP BY 1),
c AS (SELECT f.video_id, unnest(chosen) AS frame_id, 'temporal_coverage' AS selection_reason FROM f),
r AS (SELECT s.*, row_number() OVER (PARTITION BY s.video_id ORDER BY -s.quality_score, s.timestamp_sec, s.frame_index, s.frame_id) AS place FROM scored s JOIN f USING (video_id) WHERE NOT list_contains(f.chosen, s.frame_id)),
l AS (SELECT r.video_id, r.frame_id, 'budget_fallback' AS selection_reason FROM r JOIN b USING (video_id) JOIN f USING (video_id) WHERE b.n > 0 AND place <= fewest - len(f.chosen)),
every AS (SELECT * FROM c UNION ALL SELECT * FROM l)
SELECT every.*, s.timestamp_sec, s.quality_score FROM every JOIN scored s USING (video_id, frame_id) UNION ALL SELECT video_id, NULL, 'all_frames_rejected', NULL, NULL FROM b WHERE n = 0""")
def select_frames(b_frames):
    durations = b_frames.groupBy("video_id").agg((F.max("timestamp_sec") + 1).alias("duration_sec"))
    return frames.select_frames(frames.scored_frames(b_frames), durations, target_fps=1e-4, min_frames=4, max_frames=60)


@query("SELECT video_id, greatest(4, least(60, CAST(ceil((max(timestamp_sec) + 1) * 0.0001) AS BIGINT))) AS budget FROM b_frames GROUP BY 1")
def sampling_plan(b_frames):
    return b_frames.groupBy("video_id").agg((F.max("timestamp_sec") + 1).alias("d")).select("video_id", X.frame_budget(F.col("d"), 0.0001, 4, 60).alias("budget"))


@query(f"WITH {SCORED} SELECT video_id, frame_id, round(quality_score, 4) AS quality_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY -quality_score, timestamp_sec, frame_index, frame_id) AS rank FROM scored) WHERE rank <= 5")
def top_frames(b_frames):
    from pyspark.sql import Window

    d = frames.scored_frames(b_frames)
    rank = F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc("quality_score"), "timestamp_sec", "frame_index", "frame_id"))
    return d.withColumn("rank", rank).where("rank <= 5").select("video_id", "frame_id", F.round("quality_score", 4).alias("quality_score"), "rank")


# ---- telemetry

PARSED = r"""m AS (SELECT run_id, seq, substr(line, 1, strpos(line, ' ') - 1) AS marker, regexp_replace(substr(line, strpos(line, ' ') + 1), '\s*\[\d{2}/\d{2} \d{2}:\d{2}:\d{2}\]\s*$', '') AS body FROM b_markers),
j AS (SELECT run_id, seq, marker, body FROM m WHERE starts_with(body, '{') AND ends_with(body, '}') AND NOT contains(body, 'NaN'))"""


@query(f"WITH {PARSED} SELECT run_id, seq, json_extract_string(body, '$.frame') AS frame, CAST(json_extract(body, '$.accepted') AS BOOLEAN) AS accepted, CAST(json_extract(body, '$.inlier_ratio') AS DOUBLE) AS inlier_ratio FROM j WHERE marker = 'POSE_TELEMETRY'")
def parse_markers(b_markers):
    return markers.parse_markers(b_markers, "POSE_TELEMETRY", telemetry.POSE).select("run_id", "seq", "record.frame", "record.accepted", "record.inlier_ratio")


@query(f"""WITH {PARSED}, p AS (SELECT run_id, seq, json_extract_string(body, '$.frame') AS frame, CAST(json_extract(body, '$.accepted') AS BOOLEAN) AS ok, CAST(json_extract(body, '$.inlier_ratio') AS DOUBLE) AS r FROM j WHERE marker = 'POSE_TELEMETRY'),
f AS (SELECT run_id, frame, arg_min(ok, seq) AS ok FROM p GROUP BY 1, 2), c AS (SELECT run_id, count_if(ok) AS n FROM f GROUP BY 1)
SELECT p.run_id, count(*) AS attempt_count, count_if(NOT ok) AS rejected_attempt_count, min(r) AS min_inlier_ratio, CAST(any_value(c.n) AS INT) AS accepted_camera_count FROM p JOIN c USING (run_id) GROUP BY p.run_id""")
def pose_telemetry_summary(b_markers):
    return telemetry.pose_summary(b_markers).select("run_id", "attempt_count", "rejected_attempt_count", "min_inlier_ratio", "accepted_camera_count")


@query(f"WITH {PARSED} SELECT run_id, count_if(json_extract_string(body, '$.result') = 'aligned') AS aligned, count_if(json_extract_string(body, '$.result') = 'missing') AS missing, count_if(json_extract_string(body, '$.result') = 'rejected') AS rejected, min(CAST(json_extract(body, '$.correlation') AS DOUBLE)) AS min_correlation FROM j WHERE marker = 'VDA_TELEMETRY' GROUP BY 1")
def vda_telemetry_summary(b_markers):
    return telemetry.depth_summary(b_markers).drop("mean_inlier_ratio")


@query(f"WITH {PARSED}, p AS (SELECT run_id, seq, json_extract_string(body, '$.frame') AS frame, CAST(json_extract(body, '$.accepted') AS BOOLEAN) AS ok FROM j WHERE marker = 'POSE_TELEMETRY') SELECT run_id, frame, arg_min(ok, seq) AS first FROM p GROUP BY 1, 2")
def first_record_per_key(b_markers):
    d = markers.parse_markers(b_markers, "POSE_TELEMETRY", telemetry.POSE).select("run_id", "seq", "record.frame", "record.accepted")
    return telemetry.first_record_per_key(d, ["run_id", "frame"], "seq", "accepted")


@query("WITH h AS (SELECT *, bool_or(kind = 'telemetry') OVER (PARTITION BY run_id) AS has FROM b_losses), k AS (SELECT * FROM h WHERE kind = CASE WHEN has THEN 'telemetry' ELSE 'text' END) SELECT run_id, count(*) AS sample_count, round(quantile_cont(total, 0.5), 6) AS loss_q50, round(quantile_cont(total, 0.95), 6) AS loss_q95, round(quantile_cont(total, 0.99), 6) AS loss_q99, round(max(total), 6) AS loss_max, round(avg(CASE WHEN total > 10 THEN 1.0 ELSE 0.0 END), 6) AS loss_gt_10_ratio, min(kind) AS source FROM k GROUP BY 1")
def loss_log_stats(b_losses):
    return telemetry.loss_stats(b_losses).select("run_id", "sample_count", *[r6(c).alias(c) for c in ("loss_q50", "loss_q95", "loss_q99", "loss_max", "loss_gt_10_ratio")], "source")


EXPOSED = "WITH r AS (SELECT run_id, count(*) AS iterations, count(DISTINCT camera) AS camera_count FROM b_exposure GROUP BY 1)"


@query(EXPOSED + " SELECT run_id, iterations // camera_count AS complete_rounds, iterations % camera_count AS partial_round_size, iterations // camera_count + CASE WHEN iterations % camera_count > 0 THEN 1 ELSE 0 END AS max_exposure_count, least(1.0, iterations / camera_count) AS predicted_coverage_fraction FROM r")
def predicted_exposure(b_exposure):
    r = b_exposure.groupBy("run_id").agg(F.count("*").alias("iterations"), F.count_distinct("camera").alias("camera_count"))
    return telemetry.predicted_exposure(r).select("run_id", "complete_rounds", "partial_round_size", "max_exposure_count", "predicted_coverage_fraction")


@query("WITH c AS (SELECT DISTINCT run_id, camera FROM b_exposure UNION SELECT DISTINCT run_id, 'spare' FROM b_exposure), n AS (SELECT c.run_id, c.camera, count(e.iteration) AS exposures FROM c LEFT JOIN b_exposure e ON e.run_id = c.run_id AND e.camera = c.camera GROUP BY 1, 2), t AS (SELECT *, sum(exposures) OVER (PARTITION BY run_id) AS total, count(*) OVER (PARTITION BY run_id) AS cameras FROM n) SELECT run_id, camera, exposures, exposures BETWEEN total // cameras AND total // cameras + CASE WHEN total % cameras > 0 THEN 1 ELSE 0 END AS within_floor_ceiling FROM t")
def exposure_counts(b_exposure):
    seen = b_exposure.select("run_id", "camera").distinct()
    cameras = seen.unionByName(seen.select("run_id").distinct().withColumn("camera", F.lit("spare")))
    return telemetry.exposure_counts(b_exposure, cameras).select("run_id", "camera", "exposures", "within_floor_ceiling")


@query("WITH e AS (SELECT *, row_number() OVER (PARTITION BY run_id, camera ORDER BY iteration) AS exposure_count FROM b_exposure) SELECT run_id, iteration, camera, exposure_count, CAST(sum(CASE WHEN exposure_count = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY iteration ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_unique_count, iteration = row_number() OVER (PARTITION BY run_id ORDER BY iteration) AS in_sequence FROM e")
def running_exposure(b_exposure):
    return telemetry.running_exposure(b_exposure)


@query("WITH v AS (SELECT *, CASE WHEN iteration BETWEEN 1 AND total THEN iteration END AS ok FROM b_progress), b AS (SELECT *, coalesce(max(ok) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS best FROM v) SELECT run_id, seq, iteration FROM b WHERE ok > best")
def monotonic_progress(b_progress):
    return telemetry.monotonic_progress(b_progress).select("run_id", "seq", "iteration")


@query("WITH g AS (SELECT run_id, seq, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY run_id ORDER BY ts, seq))) / 1e6 AS gap_sec FROM b_progress) SELECT run_id, seq, round(gap_sec, 6) AS gap_sec FROM g WHERE gap_sec > 900")
def heartbeat_alerts(b_progress):
    return telemetry.heartbeat_alerts(b_progress).select("run_id", "seq", r6("gap_sec").alias("gap_sec"))


ANCHORS = "WITH r AS (SELECT run_id, max(iteration) AS iterations FROM b_exposure GROUP BY 1), p AS (SELECT run_id, unnest(generate_series(100, iterations - 1, 100)) AS iteration FROM r WHERE iterations > 100), e AS (SELECT run_id, iteration, iteration AS before, 3 AS added, 1 AS deleted, iteration + CASE WHEN iteration % 700 = 0 THEN 3 ELSE 2 END AS after FROM b_exposure WHERE iteration % 50 = 0 AND camera <> 'error')"


@query(ANCHORS + " SELECT run_id, iteration, CASE WHEN e.after IS NULL THEN 'missing' WHEN p.iteration IS NULL THEN 'unplanned' ELSE 'counts' END AS violation FROM p FULL JOIN e USING (run_id, iteration) WHERE e.after IS NULL OR p.iteration IS NULL OR after <> before + added - deleted")
def anchor_event_check(b_exposure):
    r = b_exposure.groupBy("run_id").agg(F.max("iteration").alias("iterations"))
    e = b_exposure.where("iteration % 50 = 0 AND camera <> 'error'").select("run_id", F.col("iteration").cast("long").alias("iteration"), F.col("iteration").alias("before"), F.lit(3).alias("added"), F.lit(1).alias("deleted"), (F.col("iteration") + F.when(F.col("iteration") % 700 == 0, 3).otherwise(2)).alias("after"))
    return telemetry.anchor_event_check(r, e)


@query("SELECT frame_id AS scene_id, count_if(v - 1 <= 0) AS nonpositive_count, round(min(v - 1), 6) AS min_before, round(max(v - 1), 6) AS max_before, round(min(greatest(1e-7, least(0.1, v - 1))), 6) AS min_after, round(max(greatest(1e-7, least(0.1, v - 1))), 6) AS max_after, count(*) AS finite_scale_count FROM b_depth_pixels GROUP BY 1")
def distance_floor_stats(b_depth_pixels):
    d = telemetry.distance_floor_stats(b_depth_pixels.select(F.col("frame_id").alias("scene_id"), (F.col("v") - 1).alias("distance")), 0.1)
    return d.select("scene_id", "nonpositive_count", *[r6(c).alias(c) for c in ("min_before", "max_before", "min_after", "max_after")], "finite_scale_count")


@query("WITH c AS (SELECT user_id AS run_id, event_id AS phase, CAST(json_extract_string(props, '$.k') AS INT) - 2 AS transfers, event_id % 4 - 1 AS bytes, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS errors FROM events) SELECT run_id, phase, concat_ws(',', CASE WHEN transfers < 0 OR bytes < 0 THEN 'negative_counter' END, CASE WHEN errors <> 0 THEN 'errors' END, CASE WHEN (bytes > 0) <> (transfers > 0) THEN 'bytes_without_transfers' END) AS violations FROM c WHERE transfers < 0 OR bytes < 0 OR errors <> 0 OR (bytes > 0) <> (transfers > 0)")
def residency_check(events):
    d = events.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("phase"), (F.get_json_object("props", "$.k").cast("int") - 2).alias("transfers"), (F.col("event_id") % 4 - 1).alias("bytes"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("errors"), F.lit("streaming").alias("strategy"), F.lit(1).alias("peak_frames"))
    return telemetry.residency_violations(d).select("run_id", "phase", F.array_join("violations", ",").alias("violations"))


# ---- clouds and vertices

CORE = " AND ".join(f"isfinite({c})" for c in X.CORE)
OPACITY = "1 / (1 + exp(-greatest(least(opacity, 50), -50)))"
STRETCH = "exp(greatest(least(greatest(scale_0, scale_1, scale_2) - least(scale_0, scale_1, scale_2), 80), 0))"
NORM = "sqrt(rot_0 * rot_0 + rot_1 * rot_1 + rot_2 * rot_2 + rot_3 * rot_3)"


@query(f"SELECT scene_id, count(*) AS vertex_count, round(avg(CASE WHEN {CORE} THEN 1.0 ELSE 0 END), 6) AS finite_core_fraction, round(avg(CASE WHEN {OPACITY} > 0.1 THEN 1.0 ELSE 0 END), 6) AS effective_fraction, round(quantile_cont({OPACITY}, 0.5), 6) AS opacity_q50, round(avg(CASE WHEN {OPACITY} > 0.5 THEN 1.0 ELSE 0 END), 6) AS opacity_gt_05_fraction, round(quantile_cont({STRETCH}, 0.5), 4) AS anisotropy_q50, round(quantile_cont({STRETCH}, 0.99), 4) AS anisotropy_q99, round(avg(CASE WHEN abs({NORM} - 1) <= 0.01 THEN 1.0 ELSE 0 END), 6) AS quaternion_within_1pct_fraction FROM b_gaussians GROUP BY 1")
def gaussian_quality(b_gaussians):
    d = clouds.gaussian_quality(b_gaussians)
    return d.select("scene_id", "vertex_count", *[r6(c).alias(c) for c in ("finite_core_fraction", "effective_fraction", "opacity_q50", "opacity_gt_05_fraction", "quaternion_within_1pct_fraction")], *[F.round(c, 4).alias(c) for c in ("anisotropy_q50", "anisotropy_q99")])


@query(f"SELECT scene_id, vertex_id, round({OPACITY}, 6) AS opacity, round({STRETCH}, 4) AS anisotropy, coalesce(abs({NORM} - 1) <= 0.01, false) AS unit_quaternion, round(CASE WHEN {NORM} > 1e-8 THEN rot_0 / {NORM} ELSE 1 END, 6) AS w FROM b_gaussians WHERE {OPACITY} > 0.1")
def effective_vertices(b_gaussians):
    q = [F.col(f"rot_{i}") for i in range(4)]
    return b_gaussians.where(X.effective()).select("scene_id", "vertex_id", r6(X.activated_opacity(F.col("opacity"))).alias("opacity"), F.round(X.anisotropy(), 4).alias("anisotropy"), X.unit_quaternion(q).alias("unit_quaternion"), r6(X.normalized_quaternion(q)[0]).alias("w"))


@query("SELECT scene_id, round(avg(pow(greatest(greatest(scale_0, scale_1, scale_2) - least(scale_0, scale_1, scale_2) - 1, 0), 2)), 6) AS penalty FROM b_gaussians GROUP BY 1")
def anisotropy_penalty(b_gaussians):
    return clouds.anisotropy_penalty(b_gaussians, 1.0).select("scene_id", r6("penalty").alias("penalty"))


HOLES = "h AS (SELECT scene_id, vertex_id, CASE WHEN vertex_id % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE x END AS x, y, z FROM b_gaussians)"


@query(f"WITH {HOLES} SELECT scene_id, round(avg(CASE WHEN isfinite(x) AND isfinite(y) AND isfinite(z) THEN 0.0 ELSE 1.0 END), 6) AS removed_ratio, count_if(isfinite(x)) AS kept FROM h GROUP BY 1")
def drop_nonfinite_vertices(b_gaussians):
    h = b_gaussians.select("scene_id", "vertex_id", F.when(F.col("vertex_id") % 13 == 0, float("nan")).otherwise(F.col("x")).alias("x"), "y", "z")
    kept, report = clouds.drop_nonfinite(h)
    return report.join(kept.groupBy("scene_id").agg(F.count("*").alias("kept")), "scene_id").select("scene_id", r6("removed_ratio").alias("removed_ratio"), "kept")


@query("SELECT label AS scene_id, 'x' AS field, count(*) AS bad FROM embeddings WHERE vec_id % 13 = 0 GROUP BY 1 UNION ALL SELECT label, 'zero_quaternion', count(*) FROM embeddings WHERE vec_id % 17 = 0 GROUP BY 1")
def vertex_schema_violations(b_gaussians):
    d = b_gaussians.withColumn("x", F.when(F.col("vertex_id") % 13 == 0, float("nan")).otherwise(F.col("x")))
    d = d.withColumns({f"rot_{i}": F.when(F.col("vertex_id") % 17 == 0, 0.0).otherwise(F.col(f"rot_{i}")) for i in range(4)})
    return clouds.vertex_field_violations(d)


@query("WITH r AS (SELECT scene_id, quantile_cont(x, 0.2) AS a, quantile_cont(x, 0.8) AS b FROM b_clouds GROUP BY 1) SELECT c.scene_id, c.cloud, count(*) AS points FROM b_clouds c JOIN r USING (scene_id) WHERE x BETWEEN a AND b AND y BETWEEN -0.1 AND 0.1 AND z BETWEEN -0.2 AND 0.2 GROUP BY ALL")
def crop_roi(b_clouds):
    roi = b_clouds.groupBy("scene_id").agg(F.percentile("x", F.lit(0.2)).alias("x_min"), F.percentile("x", F.lit(0.8)).alias("x_max")).withColumns({"y_min": F.lit(-0.1), "y_max": F.lit(0.1), "z_min": F.lit(-0.2), "z_max": F.lit(0.2)})
    return clouds.crop_roi(b_clouds, roi).groupBy("scene_id", "cloud").agg(F.count("*").alias("points"))


CELL = "CAST(trunc({c} * (1 / 0.1)) AS BIGINT)"
VOX = ", ".join(f"CAST(trunc({c} * (1.0 / CAST(0.1 AS DOUBLE))) AS BIGINT) AS v{c}" for c in "xyz")


@query(f"WITH v AS (SELECT *, {VOX} FROM b_clouds) SELECT scene_id, min(vertex_id) AS vertex_id FROM v GROUP BY scene_id, vx, vy, vz")
def voxel_dedup(b_clouds):
    return clouds.voxel_dedup(b_clouds, 0.1).select("scene_id", "vertex_id")


def _near(source: str, target: str) -> str:
    return f"SELECT s.scene_id, s.vertex_id, least(sqrt(coalesce(min(pow(s.x - t.x, 2) + pow(s.y - t.y, 2) + pow(s.z - t.z, 2)), 1)), 1) AS distance FROM v s LEFT JOIN v t ON t.cloud = '{target}' AND t.scene_id = s.scene_id AND abs(t.vx - s.vx) <= 1 AND abs(t.vy - s.vy) <= 1 AND abs(t.vz - s.vz) <= 1 WHERE s.cloud = '{source}' GROUP BY 1, 2"


@query(f"WITH v AS (SELECT *, {VOX} FROM b_clouds) SELECT scene_id, vertex_id, round(distance, 6) AS distance FROM ({_near('model', 'laser')})")
def voxel_neighbor_distance(b_clouds):
    d = clouds.voxel_neighbor_distance(b_clouds.where("cloud = 'model'"), b_clouds.where("cloud = 'laser'"), 0.1, 1.0)
    return d.select("scene_id", "vertex_id", r6("distance").alias("distance"))


@query(f"WITH v AS (SELECT *, {VOX} FROM b_clouds), a AS (SELECT scene_id, avg(CASE WHEN distance <= 0.12 THEN 1.0 ELSE 0 END) AS p FROM ({_near('model', 'laser')}) GROUP BY 1), c AS (SELECT scene_id, avg(CASE WHEN distance <= 0.12 THEN 1.0 ELSE 0 END) AS r FROM ({_near('laser', 'model')}) GROUP BY 1) SELECT scene_id, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f_score FROM a JOIN c USING (scene_id)")
def f_score(b_clouds):
    m, s = b_clouds.where("cloud = 'model'"), b_clouds.where("cloud = 'laser'")
    d = clouds.f_score(clouds.voxel_neighbor_distance(m, s, 0.1, 1.0), clouds.voxel_neighbor_distance(s, m, 0.1, 1.0), 0.12)
    return d.select("scene_id", *[r6(c).alias(c) for c in ("precision", "recall", "f_score")])


@query()
def plane_metrics(b_gaussians):
    return clouds.plane_metrics(b_gaussians.where(X.effective()).select(F.col("scene_id").cast("long").alias("scene_id"), "x", "y", "z"), 32)


def _sim3_pairs(b_clouds):
    c = [F.col("x"), F.col("y"), F.col("z")]
    return b_clouds.select(F.col("scene_id").cast("long").alias("scene_id"), *[a.alias(n) for a, n in zip(c, ("sx", "sy", "sz"), strict=True)], (-2 * c[1] + 1).alias("tx"), (2 * c[0] - 1).alias("ty"), (2 * c[2] + 0.5).alias("tz"))


@query("SELECT DISTINCT scene_id, CAST(2 AS DOUBLE) AS scale, CAST(1 AS DOUBLE) AS tx, CAST(-1 AS DOUBLE) AS ty, CAST(0.5 AS DOUBLE) AS tz FROM b_clouds")
def estimate_sim3(b_clouds):
    d = clouds.estimate_sim3(_sim3_pairs(b_clouds))
    return d.select("scene_id", F.round("scale", 6).alias("scale"), *[F.round(F.col("translation")[i], 6).alias(n) for i, n in enumerate(("tx", "ty", "tz"))])


@query("SELECT scene_id, vertex_id, round(-2 * y + 1, 6) AS x, round(2 * x - 1, 6) AS y, round(2 * z + 0.5, 6) AS z FROM b_clouds")
def apply_sim3(b_clouds):
    d = clouds.apply_sim3(b_clouds.withColumn("scene_id", F.col("scene_id").cast("long")), clouds.estimate_sim3(_sim3_pairs(b_clouds)))
    return d.select("scene_id", "vertex_id", *[r6(c).alias(c) for c in ("x", "y", "z")])


@query()
def compare_clouds(b_clouds):
    c = b_clouds.withColumn("scene_id", F.col("scene_id").cast("long"))
    roi = c.select("scene_id").distinct().withColumns({f"{a}_{e}": F.lit(v) for a in "xyz" for e, v in (("min", -0.5), ("max", 0.5))})
    pairs = c.where("cloud = 'model'").select("scene_id", *[F.col(a).alias(f"s{a}") for a in "xyz"], *[F.col(a).alias(f"t{a}") for a in "xyz"])
    return clouds.compare_clouds(c.where("cloud = 'model'"), c.where("cloud = 'laser'"), pairs, roi, 0.1, 1.0, (0.1, 0.15))


@query(f"SELECT scene_id, concat_ws(',', CASE WHEN avg(CASE WHEN {OPACITY} > 0.1 THEN 1.0 ELSE 0 END) < 0.35 THEN 'effective_fraction' END, CASE WHEN quantile_cont({STRETCH}, 0.99) > 50 THEN 'anisotropy_q99' END, CASE WHEN avg(CASE WHEN abs({NORM} - 1) <= 0.01 THEN 1.0 ELSE 0 END) < 0.9999 THEN 'quaternion_within_1pct_fraction' END) AS reasons FROM b_gaussians GROUP BY 1")
def ply_gate(b_gaussians):
    return gates.evaluate_gate(clouds.gaussian_quality(b_gaussians), gates.PLY_GATE).select("scene_id", F.array_join("reasons", ",").alias("reasons"))


# ---- trajectories

QN = "sqrt(qw*qw + qx*qx + qy*qy + qz*qz)"
ROT = f"u AS (SELECT scene_id, ord, qw/{QN} AS w, qx/{QN} AS x, qy/{QN} AS y, qz/{QN} AS z, tx, ty, tz FROM b_poses), c AS (SELECT *, -((1-2*(y*y+z*z))*tx + 2*(x*y+w*z)*ty + 2*(x*z-w*y)*tz) AS cx, -(2*(x*y-w*z)*tx + (1-2*(x*x+z*z))*ty + 2*(y*z+w*x)*tz) AS cy, -(2*(x*z+w*y)*tx + 2*(y*z-w*x)*ty + (1-2*(x*x+y*y))*tz) AS cz FROM u)"
STEPS = ROT + ", s AS (SELECT scene_id, ord, cx, cy, cz, sqrt(pow(cx - lag(cx) OVER k, 2) + pow(cy - lag(cy) OVER k, 2) + pow(cz - lag(cz) OVER k, 2)) AS center_step, CASE WHEN lag(w) OVER k IS NOT NULL THEN 2*acos(least(abs(w*lag(w) OVER k + x*lag(x) OVER k + y*lag(y) OVER k + z*lag(z) OVER k), 1)) END AS rotation_step FROM c WINDOW k AS (PARTITION BY scene_id ORDER BY ord))"


@query(f"WITH {STEPS} SELECT scene_id, ord, round(cx, 6) AS cx, round(cy, 6) AS cy, round(cz, 6) AS cz, round(CASE WHEN isnan(center_step) THEN NULL ELSE center_step END, 6) AS center_step, round(rotation_step, 5) AS rotation_step FROM s")
def trajectory_steps(b_poses):
    d = trajectory.quaternion_trajectory(b_poses)
    return d.select("scene_id", "ord", *[r6(c).alias(c) for c in ("cx", "cy", "cz", "center_step")], F.round("rotation_step_rad", 5).alias("rotation_step"))


@query(f"WITH {STEPS}, p AS (SELECT scene_id, ord, center_step, list_sort(list(center_step) OVER (PARTITION BY scene_id ORDER BY ord ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) AS l0 FROM s), q AS (SELECT *, [v FOR v IN l0 IF v IS NOT NULL] AS l FROM p) SELECT scene_id, ord, round(CASE WHEN len(l) >= 3 THEN center_step / ((l[(len(l) - 1) // 2 + 1] + l[len(l) // 2 + 1]) / 2) END, 5) AS ratio FROM q")
def translation_step_ratio(b_poses):
    d = trajectory.translation_step_ratios(trajectory.quaternion_trajectory(b_poses))
    return d.select("scene_id", "ord", F.round("translation_step_ratio", 5).alias("ratio"))


def _matrices(b_poses):
    q = [F.col(c) for c in ("qw", "qx", "qy", "qz")]
    return b_poses.select("scene_id", "ord", F.array(*X.rotation_matrix(X.normalized_quaternion(q))).alias("R"), F.array("tx", "ty", "tz").alias("T"))


@query(f"WITH {STEPS}, t AS (SELECT scene_id, sqrt(pow(tx - lag(tx) OVER k, 2) + pow(ty - lag(ty) OVER k, 2) + pow(tz - lag(tz) OVER k, 2)) AS m FROM b_poses WINDOW k AS (PARTITION BY scene_id ORDER BY ord)), a AS (SELECT scene_id, count(*) AS camera_count, round(degrees(max(rotation_step)), 3) AS max_rotation_step_deg FROM s GROUP BY 1), b AS (SELECT scene_id, round(max(m), 6) AS max_translation_step FROM t GROUP BY 1) SELECT scene_id, camera_count, max_rotation_step_deg, max_translation_step, true AS all_rotations_finite, true AS orthogonal FROM a JOIN b USING (scene_id)")
def trajectory_quality(b_poses):
    d = trajectory.trajectory_quality(_matrices(b_poses))
    return d.select("scene_id", "camera_count", F.round("max_rotation_step_deg", 3).alias("max_rotation_step_deg"), r6("max_translation_step").alias("max_translation_step"), "all_rotations_finite", ((F.col("max_orthogonality_error") < 1e-9) & (F.col("max_determinant_error") < 1e-9)).alias("orthogonal"))


@query(f"WITH {STEPS}, t AS (SELECT scene_id, sqrt(pow(tx - lag(tx) OVER k, 2) + pow(ty - lag(ty) OVER k, 2) + pow(tz - lag(tz) OVER k, 2)) AS m FROM b_poses WINDOW k AS (PARTITION BY scene_id ORDER BY ord)), a AS (SELECT scene_id, count(*) AS n, degrees(max(rotation_step)) AS r FROM s GROUP BY 1), b AS (SELECT scene_id, max(m) / median(m) AS q FROM t GROUP BY 1) SELECT scene_id, concat_ws(',', CASE WHEN r > 25 THEN 'rotation_step' END, CASE WHEN q > 3 THEN 'translation_step_ratio' END, CASE WHEN n % 2 = 1 THEN 'accepted_camera_count' END) AS reasons FROM a JOIN b USING (scene_id)")
def pose_audit(b_poses):
    q = trajectory.trajectory_quality(_matrices(b_poses))
    accepted = b_poses.groupBy("scene_id").agg((F.count("*") - F.count("*") % 2).alias("accepted_camera_count"))
    return trajectory.pose_audit(q, accepted, step_ratio=3.0).select("scene_id", F.array_join("reasons", ",").alias("reasons"))


# The nearest rotation of a matrix near one is the limit of (m + cofactors / determinant) / 2; eight steps are plenty.
_COFACTORS = dict(zip("abcdefghi", ("e*i - f*h", "f*g - d*i", "d*h - e*g", "c*h - b*i", "a*i - c*g", "b*g - a*h", "b*f - c*e", "c*d - a*f", "a*e - b*d"), strict=True))
_QUATERNION = ("1-2*(y*y+z*z)", "2*(x*y-w*z)", "2*(x*z+w*y)", "2*(x*y+w*z)", "1-2*(x*x+z*z)", "2*(y*z-w*x)", "2*(x*z-w*y)", "2*(y*z+w*x)", "1-2*(x*x+y*y)")
POLAR = f"m0 AS (SELECT scene_id, ord, {', '.join(f'({e})*1.5 + 0.01 AS {n}' for n, e in zip('abcdefghi', _QUATERNION, strict=True))} FROM u)" + "".join(f", m{k + 1} AS (SELECT scene_id, ord, {', '.join(f'({n} + ({c}) / q) / 2 AS {n}' for n, c in _COFACTORS.items())} FROM (SELECT *, a*(e*i - f*h) + b*(f*g - d*i) + c*(d*h - e*g) AS q FROM m{k}))" for k in range(8))


@query(f"WITH {ROT}, {POLAR} SELECT scene_id, ord, {', '.join(f'round({n}, 5) + 0.0 AS r{k}' for k, n in enumerate('abcdefghi'))} FROM m8")
def project_to_so3(b_poses):
    d = _matrices(b_poses).withColumn("R", F.transform("R", lambda v: v * 1.5 + 0.01))
    d = d.select("scene_id", "ord", trajectory.project_to_so3("R").alias("R"))
    return d.select("scene_id", "ord", *[(F.round(F.col("R")[k], 5) + 0.0).alias(f"r{k}") for k in range(9)])


# ---- sparse models

VISIBLE = "x >= 10 AND x < 40 AND y >= 5 AND y < 45"


@query("WITH t AS (SELECT t.image_id, t.idx, t.point_id, 'track_of_other_point' AS violation FROM b_tracks t JOIN b_observations o USING (image_id, idx) WHERE o.point_id <> t.point_id), n AS (SELECT image_id, idx, point_id, 'observation_without_track' AS violation FROM b_observations o WHERE point_id <> -1 AND NOT EXISTS (SELECT 1 FROM b_tracks t WHERE t.image_id = o.image_id AND t.idx = o.idx AND t.point_id = o.point_id)), p AS (SELECT image_id, idx, point_id, 'observation_without_point' AS violation FROM b_observations WHERE point_id <> -1 AND point_id % 5 = 0) SELECT * FROM t UNION ALL SELECT * FROM n UNION ALL SELECT * FROM p")
def track_reciprocity(b_observations, b_tracks, b_points):
    return sparse.track_violations(b_observations.select("image_id", "idx", "point_id"), b_tracks, b_points.where("point_id % 5 <> 0")).select("image_id", "idx", "point_id", "violation")


@query("SELECT image_id, camera_id FROM b_images WHERE camera_id % 3 = 0")
def camera_fk(b_images, b_cameras):
    return sparse.camera_violations(b_images, b_cameras.where("camera_id % 3 <> 0"))


@query(f"WITH k AS (SELECT image_id, idx, row_number() OVER (PARTITION BY image_id ORDER BY idx) - 1 AS n FROM b_observations WHERE {VISIBLE}) SELECT t.image_id, k.n AS idx, t.point_id FROM b_tracks t JOIN k USING (image_id, idx)")
def crop_sparse_model(b_observations, b_tracks, b_points):
    _, moved, _ = sparse.crop_sparse_model(b_observations, b_tracks, b_points, 10, 5, 30, 40)
    return moved.select("image_id", F.col("idx").cast("long").alias("idx"), "point_id")


@query("SELECT image_id % 100 AS model, CAST(count_if(image_id % 7 = 0) AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, max(CASE WHEN image_id % 7 <> 0 THEN 0.25 ELSE 0 END) > 0 AS differs FROM b_observations GROUP BY 1")
def compare_sparse_models(b_observations):
    left = b_observations.withColumn("model", F.col("image_id") % 100)
    right = left.where("image_id % 7 <> 0").withColumn("x", F.col("x") + 0.25)
    d = sparse.compare_tables(left, right, ["model", "image_id", "idx"], ["x", "y"], 1e-6, ["model"])
    return d.select("model", "only_left", "only_right", (F.col("max_x_diff") > 0).alias("differs"))


@query("SELECT component, name, name % 3 <> 0 AS registered FROM b_components")
def registered_vs_selected(b_components):
    return sparse.registered_vs_selected(b_components.where("name % 3 <> 0"), b_components, ["component"])


RELATED = "few AS (SELECT component, name FROM b_components), sz AS (SELECT component, count(*) AS n FROM few GROUP BY 1), o AS (SELECT a.component AS l, b.component AS r, count(*) AS overlap_count FROM few a JOIN few b ON a.name = b.name AND a.component < b.component GROUP BY 1, 2), rel AS (SELECT l, r, overlap_count, CASE WHEN overlap_count = x.n AND overlap_count = y.n THEN 'equal_registered_name_set' WHEN overlap_count = x.n THEN 'strict_subset' WHEN overlap_count = y.n THEN 'strict_superset' ELSE 'non_subset_overlap' END AS relation FROM o JOIN sz x ON x.component = l JOIN sz y ON y.component = r)"


@query("WITH sz AS (SELECT component, count(*) AS n FROM b_components GROUP BY 1), o AS (SELECT a.component AS l, b.component AS r, count(*) AS common, string_agg(CAST(a.name AS VARCHAR), ',' ORDER BY a.name) AS names FROM b_components a JOIN b_components b ON a.name = b.name AND a.component < b.component GROUP BY 1, 2) SELECT x.component AS left_component, y.component AS right_component, coalesce(common, 0) AS overlap_count, CASE WHEN common IS NULL THEN 'disjoint' WHEN common = x.n AND common = y.n THEN 'equal_registered_name_set' WHEN common = x.n THEN 'strict_subset' WHEN common = y.n THEN 'strict_superset' ELSE 'non_subset_overlap' END AS relation, coalesce(names, '') AS overlap_names FROM sz x JOIN sz y ON x.component < y.component LEFT JOIN o ON l = x.component AND r = y.component")
def component_relations(b_components):
    names = F.when(F.col("overlap_count") > 0, F.array_join(F.col("overlap_names").cast("array<string>"), ",")).otherwise("")
    return sparse.pair_relations(b_components).select(F.col("left").alias("left_component"), F.col("right").alias("right_component"), "overlap_count", "relation", names.alias("overlap_names"))


INVENTORY = "pos AS (SELECT p_partkey AS name, row_number() OVER (ORDER BY p_partkey) - 1 AS position FROM part), m AS (SELECT f.component, p.position FROM few f JOIN pos p USING (name)), i AS (SELECT component, position - row_number() OVER (PARTITION BY component ORDER BY position) AS g, position FROM m), ru AS (SELECT component, count(*) AS n, min(position) AS s FROM i GROUP BY component, g), tp AS (SELECT component, max(n) AS longest_run FROM ru GROUP BY 1), iv AS (SELECT m.component, count(*) AS registered, any_value(longest_run) AS longest_run FROM m JOIN tp USING (component) GROUP BY 1)"


def _inventory(b_components, part):
    positions = frames.dense_positions(part.select(F.col("p_partkey").alias("name")), "name")
    return sparse.component_inventory(b_components, positions)


@query(f"WITH {RELATED}, {INVENTORY} SELECT component, registered, longest_run FROM iv")
def component_inventory(b_components, part):
    return _inventory(b_components, part).select("component", "registered", "longest_run")


@query(f"WITH {RELATED}, {INVENTORY}, sub AS (SELECT l AS component FROM rel WHERE relation = 'strict_subset' UNION SELECT r FROM rel WHERE relation = 'strict_superset'), act AS (SELECT iv.*, sub.component IS NULL AS active FROM iv LEFT JOIN sub USING (component)), rk AS (SELECT *, row_number() OVER (ORDER BY active DESC, longest_run DESC, registered DESC, component) AS rank FROM act) SELECT component, CAST(rank AS INT) AS rank, CASE WHEN NOT active THEN 'dominated' WHEN rank = 1 THEN 'selected' ELSE 'not_selected' END AS status FROM rk")
def select_component(b_components, part):
    d = sparse.select_component(_inventory(b_components, part), sparse.strict_subsets(b_components))
    return d.select("component", "rank", "status")


CAND = "c AS (SELECT o_custkey % 50 AS capture_id, o_custkey AS model_name, count(*) AS n, sum(o_orderkey) % 1000 AS p, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(o_custkey % 9 AS DOUBLE) END AS e FROM orders GROUP BY ALL)"


@query(f"WITH {CAND}, s AS (SELECT *, n + CASE WHEN e IS NULL THEN 0 ELSE 1 / (1 + e) END + 0.25 * ln(1 + p) AS score FROM c) SELECT capture_id, model_name, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY capture_id ORDER BY score DESC, model_name) AS INT) AS rank FROM s")
def rank_model_candidates(orders):
    g = orders.groupBy((F.col("o_custkey") % 50).alias("capture_id"), F.col("o_custkey").alias("model_name")).agg(F.count("*").alias("registered_image_count"), (F.sum("o_orderkey") % 1000).alias("triangulated_point_count"))
    g = g.withColumn("reprojection_error_px", F.when(F.col("model_name") % 4 != 0, (F.col("model_name") % 9).cast("double")))
    return sparse.rank_model_candidates(g).select("capture_id", "model_name", r6("score").alias("score"), "rank")


@query("WITH o AS (SELECT image_id % 100 AS model_id, count(DISTINCT image_id) AS images, count(*) AS observations, count_if(point_id <> -1) AS tracked FROM b_observations GROUP BY 1), t AS (SELECT image_id % 100 AS model_id, count(DISTINCT point_id) AS points, count(*) AS tracks FROM b_tracks GROUP BY 1) SELECT o.*, coalesce(points, 0) AS points, coalesce(tracks, 0) AS tracks FROM o LEFT JOIN t USING (model_id)")
def model_counts(b_observations, b_tracks):
    m = (F.col("image_id") % 100).alias("model_id")
    return sparse.model_counts(b_observations.select("*", m), b_tracks.select("*", m), ["model_id"])


@query("WITH o AS (SELECT image_id % 20 AS model_id, count(DISTINCT image_id) AS registered_image_count FROM b_observations GROUP BY 1), l AS (SELECT image_id % 20 AS model_id, point_id, count(*) AS n FROM b_tracks GROUP BY 1, 2), t AS (SELECT model_id, count(*) AS track_count, min(n) AS track_min, max(n) AS track_max, round(avg(n), 6) AS track_mean, median(n) AS track_median FROM l GROUP BY 1), p AS (SELECT point_id % 20 AS model_id, count(*) AS error_count, round(avg(error), 6) AS error_mean, median(error) AS error_median FROM b_points GROUP BY 1) SELECT * FROM o JOIN p USING (model_id) JOIN t USING (model_id)")
def sparse_model_evidence(b_observations, b_tracks, b_points):
    m = (F.col("image_id") % 20).alias("model_id")
    d = sparse.sparse_model_evidence(b_observations.select("*", m), b_tracks.select("*", m), b_points.select("*", (F.col("point_id") % 20).alias("model_id")), ["model_id"])
    return d.select("model_id", "registered_image_count", "track_count", "track_min", "track_max", r6("track_mean").alias("track_mean"), "track_median", "error_count", r6("error_mean").alias("error_mean"), "error_median")


@query("WITH e AS (SELECT image_id % 20 AS model_id, count(DISTINCT image_id) AS n FROM b_observations GROUP BY 1) SELECT model_id, concat_ws(',', CASE WHEN model_id % 3 <> 1 THEN 'component_count_must_equal_one' END, CASE WHEN n < 2 THEN 'too_few_registered_images' END, CASE WHEN model_id % 5 = 0 THEN 'non_positive_focal_length' END, CASE WHEN model_id % 7 = 0 THEN 'camera_trajectory_not_continuous' END) AS hard_failures FROM e")
def sparse_geometry_gate(b_observations):
    e = b_observations.groupBy((F.col("image_id") % 20).alias("model_id")).agg(F.count_distinct("image_id").alias("registered_image_count"))
    m = F.col("model_id")
    e = e.withColumns({"component_count": m % 3, "camera_count": F.lit(1), "fx": F.when(m % 5 == 0, 0.0).otherwise(500.0), "fy": F.lit(500.0), "point_count": F.lit(10), "centers_finite": F.lit(True), "continuous": m % 7 != 0, "reprojection_error_px": F.lit(None).cast("double"), "track_count": F.lit(1)})
    return sparse.geometry_gate(e).select("model_id", F.array_join("hard_failures", ",").alias("hard_failures"))


@query("WITH c AS (SELECT l_orderkey AS frame_id, l_linenumber AS reference_index, l_quantity / 50 AS r, l_discount AS g, l_tax AS e, l_returnflag = 'R' AS hard, l_linestatus = 'F' AS q FROM lineitem) SELECT frame_id, reference_index FROM (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY r DESC, g DESC, e, reference_index) AS n FROM c WHERE NOT hard AND NOT q) WHERE n = 1")
def select_pose_candidate(lineitem):
    none = F.array().cast("array<string>")
    c = lineitem.select(F.col("l_orderkey").alias("frame_id"), F.col("l_linenumber").alias("reference_index"), (F.col("l_quantity") / 50).alias("inlier_ratio"), F.col("l_discount").alias("grid_coverage"), F.col("l_tax").alias("reprojection_rmse_px"), F.when(F.col("l_returnflag") == "R", F.array(F.lit("x"))).otherwise(none).alias("hard_reasons"), F.when(F.col("l_linestatus") == "F", F.array(F.lit("x"))).otherwise(none).alias("quality_reasons"))
    return sparse.select_pose_candidate(c).select("frame_id", "reference_index")


@query("WITH s AS (SELECT user_id AS video_id, event_type, count(*) AS frame_count, min(event_id) AS start FROM events GROUP BY 1, 2), t AS (SELECT *, max(frame_count) OVER (PARTITION BY video_id) AS m FROM s) SELECT video_id, max(m) AS frame_count, min(start) AS start, count(*) AS ties FROM t WHERE frame_count = m GROUP BY 1")
def longest_segment(events):
    s = events.groupBy(F.col("user_id").alias("video_id"), "event_type").agg(F.count("*").alias("frame_count"), F.min("event_id").alias("start"))
    return sparse.longest_segment(s, ["video_id"])


@query("WITH f AS (SELECT DISTINCT l_suppkey AS capture, l_partkey % 20 AS folder, CASE l_linenumber % 4 WHEN 0 THEN 'cameras' WHEN 1 THEN 'images' WHEN 2 THEN 'points3D' ELSE 'other' END AS kind FROM lineitem), w AS (SELECT capture, folder FROM f WHERE kind <> 'other' GROUP BY 1, 2 HAVING count(DISTINCT kind) = 3) SELECT capture, count(*) AS models FROM w GROUP BY 1")
def model_inventory(lineitem):
    kind = F.element_at(F.array(*map(F.lit, ("cameras", "images", "points3D", "other"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    return sparse.model_inventory(lineitem.select(F.col("l_suppkey").alias("capture"), (F.col("l_partkey") % 20).alias("folder"), kind.alias("kind"))).select("capture", "models")


# ---- cameras


def _camera(b_cameras):
    k = X.normalize_camera(F.col("model"), [F.col(f"p{i}") for i in range(4)])
    return b_cameras.withColumns(k), k


CAM = "k AS (SELECT *, CASE WHEN model <> 'OPENCV' THEN p0 END AS fx, CASE model WHEN 'PINHOLE' THEN p1 WHEN 'SIMPLE_PINHOLE' THEN p0 WHEN 'SIMPLE_RADIAL' THEN p0 END AS fy, CASE model WHEN 'PINHOLE' THEN p2 WHEN 'SIMPLE_PINHOLE' THEN p1 WHEN 'SIMPLE_RADIAL' THEN p1 END AS cx, CASE model WHEN 'PINHOLE' THEN p3 WHEN 'SIMPLE_PINHOLE' THEN p2 WHEN 'SIMPLE_RADIAL' THEN p2 END AS cy FROM b_cameras)"


@query(f"WITH {CAM} SELECT camera_id, fx, fy, cx, cy, model = 'OPENCV' AS invalid_model FROM k")
def normalize_camera(b_cameras):
    return _camera(b_cameras)[0].select("camera_id", "fx", "fy", "cx", "cy", "invalid_model")


@query(f"WITH {CAM}, r AS (SELECT *, (camera_id % 4) * 90 AS rot FROM k WHERE model <> 'OPENCV') SELECT camera_id, rot, CASE WHEN rot IN (90, 270) THEN fy ELSE fx END * 0.5 AS fx, round(CASE rot WHEN 90 THEN height - cy WHEN 180 THEN width - cx WHEN 270 THEN cy ELSE cx END * 0.5 + 1, 6) AS cx, round(CASE rot WHEN 90 THEN cx WHEN 180 THEN height - cy WHEN 270 THEN width - cx ELSE cy END * 0.5 + 1, 6) AS cy, CAST(round_even(CASE WHEN rot IN (90, 270) THEN height ELSE width END * CAST(0.5 AS DOUBLE), 0) AS BIGINT) AS width FROM r")
def transform_intrinsics(b_cameras):
    d, k = _camera(b_cameras)
    half, one, rot = F.lit(0.5), F.lit(1.0), F.col("camera_id") % 4 * 90
    new = X.transform_intrinsics(rot, {n: F.col(n) for n in ("fx", "fy", "cx", "cy")}, F.col("width"), F.col("height"), half, half, one, one)
    return d.where("NOT invalid_model").select("camera_id", rot.alias("rot"), new["fx"].alias("fx"), r6(new["cx"]).alias("cx"), r6(new["cy"]).alias("cy"), new["width"].alias("width"))


@query(f"WITH {CAM} SELECT camera_id, concat_ws(',', CASE WHEN model NOT IN ('PINHOLE', 'SIMPLE_PINHOLE') THEN 'model' END, CASE WHEN NOT coalesce(fx > 0 AND fy > 0, false) THEN 'focal' END, CASE WHEN NOT coalesce(abs(cx - width / 2) <= 0.5, false) THEN 'center_x' END, CASE WHEN NOT coalesce(abs(cy - height / 2) <= 0.5, false) THEN 'center_y' END) AS violations FROM k")
def centered_pinhole_check(b_cameras):
    d, _ = _camera(b_cameras)
    v = X.centered_pinhole_violations(F.col("model"), {n: F.col(n) for n in ("fx", "fy", "cx", "cy")}, F.col("width"), F.col("height"))
    return d.select("camera_id", F.array_join(v, ",").alias("violations"))


@query("WITH c AS (SELECT camera_id, width, 320 + camera_id % 30 AS cx FROM b_cameras), n AS (SELECT camera_id, width, cx, unnest(generate_series(CAST(ceil(width * 0.75) AS BIGINT), width)) AS len FROM c), o AS (SELECT *, greatest(CAST(ceil(cx - len / 2 - 0.5) AS BIGINT), 0) AS origin FROM n), f AS (SELECT * FROM o WHERE abs(cx - origin - len / 2) <= 0.5 AND origin + len <= width) SELECT camera_id, max(len) AS length, arg_max(origin, len) AS origin FROM f GROUP BY 1")
def plan_centered_crop(b_cameras):
    crop = X.centered_crop(F.col("width"), (320 + F.col("camera_id") % 30).cast("double"))
    return b_cameras.select("camera_id", crop.alias("c")).where("c IS NOT NULL").select("camera_id", F.col("c.length").cast("long").alias("length"), F.col("c.origin").cast("long").alias("origin"))


@query("SELECT o_orderkey AS camera_id, printf('frame_%06d.png', o_orderkey) AS staged, o_orderpriority NOT LIKE '%HIGH%' AS safe FROM orders")
def stage_frame_name(orders):
    path = F.when(F.contains("o_orderpriority", F.lit("HIGH")), "../x").otherwise("frames/x")
    return orders.select(F.col("o_orderkey").alias("camera_id"), X.stage_frame_name(F.col("o_orderkey")).alias("staged"), X.safe_relative_path(path).alias("safe"))


# ---- images


@query("WITH a AS (SELECT run_id, ordinal, avg(pow(left_v - right_v, 2)) AS mse, avg(abs(left_v - right_v)) AS mad, avg(left_v) AS ma, avg(right_v) AS mb, var_pop(left_v) AS va, var_pop(right_v) AS vb, covar_pop(left_v, right_v) AS ab FROM b_pairs GROUP BY 1, 2) SELECT run_id, ordinal, round(mse, 6) AS mse, round(10 * log10(1 / mse), 5) AS psnr, round(((2*ma*mb + 0.0001) * (2*ab + 0.0009)) / ((ma*ma + mb*mb + 0.0001) * (va + vb + 0.0009)), 6) AS ssim, round(mad, 6) AS mean_abs_diff FROM a")
def image_pair_metrics(b_pairs):
    d = images.image_pair_metrics(b_pairs)
    return d.select("run_id", "ordinal", r6("mse").alias("mse"), F.round("psnr", 5).alias("psnr"), r6("ssim").alias("ssim"), r6("mean_abs_diff").alias("mean_abs_diff"))


PAIRED = "a AS (SELECT run_id, ordinal, avg(pow(left_v - right_v, 2)) AS mse, avg(abs(left_v - right_v)) AS mad, avg(left_v) AS ma FROM b_pairs GROUP BY 1, 2), p AS (SELECT *, 10 * log10(1 / mse) AS psnr FROM a)"


@query(f"WITH {PAIRED} SELECT run_id, count(*) AS views, round(avg(mse), 6) AS mse_mean, round(quantile_cont(mse, 0.1), 6) AS mse_p10, round(max(mse), 6) AS mse_max, round(avg(psnr), 5) AS psnr_mean, round(min(psnr), 5) AS psnr_min FROM p GROUP BY 1")
def view_metric_summary(b_pairs):
    d = images.view_metric_summary(images.image_pair_metrics(b_pairs))
    return d.select("run_id", "views", *[r6(c).alias(c) for c in ("mse_mean", "mse_p10", "mse_max")], *[F.round(c, 5).alias(c) for c in ("psnr_mean", "psnr_min")])


@query(f"WITH {PAIRED} SELECT run_id, round(avg(psnr), 5) AS mean_psnr, round(min(psnr), 5) AS min_psnr, CASE WHEN max(ma) < 1e-4 THEN 'fail' ELSE 'needs_review' END AS health FROM p GROUP BY 1")
def postcheck_metrics(b_pairs):
    b = b_pairs.groupBy("run_id", "ordinal").agg(F.avg("left_v").alias("image_mean"))
    return images.postcheck_metrics(images.image_pair_metrics(b_pairs), b).select("run_id", F.round("mean_psnr", 5).alias("mean_psnr"), F.round("min_psnr", 5).alias("min_psnr"), "health")


@query("WITH i AS (SELECT label AS run_id, vec_id, avg(255 * (e + 0.5)) AS m, stddev_pop(255 * (e + 0.5)) AS s FROM b_elements GROUP BY 1, 2) SELECT run_id, count(*) AS images, round(max(m), 5) AS max_mean, round(min(s), 5) AS min_std, CASE WHEN max(m) < 1e-4 OR max(s) < 1e-5 THEN 'fail' WHEN max(s) < 1 THEN 'warn' ELSE 'pass' END AS status FROM i GROUP BY 1")
def render_health(b_elements):
    px = 255 * (F.col("e") + 0.5)
    i = b_elements.groupBy(F.col("label").alias("run_id"), "vec_id").agg(F.avg(px).alias("mean"), F.stddev_pop(px).alias("std"), F.first("vec_id").alias("sha"))
    return images.render_health(i).select("run_id", "images", F.round("max_mean", 5).alias("max_mean"), F.round("min_std", 5).alias("min_std"), "status")


@query(f"WITH {PAIRED} SELECT run_id, count(*) AS views, count_if(mse > 0.025) AS bad_views FROM p GROUP BY 1")
def converted_eval_verdict(b_pairs):
    return images.converted_eval_verdict(images.image_pair_metrics(b_pairs), most_mse=0.025).select("run_id", "views", "bad_views")


@query("SELECT coalesce(a.ordinal, b.ordinal) AS ordinal, coalesce(a.run_id, b.run_id) AS run_id, CASE WHEN b.ordinal IS NULL THEN 'left_only' WHEN a.ordinal IS NULL THEN 'right_only' ELSE 'paired' END AS status FROM (SELECT label AS run_id, vec_id AS ordinal FROM embeddings WHERE vec_id % 3 <> 0) a FULL JOIN (SELECT label AS run_id, vec_id AS ordinal FROM embeddings WHERE vec_id % 5 <> 0) b ON a.run_id = b.run_id AND a.ordinal = b.ordinal")
def pair_views(embeddings):
    v = embeddings.select(F.col("label").alias("run_id"), F.col("vec_id").alias("ordinal"), F.col("vec_id").alias("view"))
    return images.pair_views(v.where("ordinal % 3 <> 0"), v.where("ordinal % 5 <> 0")).select("ordinal", "run_id", "status")


@query("SELECT l_suppkey AS run_id, l_partkey AS camera, CASE WHEN count_if(l_discount = 0) = 0 THEN 'missing' WHEN count_if(l_discount = 0) > 1 THEN 'several' ELSE 'pixels' END AS violation FROM lineitem GROUP BY 1, 2 HAVING count_if(l_discount = 0) <> 1 OR max(CASE WHEN l_discount = 0 THEN l_returnflag END) <> 'N'")
def endpoint_match(lineitem):
    views = lineitem.select(F.col("l_suppkey").alias("run_id"), F.col("l_partkey").alias("camera")).distinct().withColumn("sha", F.lit("N"))
    poses = lineitem.select(F.col("l_suppkey").alias("run_id"), F.col("l_partkey").alias("left"), F.col("l_partkey").alias("right"), F.col("l_discount").alias("alpha"), F.col("l_returnflag").alias("sha"))
    return images.endpoint_match(views, poses).select("run_id", "camera", "violation")


@query("WITH s AS (SELECT user_id AS run_id, event_type AS segment, min(event_id) AS f, max(event_id) AS l, min(value) AS a, max(value) AS b FROM events GROUP BY 1, 2), g AS (SELECT run_id, segment, l AS last_camera, lead(f) OVER w AS next_camera, lead(a) OVER w - b AS gap_sec FROM s WINDOW w AS (PARTITION BY run_id ORDER BY segment)) SELECT run_id, segment, last_camera, next_camera, round(gap_sec, 6) AS gap_sec, CASE WHEN last_camera % 2 = 0 THEN 1 ELSE 0 END AS midpoints FROM g WHERE next_camera IS NOT NULL")
def cross_gap_midpoint(events):
    from pyspark.sql import Window

    s = events.groupBy(F.col("user_id").alias("run_id"), F.col("event_type").alias("segment")).agg(F.min("event_id").alias("first_camera"), F.max("event_id").alias("last_camera"), F.min("value").alias("start_sec"), F.max("value").alias("end_sec"))
    poses = s.select("run_id", F.col("last_camera").alias("left"), F.lead("first_camera").over(Window.partitionBy("run_id").orderBy("segment")).alias("right"), F.lit(0.5).alias("alpha")).where("left % 2 = 0")
    d = images.cross_gap_midpoints(s, poses)
    return d.select("run_id", "segment", "last_camera", "next_camera", r6("gap_sec").alias("gap_sec"), F.col("midpoints").cast("int").alias("midpoints"))


@query("WITH a AS (SELECT run_id, ordinal // 10 AS o, avg(pow(left_v - right_v, 2)) AS mse FROM b_pairs GROUP BY 1, 2), p AS (SELECT run_id, o, 10 * log10(1 / mse) AS psnr FROM a) SELECT x.o AS ordinal, round(x.psnr - y.psnr, 5) AS psnr_delta FROM p x JOIN p y ON x.o = y.o AND x.run_id = 0 AND y.run_id = 1")
def compare_runs(b_pairs):
    m = images.image_pair_metrics(b_pairs.withColumn("ordinal", F.expr("ordinal div 10")))
    return images.compare_runs(m, 0, 1).select("ordinal", F.round("psnr_delta", 5).alias("psnr_delta"))


# Blurs of 8x8 images as weights of rows (then columns): a Gaussian over 11 places, mirrored at the edges.
BLURRED = """g AS (SELECT t, exp(-t * t / 4.5) AS w FROM (SELECT unnest(generate_series(-5, 5)) AS t)), k AS (SELECT o, CASE WHEN o + t < 0 THEN -o - t WHEN o + t > 7 THEN 14 - o - t ELSE o + t END AS s, sum(w / (SELECT sum(w) FROM g)) AS w FROM g, (SELECT unnest(generate_series(0, 7)) AS o) GROUP BY 1, 2),
p AS (SELECT run_id, ordinal, (px - 1) // 8 AS y, (px - 1) % 8 AS x, round(255 * left_v) AS a, round(255 * right_v) AS b FROM b_pairs),
d AS (SELECT run_id, ordinal, o AS y, x, sum(w * a) AS a, sum(w * b) AS b, sum(w * a * a) AS aa, sum(w * b * b) AS bb, sum(w * a * b) AS ab FROM p JOIN k ON s = y GROUP BY run_id, ordinal, o, x),
z AS (SELECT run_id, ordinal, y, o AS x, sum(w * a) AS a, sum(w * b) AS b, sum(w * aa) AS aa, sum(w * bb) AS bb, sum(w * ab) AS ab FROM d JOIN k ON s = x GROUP BY run_id, ordinal, y, o),
v AS (SELECT run_id, ordinal, avg((2 * a * b + 6.5025) * (2 * (ab - a * b) + 58.5225) / ((a * a + b * b + 6.5025) * (aa - a * a + bb - b * b + 58.5225))) AS ssim FROM z GROUP BY 1, 2), f AS (SELECT run_id, ordinal, avg((a - b) * (a - b)) AS mse FROM p GROUP BY 1, 2)"""


@query(f"WITH {BLURRED} SELECT run_id, ordinal, round(CASE WHEN mse > 0 THEN 10 * log10(65025 / mse) END, 5) AS psnr, round(ssim, 5) AS ssim FROM f JOIN v USING (run_id, ordinal)")
def pixel_pair_metrics(b_pairs):
    packed = lambda c: F.expr(f"unhex(array_join(transform(array_sort(collect_list(struct(px, {c}))), x -> lpad(hex(cast(round(255 * x.{c}) AS INT)), 2, '0')), ''))")
    d = b_pairs.groupBy("run_id", "ordinal").agg(packed("left_v").alias("left"), packed("right_v").alias("right"), F.lit(8).alias("height"), F.lit(8).alias("width"))
    return images.pixel_pair_metrics(d).select("run_id", "ordinal", *[F.round(c, 5).alias(c) for c in ("psnr", "ssim")])


# An 8x8 image's own cells are its pixels, so its mean hash has one bit for each, the first one highest. Variances are whole multiples of 1 / 4096.
PIXELS = """p AS (SELECT CAST(label AS BIGINT) AS video_id, vec_id AS frame_index, i, (i - 1) // 8 AS y, (i - 1) % 8 AS x, least(greatest(round(255 * (e + 0.5)), 0), 255) AS v FROM b_elements),
n AS (SELECT *, avg(v) OVER (PARTITION BY frame_index) AS m, coalesce(lag(v) OVER r, v) + coalesce(lead(v) OVER r, v) + coalesce(lag(v) OVER c, v) + coalesce(lead(v) OVER c, v) - 4 * v AS lap FROM p WINDOW r AS (PARTITION BY frame_index, y ORDER BY x), c AS (PARTITION BY frame_index, x ORDER BY y)),
f AS (SELECT video_id, frame_index, round(var_pop(lap) * 4096) / 4096 AS sharpness, avg(CASE WHEN v >= 250 THEN 1.0 ELSE 0 END) AS overexposed_ratio, avg(CASE WHEN v <= 5 THEN 1.0 ELSE 0 END) AS underexposed_ratio, CAST(sum(CASE WHEN v > m THEN CAST(CASE WHEN i = 1 THEN -9223372036854775808 ELSE CAST(power(2, 64 - i) AS HUGEINT) END AS HUGEINT) ELSE 0 END) AS BIGINT) AS mean_hash FROM n GROUP BY 1, 2)"""


@query(f"WITH {PIXELS} SELECT *, CAST(bit_count(xor(mean_hash, lag(mean_hash) OVER (PARTITION BY video_id ORDER BY frame_index))) AS INT) AS duplicate_score FROM f")
def frame_pixel_metrics(b_elements):
    data = F.expr("unhex(array_join(transform(array_sort(collect_list(struct(i, e))), x -> lpad(hex(cast(least(greatest(round(255 * (x.e + 0.5)), 0), 255) AS INT)), 2, '0')), ''))")
    d = b_elements.groupBy(F.col("label").cast("long").alias("video_id"), F.col("vec_id").alias("frame_index")).agg(data.alias("data"), F.lit(8).alias("height"), F.lit(8).alias("width"))
    return images.frame_pixel_metrics(d).withColumn("sharpness", F.round(F.col("sharpness") * 4096) / 4096)


# ---- depth


@query("WITH f AS (SELECT DISTINCT o_custkey % 100 AS run_id, o_orderkey AS path FROM orders), m AS (SELECT l_orderkey AS path, count(*) AS n FROM lineitem WHERE l_discount < 0.03 GROUP BY 1), j AS (SELECT f.run_id, f.path, n FROM f LEFT JOIN m USING (path)) SELECT run_id, path, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'duplicate' ELSE 'matched' END AS status FROM j")
def depth_coverage(orders, lineitem):
    f = orders.select((F.col("o_custkey") % 100).alias("run_id"), F.col("o_orderkey").alias("path"))
    m = lineitem.where("l_discount < 0.03").select(F.col("l_orderkey").alias("path")).join(f, "path").select("run_id", "path")
    return depth.depth_coverage(f, m)


@query("""WITH d AS (SELECT frame_id, v, 1 / d_ref AS w FROM b_depth_pixels WHERE d_ref > 0), f AS (SELECT frame_id, count(*) AS pixels, regr_slope(w, v) AS a, regr_intercept(w, v) AS b FROM d GROUP BY 1),
r AS (SELECT d.*, w - (a * v + b) AS e FROM d JOIN f USING (frame_id)), s AS (SELECT frame_id, avg(e) AS m, stddev_samp(e) AS sd FROM r GROUP BY 1), k AS (SELECT r.* FROM r JOIN s USING (frame_id) WHERE abs(e - m) <= sd),
g AS (SELECT frame_id, count(*) AS kept, regr_slope(w, v) AS slope, regr_intercept(w, v) AS offs, corr(v, w) AS correlation FROM k GROUP BY 1), q AS (SELECT k.frame_id, sqrt(avg(pow(w - slope * v - offs, 2))) AS rmse, quantile_disc(w, 0.5) AS mid FROM k JOIN g USING (frame_id) GROUP BY 1)
SELECT frame_id, pixels, kept, round(slope, 5) AS slope, round(offs, 5) AS offset_, round(correlation, 5) AS correlation, round(rmse, 5) AS rmse, round(rmse / mid, 5) AS normalized_rmse FROM f JOIN g USING (frame_id) JOIN q USING (frame_id)""")
def fit_depth_alignment(b_depth_pixels):
    d = depth.fit_depth_alignment(b_depth_pixels)
    return d.select("frame_id", "pixels", "kept", *[F.round(c, 5).alias(c.replace("offset", "offset_")) for c in ("slope", "offset", "correlation", "rmse", "normalized_rmse")])


@query("SELECT frame_id, count(*) AS match_count, count_if(abs(residual) <= 1) AS inlier_count, round(sqrt(avg(CASE WHEN abs(residual) <= 1 THEN pow(residual, 2) END)), 6) AS rmse, count(DISTINCT CASE WHEN abs(residual) <= 1 THEN least(greatest(floor(v * 4), 0), 3) * 4 + least(greatest(floor(u * 4), 0), 3) END) / 16 AS grid_coverage, round(avg(CASE WHEN depth > 0 THEN 1.0 ELSE 0 END), 6) AS positive_depth_ratio FROM b_matches GROUP BY 1")
def match_quality(b_matches):
    d = depth.match_quality(b_matches, 1.0)
    return d.select("frame_id", "match_count", "inlier_count", r6("reprojection_rmse_px").alias("rmse"), "grid_coverage", r6("positive_depth_ratio").alias("positive_depth_ratio"))


@query("WITH q AS (SELECT frame_id, count(*) AS mc, count_if(abs(residual) <= 1) AS ic, sqrt(avg(CASE WHEN abs(residual) <= 1 THEN pow(residual, 2) END)) AS rmse, avg(CASE WHEN depth > 0 THEN 1.0 ELSE 0 END) AS pos FROM b_matches GROUP BY 1) SELECT frame_id, concat_ws(',', CASE WHEN mc < 100 THEN 'match_count' END, CASE WHEN ic < 50 THEN 'inlier_count' END, CASE WHEN ic / mc < 0.7 THEN 'inlier_ratio' END, CASE WHEN rmse > 0.5 THEN 'reprojection_rmse' END, CASE WHEN pos < 0.99 THEN 'positive_depth' END) AS reasons FROM q")
def online_pose_gate(b_matches):
    d = depth.match_quality(b_matches, 1.0).withColumn("rotation_step_deg", F.lit(None).cast("double")).withColumn("translation_step_ratio", F.lit(None).cast("double"))
    return trajectory.pose_attempt_reasons(d, least_inlier_ratio=0.7, most_rmse=0.5, least_positive=0.99).select("frame_id", F.array_join("rejection_reasons", ",").alias("reasons"))


# Gradients are central inside and one-sided at the edges; erosion takes what lies outside as not reliable.
MASKS = """p AS (SELECT vec_id AS frame_id, (i - 1) // 8 AS y, (i - 1) % 8 AS x, 1 + e > 0 AS ok, CASE WHEN 1 + e > 0 THEN 1 + e ELSE 0 END AS d FROM b_elements),
g AS (SELECT *, (coalesce(lead(d) OVER r, d) - coalesce(lag(d) OVER r, d)) / CASE WHEN x IN (0, 7) THEN 1 ELSE 2 END AS gx, (coalesce(lead(d) OVER c, d) - coalesce(lag(d) OVER c, d)) / CASE WHEN y IN (0, 7) THEN 1 ELSE 2 END AS gy FROM p WINDOW r AS (PARTITION BY frame_id, y ORDER BY x), c AS (PARTITION BY frame_id, x ORDER BY y)),
e AS (SELECT *, sqrt(gx * gx + gy * gy) AS edge FROM g), q AS (SELECT frame_id, quantile_cont(edge, 0.9) FILTER (WHERE ok) AS most FROM e GROUP BY 1), b AS (SELECT e.*, ok AND edge <= most AS good FROM e JOIN q USING (frame_id)),
s AS (SELECT *, good AND coalesce(lag(good) OVER r, false) AND coalesce(lead(good) OVER r, false) AND coalesce(lag(good) OVER c, false) AND coalesce(lead(good) OVER c, false) AS inner_ FROM b WINDOW r AS (PARTITION BY frame_id, y ORDER BY x), c AS (PARTITION BY frame_id, x ORDER BY y))"""


@query(f"WITH {MASKS} SELECT frame_id, avg(CASE WHEN ok THEN 1.0 ELSE 0 END) AS valid_ratio, avg(CASE WHEN inner_ THEN 1.0 ELSE 0 END) AS reliable_ratio, round(coalesce(avg(CASE WHEN edge > 1e-3 THEN 1.0 ELSE 0 END) FILTER (WHERE ok), 0), 6) AS texture_ratio FROM s GROUP BY 1")
def depth_masks(b_elements):
    d = b_elements.groupBy(F.col("vec_id").alias("frame_id")).agg(F.expr("transform(array_sort(collect_list(struct(i, e))), x -> 1 + x.e)").alias("depth"), F.lit(8).alias("height"), F.lit(8).alias("width"))
    return depth.depth_masks(d).withColumn("texture_ratio", r6(F.col("texture_ratio")))


# ---- runs


@query("SELECT run_id, stage, attempt, status FROM (SELECT *, row_number() OVER (PARTITION BY run_id, stage ORDER BY attempt DESC) AS n FROM b_attempts) WHERE n = 1")
def latest_attempt(b_attempts):
    return runs.latest_attempt(b_attempts).select("run_id", "stage", "attempt", "status")


@query("SELECT run_id, stage, count(*) AS attempts, max(attempt) AS latest_attempt, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'blocked') THEN 'blocked' ELSE 'passed' END AS merged_status, arg_max(status, attempt) AS latest_status FROM b_attempts GROUP BY 1, 2")
def stage_observations(b_attempts):
    return runs.stage_observations(b_attempts)


@query("SELECT run_id, stage, attempt, CAST(list_position(['view','click','cart','purchase','error'], stage) AS BIGINT) AS position, CAST(60 AS DOUBLE) AS seconds FROM (SELECT *, row_number() OVER (PARTITION BY run_id, stage ORDER BY attempt DESC) AS n FROM b_attempts) WHERE n = 1")
def stage_timing(b_attempts):
    d = b_attempts.withColumn("started_at", F.col("ts").cast("timestamp")).withColumn("finished_at", F.col("started_at") + F.expr("INTERVAL 1 MINUTE"))
    return runs.stage_timing(d, ["view", "click", "cart", "purchase", "error"]).select("run_id", "stage", "attempt", F.when(F.col("position") > 0, F.col("position")).alias("position"), "seconds")


@query("SELECT run_id, stage, attempt FROM b_attempts WHERE status = 'blocked'")
def orphan_attempts(b_attempts):
    return runs.orphan_attempts(b_attempts.select("run_id", "stage", "attempt"), b_attempts.where("status <> 'blocked'"))


STATUS = "t AS (SELECT user_id AS run_id, event_id AS seq, CASE event_id % 4 WHEN 0 THEN 'planned' WHEN 1 THEN 'running' WHEN 2 THEN 'failed' ELSE 'complete' END AS status FROM events), b AS (SELECT *, lag(status) OVER (PARTITION BY run_id ORDER BY seq) AS before FROM t)"


@query(f"WITH {STATUS} SELECT run_id, seq, status FROM b WHERE NOT ((before IS NULL AND status = 'planned') OR coalesce(before = 'planned' AND status IN ('running', 'failed'), false) OR coalesce(before = 'running' AND status IN ('running', 'failed', 'complete'), false))")
def run_status_transition_ok(events):
    s = F.element_at(F.array(*map(F.lit, ("planned", "running", "failed", "complete"))), (F.col("event_id") % 4 + 1).cast("int"))
    return runs.transition_violations(events.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), s.alias("status"))).select("run_id", "seq", "status")


@query("WITH a AS (SELECT l_orderkey AS run_id, l_partkey AS path, l_returnflag AS sha, l_linestatus AS st FROM lineitem) SELECT run_id, count(*) AS artifacts, count_if(path % 4 = 0 OR sha <> CASE WHEN path % 3 = 0 THEN 'R' ELSE 'N' END) AS invalid_artifacts FROM a GROUP BY 1")
def artifact_hash_check(lineitem, part):
    a = lineitem.groupBy(F.col("l_orderkey").alias("run_id")).agg(F.collect_list(F.struct(F.col("l_partkey").alias("path"), F.col("l_returnflag").alias("sha256"))).alias("artifacts"), F.lit("passed").alias("status"))
    a = a.withColumn("stage", F.lit("train")).withColumn("attempt", F.lit(1))
    inventory = part.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("path"), F.when(F.col("p_partkey") % 3 == 0, "R").otherwise("N").alias("sha256"))
    return runs.artifact_hash_check(a, inventory).select("run_id", "artifacts", "invalid_artifacts")


@query("SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' OR o_orderkey % 10 = 0 THEN 'reject_nonreusable' WHEN o_orderkey % 4 = 0 THEN 'reject_unsafe_drift' WHEN o_orderkey % 3 = 0 THEN 'stale_rebuildable' ELSE 'reusable_exact' END AS classification FROM orders")
def classify_stage_migration(orders):
    k = F.col("o_orderkey")
    observed = orders.select(k.alias("k"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("passed").alias("status"), F.lit(True).alias("reusable"), F.col("o_custkey").alias("source"), F.col("o_orderpriority").alias("tool"))
    expected = orders.where("o_orderkey % 10 <> 0").select(k.alias("k"), F.when(k % 4 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("source"), F.when(k % 3 == 0, "other").otherwise(F.col("o_orderpriority")).alias("tool"))
    return runs.classify_stage_migration(observed, expected, ["k"], ["source"], ["tool"]).select("k", "classification")


@query("WITH m AS (SELECT l_orderkey AS k, md5(l_partkey || ':' || l_returnflag) AS h FROM lineitem) SELECT k, count(*) AS files, sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) || '-' || sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS fingerprint FROM m GROUP BY 1")
def content_fingerprint(lineitem):
    return runs.content_fingerprint(lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("name"), F.col("l_returnflag").alias("sha256")), ["k"])


@query("WITH s AS (SELECT user_id AS video_id, event_id AS name FROM events) SELECT video_id, name, 'crop' AS stage, CASE WHEN name % 10 = 0 THEN 'no_source' ELSE 'source_hash' END AS violation FROM s WHERE name % 10 = 0 OR name % 7 = 0")
def pixel_lineage(events):
    base = events.select(F.col("user_id").alias("video_id"), F.col("event_id").alias("name"), F.col("event_type").alias("sha256"))
    one = base.where("name % 10 <> 0").withColumn("stage", F.lit("staged")).withColumn("source_sha256", F.lit(None).cast("string"))
    two = base.withColumn("stage", F.lit("crop")).withColumn("source_sha256", F.when(F.col("name") % 7 == 0, "changed").otherwise(F.col("sha256")))
    return runs.pixel_lineage(one.unionByName(two), ["staged", "crop"]).select("video_id", "name", "stage", "violation")


@query("WITH c AS (SELECT o_custkey % 10 AS run_id, o_orderkey AS n FROM orders WHERE o_orderkey % 5 <> 0), k AS (SELECT o_custkey % 10 AS run_id, o_orderkey AS n, o_orderkey AS ord FROM orders WHERE o_orderkey % 3 <> 0) SELECT coalesce(c.run_id, k.run_id) AS run_id, 'cam_' || coalesce(c.n, k.n) AS stem, k.ord, CASE WHEN k.n IS NULL THEN 'extra' WHEN c.n IS NULL THEN 'missing' ELSE 'ordered' END AS status FROM c FULL JOIN k ON c.run_id = k.run_id AND c.n = k.n")
def order_by_contract(orders):
    d = orders.select((F.col("o_custkey") % 10).alias("run_id"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("images/cam_"), F.col("o_orderkey"), F.lit(".jpg")).alias("name"))
    return runs.order_by_contract(d.where("ord % 5 <> 0").select("run_id", "name"), d.where("ord % 3 <> 0")).select("run_id", "stem", "ord", "status")


# ---- gates


@query(f"WITH {PARSED}, s AS (SELECT run_id, count_if(json_extract_string(body, '$.result') = 'aligned') AS a, count_if(json_extract_string(body, '$.result') = 'rejected') AS r FROM j WHERE marker = 'VDA_TELEMETRY' GROUP BY 1) SELECT run_id, concat_ws(',', CASE WHEN run_id % 2 = 1 THEN 'record_count' END, CASE WHEN a / (a + r + run_id % 2) < 0.98 THEN 'aligned_ratio' END) AS reasons FROM s")
def depth_gate(b_markers):
    s = telemetry.depth_summary(b_markers).withColumn("camera_count", F.col("aligned") + F.col("rejected") + F.col("run_id") % 2)
    return gates.depth_gate(s).select("run_id", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT c_custkey AS run_id, 2 * (c_custkey % 200 + 1) AS minimum_iterations, concat_ws(',', CASE WHEN c_custkey % 200 + 1 > 150 THEN 'active_camera_count_exceeds_frame_selector_max_frames' END, CASE WHEN 250 < 2 * (c_custkey % 200 + 1) THEN 'requested_iterations_below_two_complete_camera_rounds' END) AS reasons FROM customer")
def coverage_plan(customer):
    r = customer.select(F.col("c_custkey").alias("run_id"), (F.col("c_custkey") % 200 + 1).alias("camera_count"), F.lit(150).alias("max_frames"), F.lit(250).alias("requested_iterations"))
    return gates.coverage_plan(r).select("run_id", "minimum_iterations", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT o_orderkey AS run_id, o_orderstatus = 'F' AND o_orderpriority LIKE '1%' AND o_orderkey % 2 = 0 AS eligible, CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END + CASE WHEN o_orderpriority LIKE '1%' THEN 0 ELSE 1 END + CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS INT) AS reasons FROM orders")
def release_decision(orders):
    r = orders.select(F.col("o_orderkey").alias("run_id"), (F.col("o_orderstatus") == "F").alias("structural_pass"), F.when(F.col("o_orderpriority").startswith("1"), "pass").alias("visual_decision"), (F.col("o_orderkey") % 2 == 0).alias("visual_review"))
    return gates.release_decision(r).select("run_id", F.col("formal_release_eligible").alias("eligible"), F.size("reasons").alias("reasons"))


@query("SELECT c_nationkey AS run_id, count(*) AS cameras, count(DISTINCT c_custkey % 500) AS names, concat_ws(',', CASE WHEN count(*) <> count(DISTINCT c_custkey % 500) THEN 'duplicate_names' END, CASE WHEN count(DISTINCT c_mktsegment) <> 1 THEN 'mixed_sizes' END) AS reasons FROM customer GROUP BY 1")
def camera_identity(customer):
    c = customer.select(F.col("c_nationkey").alias("run_id"), (F.col("c_custkey") % 500).alias("name"), F.col("c_mktsegment").alias("width"), F.lit(1).alias("height"))
    return gates.camera_identity(c).select("run_id", "cameras", "names", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {PAIRED} SELECT run_id, concat_ws(',', CASE WHEN avg(psnr) < 15 THEN 'mean_psnr' END, CASE WHEN min(psnr) < 13.5 THEN 'min_psnr' END) AS warnings, run_id % 2 = 0 AS computed_pass FROM p GROUP BY 1")
def release_gate(b_pairs):
    m = images.view_metric_summary(images.image_pair_metrics(b_pairs)).select("run_id", F.col("psnr_mean").alias("mean_psnr"), F.col("psnr_min").alias("min_psnr"), (F.col("run_id") % 2 == 0).alias("structural_pass"), F.lit(True).alias("exposure_ok"))
    d = gates.release_gate(m, {"mean_psnr": (">=", 15.0), "min_psnr": (">=", 13.5)})
    return d.select("run_id", F.array_join("warnings", ",").alias("warnings"), "computed_pass")


@query("SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS version, event_type <> 'error' AS computed_pass, concat_ws(',', CASE WHEN event_id % 5 = 0 THEN 'not_boolean_held_out' END, CASE WHEN event_type = 'error' THEN 'eligible_without_pass' END) AS violations FROM events")
def normalize_gate(events):
    flag = F.when(F.col("event_type") == "error", "false").otherwise("true")
    held = F.when(F.col("event_id") % 5 == 0, '"no"').otherwise("false")
    flat = F.concat(F.lit('{"computed_pass":'), flag, F.lit(',"formal_release_eligible":true,"formal_auto_release":false,"training_views_only":true,"held_out":'), held, F.lit("}"))
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"policy":{},"decision":'), flat, F.lit("}"))).otherwise(flat)
    return gates.normalize_gate(events.select(F.col("event_id").alias("id"), text.alias("gate"))).select("id", "version", "computed_pass", F.array_join("violations", ",").alias("violations"))


# ---- media and reports


@query("SELECT l_orderkey AS video_id, l_linenumber AS n, CAST(l_partkey % 3 + 24 AS DOUBLE) AS fps, CAST(l_quantity AS DOUBLE) AS duration_sec, CAST(greatest(1, round_even(CAST(l_quantity AS DOUBLE) * (l_partkey % 3 + 24), 0)) AS BIGINT) AS frame_count, CAST(CASE WHEN l_suppkey % 4 = 3 THEN NULL ELSE (l_suppkey % 4) * 90 END AS INT) AS rotation, CASE WHEN l_suppkey % 4 IN (1) THEN 480 ELSE 640 END AS canonical_width, CASE WHEN l_suppkey % 4 = 3 THEN 'rotation' ELSE '' END AS violations FROM lineitem WHERE l_linenumber = 1")
def normalize_probe(lineitem):
    from ..operators import media

    turn = F.when(F.col("l_suppkey") % 4 == 3, 45).otherwise(F.col("l_suppkey") % 4 * 90).cast("string")
    payload = F.concat(F.lit('{"streams":[{"codec_type":"audio"},{"codec_type":"video","width":640,"height":480,"avg_frame_rate":"'), (F.col("l_partkey") % 3 + 24).cast("string"), F.lit('/1","duration":"'), F.col("l_quantity").cast("string"), F.lit('","tags":{"rotate":"'), turn, F.lit('"}}]}'))
    d = media.normalize_probe(lineitem.where("l_linenumber = 1").select(F.col("l_orderkey").alias("video_id"), F.col("l_linenumber").alias("n"), payload.alias("payload")))
    return d.select("video_id", "n", "fps", "duration_sec", "frame_count", "rotation", "canonical_width", F.array_join("violations", ",").alias("violations"))


@query("SELECT o_orderkey AS prior, concat_ws(',', CASE WHEN o_custkey % 5 = 0 THEN 'source' END, CASE WHEN o_custkey % 5 <> 0 AND o_orderkey % 3 = 0 THEN 'dimensions' END) AS violations FROM orders")
def camera_prior_check(orders, customer):
    from ..operators import media

    p = orders.select(F.col("o_orderkey").alias("prior"), F.col("o_custkey").alias("source_sha256"), F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)).alias("params"), F.when(F.col("o_orderkey") % 3 == 0, 100).otherwise(640).alias("width"), F.lit(480).alias("height"))
    m = customer.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("sha256"), F.lit(640).alias("width"), F.lit(480).alias("height"))
    return media.camera_prior_check(p, m).select("prior", F.array_join("violations", ",").alias("violations"))


@query("WITH c AS (SELECT run_id, count(DISTINCT camera) AS camera_count, string_agg(DISTINCT camera, ',' ORDER BY camera) AS camera_names FROM b_exposure GROUP BY 1), l AS (SELECT run_id, round(max(total), 6) AS loss_max FROM (SELECT *, bool_or(kind = 'telemetry') OVER (PARTITION BY run_id) AS has FROM b_losses) WHERE kind = CASE WHEN has THEN 'telemetry' ELSE 'text' END GROUP BY 1) SELECT run_id, camera_count, camera_names, camera_count * 640 * 480 AS pixel_count, loss_max FROM c LEFT JOIN l USING (run_id)")
def training_run_report(b_exposure, b_losses):
    from ..operators import media

    cameras = b_exposure.select("run_id", F.col("camera").alias("name")).distinct().withColumns({"ord": F.col("name"), "width": F.lit(640), "height": F.lit(480)})
    d = media.training_run_report(b_exposure.select("run_id").distinct(), cameras, telemetry.loss_stats(b_losses).select("run_id", r6("loss_max").alias("loss_max")))
    return d.select("run_id", "camera_count", F.array_join("camera_names", ",").alias("camera_names"), "pixel_count", "loss_max")


@query("WITH e AS (SELECT run_id, camera, count(*) AS n FROM b_exposure GROUP BY 1, 2), r AS (SELECT run_id, count(*) AS cc, sum(n) AS it, min(n) AS lo, max(n) AS hi FROM e GROUP BY 1) SELECT run_id, concat_ws(',', CASE WHEN run_id % 3 = 0 THEN 'residual_p90' END, CASE WHEN NOT (lo = it // cc AND hi = it // cc + CASE WHEN it % cc > 0 THEN 1 ELSE 0 END) THEN 'exposure' END, CASE WHEN run_id % 4 = 0 THEN 'digest' END) AS violations FROM r")
def training_evidence_audit(b_exposure):
    from ..operators import media

    n = b_exposure.groupBy("run_id", "camera").agg(F.count("*").alias("n"))
    r = n.groupBy("run_id").agg(F.count("*").alias("camera_count"), F.sum("n").alias("iterations"), F.min("n").alias("min_exposure"), F.max("n").alias("max_exposure"))
    r = r.withColumns({"p90": F.when(F.col("run_id") % 3 == 0, 1.0).otherwise(1e-6), "digest": F.lit("a"), "declared_digest": F.when(F.col("run_id") % 4 == 0, "b").otherwise("a")})
    return media.training_evidence_audit(r, ["p90"]).select("run_id", F.array_join("violations", ",").alias("violations"))


@query("WITH s AS (SELECT DISTINCT run_id FROM b_attempts), o AS (SELECT * FROM (VALUES (0, 'view'), (1, 'click'), (2, 'error'), (3, 'none')) t(position, stage)), l AS (SELECT run_id, stage, attempt, status FROM (SELECT *, row_number() OVER (PARTITION BY run_id, stage ORDER BY attempt DESC) AS n FROM b_attempts) WHERE n = 1) SELECT s.run_id, o.position, o.stage, l.attempt, coalesce(l.status, 'missing') AS status, coalesce(l.status = 'passed' AND s.run_id % 2 = 0, false) AS reusable FROM s CROSS JOIN o LEFT JOIN l ON l.run_id = s.run_id AND l.stage = o.stage")
def existing_run_stages(b_attempts):
    from ..operators import media

    a = b_attempts.withColumn("artifacts", F.array(F.struct(F.col("run_id").cast("string").alias("path"), F.lit("x").alias("sha256"))))
    inventory = b_attempts.where("run_id % 2 = 0").select(F.col("run_id").cast("string").alias("path"), F.lit("x").alias("sha256")).distinct()
    return media.existing_run_stages(a, inventory, ["view", "click", "error", "none"]).select("run_id", "position", "stage", "attempt", "status", "reusable")


@query("WITH i AS (SELECT o_custkey % 50 AS model_id, o_orderkey AS name FROM orders) SELECT model_id, name, 'contract_unexpected' AS violation FROM i WHERE name % 5 = 0 AND name % 7 <> 0 UNION ALL SELECT model_id, name, 'model_missing' FROM i WHERE name % 7 = 0 UNION ALL SELECT model_id, name, 'contract_missing' FROM i WHERE name % 7 = 0 AND name % 5 <> 0 UNION ALL SELECT model_id, name, 'hash' FROM i WHERE name % 3 = 0 AND name % 5 <> 0 AND name % 7 <> 0")
def audit_training_input(orders):
    from ..operators import media

    i = orders.select((F.col("o_custkey") % 50).alias("model_id"), F.col("o_orderkey").alias("name"), F.lit("a").alias("sha256"))
    contract = i.where("name % 5 <> 0").withColumn("sha256", F.when(F.col("name") % 3 == 0, "b").otherwise("a"))
    return media.audit_training_input(i.where("name % 7 <> 0"), contract, i.select("model_id", "name")).select("model_id", "name", "violation")


@query("SELECT event_id AS id, concat_ws(',', CASE WHEN event_id % 4 = 0 THEN 'no_verdict' END, CASE WHEN event_id % 4 = 3 THEN 'alias_conflict' END) AS violations, CASE event_id % 4 WHEN 1 THEN 'needs_review' WHEN 2 THEN 'passed' WHEN 3 THEN 'failed' ELSE 'needs_review' END AS status FROM events")
def normalize_converted_eval(events):
    from ..operators import media

    text = F.element_at(F.array(*map(F.lit, ("{}", '{"passed":true}', '{"structural_pass":true,"visual_pass":true}', '{"passed":true,"structural_pass":false}'))), (F.col("event_id") % 4 + 1).cast("int"))
    return media.normalize_converted_eval(events.select(F.col("event_id").alias("id"), text.alias("evidence"))).select("id", F.array_join("violations", ",").alias("violations"), "status")


@query("SELECT event_id AS id, event_id % 3 = 1 AS nested, CASE WHEN event_id % 3 = 2 THEN 'no_structural' ELSE '' END AS violations FROM events")
def normalize_postcheck(events):
    from ..operators import media

    text = F.element_at(F.array(*map(F.lit, ('{"structural":{"ok":true}}', '{"postcheck_result":{"structural":{"ok":1}}}', '{"structural":5}'))), (F.col("event_id") % 3 + 1).cast("int"))
    return media.normalize_postcheck(events.select(F.col("event_id").alias("id"), text.alias("evidence"))).select("id", "nested", F.array_join("violations", ",").alias("violations"))


from . import file_queries, more_queries, pixel_queries, report_queries, sink_queries  # noqa: E402, F401  they register theirs
