"""Queries of declared against recomputed reports, name orders, gate settings, sampling plans and recorded progress."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.staging import new_folder, staged
from ..operators import gates, media, reports, runs, sparse, telemetry, trajectory
from ..sources import files
from ..streaming import progress
from .file_queries import documents
from .queries import ORACLES, query
from .sink_queries import _streamed

# ---- coverage reports

COVERAGE = """n AS (SELECT video_id, segment_id, min(timestamp_sec) - 5 AS s, max(timestamp_sec) + CASE WHEN video_id % 6 = 0 THEN -1 ELSE 5 END AS e, row_number() OVER (PARTITION BY video_id ORDER BY segment_id) - 1 AS position, count(*) AS total_frames, count_if(selected) AS selected_frames, count_if(NOT selected) AS rejected_frames, count_if(selected AND bridge) AS bridge_frames FROM b_segments GROUP BY 1, 2),
g AS (SELECT video_id, segment_id, timestamp_sec AS t, timestamp_sec - lag(timestamp_sec) OVER (PARTITION BY video_id, segment_id ORDER BY timestamp_sec) AS gap FROM b_segments WHERE selected), a AS (SELECT video_id, segment_id, max(gap) AS gap, min(t) AS f, max(t) AS l FROM g GROUP BY 1, 2),
q AS (SELECT n.*, CAST(CASE WHEN selected_frames > 0 THEN 1 ELSE 0 END AS BIGINT) AS component_count, round(coalesce(greatest(gap, f - s, e - l), 0), 3) AS m, f, l FROM n LEFT JOIN a USING (video_id, segment_id)),
z AS (SELECT *, concat_ws(',', CASE WHEN selected_frames = 0 THEN 'no_selected_frames' END, CASE WHEN m > CASE WHEN video_id % 13 = 0 THEN 0 ELSE 20000 END THEN 'max_selected_gap_sec' END, CASE WHEN least(f - s, e - l) < 0 THEN 'outside_window' END, CASE WHEN video_id % 13 = 0 THEN 'selection_max_gap_sec' END) AS failed_reasons FROM q),
r AS (SELECT video_id, sum(selected_frames) AS selected_frames, sum(bridge_frames) AS bridge_frames, max(component_count) AS component_count, max(m) AS m, coalesce(string_agg(CASE WHEN failed_reasons <> '' THEN segment_id END, ',' ORDER BY position), '') AS failed FROM z GROUP BY 1)"""


def _coverage(b_segments):
    v = F.col("video_id")
    segments = b_segments.groupBy("video_id", "segment_id").agg((F.min("timestamp_sec") - 5).alias("start_sec"), (F.max("timestamp_sec") + F.when(v % 6 == 0, -1).otherwise(5)).alias("end_sec"))
    segments = segments.withColumn("position", F.row_number().over(Window.partitionBy("video_id").orderBy("segment_id")) - 1)
    settings = b_segments.select("video_id", F.when(v % 13 == 0, 0.0).otherwise(20_000.0).alias("selection_max_gap_sec")).distinct()
    return segments, settings


@query(f"WITH {COVERAGE} SELECT video_id, segment_id, position, total_frames, selected_frames, rejected_frames, bridge_frames, component_count, m AS max_selected_gap_sec, failed_reasons FROM z")
def coverage_segments(b_segments):
    return reports.coverage_segments(b_segments, *_coverage(b_segments))


@query(f"""WITH {COVERAGE}, x AS (SELECT video_id, segment_id, unnest([{{'f': 'position', 'c': CAST(position AS VARCHAR), 'd': CAST(CASE WHEN video_id % 5 = 0 THEN 3 - position ELSE position END AS VARCHAR)}}, {{'f': 'selected_frames', 'c': CAST(selected_frames AS VARCHAR), 'd': CAST(selected_frames + CASE WHEN video_id % 7 = 0 THEN 1 ELSE 0 END AS VARCHAR)}}, {{'f': 'failed_reasons', 'c': failed_reasons, 'd': CASE WHEN video_id % 11 = 0 THEN 'other' ELSE failed_reasons END}}]) AS u FROM z),
y AS (SELECT video_id, CAST(NULL AS VARCHAR) AS segment_id, unnest([{{'f': 'bridge_frames', 'c': CAST(bridge_frames AS VARCHAR), 'd': CAST(bridge_frames + CASE WHEN video_id % 3 = 0 THEN 2 ELSE 0 END AS VARCHAR)}}, {{'f': 'status', 'c': CASE WHEN failed <> '' THEN 'failed' ELSE 'passed' END, 'd': 'passed'}}, {{'f': 'failed_segments', 'c': failed, 'd': ''}}]) AS u FROM r)
SELECT video_id, segment_id, u.f AS field, u.c AS computed, u.d AS declared FROM (SELECT * FROM x UNION ALL SELECT * FROM y) WHERE u.c <> u.d""")
def coverage_report_violations(b_segments):
    """The declared report and summary are the right ones with other orders, counts, reasons and verdicts."""
    segments, settings = _coverage(b_segments)
    v, c = F.col("video_id"), F.col
    right = reports.coverage_segments(b_segments, segments, settings)
    declared = right.withColumns({"position": F.when(v % 5 == 0, 3 - c("position")).otherwise(c("position")), "selected_frames": c("selected_frames") + F.when(v % 7 == 0, 1).otherwise(0), "failed_reasons": F.when(v % 11 == 0, "other").otherwise(c("failed_reasons"))})
    summaries = reports.coverage_summary(right).withColumns({"bridge_frames": c("bridge_frames") + F.when(v % 3 == 0, 2).otherwise(0), "status": F.lit("passed"), "failed_segments": F.lit("")})
    return reports.coverage_report_violations(b_segments, segments, settings, declared, summaries).select("video_id", "segment_id", "field", "computed", "declared")


@query("SELECT video_id, frame_id, concat_ws(',', CASE WHEN frame_id % 8 = 0 THEN 'policy' END, CASE WHEN frame_id % 5 = 0 THEN 'selected_by_policy' END, CASE WHEN frame_id % 9 = 0 THEN 'bridge' END, CASE WHEN frame_id % 9 <> 0 AND (bridge OR frame_id % 6 = 0) AND NOT selected THEN 'rejected_bridge' END) AS violations FROM b_segments WHERE violations <> ''")
def coverage_frame_violations(b_segments):
    k = F.col("frame_id")
    d = b_segments.withColumns({"policy": F.when(k % 8 == 0, "legacy").otherwise("coverage_v1"), "selected_by_policy": F.when(k % 5 == 0, ~F.col("selected")).otherwise(F.col("selected")), "bridge": F.when(k % 9 != 0, F.col("bridge") | (k % 6 == 0))})
    return reports.coverage_frame_violations(d).select("video_id", "frame_id", F.array_join("violations", ",").alias("violations"))


# ---- names in order

NAMES = "a AS (SELECT l_orderkey AS k, l_partkey AS name, min(l_linenumber) AS e, count(*) AS n FROM lineitem WHERE l_suppkey % 7 <> 0 GROUP BY 1, 2), b AS (SELECT l_orderkey AS k, l_partkey AS name, min(CASE WHEN l_orderkey % 4 = 0 THEN 8 - l_linenumber ELSE l_linenumber END) AS p, count(*) AS n FROM lineitem WHERE l_suppkey % 5 <> 0 GROUP BY 1, 2)"


@query(f"WITH {NAMES} SELECT k, name, e AS expected_position, p AS actual_position, CASE WHEN a.n IS NULL THEN 'unexpected' WHEN b.n IS NULL THEN 'missing' WHEN greatest(a.n, b.n) > 1 THEN 'repeated' WHEN e <> p THEN 'moved' ELSE 'matched' END AS status FROM a FULL JOIN b USING (k, name)")
def name_order_status(lineitem):
    d = lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("name"), F.col("l_linenumber").alias("position"), "l_suppkey")
    turned = F.when(F.col("k") % 4 == 0, 8 - F.col("position")).otherwise(F.col("position"))
    return reports.name_order_status(d.where("l_suppkey % 7 <> 0"), d.where("l_suppkey % 5 <> 0").withColumn("position", turned), ["k"])


# ---- settings of gates

#: Configurations by the rest of a number; "#" is put in for that number's hundredths.
CONFIGS = ("{}", '{"pose":{"mode":"enforce","min_inlier_ratio":0.#},"ply":5}', '{"vda":{"min_correlation":1.5,"other":1},"more":{}}', '{"ply":{"mode":"always","max_anisotropy_q99":#,"min_effective_fraction":"0.5"}}', "[1]", '{"pose":{"min_match_count":true,"reference_lookback":-1},"ply":{"mode":"observe","min_effective_fraction":0.#}}', None)


def _config(number):
    which = F.element_at(F.array(*map(F.lit, CONFIGS)), (number % len(CONFIGS) + 1).cast("int"))
    return F.replace(which, F.lit("#"), F.lpad((number % 90 + 10).cast("string"), 2, "0"))


def _settings_sql(source: str) -> str:
    known = ", ".join(f"('{g}', '{n}', CAST({v} AS DOUBLE))" for g, s in gates.DEFAULTS.items() for n, v in s.items())
    share = "CAST(k % 90 + 10 AS DOUBLE)"
    return f"""c AS (SELECT k, k % 7 AS w, {share} AS s FROM {source}), known AS (SELECT * FROM (VALUES {known}) t(gate, name, preset) UNION ALL SELECT gate, 'mode', NULL FROM (VALUES ('pose'), ('vda'), ('ply')) t(gate)),
given AS (SELECT k, 'pose' AS gate, 'mode' AS name, CAST(NULL AS DOUBLE) AS value, 'enforce' AS mode, CAST(NULL AS VARCHAR) AS violation FROM c WHERE w = 1 UNION ALL SELECT k, 'pose', 'min_inlier_ratio', s / 100, NULL, NULL FROM c WHERE w = 1 UNION ALL SELECT k, 'vda', 'min_correlation', NULL, NULL, 'value' FROM c WHERE w = 2 UNION ALL SELECT k, 'vda', 'other', NULL, NULL, 'unknown' FROM c WHERE w = 2 UNION ALL SELECT k, 'more', NULL, NULL, NULL, 'unknown' FROM c WHERE w = 2
 UNION ALL SELECT k, 'ply', 'mode', NULL, NULL, 'mode' FROM c WHERE w = 3 UNION ALL SELECT k, 'ply', 'max_anisotropy_q99', s, NULL, NULL FROM c WHERE w = 3 UNION ALL SELECT k, 'ply', 'min_effective_fraction', NULL, NULL, 'value' FROM c WHERE w = 3 UNION ALL SELECT k, NULL, NULL, NULL, NULL, 'not_an_object' FROM c WHERE w = 4
 UNION ALL SELECT k, 'pose', 'min_match_count', NULL, NULL, 'value' FROM c WHERE w = 5 UNION ALL SELECT k, 'pose', 'reference_lookback', NULL, NULL, 'value' FROM c WHERE w = 5 UNION ALL SELECT k, 'ply', 'mode', NULL, 'observe', NULL FROM c WHERE w = 5 UNION ALL SELECT k, 'ply', 'min_effective_fraction', s / 100, NULL, NULL FROM c WHERE w = 5),
settings AS (SELECT k, gate, name, value, mode, true AS given, violation FROM given UNION ALL SELECT c.k, known.gate, known.name, preset, CASE WHEN name = 'mode' THEN 'off' END, false, NULL FROM c, known WHERE w <> 4 AND NOT EXISTS (SELECT 1 FROM given g WHERE g.k = c.k AND g.gate = known.gate AND g.name = known.name))"""


@query(f"WITH {_settings_sql('(SELECT c_custkey AS k FROM customer)')} SELECT * FROM settings")
def gate_settings(customer):
    return gates.gate_settings(customer.select(F.col("c_custkey").alias("k"), _config(F.col("c_custkey")).alias("quality_gates")), "k")


@query(f"""WITH {_settings_sql('(SELECT DISTINCT label AS k FROM embeddings)')}, limits AS (SELECT k, max(mode) AS mode, max(CASE WHEN name = 'min_effective_fraction' THEN value END) AS low, count(violation) AS faults FROM settings WHERE gate = 'ply' OR gate IS NULL GROUP BY 1),
m AS (SELECT label AS k, vec_id, label % 2 = 0 AS few, CASE WHEN vec_id % 5 = 0 THEN NULL ELSE vec_id % 100 / 100.0 END AS share FROM embeddings)
SELECT m.k, vec_id, mode, faults = 0 AND (mode <> 'enforce') AS passed, concat_ws(',', CASE WHEN faults > 0 THEN 'settings' END, CASE WHEN faults = 0 AND mode <> 'off' AND NOT coalesce(share >= low, false) THEN 'min_effective_fraction' END, CASE WHEN faults = 0 AND mode <> 'off' AND few THEN 'max_anisotropy_q99' END, CASE WHEN faults = 0 AND mode <> 'off' THEN 'min_unit_quaternion_fraction' END) AS reasons FROM m JOIN limits USING (k)""")
def configured_gate(embeddings):
    """Each row is judged by the configuration of its label; the last metric is missing."""
    k = F.col("k")
    configs = embeddings.select(F.col("label").alias("k")).distinct().select("k", _config(k).alias("quality_gates"))
    share = F.when(F.col("vec_id") % 5 != 0, F.col("vec_id") % 100 / 100)
    m = embeddings.select(F.col("label").alias("k"), "vec_id", share.alias("effective_fraction"), F.when(F.col("label") % 2 == 0, float("nan")).otherwise(1.0).alias("anisotropy_q99"))
    d = gates.configured_gate(m, gates.gate_settings(configs, "k"), "k", "ply")
    return d.select("k", "vec_id", "mode", "passed", F.array_join("reasons", ",").alias("reasons"))


# ---- sampling plans, settings of manifests, progress, anchors

@query("WITH v AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS DOUBLE) - 3 AS d, l_partkey % 9 = 0 AS vfr, l_suppkey % 4 / 2.0 AS rate, l_linenumber % 6 AS low, 5 + l_partkey % 20 - l_suppkey % 7 AS high FROM lineitem), p AS (SELECT *, concat_ws(',', CASE WHEN vfr THEN 'variable_frame_rate' END, CASE WHEN d <= 0 THEN 'duration' END, CASE WHEN rate <= 0 THEN 'target_fps' END, CASE WHEN low <= 0 OR high < low THEN 'frame_limits' END) AS violations, greatest(low, least(high, CAST(ceil(d * rate) AS BIGINT))) AS b FROM v) SELECT k, n, violations, CASE WHEN violations = '' THEN b END AS candidate_budget, round(CASE WHEN violations = '' THEN b / d END, 9) AS candidate_fps FROM p")
def candidate_plan(lineitem):
    c = F.col
    p = X.candidate_plan(c("l_quantity").cast("double") - 3, c("l_partkey") % 9 == 0, c("l_suppkey") % 4 / 2, c("l_linenumber") % 6, 5 + c("l_partkey") % 20 - c("l_suppkey") % 7)
    return lineitem.select(c("l_orderkey").alias("k"), c("l_linenumber").alias("n"), F.array_join(p["violations"], ",").alias("violations"), p["candidate_budget"].alias("candidate_budget"), F.round(p["candidate_fps"], 9).alias("candidate_fps"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS video_id, unnest(['keyframe_policy', 'selection_max_gap_sec', 'limits']) AS name, unnest([c_mktsegment, CAST(c_custkey % 50 AS VARCHAR), '{\"low\":' || c_nationkey || '}']) AS value FROM customer WHERE c_custkey % 6 <> 0")
def read_manifest_settings(customer):
    k = F.col("c_custkey")
    settings = F.struct(F.col("c_mktsegment").alias("keyframe_policy"), (k % 50).alias("selection_max_gap_sec"), F.struct(F.col("c_nationkey").alias("low")).alias("limits"))
    doc = F.to_json(F.struct(F.lit("2.0").alias("schema_version"), k.cast("string").alias("video_id"), F.when(k % 6 != 0, settings).alias("settings")))
    spark = customer.sparkSession
    return files.read_manifest_settings(spark, documents(customer.select(F.floor(k / 500).alias("g"), doc.alias("doc")), "g", spark))


RECORDS = """WITH e AS (SELECT user_id AS run_id, event_id AS seq, CASE event_type WHEN 'signup' THEN 'child_started' WHEN 'error' THEN 'parent_error' WHEN 'view' THEN 'other' ELSE 'iteration' END AS phase, event_id % 37 * 3 + event_id % 11 + event_id // 1500 AS it, value - 5 AS elapsed FROM events),
v AS (SELECT *, CASE WHEN phase = 'iteration' AND it BETWEEN 1 AND 100 THEN it END AS ok FROM e WHERE phase <> 'other'), m AS (SELECT *, coalesce(max(ok) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS best FROM v)
SELECT run_id, seq, phase, CASE WHEN phase = 'iteration' THEN it END AS iteration, 100 AS total, round(greatest(elapsed, 0), 6) AS elapsed_seconds, CAST(NULL AS BIGINT) AS returncode, CASE WHEN phase = 'parent_error' THEN 'E' END AS error_type FROM m WHERE phase <> 'iteration' OR ok > best"""


def _records(events):
    c, k = F.col, F.col("event_id")
    phase = F.when(c("event_type") == "signup", "child_started").when(c("event_type") == "error", "parent_error").when(c("event_type") == "view", "other").otherwise("iteration")
    return events.select(c("user_id").cast("long").alias("run_id"), k.cast("long").alias("seq"), phase.alias("phase"), (k % 37 * 3 + k % 11 + F.floor(k / 1500)).cast("long").alias("iteration"), F.lit(100).cast("long").alias("total"), (c("value").cast("double") - 5).alias("elapsed"), F.lit(7).cast("long").alias("returncode"), F.lit("E").alias("error_type"))


@query(RECORDS)
def progress_records(events):
    return telemetry.progress_records(_records(events))


@query()
def stream_records(events):
    """The same events as a stream that reads what is there and ends."""
    spark, d = events.sparkSession, _records(events)
    path = new_folder(spark, "progress-events")
    d.write.parquet(path)
    return _streamed(progress.stream_records(spark.readStream.schema(d.schema).parquet(path)), "progress-records")


# The stream's rows are those of its batch twin.
ORACLES["stream_records"] = ORACLES["progress_records"]


@query("WITH r AS (SELECT run_id, max(iteration) AS iterations FROM b_exposure GROUP BY 1), p AS (SELECT run_id, unnest(generate_series(100, iterations - 1, 100)) AS iteration FROM r WHERE iterations > 100 AND run_id % 3 <> 0) SELECT r.run_id, count(p.iteration) AS anchor_faults, concat_ws(',', CASE WHEN r.run_id % 4 = 0 THEN 'digest' END, CASE WHEN count(p.iteration) > 0 THEN 'anchor_plan' END) AS violations, r.run_id % 4 <> 0 AND count(p.iteration) = 0 AS passed FROM r LEFT JOIN p USING (run_id) GROUP BY r.run_id")
def training_anchor_audit(b_exposure):
    """Every third run has the events of its plan, the others have none."""
    runs = b_exposure.groupBy("run_id").agg(F.max("iteration").alias("iterations"))
    audited = runs.select("run_id", X.violations(digest=F.col("run_id") % 4 == 0).alias("violations"))
    events = b_exposure.where("iteration % 100 = 0").join(runs.hint("merge"), "run_id").where("iteration < iterations AND run_id % 3 = 0").select("run_id", F.col("iteration").cast("long").alias("iteration"), F.lit(5).alias("before"), F.lit(2).alias("added"), F.lit(1).alias("deleted"), F.lit(6).alias("after"))
    return media.training_anchor_audit(audited, runs, events).select("run_id", "anchor_faults", F.array_join("violations", ",").alias("violations"), "passed")


# ---- digests

@query("WITH r AS (SELECT l_orderkey % 50 AS k, sha256(CAST(l_partkey AS VARCHAR)) AS n, sha256(l_returnflag) AS s FROM lineitem), p AS (SELECT k, substr(n, 1, 3) AS part, count(*) AS c, sha256(string_agg(n || ':' || s, chr(10) ORDER BY n || ':' || s)) AS d FROM r GROUP BY 1, 2) SELECT k, CAST(sum(c) AS BIGINT) AS files, sha256(string_agg(part || ':' || d, chr(10) ORDER BY part || ':' || d)) AS digest FROM p GROUP BY 1")
def content_digest(lineitem):
    return runs.content_digest(lineitem.select((F.col("l_orderkey") % 50).alias("k"), F.col("l_partkey").alias("name"), F.col("l_returnflag").alias("sha256")), ["k"])


@query("""WITH c AS (SELECT event_id AS k, '{"a":[1,"é"],"k":' || CAST(json_extract_string(props, '$.k') AS INT) || ',"type":"' || event_type || '"}' AS body FROM events)
SELECT k, CASE WHEN k % 11 NOT IN (3, 4) THEN sha256(body) END AS digest, CASE WHEN k % 11 = 3 THEN 'not_json' WHEN k % 11 = 4 THEN 'not_an_object' WHEN k % 11 IN (5, 6) THEN 'digest' END AS violation FROM c""")
def document_digest(events):
    """Documents with their fields in another order, spaces and escapes; some have a wrong digest, none, or are no documents."""
    k = F.col("event_id")
    fields = F.concat(F.lit('"type": "'), "event_type", F.lit('", "k":  '), F.get_json_object("props", "$.k"), F.lit(', "a": [1, "\\u00e9"]'))
    canonical = F.concat(F.lit('{"a":[1,"é"],"k":'), F.get_json_object("props", "$.k"), F.lit(',"type":"'), "event_type", F.lit('"}'))
    own = F.when(k % 11 == 5, F.lit('"x"')).otherwise(F.concat(F.lit('"'), F.sha2(canonical, 256), F.lit('"')))
    text = F.when(k % 11 == 3, '{"k": NaN}').when(k % 11 == 4, "[1]").when(k % 11 == 6, F.concat(F.lit("{"), fields, F.lit("}"))).otherwise(F.concat(F.lit('{"sha": '), own, F.lit(", "), fields, F.lit("}")))
    return runs.document_digest(events.select(k.alias("k"), text.alias("document")), declared="sha").select("k", "digest", "violation")


# ---- audits of models

@query("WITH f AS (SELECT DISTINCT l_orderkey % 50 AS k, CASE WHEN l_linenumber = 1 AND l_orderkey % 2 = 0 THEN l_partkey END AS native, l_suppkey AS cloud FROM lineitem), c AS (SELECT k, coalesce(max(native), max(cloud)) AS i FROM f WHERE k % 9 <> 0 GROUP BY 1) SELECT k, i AS checkpoint_iteration, concat_ws(',', CASE WHEN k % 4 = 0 THEN 'rotation_step' END, CASE WHEN k % 5 <> 0 AND i IS NULL THEN 'checkpoint_missing' END, CASE WHEN k % 5 <> 0 AND k % 3 = 0 AND i IS NOT NULL THEN 'checkpoint_iteration' END) AS reasons FROM (SELECT DISTINCT l_orderkey % 50 AS k FROM lineitem) m LEFT JOIN c USING (k)")
def checkpoint_audit(lineitem):
    k = F.col("k")
    d = lineitem.withColumn("k", F.col("l_orderkey") % 50)
    native = d.where("k % 9 <> 0 AND l_linenumber = 1 AND l_orderkey % 2 = 0").select("k", F.concat(F.lit("m/chkpnt"), F.col("l_partkey").cast("string"), F.lit(".pth")).alias("path"))
    cloud = d.where("k % 9 <> 0").select("k", F.concat(F.lit("m/point_cloud/iteration_"), F.col("l_suppkey").cast("string"), F.lit("/points.ply")).alias("path"))
    inventory = native.unionByName(cloud)
    audited = d.select("k").distinct().withColumn("reasons", X.violations(rotation_step=k % 4 == 0))
    right = trajectory.native_checkpoints(inventory, ["k"]).select("k", F.col("checkpoint_iteration").alias("i"))
    expected = d.select("k").distinct().join(right, "k", "left").select("k", F.when(k % 5 != 0, F.coalesce("i", F.lit(1)) + F.when(k % 3 == 0, 1).otherwise(0)).alias("expected_iteration"))
    return trajectory.checkpoint_audit(audited, inventory, expected, ["k"]).select("k", "checkpoint_iteration", F.array_join("reasons", ",").alias("reasons"))


@query("""WITH i AS (SELECT o_custkey % 40 AS model_id, o_orderkey AS name FROM orders), r AS (SELECT model_id, count(*) AS registered_image_count, bool_and(model_id % 6 <> 0 OR name % 50 <> 0) AS same FROM i WHERE model_id % 8 <> 7 GROUP BY 1), p AS (SELECT p_partkey % 40 AS model_id, count(*) AS point_count, round(avg(CAST(p_retailprice AS DOUBLE)), 6) AS e FROM part WHERE p_partkey % 40 <> 11 GROUP BY 1), m AS (SELECT DISTINCT c_custkey % 40 AS model_id FROM customer)
SELECT model_id, coalesce(registered_image_count, 0) AS registered_image_count, coalesce(point_count, 0) AS point_count, e AS reprojection_error_px, concat_ws(',', CASE WHEN model_id % 3 = 0 THEN 'component_count_must_equal_one' END, CASE WHEN coalesce(registered_image_count, 0) < 2 THEN 'too_few_registered_images' END, CASE WHEN model_id % 10 = 4 THEN 'exactly_one_camera_required' END, CASE WHEN model_id % 5 = 0 THEN 'non_positive_focal_length' END, CASE WHEN point_count IS NULL THEN 'sparse_points_required' END, CASE WHEN model_id % 9 = 0 THEN 'camera_trajectory_not_finite' END, CASE WHEN model_id % 7 = 0 THEN 'camera_trajectory_not_continuous' END, CASE WHEN model_id % 13 = 2 THEN 'non_finite_camera_cy' END, CASE WHEN model_id % 8 = 7 OR NOT same THEN 'registered_names_do_not_match_staged_set' END) AS hard_failures, CASE WHEN e IS NULL THEN 'reprojection_error_not_available,track_length_not_available' ELSE '' END AS warnings
FROM m LEFT JOIN r USING (model_id) LEFT JOIN p USING (model_id)""")
def geometry_evidence(customer, orders, part):
    """Models with cameras, images, points and trajectories of their own; some lack images, points or a staged name."""
    c, m = F.col, F.col("model_id")
    models = customer.select((c("c_custkey") % 40).alias("model_id")).distinct()
    cam = models.select("model_id", F.lit(640).alias("width"), F.lit(480).alias("height"), F.array(F.when(m % 5 == 0, 0.0).otherwise(500.0), F.lit(500.0), F.lit(320.0), F.when(m % 13 == 2, float("inf")).otherwise(240.0)).alias("params"))
    cam = cam.unionByName(cam.where("model_id % 10 = 4"))
    names = orders.select((c("o_custkey") % 40).alias("model_id"), c("o_orderkey").alias("name"))
    images = names.where("model_id % 8 <> 7")
    expected = names.where("NOT (model_id % 6 = 0 AND name % 50 = 0)")
    points = part.where("p_partkey % 40 <> 11").select((c("p_partkey") % 40).alias("model_id"), c("p_retailprice").cast("double").alias("error"), F.lit(2).alias("track_length"))
    walk = models.select("model_id", (m % 9 != 0).alias("centers_finite"), (m % 7 != 0).alias("continuous"))
    d = sparse.named_geometry_gate(sparse.geometry_evidence(cam, images, points, walk, models.withColumn("component_count", F.when(m % 3 == 0, 2).otherwise(1)), expected))
    return d.select("model_id", "registered_image_count", "point_count", F.round("reprojection_error_px", 6).alias("reprojection_error_px"), F.array_join("hard_failures", ",").alias("hard_failures"), F.array_join("warnings", ",").alias("warnings"))


TRAINING = """t AS (SELECT l_orderkey % 50 AS model_id, l_partkey AS p, CASE WHEN l_partkey % 29 = 0 THEN 'd/' ELSE '' END || 'f' || l_partkey || CASE WHEN l_suppkey % 2 = 0 THEN '.png' ELSE '.jpg' END AS name FROM lineitem), n AS (SELECT model_id, name, any_value(p) AS p, count(*) AS copies FROM t GROUP BY 1, 2), s AS (SELECT *, p % 23 <> 0 AS has, count(CASE WHEN p % 23 <> 0 THEN 1 END) OVER (PARTITION BY model_id, regexp_replace(name, '[.][^.]*$', '')) AS twins FROM n)"""


def _training(lineitem):
    c, p = F.col, F.col("p")
    t = lineitem.select((c("l_orderkey") % 50).alias("model_id"), c("l_partkey").alias("p"), (c("l_suppkey") % 2 == 0).alias("png"))
    named = lambda d: d.select("model_id", "p", F.concat(F.when(p % 29 == 0, "d/").otherwise(""), F.lit("f"), p.cast("string"), F.when(c("png"), ".png").otherwise(".jpg")).alias("name"))
    records = named(t.where("p % 23 <> 0")).select("model_id", "name", F.lit("a").alias("file_sha256"), F.lit("b").alias("decoded_pixel_sha256"))
    # A name is its numbers, which are made different and written once for the three sides that read them.
    n = named(staged(t.distinct(), "training-names"))
    found = n.where("p % 11 <> 0").select("model_id", "name", F.when(p % 13 == 0, "x").otherwise("a").alias("sha256"), F.when(p % 19 == 0, "y").otherwise("b").alias("pixel_sha256"), F.when(p % 17 == 0, 641).otherwise(640).alias("width"), F.lit(480).alias("height"))
    names = lambda d: d.select("model_id", "name")
    return records, found, names(n.where("p % 5 <> 0")), names(n.where("p % 7 <> 0"))


@query(f"""WITH {TRAINING}, v AS (SELECT model_id, name, concat_ws(',', CASE WHEN has AND p % 29 = 0 THEN 'not_a_basename' END, CASE WHEN has AND copies > 1 THEN 'repeated' END, CASE WHEN has AND twins > 1 THEN 'stem' END, CASE WHEN has AND p % 5 = 0 THEN 'not_in_contract' END, CASE WHEN NOT has AND p % 5 <> 0 THEN 'only_in_contract' END, CASE WHEN has AND p % 7 = 0 THEN 'not_in_model' END, CASE WHEN NOT has AND p % 7 <> 0 THEN 'only_in_model' END,
CASE WHEN has AND p % 11 = 0 THEN 'file_missing' END, CASE WHEN has AND p % 11 <> 0 AND p % 13 = 0 THEN 'file_hash' END, CASE WHEN has AND p % 11 <> 0 AND p % 19 = 0 THEN 'pixel_hash' END, CASE WHEN has AND p % 11 <> 0 AND (p % 17 = 0 OR model_id % 6 = 5) THEN 'dimensions' END) AS violations FROM s) SELECT * FROM v WHERE violations <> ''""")
def audit_image_records(lineitem):
    records, found, contract, model = _training(lineitem)
    sizes = lineitem.select((F.col("l_orderkey") % 50).alias("model_id")).distinct().where("model_id % 6 <> 5").withColumns({"width": F.lit(640), "height": F.lit(480)})
    d = media.audit_image_records(records, found, contract, model, sizes)
    return d.select("model_id", "name", F.array_join("violations", ",").alias("violations"))


@query(f"""WITH {TRAINING}, r AS (SELECT model_id, sum(copies) FILTER (p % 23 <> 0) AS records, count(*) FILTER (p % 7 <> 0) AS images FROM n GROUP BY 1)
SELECT model_id, concat_ws(',', CASE WHEN coalesce(records, 0) = 0 THEN 'no_records' END, CASE WHEN model_id % 4 = 1 THEN 'camera_count' END, CASE WHEN model_id % 7 = 3 THEN 'contract_camera' END, CASE WHEN model_id % 4 <> 1 AND model_id % 7 = 3 THEN 'camera_model' END, CASE WHEN model_id % 4 <> 1 AND model_id % 5 = 2 THEN 'camera_size' END, CASE WHEN model_id % 4 <> 1 AND model_id % 3 = 1 THEN 'intrinsics' END, CASE WHEN images <> coalesce(records, 0) THEN 'image_count' END, CASE WHEN model_id % 3 = 0 THEN 'pixel_digest' END) AS violations FROM r""")
def audit_training_models(lineitem):
    records, found, _, model = _training(lineitem)
    m = F.col("model_id")
    models = lineitem.select((F.col("l_orderkey") % 50).alias("model_id")).distinct()
    kept = found.join(records.select("model_id", "name").distinct().hint("merge"), ["model_id", "name"], "left_semi")
    right = runs.content_digest(kept, ["model_id"], "name", "pixel_sha256").select("model_id", "digest")
    contracts = models.join(right, "model_id", "left").select("model_id", F.when(m % 7 == 3, "OPENCV").otherwise("PINHOLE").alias("model"), F.lit(640).alias("width"), F.lit(480).alias("height"), *[F.lit(v).alias(n) for n, v in (("fx", 500.0), ("fy", 500.5), ("cx", 320.0), ("cy", 240.0))], F.when(m % 3 == 0, "x").otherwise(F.col("digest")).alias("pixel_digest"))
    cameras = models.select("model_id", F.lit("PINHOLE").alias("model"), F.when(m % 5 == 2, 641).otherwise(640).alias("width"), F.lit(480).alias("height"), F.array(F.lit(500.0), F.when(m % 3 == 1, 500.6).otherwise(500.5 + 1e-9), F.lit(320.0), F.lit(240.0)).alias("params"))
    cameras = cameras.unionByName(cameras.where("model_id % 4 = 1"))
    return media.audit_training_models(contracts, records, found, cameras, model).select("model_id", F.array_join("violations", ",").alias("violations"))
