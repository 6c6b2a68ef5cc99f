"""Declared against recomputed: coverage reports, name orders, gate settings, sampling plans and recorded progress."""

import json
import random

import pytest
from pyspark.sql import functions as F

from capturelake.functions import expressions as X
from capturelake.operators import gates, reports, telemetry
from capturelake.sources import files
from capturelake.streaming import progress

FRAMES = "video_id string, segment_id string, timestamp_sec double, selected boolean, bridge boolean"


def coverage(spark, frames, windows, limit=10.0):
    f = spark.createDataFrame(frames, FRAMES)
    s = spark.createDataFrame(windows, "video_id string, segment_id string, position int, start_sec double, end_sec double")
    settings = s.select("video_id").distinct().withColumn("selection_max_gap_sec", F.lit(limit))
    return f, s, settings


def test_gaps_within_and_across_parts(spark):
    rng = random.Random(3)
    times = {k: sorted({round(rng.uniform(0, 900), 3) for _ in range(rng.choice([1, 2, 5, 400]))}) for k in "abcdefgh"}
    f, *_ = coverage(spark, [("v", k, t, True, False) for k, ts in times.items() for t in ts] + [("v", "a", 5000.0, False, True), ("v", "a", None, True, False)], [("v", "a", 0, 0.0, 1.0)])
    got = {r["segment_id"]: (r["gap"], r["first"], r["last"]) for r in reports.selected_gaps(f).collect()}
    assert got == {k: (max((b - a for a, b in zip(ts, ts[1:])), default=None), ts[0], ts[-1]) for k, ts in times.items()}


def test_coverage_report_order_counts_and_summary(spark):
    f, s, settings = coverage(
        spark,
        [("v", "a", 1.0, True, True), ("v", "a", 4.0, True, False), ("v", "a", 5.0, False, False), ("v", "b", 30.0, True, False), ("v", "x", 1.0, True, False)],
        [("v", "a", 0, 0.0, 6.0), ("v", "b", 1, 20.0, 45.0), ("v", "c", 2, 50.0, 60.0)],
    )
    right = reports.coverage_segments(f, s, settings)
    rows = {r["segment_id"]: r.asDict() for r in right.collect()}
    assert {k: (r["total_frames"], r["selected_frames"], r["bridge_frames"], r["max_selected_gap_sec"], r["failed_reasons"]) for k, r in rows.items()} == {"a": (3, 2, 1, 3.0, ""), "b": (1, 1, 0, 15.0, "max_selected_gap_sec"), "c": (0, 0, 0, 0.0, "no_selected_frames")}
    summary = reports.coverage_summary(right)
    assert summary.first().asDict() == {"video_id": "v", "selected_frames": 3, "bridge_frames": 1, "component_count": 1, "max_selected_gap_sec": 15.0, "failed_segments": "b,c", "status": "failed"}
    assert reports.coverage_report_violations(f, s, settings, right, summary).count() == 0
    turned = right.withColumn("position", 2 - F.col("position")).where("segment_id <> 'b'")
    wrong = reports.coverage_report_violations(f, s, settings, turned, summary.withColumn("status", F.lit("passed"))).collect()
    assert {(r["segment_id"], r["field"]) for r in wrong} == {("a", "position"), ("c", "position"), (None, "status")} | {("b", n) for n in reports.COUNTS}


@pytest.mark.parametrize("limit", [None, 0.0, -1.0, float("nan"), float("inf")])
def test_a_limit_must_be_a_positive_number(spark, limit):
    f, s, _ = coverage(spark, [("v", "a", 1.0, True, False)], [("v", "a", 0, 0.0, 2.0)])
    settings = spark.createDataFrame([("v", limit)], "video_id string, selection_max_gap_sec double")
    assert "selection_max_gap_sec" in reports.coverage_segments(f, s, settings).first()["failed_reasons"].split(",")


def test_frames_outside_of_their_window(spark):
    f, s, settings = coverage(spark, [("v", "a", 1.0, True, False), ("v", "a", 9.0, True, False)], [("v", "a", 0, 2.0, 10.0)])
    assert reports.coverage_segments(f, s, settings).first()["failed_reasons"] == "outside_window"
    assert reports.coverage_segments(f.limit(0), s.limit(0), settings.limit(0)).count() == 0


def test_names_in_order(spark):
    lists = lambda rows: spark.createDataFrame([(k, n, i) for k, names in rows.items() for i, n in enumerate(names)], "k string, name string, position int")
    got = reports.name_order_status(lists({"same": ["a", "b", None], "turned": ["a", "b"], "twice": ["a"], "lost": ["a", "b"]}), lists({"same": ["a", "b", None], "turned": ["b", "a"], "twice": ["a", "a"], "lost": ["a", "c"]}), ["k"])
    assert {(r["k"], r["name"]): r["status"] for r in got.collect()} == {
        ("same", "a"): "matched", ("same", "b"): "matched", ("same", None): "matched", ("turned", "a"): "moved", ("turned", "b"): "moved", ("twice", "a"): "repeated", ("lost", "a"): "matched", ("lost", "b"): "missing", ("lost", "c"): "unexpected",
    }


def settings_of(spark, *texts):
    return gates.gate_settings(spark.createDataFrame(list(enumerate(texts)), "k long, quality_gates string"), "k")


def test_settings_by_default_and_given(spark):
    rows = settings_of(spark, None, '{"vda":{"mode":"enforce","min_correlation":0,"max_normalized_rmse":1e3}}').collect()
    values = {(r["k"], r["gate"], r["name"]): r["value"] for r in rows if r["name"] != "mode"}
    for g, defaults in gates.DEFAULTS.items():
        for n, v in defaults.items():
            assert values[0, g, n] == v
    assert values[1, "vda", "min_correlation"] == 0 and values[1, "vda", "max_normalized_rmse"] == 1000 and values[1, "vda", "min_inlier_ratio"] == 0.95
    assert {(r["k"], r["gate"]): r["mode"] for r in rows if r["name"] == "mode"} == {(0, "pose"): "off", (0, "vda"): "off", (0, "ply"): "off", (1, "pose"): "off", (1, "vda"): "enforce", (1, "ply"): "off"}
    assert all(r["violation"] is None for r in rows)


@pytest.mark.parametrize(
    ("document", "want"),
    [
        ({"pose": {"min_inlier_ratio": 1.01}}, ("pose", "min_inlier_ratio", "value")), ({"pose": {"max_rotation_step_deg": -0.1}}, ("pose", "max_rotation_step_deg", "value")), ({"pose": {"min_match_count": True}}, ("pose", "min_match_count", "value")),
        ({"ply": {"min_effective_fraction": "0.4"}}, ("ply", "min_effective_fraction", "value")), ({"ply": {"min_effective_fraction": None}}, ("ply", "min_effective_fraction", "value")), ({"ply": {"mode": "on"}}, ("ply", "mode", "mode")), ({"ply": {"mode": None}}, ("ply", "mode", "mode")),
        ({"ply": {"min_correlation": 0.5}}, ("ply", "min_correlation", "unknown")), ({"depth": {"mode": "off"}}, ("depth", None, "unknown")), ([1], (None, None, "not_an_object")), ("x", (None, None, "not_an_object")),
    ],
)
def test_settings_that_break_a_rule(spark, document, want):
    rows = settings_of(spark, json.dumps(document)).where("violation IS NOT NULL").collect()
    assert [(r["gate"], r["name"], r["violation"]) for r in rows] == [want]


def test_broken_json_and_no_configurations(spark):
    assert [r["violation"] for r in settings_of(spark, "{").collect()] == ["not_an_object"]
    assert settings_of(spark, "{}").limit(0).count() == 0


def test_rows_are_judged_by_their_own_configuration(spark):
    texts = ['{"ply":{"mode":"enforce"}}', '{"ply":{"mode":"observe","min_effective_fraction":0.9}}', "{}", '{"ply":{"mode":"enforce","more":1}}']
    m = spark.createDataFrame([(k, 0.5, 60.0, 1.0) for k in range(5)] + [(0, None, 1.0, float("nan"))], "k long, effective_fraction double, anisotropy_q99 double, unit_quaternion_fraction double")
    got = sorted((r["k"], r["passed"], r["reasons"]) for r in gates.configured_gate(m, settings_of(spark, *texts), "k", "ply").collect())
    assert got == [(0, False, ["max_anisotropy_q99"]), (0, False, ["min_effective_fraction", "min_unit_quaternion_fraction"]), (1, True, ["min_effective_fraction", "max_anisotropy_q99"]), (2, True, []), (3, False, ["settings"]), (4, False, ["settings"])]


def test_plans_of_candidates(spark):
    rows = [(10.0, False, 2.0, 4, 60), (10.01, False, 2.0, 4, 60), (1.0, None, 0.5, 4, 60), (1e4, False, 5.0, 4, 60), (10.0, True, 2.0, 4, 60), (None, False, 0.0, 0, 60), (float("inf"), False, 1.0, 5, 4)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d double, v boolean, r double, lo int, hi int")
    p = X.candidate_plan(*[F.col(c) for c in ("d", "v", "r", "lo", "hi")])
    got = [(r["b"], r["f"], r["bad"]) for r in d.select("i", p["candidate_budget"].alias("b"), p["candidate_fps"].alias("f"), p["violations"].alias("bad")).orderBy("i").collect()]
    assert got == [(20, 2.0, []), (21, 21 / 10.01, []), (4, 4.0, []), (60, 0.006, []), (None, None, ["variable_frame_rate"]), (None, None, ["duration", "target_fps", "frame_limits"]), (None, None, ["duration", "frame_limits"])]


def test_settings_of_manifests(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"video_id": "v", "settings": {"keyframe_policy": "legacy", "n": 3, "none": None, "list": [1, 2]}}, {"video_id": "w"}, {"video_id": "x", "settings": {}}]))
    got = {(r["video_id"], r["name"], r["value"]) for r in files.read_manifest_settings(spark, str(tmp_path)).collect()}
    assert got == {("v", "keyframe_policy", "legacy"), ("v", "n", "3"), ("v", "none", None), ("v", "list", "[1,2]")}


EVENTS = "run_id long, seq long, phase string, iteration long, total long, elapsed double, returncode long, error_type string"


def plain(rows):
    kept, last = [], {}
    for run, seq, phase, iteration, total, elapsed, code, error in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        if phase == "iteration":
            if iteration is None or total is None or not max(0, last.get(run, 0)) < iteration <= total:
                continue
            last[run] = iteration
        elif phase not in ("child_started", "child_exited", "parent_error"):
            continue
        kept.append((run, seq, phase, iteration if phase == "iteration" else None, total, max(elapsed or 0.0, 0.0), code if phase == "child_exited" else None, error if phase == "parent_error" else None))
    return kept


def some_events():
    rng = random.Random(5)
    phases = ["iteration"] * 6 + ["child_started", "child_exited", "parent_error", "else", None]
    rows = [(rng.choice([1, 2, 3, None]), seq * 9_000, rng.choice(phases), rng.choice([None, -1, 0, 101, *range(1, 101, 3)]), rng.choice([100, 100, 100, None]), rng.choice([None, -2.0, 3.5]), 7, "E") for seq in range(300)]
    return rows + [(1, None, "child_started", None, 100, 1.0, None, None)]


def test_progress_over_blocks_is_that_of_plain_code(spark):
    rows = some_events()
    got = [tuple(r) for r in telemetry.progress_records(spark.createDataFrame(rows, EVENTS)).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    assert telemetry.progress_records(spark.createDataFrame([], EVENTS)).count() == 0


def test_progress_as_a_stream_over_a_restart(spark, tmp_path):
    rows = some_events()
    source, out, check = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    for part in (rows[:120], rows[120:]):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)
        d = progress.stream_records(spark.readStream.schema(EVENTS).parquet(source))
        d.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    assert sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=str) == sorted(plain(rows), key=str)


def test_settings_are_made_by_all_tasks(spark):
    """A table of one file is dealt before each row becomes many."""
    configs = spark.range(0, 40, 1, 1).select(F.col("id").alias("k"), F.lit('{"ply": {"mode": "observe"}}').alias("quality_gates"))
    d = gates.gate_settings(configs, "k")
    per_task = d.groupBy(F.spark_partition_id()).agg(F.count_distinct("k").alias("n")).collect()
    assert len(per_task) > 1 and sum(r["n"] for r in per_task) == 40
    assert d.where("gate = 'ply' AND name = 'mode' AND mode = 'observe'").count() == 40
