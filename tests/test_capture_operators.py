"""Operators on tiny inputs with answers computed by hand or by brute force."""

import json
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from capturelake.functions import expressions as X
from capturelake.functions import markers
from capturelake.operators import clouds, depth, frames, gates, images, runs, sparse, telemetry, trajectory
from capturelake.sources import files, gaussians


def test_scores_and_reasons(spark):
    d = spark.createDataFrame([(1, 0, 0.0, 0, 100.0, 0.1, 0.9, None, 2, ["blur", "blur"]), (1, 1, 1.0, 1, None, None, None, 0.5, None, None)], "video_id long, frame_id long, timestamp_sec double, frame_index int, sharpness double, overexposed_ratio double, underexposed_ratio double, motion_score double, duplicate_score int, reject_reasons array<string>")
    a, b = frames.scored_frames(d).orderBy("frame_id").collect()
    assert a.quality_score == pytest.approx(0.45 * (1 - math.exp(-1)) + 0.25 * 0.1 + 0.15 * 0.5 + 0.15 * 0.5)
    assert a.reasons == ["blur", "underexposed", "duplicate"] and not a.eligible
    assert b.quality_score == pytest.approx(0.45 * 0.5 + 0.25 + 0.15 * 0.5 + 0.15 * 0.5) and b.reasons == [] and b.eligible


def test_select_frames_against_plain_greedy(spark):
    rng = np.random.default_rng(1)
    rows = [(v, i, float(t), i, float(rng.random()), bool(rng.random() > 0.3)) for v in range(4) for i, t in enumerate(np.sort(rng.random(30) * 10).round(1))]
    d = spark.createDataFrame(rows, "video_id long, frame_id long, timestamp_sec double, frame_index int, quality_score double, eligible boolean")
    durations = spark.createDataFrame([(v, 10.0) for v in range(4)], "video_id long, duration_sec double")
    got = {(r.video_id, r.frame_id): r.selection_reason for r in frames.select_frames(d, durations, 0.8, 3, 12).collect()}
    want = {}
    for v in range(4):
        own = [r for r in rows if r[0] == v]
        budget = min(max(3, min(12, math.ceil(8))), 30)
        tie = lambda r: (-r[4], r[2], r[3], r[1])
        free = [r for r in own if r[5]]
        for n in range(budget):
            if not free:
                break
            best = min(free, key=lambda r: (abs(r[2] - 10.0 * n / (budget - 1)), tie(r)))
            free.remove(best)
            want[v, best[1]] = "temporal_coverage"
    assert got == want


def test_selection_falls_back_to_rejected_frames(spark):
    d = spark.createDataFrame([(1, i, float(i), i, i / 10, i == 0) for i in range(6)], "video_id long, frame_id long, timestamp_sec double, frame_index int, quality_score double, eligible boolean")
    got = {r.frame_id: r.selection_reason for r in frames.select_frames(d, spark.createDataFrame([(1, 6.0)], "video_id long, duration_sec double"), 1.0, 3, 9).collect()}
    assert got == {0: "temporal_coverage", 5: "budget_fallback", 4: "budget_fallback"}


def test_markers_are_strict(spark):
    lines = ['POSE_TELEMETRY {"frame": "a", "accepted": true}', 'POSE_TELEMETRY {"frame": "a"} [05/03 10:11:12]', 'POSE_TELEMETRY {"frame": "a"} trailing', 'POSE_TELEMETRY {"inlier_ratio": NaN}', "POSE_TELEMETRY [1]", "POSE_TELEMETRY", " POSE_TELEMETRY {}", "POSE_TELEMETRY  {}", 'POSE_TELEMETRY {"inlier_ratio": "0.5", "accepted": 1}']
    d = spark.createDataFrame([("r", i, s) for i, s in enumerate(lines)], "run_id string, seq long, line string")
    got = markers.parse_markers(d, "POSE_TELEMETRY", telemetry.POSE).select("seq", "record.*").orderBy("seq").collect()
    assert [r.seq for r in got] == [0, 1, 7, 8] and got[0].accepted and got[3].inlier_ratio is None
    s = spark.createDataFrame([("r", "SHAPE iteration=12 loss=0.5 name=x"), ("r", "SHAPE iteration=-1 a=b"), ("r", "SHAPE a=b")], "run_id string, line string")
    assert [(r.iteration, r.fields["name"]) for r in markers.parse_shape_marker(s, "SHAPE").collect()] == [(12, "x")]


def test_pose_summary_uses_first_record(spark):
    rows = [('{"frame":"a","accepted":false}', 0), ('{"frame":"a","accepted":true,"inlier_ratio":0.7}', 1), ('{"frame":"b","success":true,"inlier_ratio":0.9}', 2), ('{"rejection_reasons":[]}', 3)]
    d = spark.createDataFrame([("r", i, "POSE_TELEMETRY " + s) for s, i in rows], "run_id string, seq long, line string")
    one, both = telemetry.pose_summary(d).first(), telemetry.pose_summary(d, any_attempt=True).first()
    assert (one.attempt_count, one.rejected_attempt_count, one.accepted_frames, one.min_inlier_ratio) == (4, 1, ["b"], 0.7)
    assert both.accepted_frames == ["a", "b"]


def test_loss_prefers_markers(spark):
    d = spark.createDataFrame([("a", "Loss=3.5 x Loss=1e1"), ("b", 'LOSS_TELEMETRY {"total": 11.0, "finite": false}'), ("b", "Loss=2.0")], "run_id string, line string")
    s = {r.run_id: r for r in telemetry.loss_stats(telemetry.loss_values(d)).collect()}
    assert (s["a"].sample_count, s["a"].loss_max, s["a"].source) == (2, 10.0, "text") and (s["b"].sample_count, s["b"].loss_gt_10_ratio, s["b"].source) == (1, 1.0, "telemetry")
    assert telemetry.loss_summary(d).first().has_nonfinite


def test_sim3_is_recovered_and_degenerate_pairs_refused(spark):
    rng = np.random.default_rng(42)
    p = rng.normal(size=(20, 3))
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    t = 2.5 * p @ q.T + [1, -2, 3]
    rows = [(1, *map(float, a), *map(float, b)) for a, b in zip(p, t, strict=True)] + [(2, float(i), 0.0, 0.0, float(i), 0.0, 0.0) for i in range(6)] + [(3, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]
    d = spark.createDataFrame(rows, "scene_id long, sx double, sy double, sz double, tx double, ty double, tz double")
    got = {r.scene_id: r for r in clouds.estimate_sim3(d).collect()}
    assert got[1].scale == pytest.approx(2.5) and np.allclose(got[1].rotation, q.ravel()) and np.allclose(got[1].translation, [1, -2, 3])
    assert got[2].violation == "coplanar" and got[3].violation == "too_few_pairs"


def test_sim3_loads_no_scene_whole(spark):
    d = spark.createDataFrame([(1, *map(float, (i % 3, i % 5, i % 7, i % 3 + 1, i % 5, i % 7))) for i in range(50)], "scene_id long, sx double, sy double, sz double, tx double, ty double, tz double")
    e = clouds.estimate_sim3(d)
    assert "FlatMapGroups" not in e._jdf.queryExecution().toString()
    r = e.first()
    assert r.scale == pytest.approx(1) and r.translation == pytest.approx([1, 0, 0], abs=1e-9)


def test_plane_metrics(spark):
    rng = np.random.default_rng(3)
    flat = [(1, float(a), float(b), 0.01 * float(c)) for a, b, c in rng.normal(size=(400, 3))]
    d = spark.createDataFrame(flat + [(2, 0.0, 0.0, 0.0)] * 3 + [(3, 1.0, 1.0, 1.0)] * 5, "scene_id long, x double, y double, z double")
    got = {r.scene_id: r for r in clouds.plane_metrics(d, 16).collect()}
    xyz = np.array([r[1:] for r in flat])
    c = xyz - xyz.mean(0)
    v = np.linalg.svd(c, full_matrices=False)[2]
    want = np.median(np.abs(c @ v[-1])) / np.linalg.norm(xyz.max(0) - xyz.min(0))
    assert got[1].median_residual_diag_fraction == pytest.approx(want) and 0 < got[1].grid_occupancy < 1 and 0 < got[1].largest_component_fraction <= 1
    assert got[2].grid_occupancy is None and got[3].grid_occupancy == 0.0


def test_voxel_distance_clamps_and_truncates(spark):
    s = spark.createDataFrame([(1, 1, -0.05, 0.0, 0.0), (1, 2, 5.0, 0.0, 0.0), (2, 3, 0.0, 0.0, 0.0)], "scene_id long, vertex_id long, x double, y double, z double")
    t = spark.createDataFrame([(1, 9, 0.05, 0.0, 0.0), (1, 8, 5.25, 0.0, 0.0)], s.schema)
    got = {r.vertex_id: r.distance for r in clouds.voxel_neighbor_distance(s, t, 0.1, 1.0).collect()}
    assert got == {1: pytest.approx(0.1), 2: 1.0, 3: 1.0}
    assert clouds.voxel_dedup(s, 0.1).count() == 3


def test_rotations(spark):
    c, s = math.cos(math.radians(90)), math.sin(math.radians(90))
    rows = [(1, 0, [1.0, 0, 0, 0, 1.0, 0, 0, 0, 1.0], [0.0, 0, 0]), (1, 1, [c, -s, 0.0, s, c, 0.0, 0.0, 0.0, 1.0], [3.0, 4.0, 0.0]), (1, 2, [float("nan")] * 9, [3.0, 4.0, 0.0]), (1, 3, [1.0, 0, 0, 0, 1.0, 0, 0, 0, 1.1], [3.0, 4.0, 9.0])]
    d = spark.createDataFrame([(a, b, list(map(float, r)), list(map(float, t))) for a, b, r, t in rows], "scene_id long, ord long, R array<double>, T array<double>")
    q = trajectory.trajectory_quality(d).first()
    assert q.camera_count == 4 and q.max_rotation_step_deg == pytest.approx(90) and q.max_translation_step == pytest.approx(5) and q.max_orthogonality_error == pytest.approx(0.21) and not q.all_rotations_finite
    r = spark.createDataFrame([([2.0, 0.1, 0.0, 0.0, 2.0, 0.0, 0.0, 0.0, 2.0],)], "r array<double>").select(trajectory.project_to_so3("r").alias("r")).first().r
    m = np.array(r).reshape(3, 3)
    assert np.allclose(m @ m.T, np.eye(3)) and np.linalg.det(m) == pytest.approx(1)
    p = spark.createDataFrame([(1.0, 0.0, 0.0, 0.0, 1.0, 2.0, 3.0), (0.0,) * 7], "qw double, qx double, qy double, qz double, tx double, ty double, tz double")
    e = p.select(*X.camera_center([F.col(n) for n in ("qw", "qx", "qy", "qz")], [F.col(n) for n in ("tx", "ty", "tz")])).collect()
    assert tuple(e[0]) == (-1.0, -2.0, -3.0) and math.isnan(e[1][0])


def test_rotation_of_odd_matrices_is_null(spark):
    good = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    d = spark.createDataFrame([(0, good), (1, None), (2, [float("nan")] * 9), (3, [1.0, 2.0]), (4, [None, *good[1:]])], "k long, r array<double>")
    got = {r.k: r.r for r in d.select("k", trajectory.project_to_so3("r").alias("r")).collect()}
    assert np.allclose(got.pop(0), good) and set(got.values()) == {None}
    assert d.where("k = 1").select(trajectory.project_to_so3("r").alias("r")).first().r is None


def test_fingerprints_and_duplicates_are_sums(spark):
    rows = [(1, "a", "x"), (1, "b", "y"), (2, "b", "y"), (2, "a", "x"), (3, "a", "y"), (3, "b", "x"), (4, "a", "x"), (4, "a", "x")]
    d = spark.createDataFrame(rows, "k long, name string, sha256 string")
    f = {r.k: (r.files, r.fingerprint) for r in runs.content_fingerprint(d, ["k"]).collect()}
    assert f[1] == f[2] and len({f[1], f[3], f[4]}) == 3
    p = spark.createDataFrame([("a", 3), ("b", 1), ("a", 2), ("a", 9), (None, 4), (None, 5)], "k string, at long")
    got = {r.k: tuple(r)[1:] for r in frames.duplicate_keys(p, ["k"], F.col("at")).collect()}
    assert got == {"a": (3, 2, 9), None: (2, 4, 5)}


def test_component_choice(spark):
    members = [("a", n) for n in range(10)] + [("b", n) for n in range(3, 6)] + [("c", n) for n in (20, 21, 22, 30)] + [("d", n) for n in (5, 12)]
    m = spark.createDataFrame(members, "component string, name long")
    positions = spark.createDataFrame([(n, n) for n in range(40)], "name long, position long")
    got = {r.component: (r.status, r.longest_run) for r in sparse.select_component(sparse.component_inventory(m, positions), sparse.component_relations(m)).collect()}
    assert got == {"a": ("selected", 10), "b": ("dominated", 3), "c": ("not_selected", 3), "d": ("not_selected", 1)}


def test_image_metrics(spark):
    a, b = [0.0, 0.5, 1.0, 0.25], [0.0, 0.5, 0.5, 0.25]
    d = spark.createDataFrame([(1, 1, x, y) for x, y in zip(a, b, strict=True)] + [(1, 2, x, x) for x in a], "run_id long, ordinal long, left_v double, right_v double")
    got = {r.ordinal: r for r in images.image_pair_metrics(d).collect()}
    assert got[1].mse == pytest.approx(0.0625) and got[1].psnr == pytest.approx(10 * math.log10(16)) and got[2].psnr is None and got[2].ssim == pytest.approx(1)
    x = np.random.default_rng(1).integers(0, 256, (16, 16)).astype(float)
    assert images.windowed_ssim(x, x) == pytest.approx(1) and images.windowed_ssim(x, 255 - x) < 0
    i = spark.range(1).select(images.spread_indices(10, 4, [9, 20, 3]).alias("i")).first().i
    assert i == [0, 3, 6, 9]


def test_depth_fit_rejects_outliers(spark):
    rng = np.random.default_rng(5)
    v = rng.random(400) + 0.5
    w = 2 * v + 0.5 + rng.normal(size=400) * 0.01
    w[:20] += 3
    d = spark.createDataFrame([(1, float(a), float(1 / b)) for a, b in zip(v, w, strict=True)] + [(2, 1.0, 1.0)], "frame_id long, v double, d_ref double")
    got = {r.frame_id: r for r in depth.fit_depth_alignment(d).collect()}
    assert got[1].slope == pytest.approx(2, abs=0.05) and got[1].kept == 380 and got[1].reason is None and got[2].reason == "too_few_pixels"


def test_gates(spark):
    d = spark.createDataFrame([("a", 0.4, 10.0, 1.0), ("b", 0.1, None, float("nan"))], "run_id string, effective_fraction double, anisotropy_q99 double, quaternion_within_1pct_fraction double")
    got = {r.run_id: (r.passed, r.reasons) for r in gates.evaluate_gate(d, gates.PLY_GATE).collect()}
    assert got == {"a": (True, []), "b": (False, ["effective_fraction", "anisotropy_q99", "quaternion_within_1pct_fraction"])}
    assert gates.evaluate_gate(d, gates.PLY_GATE, "observe").where("NOT passed").count() == 0
    with pytest.raises(ValueError):
        gates.evaluate_gate(d, {"unknown": (">=", 1.0)})


def test_crop_plan_and_paths(spark):
    d = spark.createDataFrame([(100, 50.0), (100, 46.0), (100, 10.0)], "n int, c double")
    got = [(r.p.length, r.p.origin) if r.p else None for r in d.select(X.centered_crop(F.col("n"), F.col("c")).alias("p")).collect()]
    assert got == [(100, 0), (93, 0), None]
    p = spark.createDataFrame([("a/b.png",), ("/a",), ("a/../b",), ("",), (None,)], "p string")
    assert [r[0] for r in p.select(X.safe_relative_path(F.col("p"))).collect()] == [True, False, False, False, False]


def test_file_sources(spark, tmp_path):
    m = tmp_path / "m1"
    m.mkdir()
    (m / "cameras.txt").write_text("# c\n1 PINHOLE 640 480 500 501 320 240\n\n")
    (m / "points3D.txt").write_text("# p\n7 1 2 3 10 20 30 0.5 1 0 2 4\n8 1 2 3 1 2 3 0.1\n9 1 2 3 1 2 3 0.1 5\n")
    (m / "images.txt").write_text("# i\n\n1 1 0 0 0 0.5 0 0 1 a.jpg\n10 20 7 11 21 -1\n2 1 0 0 0 0 0 0 1 b.jpg\n\n3 1 0 0 0 0 0 0 1 c.jpg")
    c = files.read_sparse_cameras(spark, f"{m}/cameras.txt").first()
    assert (c.model_id, c.camera_id, c.model, c.params) == ("m1", 1, "PINHOLE", [500.0, 501.0, 320.0, 240.0])
    p = {r.point_id: r for r in files.read_sparse_points(spark, f"{m}/points3D.txt").collect()}
    assert [tuple(t) for t in p[7].track] == [(1, 0), (2, 4)] and p[8].track == [] and p[9].violation == "malformed"
    i = {r.image_id: r for r in files.read_sparse_images(spark, f"{m}/images.txt").collect()}
    assert [x.point_id for x in i[1].points] == [7, -1] and i[2].points == [] and i[3].violation == "missing_points_line"
    (m / "points3D.bin").write_bytes(struct.pack("<Q", 1) + struct.pack("<Q3d3BdQ", 7, 1, 2, 3, 9, 9, 9, 0.5, 2) + np.array([1, 0, 2, 4], "<u4").tobytes())
    b = files.read_sparse_binary_points(spark, f"{m}/points3D.bin").first()
    assert (b.point_id, b.x, b.error) == (7, 1.0, 0.5) and [tuple(t) for t in b.track] == [(1, 0), (2, 4)]
    (m / "cameras.bin").write_bytes(struct.pack("<Q", 1) + struct.pack("<IiQQ4d", 3, 1, 640, 480, 1, 2, 3, 4))
    assert files.read_sparse_binary_cameras(spark, f"{m}/cameras.bin").first().params == [1.0, 2.0, 3.0, 4.0]
    z = tmp_path / "z"
    z.mkdir()
    np.savez(z / "good.npz", depth=np.ones((2, 3), np.float32))
    np.savez(z / "bad.npz", depth=np.full((2, 3), np.nan, np.float32))
    d = {r.path.rsplit("/", 1)[-1]: r for r in files.read_depth(spark, str(z)).collect()}
    assert d["good.npz"].depth == [1.0] * 6 and d["bad.npz"].violation == "not_finite"
    inventory = files.file_inventory(spark, str(z))
    assert inventory.count() == 2 and files.tree_digest(inventory.withColumn("root", F.lit("r"))).first().files == 2
    t = tmp_path / "scene.json"
    t.write_text(json.dumps([{"rotation": np.eye(3).tolist(), "position": [1, 2, 3]}, {"R": np.eye(3).tolist(), "T": [4, 5, 6]}]))
    assert [r.T for r in files.read_trajectories(spark, str(t)).orderBy("ord").collect()] == [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]
    a = tmp_path / "run7" / "stages" / "train" / "attempt-0002"
    a.mkdir(parents=True)
    (a / "request.json").write_text('{"started_at": "2026-01-01T00:00:00Z"}')
    r = files.read_attempts(spark, str(tmp_path / "run7")).first()
    assert (r.run_id, r.stage, r.attempt, r.orphan) == ("run7", "train", 2, True)


def test_manifest_and_consumer_checks(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"video_id": "v", "schema_version": "2.0", "segments": [{"id": "s", "start_sec": 0, "end_sec": 2}], "frames": [{"id": "f0", "segment_id": "s", "timestamp": 0.5, "blur_score": 3.0, "selected": True, "keyframe": {"motion": {"inlier_ratio": 0.7}}}]}))
    f, s = files.read_manifests(spark, f"{tmp_path}/m.json")
    r = f.first()
    assert (r.frame_id, r.frame_index, r.timestamp_sec, r.sharpness, r.motion_score, r.bridge) == ("f0", 0, 0.5, 3.0, 0.7, False) and s.first().end_sec == 2.0
    good = {"frame_id": 0, "path": "a.png", "width": 4, "height": 4, "sha256": "0" * 64}
    (tmp_path / "c.json").write_text(json.dumps({"schema_version": 1, "segment_id": "s", "base": "b", "frames": [good, good | {"path": "../x", "width": 0}]}))
    v = [r.violations for r in files.consumer_violations(files.read_consumer_manifests(spark, f"{tmp_path}/c.json")).orderBy("position").collect()]
    assert v == [["duplicate_frame_id"], ["duplicate_frame_id", "not_ascending", "path", "size"]]


def test_gaussian_source(spark, tmp_path):
    x = np.arange(12, dtype="<f4").reshape(4, 3)
    (tmp_path / "s1.ply").write_bytes(b"ply\nformat binary_little_endian 1.0\nelement vertex 4\nproperty float x\nproperty float y\nproperty float z\nend_header\n" + x.tobytes())
    spark.dataSource.register(gaussians.GaussianSource)
    gaussians.RANGE = 3
    d = spark.read.format("gaussians").load(str(tmp_path))
    assert d.columns == ["scene_id", "vertex_id", "x", "y", "z"]
    assert [(r.vertex_id, r.z) for r in d.orderBy("vertex_id").collect()] == [(i, float(3 * i + 2)) for i in range(4)]
    assert gaussians.read_gaussians(spark, str(tmp_path), ["x", "opacity"]).where("scene_id = 's1' AND x = 9").count() == 1
    with pytest.raises(ValueError):
        gaussians.parse_header(b"ply\nformat ascii 1.0\nend_header\n")


def test_streams_equal_their_batch_twins(spark, tmp_path, data_dir):
    from capturelake.sources.bindings import bind
    from capturelake.streaming import progress

    p = bind(spark, data_dir, "b_progress").select("run_id", "seq", F.col("iteration").cast("long").alias("iteration"), F.col("total").cast("long").alias("total"))
    e = bind(spark, data_dir, "b_exposure").select(F.col("run_id").cast("long").alias("run_id"), F.col("iteration").cast("long").alias("iteration"), "camera")
    for name, d, stream, twin, order in (("p", p, progress.stream_progress, telemetry.monotonic_progress, "seq"), ("e", e, progress.stream_exposure, telemetry.running_exposure, "iteration")):
        for k in range(3):  # rows arrive in order, in three files
            cut = d.agg(F.percentile(order, F.array(F.lit(k / 3), F.lit((k + 1) / 3)))).first()[0]
            d.where((F.col(order) > cut[0]) & (F.col(order) <= cut[1]) if k else F.col(order) <= cut[1]).coalesce(1).write.parquet(f"{tmp_path}/{name}/{k}")
        source = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/{name}")
        q = stream(source).writeStream.format("memory").queryName(f"out_{name}").option("checkpointLocation", f"{tmp_path}/c{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        got = spark.table(f"out_{name}")
        want = twin(d).select(*got.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_log_stream(spark, tmp_path):
    from capturelake.streaming import progress

    (tmp_path / "run1.log").write_text("x\rSHAPE iteration=1 a=b\nSHAPE iteration=2 a=c\n")
    q = progress.stream_markers(progress.stream_lines(spark, str(tmp_path)), "SHAPE").select("run_id", "iteration").writeStream.format("memory").queryName("lines").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("lines").collect())) == [("run1", 1), ("run1", 2)]


