"""Binary sinks and readers: offsets over many tasks, failed tasks, faulty files, hashes."""

import io
import math
import os
import struct
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capturelake.sources import binary_files, files, gaussians, materialize, sparse_binary


def everything(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names)


def test_one_scene_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Half of all vertices are one scene's; its file is that of one plain writer."""
    monkeypatch.setattr(gaussians, "CHUNK", 100)
    d = spark.range(5000).select(F.when(F.col("id") % 2 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("scene_id"), (5000 - F.col("id")).alias("vertex_id"), (F.col("id") / 3).alias("x"), F.when(F.col("id") % 10 > 0, F.col("id") * 2.0).alias("opacity"))
    gaussians.write_gaussians(d.repartition(6), str(tmp_path))
    assert everything(tmp_path) == ["big.ply", *(f"s{k}.ply" for k in range(7))]
    ids = [i for i in range(4998, -1, -2)]
    body = b"".join(struct.pack("<ff", i / 3, i * 2.0 if i % 10 else math.nan) for i in ids)
    assert (tmp_path / "big.ply").read_bytes() == gaussians.header(["x", "opacity"], 2500) + body
    spark.dataSource.register(gaussians.GaussianSource)
    back = spark.read.format("gaussians").load(str(tmp_path))
    assert back.count() == 5000 and back.where("scene_id = 's3'").agg(F.max("vertex_id")).first()[0] == d.where("scene_id = 's3'").count() - 1
    with pytest.raises(Exception, match="there already"):
        gaussians.write_gaussians(d.where("scene_id = 's1'"), str(tmp_path))
    assert len(everything(tmp_path)) == 8
    gaussians.write_gaussians(d.where("scene_id = 's1'").limit(3), str(tmp_path), overwrite=True)
    assert (tmp_path / "s1.ply").read_bytes().startswith(gaussians.header(["x", "opacity"], 3))
    gaussians.write_gaussians(d.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_failed_tasks_leave_nothing(spark, tmp_path):
    d = spark.range(900).select((F.col("id") % 9).cast("string").alias("scene_id"), F.col("id").alias("vertex_id"), F.lit(1.0).alias("x"))
    for bad in (d.withColumn("scene_id", F.when(F.col("vertex_id") < 899, F.col("scene_id"))), d.withColumn("scene_id", F.concat(F.lit("../"), "scene_id"))):
        with pytest.raises(Exception, match="no file name"):
            gaussians.write_gaussians(bad, str(tmp_path / "a"))
    good = spark.range(40).select(F.concat(F.lit("f"), F.col("id")).alias("file"), F.lit(0).alias("offset"), F.lit(b"abc").alias("data"))
    for rows, why in (
        (good.withColumn("sha256", F.when(F.col("file") == "f39", "0" * 64)), "another SHA-256"), (good.withColumn("data", F.when(F.col("file") != "f3", F.col("data"))), "no bytes"), (good.unionByName(good.where("file = 'f5'")), "6 bytes were written"),
        (good.withColumn("offset", F.when(F.col("file") == "f7", 2).otherwise(0)), "its pieces end at 5"), (good.withColumn("file", F.concat(F.lit("/tmp/"), "file")), "relative file name"),
    ):
        with pytest.raises(Exception, match=why):
            binary_files.write_pieces(rows.repartition(4), str(tmp_path / "a"))
        assert not (tmp_path / "a").exists()
    with pytest.raises(Exception, match="mounted"):
        binary_files.write_pieces(good, "s3a://bucket/a")


def test_clean_gaussians(spark):
    rows = [("a", i, float("nan") if i == 1 else 1.0) for i in range(4)] + [("b", i, None if i else 1.0) for i in range(4)] + [(None, 0, 1.0), ("c", 0, float("-inf"))]
    kept, report = gaussians.clean_gaussians(spark.createDataFrame(rows, "scene_id string, vertex_id int, x double"), ["x"])
    assert sorted(((r.scene_id, r.vertex_id) for r in kept.collect()), key=str) == [("a", 0), ("a", 2), ("a", 3), (None, 0)]
    assert {r.scene_id: (r.original, r.removed, r.final, r.violation) for r in report.collect()} == {"a": (4, 1, 3, None), "b": (4, 3, 1, "removal_ratio"), "c": (1, 1, 0, "removal_ratio"), None: (1, 0, 1, None)}


def image(i, name, points, q=(1, 0, 0, 0), camera=1):
    return struct.pack("<idddddddi", i, *q, 0, 0, 0, camera) + name + b"\0" + struct.pack("<Q", len(points)) + b"".join(struct.pack("<ddq", *p) for p in points)


def test_one_binary_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sparse_binary, "RANGE_RECORDS", 7)
    m = tmp_path / "m1"
    m.mkdir()
    want = {i: [(i / 7, -i / 3, k - 1) for k in range(i % 5)] for i in range(1, 200)}
    (m / "images.bin").write_bytes(struct.pack("<Q", 199) + b"".join(image(i, f"f{i}é.png".encode(), p) for i, p in want.items()))
    d = files.read_sparse_binary_images(spark, str(m / "images.bin"))
    rows = d.withColumn("task", F.spark_partition_id()).collect()
    assert {r.image_id: [tuple(p) for p in r.points] for r in rows} == want and len({r.task for r in rows}) > 1
    assert all(r.name == f"f{r.image_id}é.png" and r.violation is None and r.q == [1, 0, 0, 0] and r.model_id == "m1" for r in rows)
    # The same bytes come back from the writer, whatever the order of rows.
    sparse_binary.write_sparse_binary_images(d.orderBy(F.desc("image_id")), str(tmp_path / "again"))
    assert (tmp_path / "again/m1/images.bin").read_bytes() == (m / "images.bin").read_bytes()


IMAGES, POINTS, CAMERAS = (k.replace(", violation string", "") for k in (sparse_binary.IMAGE_ROWS, sparse_binary.POINT_ROWS, sparse_binary.CAMERA_ROWS))


def packer(spark, monkeypatch, write, rows, schema):
    """The batch that a writer's task gets of a few rows, and what packs it."""
    taken = []
    with monkeypatch.context() as m:
        m.setattr(sparse_binary, "placed", lambda d, pack, head: taken.append((d, pack)))
        m.setattr(sparse_binary, "write_pieces", lambda *_: None)
        write(spark.createDataFrame(rows, schema), "")
    return taken[0][0].toArrow().combine_chunks().to_batches()[0], taken[0][1]


def test_records_are_packed_by_whole_batches(spark, monkeypatch):
    """Packing makes fewer than two calls a record; pieces are cut between records and at the next model, and have the bytes of plain code."""
    nan = lambda v: math.nan if v is None else v
    numbers = {name: k for k, (name, _) in enumerate(sparse_binary.MODELS)}
    an_image = lambda i, q, t, c, name, p: struct.pack("<i7di", i, *q, *t, c) + name.encode() + b"\0" + struct.pack("<Q", len(p or [])) + b"".join(struct.pack("<ddq", nan(x), nan(y), k) for x, y, k in p or [])
    a_point = lambda i, x, y, z, rgb, e, t: struct.pack("<Q3d3BdQ", i, x, y, z, *rgb, e, len(t or [])) + b"".join(struct.pack("<ii", *a) for a in t or [])
    a_camera = lambda i, m, w, h, p: struct.pack(f"<iiQQ{len(p)}d", i, numbers[m], w, h, *p)
    images = [(f"m{k // 700}", k, [k / 7, 0.0, 1.0, -k / 3], [0.5, float(k), 2.0], k % 5 - 1, f"f{k}é.png" if k % 9 else "", [(k / 3, None if j == 2 else -j / 7, j - 1) for j in range(k % 4)] if k % 11 else None) for k in range(2000)]
    points = [(f"m{k // 700}", k, k / 3, -k / 7, math.inf, [k % 256, 0, 255], k / 9, [(k - 9, j) for j in range(k % 4)] if k % 11 else None) for k in range(2000)]
    cameras = [(f"m{k // 700}", k - 3, name, k, k + 1, [k / (j + 3) for j in range(n)]) for k in range(2000) for name, n in [sparse_binary.MODELS[k % 11]]]
    for write, rows, schema, record in ((sparse_binary.write_sparse_binary_images, images, IMAGES, an_image), (sparse_binary.write_sparse_binary_points, points, POINTS, a_point), (sparse_binary.write_sparse_binary_cameras, cameras, CAMERAS, a_camera)):
        batch, pack = packer(spark, monkeypatch, write, rows, schema)
        list(pack([batch.slice(0, 9)]))  # what is imported at first use
        calls = []
        sys.setprofile(lambda frame, event, what, calls=calls: calls.append(event))
        try:
            whole = list(pack([batch]))
        finally:
            sys.setprofile(None)
        assert calls.count("call") + calls.count("c_call") < 2 * len(rows)
        want = {}
        for model, *fields in rows:
            want.setdefault(model, []).append(record(*fields))
        assert [(f.split("/")[0], n, x) for f, n, x in whole] == [(m, len(r), b"".join(r)) for m, r in want.items()]
        with monkeypatch.context() as m:
            m.setattr(sparse_binary, "RANGE_BYTES", 4 * 999)
            cut = list(pack([batch.slice(0, 7), batch.slice(7, 0), batch.slice(7, 1200), batch.slice(1207)]))
        assert len(cut) > 9 and max(len(x) for _, _, x in cut) < 999 + max(len(x) for r in want.values() for x in r)
        for file, n, data in whole:
            assert (sum(k for f, k, _ in cut if f == file), b"".join(x for f, _, x in cut if f == file)) == (n, data)


def test_records_that_the_format_cannot_hold_fail(spark, monkeypatch):
    i, p, c = ("m", 1, [1.0, 0.0, 0.0, 0.0], [0.0] * 3, 1, "a.png", [(1.0, 2.0, 3)]), ("m", 1, 0.0, 0.0, 0.0, [1, 2, 3], 0.5, [(1, 2)]), ("m", 1, "PINHOLE", 4, 4, [1.0] * 4)
    for write, schema, row, bad in (
        (sparse_binary.write_sparse_binary_images, IMAGES, i, [(0, None), (0, "a/b"), (1, None), (1, 1 << 31), (2, [1.0] * 3), (2, None), (3, [0.0, None, 0.0]), (4, None), (5, None), (6, [None]), (6, [{"x": 1.0, "y": 2.0, "point_id": None}])]),
        (sparse_binary.write_sparse_binary_points, POINTS, p, [(1, -1), (2, None), (5, [1, 2, 256]), (5, [1, 2]), (6, None), (7, [{"image_id": 1 << 31, "idx": 0}]), (7, [{"image_id": None, "idx": 0}])]),
        (sparse_binary.write_sparse_binary_cameras, CAMERAS, c, [(1, 1 << 31), (2, "X"), (3, -1), (4, None), (5, [1.0] * 3), (5, None)]),
    ):
        batch, pack = packer(spark, monkeypatch, write, [row], schema)
        assert len(list(pack([batch]))) == 1
        for k, v in bad:
            one = batch.set_column(k, batch.schema.field(k), pa.array([v], batch.schema.field(k).type))
            with pytest.raises((ValueError, TypeError, KeyError, OverflowError, AttributeError, struct.error)):
                list(pack([one]))


def test_faults_of_binary_models(spark, tmp_path):
    def folder(name, **parts):
        (tmp_path / name).mkdir()
        for file, data in parts.items():
            (tmp_path / name / f"{file}.bin").write_bytes(data)

    n = lambda k: struct.pack("<Q", k)
    camera = lambda i, model=1, w=4, p=(1.0, 2.0, 3.0, 4.0): struct.pack(f"<iiQQ{len(p)}d", i, model, w, 4, *p)
    point = lambda i, track=(), x=1.0: struct.pack("<Q3d3BdQ", i, x, 0, 0, 1, 2, 3, 0.5, len(track)) + b"".join(struct.pack("<ii", *t) for t in track)
    folder("ok", cameras=n(1) + camera(1), images=n(1) + image(1, b"a.png", [(1, 2, -1)]), points3D=n(0))
    folder("cut", cameras=n(2) + camera(1) + camera(2)[:-3], images=n(2) + image(1, b"a.png", []) + b"\1\0", points3D=n(1) + point(1, [(1, 0)])[:-1])
    folder("more", cameras=n(1) + camera(1) + b"x", images=n(0) + b"yy", points3D=n(1) + point(3) + point(4))
    folder("odd", cameras=n(4) + camera(0) + camera(5, w=0) + camera(6, p=(1.0, math.inf, 3.0, 4.0)) + camera(7, 99), images=n(6) + image(1, b"a.png", [], (math.nan, 0, 0, 0)) + image(2, b"a.gif", []) + image(3, b"\xff.png", []) + image(4, b"d.png", [(1, math.nan, 2)]) + image(5, b"e.png", [(1, 1, -2)]) + image(6, b"x/f.png", [], camera=0), points3D=n(3) + point(0) + point(1, [(0, 1)]) + point(2, x=math.inf))
    folder("none", cameras=b"", images=n(1)[:5], points3D=n(2))
    folder("twice", cameras=n(2) + camera(1) + camera(1), images=n(3) + image(1, b"a.png", []) + image(1, b"b.png", []) + image(2, b"b.png", []), points3D=n(3) + point(1, [(1, 0)]) + point(2, [(1, 0)]) + point(2))
    folder("bare", cameras=n(0), images=n(1) + image(1, b"a.png", []), points3D=n(0))
    c, i, p = files.read_sparse_binary_cameras(spark, f"{tmp_path}/*/cameras.bin"), files.read_sparse_binary_images(spark, f"{tmp_path}/*/images.bin"), files.read_sparse_binary_points(spark, f"{tmp_path}/*/points3D.bin")
    key = lambda d, k: sorted(((r[0], r[1], r[2]) for r in d.where("violation IS NOT NULL").select("model_id", k, "violation").collect()), key=str)
    assert key(c, "camera_id") == sorted([("cut", None, "truncated"), ("more", None, "trailing_bytes"), ("odd", 0, "identity"), ("odd", 5, "identity"), ("odd", 6, "not_finite"), ("odd", None, "unknown_model")], key=str)  # Spark passes over an empty file
    assert key(i, "image_id") == sorted([("cut", None, "truncated"), ("more", None, "trailing_bytes"), ("odd", 1, "not_finite"), ("odd", 2, "name"), ("odd", 3, "name"), ("odd", 4, "observation"), ("odd", 5, "observation"), ("odd", 6, "identity"), ("none", None, "truncated")], key=str)
    assert key(p, "point_id") == sorted([("cut", None, "truncated"), ("more", None, "trailing_bytes"), ("odd", 0, "identity"), ("odd", 1, "track"), ("odd", 2, "not_finite"), ("none", None, "truncated")], key=str)
    assert {r.camera_id for r in c.where("model_id = 'cut' AND camera_id IS NOT NULL").collect()} == {1}
    found = sorted(((r.model_id, r.part, r.id, r.violation) for r in sparse_binary.model_violations(c, i, p).collect()), key=str)
    assert found == sorted([("bare", "camera", None, "no_records"), ("none", "camera", None, "no_records"), ("twice", "camera", 1, "duplicate_id"), ("twice", "image", 1, "duplicate_id"), ("twice", "image", 1, "duplicate_name"), ("twice", "point", 1, "duplicate_track"), ("twice", "point", 2, "duplicate_id")], key=str)
    every = [camera(k + 1, k, p=tuple(float(x) for x in range(size))) for k, (_, size) in enumerate(sparse_binary.MODELS)]
    folder("all", cameras=n(len(every)) + b"".join(every))
    rows = files.read_sparse_binary_cameras(spark, f"{tmp_path}/all/cameras.bin").orderBy("camera_id").collect()
    assert [(r.model, len(r.params)) for r in rows] == sparse_binary.MODELS


def test_materialized_frames(spark, tmp_path):
    source = tmp_path / "src"
    source.mkdir()
    rows = []
    for k in range(6):
        (source / f"{k}.png").write_bytes(b"x" * (k + 1))
        rows.append(("s", k, f"{k}.png", __import__("hashlib").sha256(b"x" * (k + 1)).hexdigest()))
    schema = "segment_id string, frame_id int, path string, sha256 string"
    contents = spark.read.format("binaryFile").load(str(source)).select(materialize.relative_to(F.col("path"), str(source)).alias("path"), "content")
    m = materialize.materialize_frames(spark.createDataFrame(rows, schema), contents, str(tmp_path / "out"))
    assert everything(tmp_path / "out") == [f"s/frame_{k:06d}.png" for k in range(6)] and (tmp_path / "out/s/frame_000004.png").read_bytes() == b"xxxxx"
    assert sorted((r.source_path, r.prepared_name) for r in m.collect()) == [(f"{k}.png", f"frame_{k:06d}.png") for k in range(6)]
    bad = spark.createDataFrame([*rows[:2], ("s", 2, "2.png", "0" * 64), ("s", 3, "gone.png", "0" * 64), ("s", 4, "4.png", None), ("s", 5, "5.png", rows[5][3]), ("s", 5, "5.png", rows[5][3])], schema)
    assert sorted((r.frame_id, r.violation) for r in materialize.frame_violations(bad, contents).collect()) == [(2, "sha256"), (3, "missing"), (4, "sha256"), (5, "prepared_name"), (5, "prepared_name")]
    for frames, why in ((bad.where("frame_id = 2"), "SHA-256"), (bad.where("frame_id = 3"), "no bytes"), (bad.where("frame_id = 4"), "SHA-256"), (bad.where("frame_id = 5"), "were written")):
        with pytest.raises(Exception, match=why):
            materialize.materialize_frames(frames, contents, str(tmp_path / "bad"))
        assert not (tmp_path / "bad").exists()
    named = spark.createDataFrame([(7, "a/b.c/noend"), (1234567, "x.JPG"), (8, ".png")], "frame_id int, path string").select(materialize.prepared_name(F.col("frame_id"), F.col("path")).alias("n"))
    assert [r.n for r in named.collect()] == ["frame_000007.jpg", "frame_1234567.JPG", "frame_000008.jpg"]


def test_depth_violations(spark, tmp_path):
    for k in range(5):
        out = io.BytesIO()
        np.savez(out, depth=np.full((2, 3), np.nan if k == 3 else k, np.float32))
        (tmp_path / f"{k}.npz").write_bytes(out.getvalue())
    (tmp_path / "5.npy").write_bytes(b"junk")
    depths = files.read_depth(spark, str(tmp_path)).withColumn("path", materialize.relative_to(F.col("path"), str(tmp_path)))
    sha = {r.path: r.sha256 for r in depths.collect()}
    manifest = spark.createDataFrame([(f"r{k}", f"{k}.npz" if k != 5 else "5.npy", sha[f"{k}.npz" if k != 5 else "5.npy"] if k != 2 else "0" * 64) for k in range(6)] + [("r8", "gone.npz", "0" * 64), ("r0", "0.npz", sha["0.npz"])], "rgb_path string, depth_path string, sha256 string")
    mapping = spark.createDataFrame([(f"r{k}", f"p{k}.png") for k in (0, 1, 2, 3, 5, 8, 9)] + [("r1", "p1.jpg")], "source_path string, prepared_name string")
    found = sorted(map(tuple, materialize.depth_violations(depths, manifest, mapping).collect()))
    assert found == [("r0", "duplicate_entry"), ("r1", "duplicate_output"), ("r1", "duplicate_source"), ("r2", "sha256"), ("r3", "not_finite"), ("r4", "unused"), ("r5", "unreadable"), ("r8", "no_file"), ("r9", "missing")]
    with pytest.raises(ValueError, match="duplicate_entry 1"):
        materialize.materialize_depth(depths, manifest, mapping, str(tmp_path / "out"))
    good = [spark.createDataFrame([("r1", "1.npz", sha["1.npz"])], manifest.schema), spark.createDataFrame([("r1", "p1.t10.000.png")], mapping.schema)]
    r = materialize.materialize_depth(depths, *good, str(tmp_path / "out")).first()
    assert (r.output_name, r.height, r.width, r.dtype) == ("p1.t10.000_depth.npy", 2, 3, "float32")
    assert np.array_equal(np.load(tmp_path / "out/p1.t10.000_depth.npy"), np.full((2, 3), 1, np.float32))
