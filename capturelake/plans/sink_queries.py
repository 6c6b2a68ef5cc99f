"""Queries of binary sinks: files are written by Spark from the driver's tables, and read back by the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..sources import binary_files, files, gaussians, materialize, sparse_binary
from ..streaming import progress
from .queries import ORACLES, query

FIELDS = ["x", "y", "z", "f_dc_0", "f_dc_1", "f_dc_2", "opacity", "scale_0", "scale_1", "scale_2", "rot_0", "rot_1", "rot_2", "rot_3"]


def _folder(df, name):
    return binary_files.local_path(binary_files.new_folder(df.sparkSession, name))


@query(f"SELECT CAST(scene_id AS VARCHAR) AS scene_id, row_number() OVER (PARTITION BY scene_id ORDER BY vertex_id) - 1 AS vertex_id, {', '.join(f'CAST(CAST({f} AS FLOAT) AS DOUBLE) AS {f}' for f in FIELDS)} FROM b_gaussians")
def write_gaussians(b_gaussians):
    spark, path = b_gaussians.sparkSession, _folder(b_gaussians, "clouds")
    gaussians.write_gaussians(b_gaussians, path, FIELDS)
    spark.dataSource.register(gaussians.GaussianSource)
    return spark.read.format("gaussians").load(path).select("scene_id", "vertex_id", *[F.col(f).cast("double").alias(f) for f in FIELDS])


@query("WITH r AS (SELECT scene_id, count(*) AS original, count_if(vertex_id % 5 = scene_id % 5) AS removed FROM b_gaussians GROUP BY 1) SELECT CAST(scene_id AS VARCHAR) AS scene_id, original, removed, CASE WHEN removed / CAST(original AS DOUBLE) <= 0.2 THEN original - removed ELSE 0 END AS written, CASE WHEN removed / CAST(original AS DOUBLE) > 0.2 THEN 'removal_ratio' END AS violation FROM r")
def clean_gaussians(b_gaussians):
    """Vertices with an infinite field go; scenes that lose more than a fifth are not written."""
    spark, path = b_gaussians.sparkSession, _folder(b_gaussians, "clouds")
    bad = b_gaussians.withColumn("opacity", F.when(F.col("vertex_id") % 5 == F.col("scene_id") % 5, float("inf")).otherwise(F.col("opacity")))
    kept, report = gaussians.clean_gaussians(bad, FIELDS, 0.2)
    gaussians.write_gaussians(kept, path, FIELDS)
    written = gaussians.read_gaussians(spark, f"{path}/*.ply", FIELDS).where("opacity < double('Infinity')").groupBy("scene_id").agg(F.count("*").alias("written"))
    d = report.select(F.col("scene_id").cast("string").alias("scene_id"), "original", "removed", "violation").join(written.hint("merge"), "scene_id", "left")
    return d.select("scene_id", "original", "removed", F.coalesce("written", F.lit(0)).alias("written"), "violation")


POSE = "image_id / CAST(7 AS DOUBLE) AS q0, camera_id / CAST(3 AS DOUBLE) AS q1, image_id / CAST(-9 AS DOUBLE) AS t0, camera_id / CAST(11 AS DOUBLE) AS t2"


@query(f"WITH o AS (SELECT image_id, string_agg(CAST(x AS INT) || ':' || CAST(round(y) AS INT) || ':' || point_id, ',' ORDER BY idx) AS points FROM b_observations GROUP BY 1) SELECT CAST(i.image_id % 3 AS VARCHAR) AS model_id, i.image_id, {POSE}, i.camera_id, concat('f', CAST(i.image_id AS VARCHAR), '.png') AS name, coalesce(o.points, '') AS points, CASE WHEN i.image_id <= 0 OR i.camera_id <= 0 THEN 'identity' END AS violation FROM b_images i LEFT JOIN o USING (image_id)")
def sparse_binary_images_round_trip(b_images, b_observations):
    spark, path = b_images.sparkSession, _folder(b_images, "models")
    seen = b_observations.groupBy(F.col("image_id").alias("of")).agg(F.array_sort(F.collect_list(F.struct("idx", "x", "y", "point_id"))).alias("points"))
    i, c = F.col("image_id"), F.col("camera_id")
    rows = b_images.join(seen, i == F.col("of"), "left").withColumns({"model_id": i % 3, "q": F.array(i / 7.0, c / 3.0, F.lit(0.0), F.lit(1.0)), "t": F.array(i / -9.0, F.lit(2.0), c / 11.0), "name": F.concat(F.lit("f"), i.cast("string"), F.lit(".png"))})
    sparse_binary.write_sparse_binary_images(rows, path)
    d = files.read_sparse_binary_images(spark, f"{path}/*/images.bin")
    point = lambda p: F.concat_ws(":", p["x"].cast("int").cast("string"), F.round(p["y"]).cast("int").cast("string"), p["point_id"].cast("string"))
    return d.select("model_id", "image_id", F.col("q")[0].alias("q0"), F.col("q")[1].alias("q1"), F.col("t")[0].alias("t0"), F.col("t")[2].alias("t2"), "camera_id", "name", F.array_join(F.transform("points", point), ",").alias("points"), "violation")


@query("WITH t AS (SELECT point_id, string_agg(image_id || '-' || idx, ',' ORDER BY image_id, idx) AS track FROM b_tracks GROUP BY 1) SELECT CAST(p.point_id % 3 AS VARCHAR) AS model_id, p.point_id, p.error / 7 AS x, -p.error / 3 AS y, p.error * 1e-5 AS z, CAST(p.point_id % 256 AS INT) AS red, p.error, coalesce(t.track, '') AS track, CASE WHEN p.point_id <= 0 THEN 'identity' WHEN EXISTS (SELECT 1 FROM b_tracks k WHERE k.point_id = p.point_id AND k.image_id <= 0) THEN 'track' END AS violation FROM b_points p LEFT JOIN t USING (point_id)")
def sparse_binary_points_round_trip(b_points, b_tracks):
    spark, path = b_points.sparkSession, _folder(b_points, "models")
    t = b_tracks.groupBy("point_id").agg(F.array_sort(F.collect_list(F.struct("image_id", "idx"))).alias("track"))
    e, i = F.col("error"), F.col("point_id")
    rows = b_points.join(t, "point_id", "left").withColumns({"model_id": i % 3, "x": e / 7, "y": -e / 3, "z": e * F.lit(1e-5), "rgb": F.array((i % 256).cast("int"), F.lit(0), F.lit(255))})
    sparse_binary.write_sparse_binary_points(rows, path)
    d = files.read_sparse_binary_points(spark, f"{path}/*/points3D.bin")
    return d.select("model_id", "point_id", "x", "y", "z", F.col("rgb")[0].alias("red"), "error", F.array_join(F.transform("track", lambda p: F.concat_ws("-", p["image_id"].cast("string"), p["idx"].cast("string"))), ",").alias("track"), "violation")


@query("SELECT CAST(camera_id % 3 AS VARCHAR) AS model_id, camera_id, model, width, height, p0 / 7 AS p0, CASE WHEN model = 'SIMPLE_PINHOLE' THEN 3 WHEN model = 'OPENCV' THEN 8 ELSE 4 END AS params, CASE WHEN camera_id = 0 THEN 'identity' WHEN camera_id % 5 = 0 THEN 'not_finite' END AS violation FROM b_cameras")
def sparse_binary_cameras_round_trip(b_cameras):
    spark, path = b_cameras.sparkSession, _folder(b_cameras, "models")
    n = F.when(F.col("model") == "SIMPLE_PINHOLE", 3).when(F.col("model") == "OPENCV", 8).otherwise(4)
    odd = F.when(F.col("camera_id") % 5 == 0, float("nan")).otherwise(F.col("p1"))
    params = F.slice(F.array(F.col("p0") / 7, odd, "p2", "p3", *[F.lit(0.5)] * 4), F.lit(1), n)
    sparse_binary.write_sparse_binary_cameras(b_cameras.select((F.col("camera_id") % 3).alias("model_id"), "camera_id", "model", "width", "height", params.alias("params")), path)
    d = files.read_sparse_binary_cameras(spark, f"{path}/*/cameras.bin")
    return d.select("model_id", "camera_id", "model", "width", "height", F.col("params")[0].alias("p0"), F.size("params").alias("params"), "violation")


@query("SELECT CAST(s_nationkey AS VARCHAR) || '/frame_' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') || CASE WHEN s_suppkey % 4 = 0 THEN '.jpg' ELSE '.png' END AS name, CAST(s_suppkey AS VARCHAR) AS frame_id, length(s_name) + length(CAST(s_suppkey AS VARCHAR)) AS size_bytes, sha256(s_name || CAST(s_suppkey AS VARCHAR)) AS sha256 FROM supplier")
def materialize_frames(supplier):
    """Source images are files named by key, every fourth without an ending; the inventory of the prepared folder."""
    spark, source, path = supplier.sparkSession, _folder(supplier, "frames"), _folder(supplier, "prepared")
    k = F.col("s_suppkey")
    body = F.concat("s_name", k.cast("string"))
    d = supplier.select(F.col("s_nationkey").cast("string").alias("segment_id"), k.alias("frame_id"), F.concat(F.lit("a/"), k.cast("string"), F.when(k % 4 == 0, "").otherwise(".png")).alias("path"), F.sha2(body, 256).alias("sha256"), body.cast("binary").alias("data"))
    binary_files.write_pieces(d.select(F.col("path").alias("file"), F.lit(0).alias("offset"), "data"), source)
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select(materialize.relative_to(F.col("path"), source).alias("path"), "content")
    mapping = materialize.materialize_frames(d.drop("data"), contents, path)
    found = files.file_inventory(spark, path).withColumn("name", materialize.relative_to(F.col("path"), path))
    named = mapping.select(F.concat_ws("/", "segment_id", "prepared_name").alias("name"), F.col("frame_id").cast("string").alias("frame_id"))
    return found.join(named.hint("merge"), "name", "full_outer").select("name", "frame_id", "size_bytes", "sha256")


@query("SELECT 'f' || vec_id || '_depth.npy' AS name, i - 1 AS place, CAST(CAST(e + 1 AS FLOAT) AS DOUBLE) AS depth, 8 AS height FROM b_elements")
def materialize_depth(embeddings):
    """Depth maps of 8 x 8 are written as files, checked, named by their prepared frames and read again."""
    import io

    import numpy as np

    spark, source, path = embeddings.sparkSession, _folder(embeddings, "depth"), _folder(embeddings, "prepared")

    @F.pandas_udf("binary")
    def save(maps):
        out = []
        for m in maps:
            file = io.BytesIO()
            np.savez(file, depth=np.asarray(m, np.float32).reshape(8, 8))
            out.append(file.getvalue())
        return maps.__class__(out, dtype=object)

    one = F.transform("embedding", lambda v: (v.cast("double") + 1).cast("float"))
    name = F.concat(F.lit("f"), F.col("vec_id").cast("string"))
    made = binary_files.staged(embeddings.select(name.alias("name"), save(one).alias("data")), "depth-maps")
    binary_files.write_pieces(made.select(F.concat("name", F.lit(".npz")).alias("file"), F.lit(0).alias("offset"), "data"), source)
    depths = files.read_depth(spark, source).withColumn("path", materialize.relative_to(F.col("path"), source))
    manifest = made.select(F.concat("name", F.lit(".rgb")).alias("rgb_path"), F.concat("name", F.lit(".npz")).alias("depth_path"), F.sha2("data", 256).alias("sha256"))
    mapping = made.select(F.concat("name", F.lit(".rgb")).alias("source_path"), F.concat("name", F.lit(".png")).alias("prepared_name"))
    written = materialize.materialize_depth(depths, manifest, mapping, path).select(F.col("output_name").alias("name"), "output_sha256")
    d = files.read_depth(spark, path).withColumn("name", materialize.relative_to(F.col("path"), path)).join(written.hint("merge"), "name").where("sha256 = output_sha256")
    return d.select("name", F.posexplode("depth").alias("place", "v"), "height").select("name", F.col("place").cast("long").alias("place"), F.col("v").cast("double").alias("depth"), "height")


@query("SELECT o_orderkey AS k, o_totalprice AS v FROM orders")
def write_once(orders):
    """A table is written once; the second write is refused and changes nothing."""
    from pyspark.errors import AnalysisException

    spark, path = orders.sparkSession, binary_files.new_folder(orders.sparkSession, "once")
    files.write_once(orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")), path)
    try:
        files.write_once(orders.limit(0).select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")), path)
    except AnalysisException:
        return spark.read.parquet(path)
    raise AssertionError("the table was written twice")


@query("SELECT CAST(scene_id AS VARCHAR) AS scene_id, row_number() OVER (PARTITION BY scene_id ORDER BY ord) - 1 AS ord, qw AS r00, CAST(ord AS DOUBLE) AS r22, tx, ty, tz FROM b_poses")
def read_trajectories(b_poses):
    """Camera lists of two spellings, one file a scene."""
    spark, path = b_poses.sparkSession, _folder(b_poses, "trajectories")
    n, z = F.col("ord"), F.lit(0.0)
    rotation, place = F.array(F.array("qw", z, z), F.array(z, F.lit(1.0), z), F.array(z, z, n.cast("double"))), F.array("tx", "ty", "tz")
    camera = F.when(n % 2 == 0, F.to_json(F.struct(rotation.alias("R"), place.alias("T")))).otherwise(F.to_json(F.struct(rotation.alias("rotation"), place.alias("position"))))
    each = b_poses.groupBy("scene_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", camera.alias("c")))), lambda c: c["c"]), ",").alias("body"))
    binary_files.write_pieces(each.select(F.concat(F.col("scene_id").cast("string"), F.lit(".json")).alias("file"), F.lit(0).alias("offset"), F.concat(F.lit("["), "body", F.lit("]")).cast("binary").alias("data")), path)
    d = files.read_trajectories(spark, path)
    return d.select("scene_id", F.col("ord").cast("long").alias("ord"), F.col("R")[0].alias("r00"), F.col("R")[8].alias("r22"), *[F.col("T")[i].alias(c) for i, c in enumerate(("tx", "ty", "tz"))])


@query("SELECT 'run' || s_nationkey AS run_id, 'train' AS stage, CAST(s_suppkey AS INT) AS attempt, CASE WHEN s_suppkey % 3 <> 0 THEN CASE WHEN s_acctbal < 0 THEN 'failed' ELSE 'passed' END END AS status, CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS started_at, s_suppkey % 3 = 0 AS orphan FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 5 <> 0")
def read_attempts(supplier):
    """Requests and results are files of their own; some attempts lack one of them."""
    spark, path = supplier.sparkSession, _folder(supplier, "runs")
    k = F.col("s_suppkey")
    folder = F.concat(F.lit("run"), F.col("s_nationkey").cast("string"), F.lit("/stages/train/attempt-"), F.format_string("%04d", k))
    asked = supplier.where(k % 5 != 0).select(F.concat(folder, F.lit("/request.json")).alias("file"), F.to_json(F.struct(F.col("s_name").alias("started_at"))).alias("body"))
    done = supplier.where(k % 3 != 0).select(F.concat(folder, F.lit("/result.json")).alias("file"), F.to_json(F.struct(F.when(F.col("s_acctbal") < 0, "failed").otherwise("passed").alias("status"))).alias("body"))
    binary_files.write_pieces(asked.unionByName(done).select("file", F.lit(0).alias("offset"), F.col("body").cast("binary").alias("data")), path)
    return files.read_attempts(spark, path).select("run_id", "stage", "attempt", "status", "started_at", "orphan")


@query("SELECT 'd' || s_nationkey || '/' || s_suppkey || '.bmp' AS name, CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 256 END AS first_byte, CASE WHEN s_suppkey % 7 = 0 THEN 'missing' WHEN s_suppkey % 4 = 0 THEN 'size' END AS violation FROM supplier")
def read_frames_pixels(supplier):
    """Bitmaps of one colour each, 4 x 2 pixels; some are missing, and for some the manifest has another size."""
    spark, path = supplier.sparkSession, _folder(supplier, "frames")
    k = F.col("s_suppkey")
    byte = F.lpad(F.hex((k % 256).cast("int")), 2, "0")
    # Fixed values of the format: 54 bytes in front of two rows of four pixels with three bytes each.
    head = "424D4E000000000000003600000028000000040000000200000001001800000000001800000000000000000000000000000000000000"
    data = F.unhex(F.concat(F.lit(head), F.repeat(byte, 24)))
    name = F.concat(F.lit("d"), F.col("s_nationkey").cast("string"), F.lit("/"), k.cast("string"), F.lit(".bmp"))
    binary_files.write_pieces(supplier.where(k % 7 != 0).select(name.alias("file"), F.lit(0).alias("offset"), data.alias("data")), path)
    manifest = supplier.select(name.alias("name"), F.when(k % 4 == 0, 5).otherwise(4).alias("width"), F.lit(2).alias("height"))
    d = files.read_frames_pixels(spark, path, manifest, root=path)
    return d.select("name", F.conv(F.hex(F.substring("data", 1, 1)), 16, 10).cast("long").alias("first_byte"), "violation")


@query("SELECT o_orderkey AS camera_id, printf('%04d_', o_custkey) || 'f.' || o_orderkey || '.png' AS view_name FROM orders")
def converted_view_name(orders):
    path = F.concat(F.lit("a/b/f."), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".jpg").otherwise(".PNG"))
    return orders.select(F.col("o_orderkey").alias("camera_id"), X.converted_view_name(F.col("o_custkey"), path).alias("view_name"))


def _streamed(d, name):
    """All rows of a stream that reads what is there and ends."""
    spark, out, check = d.sparkSession, binary_files.new_folder(d.sparkSession, name), binary_files.new_folder(d.sparkSession, f"{name}-checkpoint")
    d.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(d.schema).parquet(out)


@query("SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS iteration, event_type AS kind FROM events WHERE event_id % 4 <> 0 AND event_id > 0")
def stream_markers(events):
    """Log files of many runs, read as a stream: two lines in one by a carriage return, and lines that are no marker."""
    spark, path = events.sparkSession, binary_files.new_folder(events.sparkSession, "logs")
    marker = F.concat(F.lit("SHAPE iteration="), F.col("event_id").cast("string"), F.lit(" kind="), "event_type")
    line = F.when(F.col("event_id") % 4 == 0, "SHAPES iteration=7").when(F.col("event_id") % 4 == 1, F.concat(F.lit("loading 10%\r"), marker)).otherwise(marker)
    ordered = binary_files.ordered(events.select(F.concat(F.col("user_id").cast("string"), F.lit(".log")).alias("file"), "event_id", line.alias("line")), ["file", "event_id"]).drop("event_id")

    binary_files.write_pieces(binary_files.placed(ordered, binary_files.packed_lines), binary_files.local_path(path))
    d = _streamed(progress.stream_markers(progress.stream_lines(spark, path), "SHAPE").select("run_id", "iteration", F.col("fields")["kind"].alias("kind")), "markers")
    return d.select("run_id", "iteration", "kind")


@query()
def stream_exposure(b_exposure):
    """Exposure events as a stream, kept by run in state."""
    spark, path = b_exposure.sparkSession, binary_files.new_folder(b_exposure.sparkSession, "exposure")
    d = b_exposure.select(F.col("run_id").cast("long").alias("run_id"), F.col("iteration").cast("long").alias("iteration"), "camera")
    d.write.parquet(path)
    return _streamed(progress.stream_exposure(spark.readStream.schema(d.schema).parquet(path)), "exposures")


# The stream's rows are those of its batch twin.
ORACLES["stream_exposure"] = ORACLES["running_exposure"]
