"""Queries of file readers: documents are made of the driver's tables by Spark, written, and read back by the reader."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import contracts, files
from .queries import query


def new_folder(spark: SparkSession) -> str:
    """A folder in ``spark.checkpoint.dir``; a session in local mode without it takes one of its own."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='spark-capturelake-', dir='/tmp')).rstrip('/')}/documents-{uuid.uuid4().hex}"


def documents(rows: DataFrame, group: str, spark: SparkSession) -> str:
    """Write rows (group, doc) as JSON files, each an array of its group's documents; groups are of bounded size."""
    path = new_folder(spark)
    each = rows.groupBy(group).agg(F.concat(F.lit("["), F.array_join(F.collect_list("doc"), ","), F.lit("]")).alias("value"))
    each.repartition(group).write.partitionBy(group).text(path)
    return path


def _videos(events, *frame):
    """A manifest's frames by video, in order of event_id."""
    f = F.array_sort(F.collect_list(F.struct("event_id", F.struct(*frame).alias("f"))))
    return events.groupBy("user_id").agg(F.transform(f, lambda x: x["f"]).alias("frames"))


K = "CAST(json_extract_string(props, '$.k') AS INT)"


@query(f"SELECT CAST(user_id AS VARCHAR) AS video_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS position, CAST(event_id AS VARCHAR) AS frame_id, event_type AS segment_id, value AS timestamp_sec, {K} % 2 = 0 AS selected FROM events")
def read_manifests(events):
    number, odd = F.col("event_id").cast("string"), F.col("event_id") % 2 == 1
    fields = [F.when(odd, number).alias("id"), F.when(~odd, number).alias("frame_id"), F.col("event_type").alias("segment_id"), F.when(odd, F.col("value")).alias("timestamp"), F.when(~odd, F.col("value")).alias("timestamp_sec"), (F.get_json_object("props", "$.k").cast("int") % 2 == 0).alias("selected")]
    docs = _videos(events, *fields).select(F.floor(F.col("user_id") / 20).alias("g"), F.to_json(F.struct(F.col("user_id").cast("string").alias("video_id"), "frames")).alias("doc"))
    spark = events.sparkSession
    d, _ = files.read_manifests(spark, documents(docs, "g", spark))
    return d.select("video_id", F.col("position").cast("long").alias("position"), "frame_id", "segment_id", "timestamp_sec", "selected")


@query("WITH f AS (SELECT user_id, event_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS position, value FROM events), w AS (SELECT *, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY position) AS before FROM f), x AS (SELECT CAST(user_id AS VARCHAR) AS video_id, 'frame' AS part, position, concat_ws(',', CASE WHEN event_type = 'error' THEN 'segment_id' END, CASE WHEN event_id % 7 = 0 THEN 'selected' END, CASE WHEN value <= before THEN 'not_increasing' END) AS violations FROM w), h AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS video_id, 'manifest' AS part, 0 AS position, concat_ws(',', CASE WHEN user_id % 3 = 0 THEN 'schema_version' END, CASE WHEN user_id % 4 = 0 THEN 'keyframe_policy' END, CASE WHEN user_id % 5 = 0 THEN 'run_id' END) AS violations FROM events), s AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS video_id, 'segment' AS part, 1 AS position, 'window' AS violations FROM events WHERE user_id % 6 = 0) SELECT * FROM x WHERE violations <> '' UNION ALL SELECT * FROM h WHERE violations <> '' UNION ALL SELECT * FROM s")
def validate_producer(events):
    spark, u = events.sparkSession, F.col("user_id")
    frames = _videos(events, F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("segment_id"), F.when(F.col("event_id") % 7 != 0, True).alias("selected"), F.col("event_id").alias("frame_index"), F.col("value").alias("timestamp_sec"))
    known = [r for r in ("click", "purchase", "signup", "view")]
    segments = F.array(*[F.struct(F.lit(k).alias("id"), F.lit(0.0).alias("start_sec"), F.when((u % 6 == 0) & F.lit(i == 1), -1.0).otherwise(9.0).alias("end_sec")) for i, k in enumerate(known)])
    doc = F.struct(F.when(u % 3 == 0, "1.0").otherwise("2.0").alias("schema_version"), u.cast("string").alias("video_id"), F.struct(F.when(u % 4 == 0, "other").otherwise("legacy").alias("keyframe_policy")).alias("settings"), F.create_map(F.lit("a"), F.lit("b")).alias("summary"), F.struct(F.when(u % 5 != 0, "r").alias("id")).alias("run"), segments.alias("segments"), "frames")
    docs = frames.select(F.floor(u / 20).alias("g"), F.to_json(doc).alias("doc"))
    d = contracts.validate_producer(contracts.read_producer(spark, documents(docs, "g", spark)))
    return d.select("video_id", "part", F.col("position").cast("long").alias("position"), F.array_join("violations", ",").alias("violations"))


@query("WITH f AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 1000 ELSE o_orderkey END AS frame_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position FROM orders), w AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, frame_id) AS n, lag(frame_id) OVER (PARTITION BY o_custkey ORDER BY position) AS before FROM f), v AS (SELECT CAST(o_custkey AS VARCHAR) AS segment_id, position, concat_ws(',', CASE WHEN n > 1 THEN 'duplicate_frame_id' END, CASE WHEN frame_id <= before THEN 'not_ascending' END, CASE WHEN o_orderkey % 5 = 0 THEN 'path' END, CASE WHEN o_orderkey % 7 = 0 THEN 'size' END) AS violations FROM w) SELECT * FROM v WHERE violations <> ''")
def consumer_violations(orders):
    spark, c = orders.sparkSession, F.col
    k = c("o_orderkey")
    frame = F.struct(F.when(k % 9 == 0, 1000).otherwise(k).alias("frame_id"), F.concat(F.when(k % 5 == 0, "/").otherwise("f/"), k.cast("string")).alias("path"), F.when(k % 7 == 0, 0).otherwise(640).alias("width"), F.lit(480).alias("height"), F.sha2(k.cast("string"), 256).alias("sha256"))
    frames = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", frame.alias("f")))).alias("s"))
    doc = F.to_json(F.struct(F.lit(2).alias("schema_version"), c("o_custkey").cast("string").alias("segment_id"), F.transform("s", lambda x: x["f"]).alias("frames")))
    path = documents(frames.select(F.floor(c("o_custkey") / 500).alias("g"), doc.alias("doc")), "g", spark)
    d = files.consumer_violations(files.read_consumer_manifests(spark, path).withColumn("manifest", c("segment_id")))
    return d.select("segment_id", c("position").cast("long").alias("position"), F.array_join("violations", ",").alias("violations"))


@query("SELECT CAST(c_nationkey AS VARCHAR) AS video_id, CASE WHEN c_nationkey % 2 = 0 THEN 'passed' ELSE 'failed' END AS status, CAST(c_custkey AS VARCHAR) AS segment_id, CAST(c_custkey % 9 AS INT) AS selected_frames, CAST(c_acctbal AS DOUBLE) AS max_selected_gap_sec FROM customer")
def read_quality_reports(customer):
    spark, c = customer.sparkSession, F.col
    s = F.struct(c("c_custkey").cast("string").alias("segment_id"), (c("c_custkey") % 9).cast("int").alias("selected_frames"), c("c_acctbal").cast("double").alias("max_selected_gap_sec"))
    # A report lists some hundred segments; a video with more has several.
    r = customer.groupBy("c_nationkey", F.floor(c("c_custkey") / 500).alias("g")).agg(F.collect_list(s).alias("segments"))
    doc = F.to_json(F.struct(c("c_nationkey").cast("string").alias("video_id"), F.when(c("c_nationkey") % 2 == 0, "passed").otherwise("failed").alias("status"), "segments"))
    return files.read_quality_reports(spark, documents(r.select("g", doc.alias("doc")), "g", spark)).select("video_id", "status", "segment_id", "selected_frames", "max_selected_gap_sec")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS contract, CAST(count(*) AS INT) AS camera_count, concat_ws(',', CASE WHEN count(DISTINCT l_partkey % 50) < count(*) THEN 'duplicate_name' END, CASE WHEN l_orderkey % 5 = 0 THEN 'frame_count' END, CASE WHEN l_orderkey % 7 = 0 THEN 'size' END) AS violations FROM lineitem GROUP BY l_orderkey")
def read_camera_contracts(lineitem):
    spark, k = lineitem.sparkSession, F.col("l_orderkey")
    d = lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.concat((F.col("l_partkey") % 50).cast("string"), F.lit(".png")))).alias("frame_names"))
    doc = F.struct(k.cast("string").alias("contract_sha256"), (F.size("frame_names") + F.when(k % 5 == 0, 1).otherwise(0)).alias("frame_count"), "frame_names", F.struct(F.lit("PINHOLE").alias("model"), F.lit(640).alias("width"), F.when(k % 7 == 0, 0).otherwise(480).alias("height")).alias("camera"))
    d = contracts.read_camera_contracts(spark, documents(d.select(F.floor(k / 4000).alias("g"), F.to_json(doc).alias("doc")), "g", spark))
    return d.select(F.col("contract_sha256").alias("contract"), "camera_count", F.array_join("violations", ",").alias("violations"))


@query("SELECT CAST(max(o_custkey) AS INT) AS max_frames, CAST(count(*) AS INT) AS frame_count, CAST(count_if(o_orderstatus = 'F') AS INT) AS selected_count, concat_ws(',', CASE WHEN o_custkey <= 0 THEN 'max_frames' END, CASE WHEN o_custkey % 3 = 0 THEN 'duration_sec' END) AS violations FROM orders GROUP BY o_custkey")
def read_frame_selections(orders):
    spark, k = orders.sparkSession, F.col("o_custkey")
    d = orders.groupBy("o_custkey").agg(F.collect_list(F.struct((F.col("o_orderstatus") == "F").alias("selected"))).alias("frames"))
    doc = F.struct(F.when(k % 3 == 0, -1.0).otherwise(5.0).alias("duration_sec"), F.struct(k.alias("max_frames")).alias("config"), "frames")
    d = contracts.read_frame_selections(spark, documents(d.select(F.floor(k / 500).alias("g"), F.to_json(doc).alias("doc")), "g", spark))
    return d.select("max_frames", "frame_count", "selected_count", F.array_join("violations", ",").alias("violations"))


@query("SELECT CAST(label AS VARCHAR) AS scene_id, CAST(embedding[1] AS DOUBLE) AS sx, CAST(embedding[2] AS DOUBLE) AS sy, CAST(embedding[4] AS DOUBLE) AS tx, CASE WHEN vec_id % 11 = 0 THEN 'malformed' END AS violation FROM embeddings")
def read_pairs(embeddings):
    spark, e = embeddings.sparkSession, lambda a, n: F.slice(F.col("embedding").cast("array<double>"), a, n)
    doc = F.struct(F.col("label").cast("string").alias("scene_id"), F.when(F.col("vec_id") % 11 == 0, e(4, 2)).otherwise(e(4, 3)).alias("laser_xyz"), e(1, 3).alias("model_xyz"))
    d = contracts.read_pairs(spark, documents(embeddings.select(F.floor(F.col("vec_id") / 500).alias("g"), F.to_json(doc).alias("doc")), "g", spark))
    return d.select("scene_id", "sx", "sy", "tx", "violation")


@query("SELECT CAST(c_custkey AS VARCHAR) AS scene_id, CAST(c_acctbal AS DOUBLE) AS x_min, CASE WHEN c_acctbal > 5000 OR c_nationkey = 3 THEN 'box' END AS violation FROM customer")
def read_roi(customer):
    spark, zero = customer.sparkSession, F.lit(0.0)
    doc = F.struct(F.col("c_custkey").cast("string").alias("scene_id"), F.col("c_acctbal").cast("double").alias("x_min"), F.lit(5000.0).alias("x_max"), zero.alias("y_min"), F.when(F.col("c_nationkey") != 3, 1.0).alias("y_max"), zero.alias("z_min"), zero.alias("z_max"))
    d = contracts.read_roi(spark, documents(customer.select(F.floor(F.col("c_custkey") / 500).alias("g"), F.to_json(doc).alias("doc")), "g", spark))
    return d.select("scene_id", "x_min", "violation")


@query("SELECT CAST(p_partkey AS VARCHAR) AS video_id, CAST(p_size AS DOUBLE) AS fps FROM part")
def read_probes(part):
    from ..operators import media

    spark, path = part.sparkSession, new_folder(part.sparkSession)
    text = F.concat(F.lit('{"video_id":"'), F.col("p_partkey").cast("string"), F.lit('","streams":[{"codec_type":"video","width":640,"height":480,"avg_frame_rate":"'), F.col("p_size").cast("string"), F.lit('/1","duration":"2"}]}'))
    part.select(text.alias("value")).write.text(path)
    return media.normalize_probe(contracts.read_probes(spark, path)).select("video_id", "fps")


@query("SELECT l_orderkey AS iteration, CAST(l_linenumber AS INT) AS exposure_count, l_returnflag AS camera_basename FROM lineitem")
def read_event_jsonl(lineitem):
    spark, path = lineitem.sparkSession, new_folder(lineitem.sparkSession)
    lineitem.select(F.col("l_orderkey").alias("iteration"), F.col("l_linenumber").alias("exposure_count"), F.col("l_returnflag").alias("camera_basename")).write.json(path)
    return files.read_event_jsonl(spark, path).select("iteration", "exposure_count", "camera_basename")


@query("WITH t AS (SELECT point_id, string_agg(image_id || '-' || idx, ',' ORDER BY image_id, idx) AS track FROM b_tracks GROUP BY 1) SELECT p.point_id, p.error, coalesce(t.track, '') AS track FROM b_points p LEFT JOIN t USING (point_id)")
def sparse_points_round_trip(b_points, b_tracks):
    spark, path = b_points.sparkSession, new_folder(b_points.sparkSession)
    t = b_tracks.groupBy("point_id").agg(F.array_sort(F.collect_list(F.struct("image_id", "idx"))).alias("track"))
    rows = b_points.join(t, "point_id", "left").withColumns({"model_id": F.col("point_id") % 3, "x": F.lit(1.5), "y": F.lit(-2.0), "z": F.lit(0.25), "rgb": F.array(F.lit(1), F.lit(2), F.lit(3))})
    rows = rows.withColumn("track", F.coalesce("track", F.array().cast("array<struct<image_id: bigint, idx: bigint>>")))
    files.write_sparse_points(rows, path)
    d = files.read_sparse_points(spark, f"{path}/*")
    return d.select("point_id", "error", F.array_join(F.transform("track", lambda x: F.concat_ws("-", x["image_id"].cast("string"), x["idx"].cast("string"))), ",").alias("track"))


@query("SELECT camera_id, model, CAST(width AS INT) AS width, CAST(height AS INT) AS height, p0, p1 FROM b_cameras")
def sparse_cameras_round_trip(b_cameras):
    spark, path = b_cameras.sparkSession, new_folder(b_cameras.sparkSession)
    files.write_sparse_cameras(b_cameras.select((F.col("camera_id") % 3).alias("model_id"), "camera_id", "model", "width", "height", F.array("p0", "p1", "p2", "p3").alias("params")), path)
    d = files.read_sparse_cameras(spark, f"{path}/*")
    return d.select("camera_id", "model", "width", "height", F.col("params")[0].alias("p0"), F.col("params")[1].alias("p1"))


@query("SELECT i.image_id, i.camera_id, concat('f', CAST(i.image_id AS VARCHAR), '.png') AS name, count(o.idx) AS points, round(coalesce(sum(o.x), 0), 3) AS sum_x FROM b_images i LEFT JOIN b_observations o ON o.image_id = i.image_id GROUP BY 1, 2, 3")
def sparse_images_round_trip(b_images, b_observations):
    spark, path = b_images.sparkSession, new_folder(b_images.sparkSession)
    seen = b_observations.groupBy(F.col("image_id").alias("of")).agg(F.collect_list(F.struct("x", "y", "point_id")).alias("points"))
    rows = b_images.join(seen, F.col("image_id") == F.col("of"), "left").withColumns({"model_id": F.col("image_id") % 3, "q": F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0))), "t": F.array(*map(F.lit, (0.5, -1.0, 2.0))), "name": F.concat(F.lit("f"), F.col("image_id").cast("string"), F.lit(".png"))})
    none = F.array().cast("array<struct<x: double, y: double, point_id: bigint>>")
    files.write_sparse_images(rows.withColumn("points", F.coalesce("points", none)), path)
    total = F.round(F.aggregate("points", F.lit(0.0), lambda a, p: a + p["x"]), 3)
    return files.read_sparse_images(spark, f"{path}/*").select("image_id", "camera_id", "name", F.size("points").cast("long").alias("points"), total.alias("sum_x"))
