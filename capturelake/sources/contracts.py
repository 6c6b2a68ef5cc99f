"""Contract documents: producer manifests in full, camera and selection contracts, point pairs, regions and probes.

Readers give rows; what breaks a rule is a violation in a row instead of an error that stops the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import is_finite, violations
from .files import _json

PRODUCER = "schema_version string, video_id string, settings struct<keyframe_policy: string>, summary map<string, string>, run struct<id: string>, segments array<struct<id: string, start_sec: double, end_sec: double>>, frames array<struct<id: string, segment_id: string, selected: boolean, frame_index: long, timestamp_sec: double>>"
CONTRACT = "contract_sha256 string, source_video_sha256 string, frame_count int, frame_names array<string>, camera struct<model: string, width: int, height: int>"
SELECTION = "duration_sec double, config struct<max_frames: int>, frames array<struct<selected: boolean>>"
PAIRS = "scene_id string, laser_xyz array<double>, model_xyz array<double>"
ROI = "scene_id string, x_min double, y_min double, z_min double, x_max double, y_max double, z_max double"


def _no(c):
    return ~F.coalesce(c, F.lit(False))


def read_producer(spark: SparkSession, path: str) -> DataFrame:
    """One row per producer manifest, with what validate_producer looks at."""
    return _json(spark, path, PRODUCER)


def validate_producer(manifests: DataFrame) -> DataFrame:
    """(video_id, part, position, violations) of all manifests, their segments and frames that break a rule.

    Manifests: version, policy, summary, run, non-empty segments. Segments: an id of their own and a window. Frames: an id of
    their own, a declared segment, a boolean selection, an index, a finite time that rises within the segment in list order.
    """
    text = lambda c: F.coalesce(c != "", F.lit(False))
    c = F.col
    head = violations(schema_version=_no(c("schema_version") == "2.0"), segments=_no(F.size("segments") > 0), frames=c("frames").isNull(), video_id=~text(c("video_id")), keyframe_policy=_no(c("settings.keyframe_policy").isin("legacy", "coverage_v1")), summary=c("summary").isNull(), run_id=~text(c("run.id")))
    whole = manifests.select("video_id", F.lit("manifest").alias("part"), F.lit(0).alias("position"), head.alias("violations"))
    s = manifests.select("video_id", F.posexplode("segments").alias("position", "s"))
    twice = F.count("*").over(Window.partitionBy("video_id", "s.id")) > 1
    bad = violations(id=~text(c("s.id")), duplicate_id=twice, window=_no(is_finite(c("s.start_sec")) & is_finite(c("s.end_sec")) & (c("s.end_sec") >= c("s.start_sec"))))
    segments = s.select("video_id", F.lit("segment").alias("part"), "position", bad.alias("violations"))
    f = manifests.select("video_id", F.transform(F.coalesce("segments", F.array()), lambda x: x["id"]).alias("known"), F.posexplode("frames").alias("position", "f"))
    before = F.lag("f.timestamp_sec").over(Window.partitionBy("video_id", "f.segment_id").orderBy("position"))
    bad = violations(id=~text(c("f.id")), duplicate_id=F.count("*").over(Window.partitionBy("video_id", "f.id")) > 1, segment_id=_no(F.array_contains("known", c("f.segment_id"))), selected=c("f.selected").isNull(), frame_index=_no(c("f.frame_index") >= 0), timestamp_sec=_no(is_finite(c("f.timestamp_sec"))), not_increasing=F.coalesce(c("f.timestamp_sec") <= before, F.lit(False)))
    frames = f.select("video_id", F.lit("frame").alias("part"), "position", bad.alias("violations"))
    return whole.unionByName(segments).unionByName(frames).where(F.size("violations") > 0)


def read_camera_contracts(spark: SparkSession, path: str) -> DataFrame:
    """One row per ordered camera contract with its violations."""
    d = _json(spark, path, CONTRACT)
    names = F.col("frame_names")
    bad = violations(frame_names=_no(F.size(names) > 0), unsafe_name=F.coalesce(F.exists(names, lambda n: n.isNull() | (n == "") | n.rlike(r"[/\\\\]|^\\.\\.?$")), F.lit(False)), duplicate_name=F.coalesce(F.size(F.array_distinct(names)) != F.size(names), F.lit(False)), frame_count=_no(F.col("frame_count") == F.size(names)), size=_no((F.col("camera.width") > 0) & (F.col("camera.height") > 0)))
    return d.select("contract_sha256", "source_video_sha256", names.alias("camera_names"), F.size(names).alias("camera_count"), "camera.model", "camera.width", "camera.height", bad.alias("violations"))


def read_frame_selections(spark: SparkSession, path: str) -> DataFrame:
    """(max_frames, frame_count, selected_count, duration_sec, violations) of selection contracts."""
    d = _json(spark, path, SELECTION)
    bad = violations(max_frames=_no(F.col("config.max_frames") > 0), frames=_no(F.size("frames") > 0), duration_sec=_no(is_finite(F.col("duration_sec")) & (F.col("duration_sec") > 0)))
    chosen = F.size(F.filter("frames", lambda f: F.coalesce(f["selected"], F.lit(False))))
    return d.select("config.max_frames", F.size("frames").alias("frame_count"), chosen.alias("selected_count"), "duration_sec", bad.alias("violations"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Corresponding points (scene_id, sx.., tx..) of a list of records; a violation where a point isn't three finite numbers."""
    d = _json(spark, path, PAIRS)
    good = lambda c: (F.size(c) == 3) & F.forall(c, lambda x: is_finite(x))
    at = lambda c, n: [F.get(c, F.lit(i)).alias(f"{n}{a}") for i, a in enumerate("xyz")]
    return d.select("scene_id", *at("model_xyz", "s"), *at("laser_xyz", "t"), F.when(_no(good(F.col("model_xyz")) & good(F.col("laser_xyz"))), "malformed").alias("violation"))


def read_roi(spark: SparkSession, path: str) -> DataFrame:
    """Boxes of regions of interest; a violation where a bound is missing or above its partner."""
    d = _json(spark, path, ROI)
    bad = F.lit(False)
    for a in "xyz":
        bad = bad | _no(is_finite(F.col(f"{a}_min")) & is_finite(F.col(f"{a}_max")) & (F.col(f"{a}_min") <= F.col(f"{a}_max")))
    return d.withColumn("violation", F.when(bad, "box"))


def read_probes(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, payload) of probe documents, one a line, for ``normalize_probe``."""
    return spark.read.text(path).select(F.regexp_extract("_metadata.file_name", r"^([^.]*)", 1).alias("file"), F.get_json_object("value", "$.video_id").alias("video_id"), F.col("value").alias("payload"))
