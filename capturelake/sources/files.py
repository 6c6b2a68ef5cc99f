"""File sources and sinks of capture data. Schemas are explicit; many files are read side by side."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .binary_files import local_path
from .sparse_binary import read_sparse_binary_cameras, read_sparse_binary_images, read_sparse_binary_points  # noqa: F401

MOTION = "struct<inlier_ratio: double, score: double, grid_coverage: double, residual_rmse_diag_ratio: double, valid: boolean, reason: string>"
FRAME = f"struct<id: string, frame_id: string, segment_id: string, frame_index: int, timestamp_sec: double, timestamp: double, width: int, height: int, path: string, sha256: string, selected: boolean, sharpness: double, blur_score: double, overexposed_ratio: double, underexposed_ratio: double, motion_score: double, coverage_score: double, quality_score: double, duplicate_score: int, reject_reasons: array<string>, keyframe: struct<policy: string, bridge: boolean, selected_by_policy: boolean, motion: {MOTION}>>"
MANIFEST = f"video_id string, schema_version string, settings map<string, string>, segments array<struct<id: string, index: int, start_sec: double, end_sec: double, path: string, sha256: string, reason: string, width: int, height: int>>, frames array<{FRAME}>"
CONSUMER = "schema_version int, segment_id string, base string, frames array<struct<frame_id: int, path: string, width: int, height: int, sha256: string, timestamp: double, producer_frame_id: string, producer_frame_index: int, producer_run_id: string>>"
REPORT = "schema_version string, video_id string, policy string, status string, segments array<struct<segment_id: string, total_frames: int, selected_frames: int, rejected_frames: int, bridge_frames: int, component_count: int, max_selected_gap_sec: double, failed_reasons: array<string>>>"
EVENT = "schema_version string, iteration long, camera_basename string, camera_internal_name string, camera_contract_index int, exposure_count int, cumulative_unique_count int"
ATTEMPT = "status string, started_at string, finished_at string, artifacts array<struct<path: string, sha256: string>>"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    # NaN and infinities are never valid numbers in these documents.
    return spark.read.schema(schema).option("multiLine", True).option("allowNonNumericNumbers", False).option("recursiveFileLookup", True).json(path)


def read_manifests(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(frames, segments) of producer manifests, with their positions; aliases of frame fields are resolved."""
    m = _json(spark, path, MANIFEST)
    f = m.select("video_id", F.posexplode("frames").alias("position", "f"))
    g = lambda n: F.col(f"f.{n}")
    frames = f.select(
        "video_id", "position", F.coalesce(g("frame_id"), g("id")).alias("frame_id"), g("segment_id").alias("segment_id"), F.coalesce(g("frame_index"), F.col("position")).alias("frame_index"), F.coalesce(g("timestamp_sec"), g("timestamp")).alias("timestamp_sec"),
        g("path").alias("path"), g("width").alias("width"), g("height").alias("height"), g("sha256").alias("sha256"), g("selected").alias("selected"), F.coalesce(g("keyframe.bridge"), F.lit(False)).alias("bridge"), F.coalesce(g("sharpness"), g("blur_score")).alias("sharpness"),
        g("overexposed_ratio").alias("overexposed_ratio"), g("underexposed_ratio").alias("underexposed_ratio"), F.coalesce(g("motion_score"), g("keyframe.motion.score"), g("keyframe.motion.inlier_ratio")).alias("motion_score"), F.coalesce(g("coverage_score"), g("quality_score")).alias("coverage_score"), g("duplicate_score").alias("duplicate_score"), g("reject_reasons").alias("reject_reasons"),
    )
    segments = m.select("video_id", F.posexplode("segments").alias("position", "s")).select("video_id", "position", F.col("s.id").alias("segment_id"), "s.start_sec", "s.end_sec", "s.reason", "s.sha256")
    return frames, segments


def read_manifest_settings(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, name, value) of producer manifests' settings: one row a setting, values as text, objects and lists as JSON.

    A manifest without settings has no rows; a setting that is null has a row with a null value.
    """
    d = _json(spark, path, "video_id string, settings string").select("video_id", F.explode(F.from_json("settings", "map<string, string>")).alias("name", "value"))
    return d.select("video_id", "name", "value")


def read_consumer_manifests(spark: SparkSession, path: str) -> DataFrame:
    m = _json(spark, path, CONSUMER).withColumn("manifest", F.col("_metadata.file_path"))
    return m.select("manifest", "segment_id", "base", F.posexplode("frames").alias("position", "f")).select("manifest", "segment_id", "base", "position", "f.*")


def consumer_violations(frames: DataFrame) -> DataFrame:
    """Violations of each consumer frame, in the order of checks; duplicates and order included."""
    from ..functions.expressions import safe_relative_path, violations

    w = Window.partitionBy("manifest")
    ordered = w.orderBy("position")
    c = F.col
    v = violations(
        frame_id=~F.coalesce(c("frame_id") >= 0, F.lit(False)), duplicate_frame_id=F.count("*").over(Window.partitionBy("manifest", "frame_id")) > 1, not_ascending=F.coalesce(c("frame_id") <= F.lag("frame_id").over(ordered), F.lit(False)), path=~safe_relative_path(c("path")),
        duplicate_path=F.count("*").over(Window.partitionBy("manifest", "path")) > 1, size=~F.coalesce((c("width") > 0) & (c("height") > 0), F.lit(False)), sha256=~F.coalesce(c("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)),
    )
    return frames.withColumn("violations", v).where(F.size("violations") > 0)


def read_quality_reports(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, REPORT).select("video_id", "status", F.explode("segments").alias("s")).select("video_id", "status", "s.*")


def read_trajectories(spark: SparkSession, path: str) -> DataFrame:
    """(scene_id, ord, R, T) of ordered camera lists; the scene is the file's name."""
    kind = "array<struct<R: array<array<double>>, rotation: array<array<double>>, T: array<double>, position: array<double>>>"
    d = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^([^.]*)", 1).alias("scene_id"), F.from_json("value", kind).alias("c"))
    d = d.select("scene_id", F.posexplode("c").alias("ord", "c"))
    return d.select("scene_id", "ord", F.flatten(F.coalesce("c.R", "c.rotation")).alias("R"), F.coalesce("c.T", "c.position").alias("T"))


def _model_id():
    return F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.text(path).select(_model_id().alias("model_id"), F.trim("value").alias("line")).where("line <> '' AND NOT startswith(line, '#')")
    return d.withColumn("t", F.split("line", r"\s+"))


def read_sparse_cameras(spark: SparkSession, path: str) -> DataFrame:
    d = _lines(spark, path)
    n = lambda i, kind: F.get("t", F.lit(i)).try_cast(kind)
    params = F.transform(F.slice("t", 5, 100), lambda x: x.try_cast("double"))
    return d.select("model_id", n(0, "long").alias("camera_id"), F.get("t", F.lit(1)).alias("model"), n(2, "int").alias("width"), n(3, "int").alias("height"), params.alias("params"))


def read_sparse_points(spark: SparkSession, path: str) -> DataFrame:
    """Points with their track as an array of (image_id, idx); a violation where the line isn't whole."""
    d = _lines(spark, path)
    n = lambda i, kind: F.get("t", F.lit(i)).try_cast(kind)
    rest = F.transform(F.slice("t", 9, 1 << 30), lambda x: x.try_cast("long"))
    track = F.transform(F.sequence(F.lit(0), F.greatest(F.expr("size(rest) div 2") - 1, F.lit(0))), lambda i: F.struct(F.get("rest", 2 * i).alias("image_id"), F.get("rest", 2 * i + 1).alias("idx")))
    d = d.withColumn("rest", F.when(F.size("t") > 8, rest).otherwise(F.array().cast("array<long>")))
    bad = (F.size("t") < 8) | (F.size("rest") % 2 == 1) | F.exists("rest", lambda x: x.isNull())
    return d.select("model_id", n(0, "long").alias("point_id"), *[n(i + 1, "double").alias(c) for i, c in enumerate("xyz")], F.array(*[n(i, "int") for i in (4, 5, 6)]).alias("rgb"), n(7, "double").alias("error"), F.when(F.size("rest") > 1, track).otherwise(F.array().cast("array<struct<image_id: bigint, idx: bigint>>")).alias("track"), F.when(bad, "malformed").alias("violation"))


def read_sparse_images(spark: SparkSession, path: str) -> DataFrame:
    """Images of two-line records. Comments and blank lines are skipped only where a header is expected; a record without its second line is a violation.

    A file is read by lines in Spark's splits, so no file is a row. Whether a line is a header follows from the number of lines that read as one since the last
    that doesn't, as such a line either stands alone or ends a record. What precedes a split is summed up by file beforehand: one row a split goes to all
    executors, with the line that ends its last record where that is in the next split.
    """
    kind = "model_id string, image_id long, q array<double>, t array<double>, camera_id long, name string, points array<struct<x: double, y: double, point_id: long>>, violation string"
    at = ["_file", "_start"]
    m = lambda n: F.col(f"_metadata.{n}")
    lines = spark.read.option("lineSep", "\n").text(path).select(m("file_path").alias("_file"), m("file_block_start").alias("_start"), (m("file_block_length") < m("file_size")).alias("_split"), m("file_size").alias("_size"), _model_id().alias("model_id"), "value")

    def header(line: str) -> dict | None:
        p = line.split(None, 10)
        try:
            return {"image_id": int(p[0]), "q": [float(x) for x in p[1:5]], "t": [float(x) for x in p[5:8]], "camera_id": int(p[8]), "name": p[9]}
        except (ValueError, IndexError):
            return None

    def pieces(b: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        """The batch's rows by split; a split's rows come in the file's order."""
        key = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        cuts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                yield key[lo], b.slice(lo, hi - lo)

    def bytes_of(values: pa.Array) -> int:
        return (pc.sum(pc.binary_length(values)).as_py() or 0) + len(values)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each split: its first line, lines that read as headers, those since its last other line (null: none), bytes with line ends, size of the file."""

        def row(key, x):
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, *x), strict=True))], schema=schema)

        schema = pa.schema([("_file", pa.string()), ("_start", pa.int64()), ("first", pa.string()), ("full", pa.int64()), ("tail", pa.int64()), ("bytes", pa.int64()), ("size", pa.int64())])
        now, x = None, None
        for b in batches:
            for key, part in pieces(b):
                if key != now:
                    if now is not None:
                        yield row(now, x)
                    now, x = key, [part.column("value")[0].as_py(), 0, None, 0, part.column("_size")[0].as_py()]
                for line in part.column("value").to_pylist():
                    if header(line):
                        x[1], x[2] = x[1] + 1, None if x[2] is None else x[2] + 1
                    else:
                        x[2] = 0
                x[3] += bytes_of(part.column("value"))
        if now is not None:
            yield row(now, x)

    sums = lines.where("_split").select(*at, "_size", "value").mapInArrow(summed, "_file string, _start long, first string, full long, tail long, bytes long, size long")
    w = Window.partitionBy("_file").orderBy("_start")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    d = sums.withColumn("_upto", F.sum("full").over(w)).withColumn("_reset", F.col("tail") - F.col("_upto"))
    begun = F.pmod(F.coalesce(F.sum("full").over(before), F.lit(0)) + F.coalesce(F.last("_reset", True).over(before), F.lit(0)), F.lit(2)) == 1
    whole = Window.partitionBy("_file")
    # A file without a line end at its end has one byte less than its lines with theirs; a byte order mark, which the reader leaves out, counts three.
    cut = (F.sum("bytes").over(whole) - F.col("size")).isin(1, -2)
    d = d.select(*at, begun.alias("begun"), F.lead("first").over(w).alias("following"), cut.alias("cut"))
    d = d.withColumn("following", F.coalesce("following", F.when(~F.col("cut"), "")))
    rows = lines.join(F.broadcast(d), at, "left").select(*at, "_split", "_size", "begun", "following", "model_id", "value")

    class Rows:
        """Records as columns; points as flat lists with bounds."""

        def __init__(self):
            self.heads, self.bad, self.bounds, self.none, self.x, self.y, self.ids = [], [], [0], [], [], [], []

        def add(self, model: str, head: dict, seen: str | None, bad: str | None = None) -> None:
            p = (seen or "").split()
            try:
                if len(p) % 3:
                    raise ValueError
                x, y, ids = list(map(float, p[0::3])), list(map(float, p[1::3])), list(map(int, p[2::3]))
            except ValueError:
                x, y, ids, bad = [], [], [], "malformed"
            bad = bad or ("missing_points_line" if seen is None else None)
            self.x += x
            self.y += y
            self.ids += ids
            self.heads.append((model, *head.values()) if head else (model, *[None] * 5))
            self.bounds.append(len(self.ids))
            self.none.append(bad is not None)
            self.bad.append(bad)

        def batch(self) -> pa.RecordBatch:
            points = pa.StructArray.from_arrays([pa.array(self.x, pa.float64()), pa.array(self.y, pa.float64()), pa.array(self.ids, pa.int64())], ["x", "y", "point_id"])
            points = pa.ListArray.from_arrays(pa.array(self.bounds, pa.int32()), points, mask=pa.array(self.none, pa.bool_()))
            kinds = [pa.string(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int64(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*self.heads, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, points, pa.array(self.bad, pa.string())], ["model_id", "image_id", "q", "t", "camera_id", "name", "points", "violation"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, odd, head, model, last, read, size, split = None, False, None, None, None, 0, 0, False

        def ended(rows: Rows) -> None:
            """The last record of a split, if its second line isn't in it."""
            if head is not None:
                rows.add(model, head, last if split else None if read - size in (1, -2) else "")

        for b in batches:
            rows = Rows()
            for key, part in pieces(b):
                if key != now:
                    ended(rows)
                    model, split, size = (part.column(n)[0].as_py() for n in ("model_id", "_split", "_size"))
                    now, odd, head, last, read = key, part.column("begun")[0].as_py(), None, part.column("following")[0].as_py(), 0
                    if split and odd is None:
                        raise ValueError(f"{key[0]} was split in another way before")
                read += bytes_of(part.column("value"))
                for value in part.column("value").to_pylist():
                    if odd:
                        # A split's first line may end the last record of the split before, which has it too.
                        if head is not None:
                            rows.add(model, head, value)
                        odd, head = False, None
                        continue
                    head = header(value)
                    odd = head is not None
                    if not odd and (text := value.strip()) and not text.startswith("#"):
                        rows.add(model, {}, None, "malformed")
            if rows.bad:
                yield rows.batch()
        rows = Rows()
        ended(rows)
        if rows.bad:
            yield rows.batch()

    return rows.mapInArrow(pair, kind)


def read_depth(spark: SparkSession, path: str) -> DataFrame:
    """Depth maps of NPZ files (key ``depth``) and NPY files: path, sha256, height, width, depth, violation."""
    import io
    import zipfile

    kind = "path string, sha256 string, height int, width int, depth array<float>, violation string"

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, sha, data in zip(b["path"], b["sha256"], b["content"], strict=True):
                try:
                    z = np.load(io.BytesIO(data), allow_pickle=False)
                    d = z if isinstance(z, np.ndarray) else z["depth"] if "depth" in z else None
                    bad = "no_depth" if d is None else "not_2d" if d.ndim != 2 else "not_finite" if not np.isfinite(d).all() else None
                except (ValueError, OSError, EOFError, zipfile.BadZipFile):
                    d, bad = None, "unreadable"
                whole = d is not None and d.ndim == 2
                rows.append((p, sha, d.shape[0] if whole else None, d.shape[1] if whole else None, d.astype(np.float32).ravel().tolist() if whole and not bad else None, bad))
            yield pd.DataFrame(rows, columns=["path", "sha256", "height", "width", "depth", "violation"]).astype({"height": "Int32", "width": "Int32"})

    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"), "content")
    return d.mapInPandas(decode, kind)


def read_frames_pixels(spark: SparkSession, path: str, manifest: DataFrame, root: str | None = None) -> DataFrame:
    """Decoded images joined with a manifest (name, width, height); violation where sizes differ, an image is missing, or several have its name.

    With ``root`` the name is the path below that folder, else the file's own name. Then two folders may hold one name: such an image has
    no pixels and the violation ``ambiguous``, instead of a row for each.
    """
    from .materialize import relative_to

    name = relative_to(F.col("origin"), root) if root else F.regexp_replace("origin", r"^.*/", "")
    i = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path).select("image.*").withColumn("name", name)
    found = i.select("name", F.col("width").alias("w"), F.col("height").alias("h"), "nChannels", "data")
    twice = found.groupBy("name").agg(F.count("*").alias("_files")).where("_files > 1")
    d = manifest.join(twice.hint("merge"), "name", "left").join(found.join(twice.hint("merge"), "name", "left_anti").hint("merge"), "name", "left")
    bad = F.when(F.col("_files") > 1, "ambiguous").when(F.col("w").isNull(), "missing").when((F.col("w") != F.col("width")) | (F.col("h") != F.col("height")), "size")
    return d.withColumn("violation", bad).drop("_files")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_extract("_metadata.file_name", r"^([^.]*)", 1).alias("run_id"), F.col("value").alias("line"))


def read_event_jsonl(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.schema(EVENT).option("allowNonNumericNumbers", False).json(path)
    return d.withColumn("run_id", F.regexp_extract("_metadata.file_name", r"^([^.]*)", 1))


def _small_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of all files below a mounted folder, hidden ones left out, as Spark's readers do. Tasks list them: the driver sees the folder's own entries only."""
    top = [os.path.join(path, n) for n in sorted(os.listdir(path)) if n[0] not in "._"]

    def below(batches):
        for b in batches:
            for start in b.column(0).to_pylist():
                if os.path.isfile(start):
                    yield pa.RecordBatch.from_arrays([pa.array([start])], ["path"])
                for folder, inner, names in os.walk(start):
                    inner[:] = [n for n in inner if n[0] not in "._"]
                    names = [os.path.join(folder, n) for n in names if n[0] not in "._"]
                    if names:
                        yield pa.RecordBatch.from_arrays([pa.array(names)], ["path"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.createDataFrame([(p,) for p in top], "path string").repartition(parts).mapInArrow(below, "path string")


def _small_json(spark: SparkSession, path: str, schema: str, wanted: str) -> DataFrame:
    """Rows of the JSON documents whose path matches ``wanted``, with their path ``p``: what ``_json`` gives, but dealt to a fixed number of tasks.

    Spark's reader sends a file's status to the driver for each file and opens some thirty files a task, whose results the driver gets too.
    """
    try:
        folder = local_path(path)
    except ValueError:
        folder = ""
    if not os.path.isdir(folder):  # other stores and patterns
        return _json(spark, path, schema).withColumn("p", F.col("_metadata.file_path")).where(F.col("p").rlike(wanted))

    def read(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 100):
                names, bodies = b.column(0).slice(lo, 100), []
                for name in names.to_pylist():
                    with open(name, "rb") as f:
                        bodies.append(f.read().decode("utf-8-sig", "replace"))
                yield pa.RecordBatch.from_arrays([names, pa.array(bodies, pa.string())], ["p", "body"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = _small_files(spark, folder).where(F.col("path").rlike(wanted)).repartition(parts, "path").mapInArrow(read, "p string, body string").where(F.col("body").rlike(r"\S"))
    kind = spark.createDataFrame([], schema).schema.simpleString()
    found = F.coalesce(F.from_json("body", f"array<{kind}>", {"allowNonNumericNumbers": "false"}), F.array(F.lit(None).cast(kind)))
    return d.select("p", F.explode(found).alias("r")).select("p", "r.*")


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Attempts of ``<run>/stages/<stage>/attempt-NNNN/{request,result}.json``; a request without a result is an orphan."""

    def side(kind: str, *columns: str) -> DataFrame:
        name = rf"([^/]+)/stages/([^/]+)/attempt-(\d+)/{kind}\.json$"
        e = lambda g: F.regexp_extract("p", name, g)
        return _small_json(spark, path, ATTEMPT, name).select(e(1).alias("run_id"), e(2).alias("stage"), e(3).try_cast("int").alias("attempt"), *columns)

    a, b = side("request", "started_at"), side("result", "status", "finished_at", "artifacts")
    return a.join(b.hint("merge"), ["run_id", "stage", "attempt"], "full_outer").withColumn("orphan", F.col("status").isNull())


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return d.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def tree_digest(inventory: DataFrame) -> DataFrame:
    """One digest of an inventory (root, path, sha256) per root."""
    from ..operators.runs import content_fingerprint

    return content_fingerprint(inventory, ["root"], "path")


def write_once(df: DataFrame, path: str) -> None:
    """Write a table that must not exist yet."""
    df.write.mode("errorifexists").parquet(path)


def _by_model(lines: DataFrame, by: str, path: str) -> None:
    """One folder of text files for each model (model_id, value), in ranges of ``by``, so that a large model is written by many tasks."""
    lines.repartitionByRange("model_id", by).select("model_id", "value").write.partitionBy("model_id").text(path)


def write_sparse_points(points: DataFrame, path: str) -> None:
    """Text lines of points (model_id, point_id, x, y, z, rgb, error, track), one folder for each model; numbers keep all digits."""
    number = lambda c: c.cast("string")
    track = F.array_join(F.transform("track", lambda t: F.concat_ws(" ", t["image_id"].cast("string"), t["idx"].cast("string"))), " ")
    line = F.concat_ws(" ", F.col("point_id").cast("string"), *[number(F.col(c)) for c in "xyz"], F.array_join(F.transform("rgb", lambda v: v.cast("string")), " "), number(F.col("error")), track)
    _by_model(points.select("model_id", "point_id", F.trim(line).alias("value")), "point_id", path)


def write_sparse_cameras(cameras: DataFrame, path: str) -> None:
    """Text lines of cameras (model_id, camera_id, model, width, height, params), one folder for each model."""
    head = [F.col(c).cast("string") for c in ("camera_id", "model", "width", "height")]
    line = F.concat_ws(" ", *head, F.array_join(F.transform("params", lambda v: v.cast("string")), " "))
    _by_model(cameras.select("model_id", "camera_id", line.alias("value")), "camera_id", path)


def write_sparse_images(images: DataFrame, path: str) -> None:
    """Two-line records of images (model_id, image_id, q, t, camera_id, name, points), one folder for each model."""
    numbers = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), " ")
    head = F.concat_ws(" ", F.col("image_id").cast("string"), numbers("q"), numbers("t"), F.col("camera_id").cast("string"), "name")
    points = F.array_join(F.transform("points", lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"), p["point_id"].cast("string"))), " ")
    _by_model(images.select("model_id", "image_id", F.concat(head, F.lit("\n"), points).alias("value")), "image_id", path)
