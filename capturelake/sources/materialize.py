"""Sinks that prepare files for training: renamed frames and depth maps, checked by hash before any of them appears."""

from __future__ import annotations

import io
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .binary_files import local_path, staged, write_pieces


def relative_to(path, root: str):
    """A file's path below ``root``, whatever Spark puts before it."""
    root = re.escape(local_path(root).strip("/"))
    return F.regexp_replace(path, f"^[^/]*/+{root}/", "")


def prepared_name(frame_id, path):
    """frame_000012.png, with the source's ending, or .jpg where it has none."""
    ending = F.regexp_extract(path, r"[^/.](\.[^./]*)$", 1)
    return F.concat(F.lit("frame_"), F.format_string("%06d", frame_id), F.when(F.length(ending) > 1, ending).otherwise(".jpg"))


def frame_violations(frames: DataFrame, contents: DataFrame) -> DataFrame:
    """Frames (segment_id, frame_id, path, sha256) that cannot be prepared: no file, another hash, or a name that two frames share."""
    name = prepared_name(F.col("frame_id"), F.col("path"))
    found = contents.select("path", F.sha2("content", 256).alias("_sha"))
    d = frames.select("segment_id", "frame_id", "path", "sha256").withColumn("prepared_name", name)
    shared = d.groupBy("segment_id", "prepared_name").agg(F.count("*").alias("_n")).where("_n > 1")
    d = d.join(found.hint("merge"), "path", "left").join(shared.hint("merge"), ["segment_id", "prepared_name"], "left")
    what = F.when(F.col("_sha").isNull(), "missing").when(~F.coalesce(F.col("_sha") == F.col("sha256"), F.lit(False)), "sha256").when(F.col("_n") > 1, "prepared_name")
    return d.withColumn("violation", what).where("violation IS NOT NULL").select("segment_id", "frame_id", "path", "prepared_name", "violation")


def materialize_frames(frames: DataFrame, contents: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Copy the files of manifest frames (segment_id, frame_id, path, sha256) to ``<segment_id>/frame_<id>.<ending>``; returns the mapping.

    contents: (path, content), as Spark's binary reader gives them, with paths like those of the frames. Bytes are read once, by the tasks that
    write them, and must have the declared hash; a missing file, another hash or two frames of one name fail the job, and then no file
    appears (``frame_violations`` lists them all). mapping: the frames with ``source_path`` and ``prepared_name``.
    """
    mapping = frames.withColumnRenamed("path", "source_path").withColumn("prepared_name", prepared_name(F.col("frame_id"), F.col("source_path")))
    d = mapping.join(contents.select(F.col("path").alias("source_path"), "content").hint("merge"), "source_path", "left")
    file = F.concat_ws("/", F.col("segment_id").cast("string"), "prepared_name")
    # A frame without a declared hash cannot be checked: it is no frame of a valid manifest.
    write_pieces(d.select(file.alias("file"), F.lit(0).alias("offset"), F.col("content").alias("data"), F.coalesce("sha256", F.lit("")).alias("sha256")), path, overwrite)
    return mapping


def depth_violations(depths: DataFrame, manifest: DataFrame, mapping: DataFrame) -> DataFrame:
    """(rgb_path, violation) of all that keeps depth maps from being written.

    depths: rows of ``read_depth`` with paths like ``depth_path``; manifest: rgb_path, depth_path, sha256; mapping: source_path, prepared_name.
    """
    stem = F.regexp_replace("prepared_name", r"\.[^./]*$", "")
    m = manifest.select("rgb_path", "depth_path", F.col("sha256").alias("declared"))
    p = mapping.select(F.col("source_path").alias("rgb_path"), stem.alias("stem"))
    side = lambda d, what: d.select("rgb_path", F.lit(what).alias("violation"))
    twice = lambda d, c: d.groupBy(c).agg(F.count("*").alias("n"), F.min("rgb_path").alias("rgb_path")).where("n > 1").select("rgb_path")
    out = side(p.join(m.hint("merge"), "rgb_path", "left_anti"), "missing").unionByName(side(m.join(p.hint("merge"), "rgb_path", "left_anti"), "unused"))
    out = out.unionByName(side(p.groupBy("rgb_path").agg(F.count("*").alias("n")).where("n > 1"), "duplicate_source")).unionByName(side(twice(p, "stem"), "duplicate_output")).unionByName(side(m.groupBy("rgb_path").agg(F.count("*").alias("n")).where("n > 1"), "duplicate_entry"))
    found = depths.select(F.col("path").alias("depth_path"), "sha256", "violation", F.lit(True).alias("there"))
    files = m.join(found.hint("merge"), "depth_path", "left")
    what = F.when(F.col("there").isNull(), "no_file").when(~F.coalesce(F.col("sha256") == F.col("declared"), F.lit(False)), "sha256").otherwise(F.col("violation"))
    return out.unionByName(files.select("rgb_path", what.alias("violation")).where("violation IS NOT NULL"))


def materialize_depth(depths: DataFrame, manifest: DataFrame, mapping: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Write ``<stem>_depth.npy`` for each prepared frame; returns rgb_path, prepared_name, source_path, source_sha256, output_name, output_sha256, height, width, dtype.

    Arguments as for ``depth_violations``; any violation is an error before a file is written. Maps are single-precision arrays.
    They are read and decoded once, for the check and for what is written.
    """
    depths = staged(depths, "depth-maps-read")
    bad = depth_violations(depths, manifest, mapping)
    faults = bad.groupBy("violation").count().collect()  # one row for each kind
    if faults:
        raise ValueError("depth maps cannot be written: " + ", ".join(f"{r['violation']} {r['count']}" for r in sorted(faults)))

    def save(batches):
        for b in batches:
            data = []
            for flat, height, width in zip(b.column("depth"), b.column("height").to_pylist(), b.column("width").to_pylist(), strict=True):
                out = io.BytesIO()
                np.save(out, flat.values.to_numpy(zero_copy_only=False).astype("<f4").reshape(height, width), allow_pickle=False)
                data.append(out.getvalue())
            keep = ["rgb_path", "prepared_name", "source_path", "source_sha256", "height", "width"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(data, pa.binary())], [*keep, "data"])

    d = mapping.select(F.col("source_path").alias("rgb_path"), "prepared_name").join(manifest.select("rgb_path", "depth_path").hint("merge"), "rgb_path")
    d = d.join(depths.select(F.col("path").alias("depth_path"), F.col("sha256").alias("source_sha256"), "height", "width", "depth").hint("merge"), "depth_path").withColumnRenamed("depth_path", "source_path")
    d = d.mapInArrow(save, "rgb_path string, prepared_name string, source_path string, source_sha256 string, height int, width int, data binary")
    d = d.withColumns({"output_name": F.concat(F.regexp_replace("prepared_name", r"\.[^./]*$", ""), F.lit("_depth.npy")), "output_sha256": F.sha2("data", 256), "dtype": F.lit("float32")})
    d = staged(d, "depth-files")
    write_pieces(d.select(F.col("output_name").alias("file"), F.lit(0).alias("offset"), "data", F.col("output_sha256").alias("sha256")), path, overwrite)
    return d.drop("data")
