"""A data source for splat vertices in binary little-endian PLY files: ``spark.read.format("gaussians").load(path)``.

The header gives the vertex count and the properties; partitions are ranges of vertices, so a large file is
read by many tasks. Register with ``spark.dataSource.register(GaussianSource)``. Paths are opened by the tasks, so they
must be on storage that all executors mount; elsewhere use ``read_gaussians``, which has Spark read the bytes.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import NumericType, StructType

from .binary_files import ordered, placed, staged, write_pieces

#: Vertices of a partition.
RANGE = 500_000


def parse_header(head: bytes) -> tuple[int, list[str], int]:
    """(vertex count, property names, header length); only float properties of one vertex element are taken."""
    end = head.index(b"end_header\n") + len(b"end_header\n")
    lines = head[:end].decode("ascii").splitlines()
    if lines[0] != "ply" or "format binary_little_endian 1.0" not in lines:
        raise ValueError("not a binary little-endian PLY file")
    count, names, inside = 0, [], False
    for line in lines:
        t = line.split()
        if t[:1] == ["element"]:
            inside = t[1] == "vertex"
            count = int(t[2]) if inside else count
        elif t[:1] == ["property"] and inside:
            if t[1] not in ("float", "float32"):
                raise ValueError(f"property {t[-1]} isn't float")
            names.append(t[2])
    return count, names, end


class _Range(InputPartition):
    def __init__(self, path: str, scene: str, names: list[str], offset: int, first: int, count: int):
        self.path, self.scene, self.names, self.offset, self.first, self.count = path, scene, names, offset, first, count


class GaussianReader(DataSourceReader):
    def __init__(self, schema: StructType, paths: list[str]):
        self.names, self.paths = schema.fieldNames(), paths

    def partitions(self) -> list[_Range]:
        out = []
        for p in self.paths:
            with open(p, "rb") as f:
                count, names, start = parse_header(f.read(1 << 16))
            scene = os.path.splitext(os.path.basename(p))[0]
            out += [_Range(p, scene, names, start + 4 * len(names) * a, a, min(RANGE, count - a)) for a in range(0, count, RANGE)]
        return out

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        data = np.fromfile(part.path, np.dtype([(n, "<f4") for n in part.names]), part.count, offset=part.offset)
        columns = {"scene_id": pa.array([part.scene] * len(data)), "vertex_id": pa.array(np.arange(part.first, part.first + len(data)))}
        columns |= {n: pa.array(np.ascontiguousarray(data[n])) if n in part.names else pa.nulls(len(data), pa.float32()) for n in self.names if n not in columns}
        yield pa.RecordBatch.from_arrays([columns[n] for n in self.names], self.names)


class GaussianSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gaussians"

    def _paths(self) -> list[str]:
        p = self.options["path"].removeprefix("file:")
        return sorted(glob.glob(os.path.join(p, "*.ply"))) if os.path.isdir(p) else sorted(glob.glob(p))

    def schema(self) -> str:
        with open(self._paths()[0], "rb") as f:
            _, names, _ = parse_header(f.read(1 << 16))
        return "scene_id string, vertex_id long, " + ", ".join(f"{n} float" for n in names)

    def reader(self, schema: StructType) -> GaussianReader:
        return GaussianReader(schema, self._paths())


def read_gaussians(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The same rows through Spark's binary reader, from any store; a file is read by one task."""
    kind = "scene_id string, vertex_id long, " + ", ".join(f"{n} float" for n in names)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for scene, data in zip(b["scene_id"], b["content"], strict=True):
                count, found, start = parse_header(data)
                v = np.frombuffer(data, np.dtype([(n, "<f4") for n in found]), count, start)
                yield pd.DataFrame({"scene_id": scene, "vertex_id": np.arange(count)} | {n: v[n] if n in found else np.full(count, np.nan, np.float32) for n in names})

    d = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+)\.ply$", 1).alias("scene_id"), "content")
    return d.mapInPandas(decode, kind)


#: Vertices of a piece that a task writes at once.
CHUNK = 65_536


def header(names: list[str], count: int) -> bytes:
    """The first bytes of a binary little-endian file of ``count`` vertices with float properties."""
    lines = ["ply", "format binary_little_endian 1.0", f"element vertex {count}", *[f"property float {n}" for n in names], "end_header", ""]
    return "\n".join(lines).encode("ascii")


def write_gaussians(points: DataFrame, path: str, names: list[str] | None = None, overwrite: bool = False) -> None:
    """One binary file ``<scene_id>.ply`` for each scene, its vertices in order of ``vertex_id``; a scene's file is written by many tasks.

    ``names`` are the properties, by default all numeric columns but the two keys, in their order; they are stored as floats, a null as NaN.
    ``vertex_id`` itself is not stored: a reader numbers vertices by their place. Vertices of equal id keep no order of their own. A null scene
    or one that is no file name fails the job, and then no file appears; so does a file that is there already, unless ``overwrite``. A scene
    without vertices has no file. An empty table writes nothing.
    """
    numeric = {f.name for f in points.schema if isinstance(f.dataType, NumericType)}
    names = names or [c for c in points.columns if c in numeric and c not in ("scene_id", "vertex_id")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
        for b in batches:
            scenes = b.column(0).dictionary_encode()
            number = scenes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            vertices = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]]).astype("<f4")
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                for at in range(lo, hi, CHUNK):
                    scene = scenes.dictionary[int(number[lo])].as_py() if number[lo] >= 0 else None
                    if not scene or "/" in scene:
                        raise ValueError(f"scene {scene!r} is no file name")
                    piece = vertices[at : min(hi, at + CHUNK)]
                    yield f"{scene}.ply", len(piece), piece.tobytes()

    d = points.select(F.col("scene_id").cast("string").alias("scene_id"), "vertex_id", *[F.col(f"`{n}`").cast("float").alias(f"p{i}") for i, n in enumerate(names)])
    d = ordered(d, ["scene_id", "vertex_id"]).drop("vertex_id")
    write_pieces(placed(d, pack, lambda n, size: header(names, n)), path, overwrite)


def clean_gaussians(points: DataFrame, fields: list[str], most_removed: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(vertices whose ``fields`` are all finite, report); scenes that would lose more than ``most_removed`` are not cleaned and have a violation.

    report: scene_id, original, removed, final, removal_ratio, violation. A null field counts as not finite.
    """
    finite = F.lit(True)
    for f in fields:
        finite = finite & F.coalesce(F.abs(F.col(f)) < float("inf"), F.lit(False)) & ~F.coalesce(F.isnan(f), F.lit(False))
    d = points.withColumn("_finite", finite)
    report = d.groupBy("scene_id").agg(F.count("*").alias("original"), F.count_if(~F.col("_finite")).alias("removed"))
    report = report.withColumns({"final": F.col("original") - F.col("removed"), "removal_ratio": F.col("removed") / F.col("original").cast("double")})
    report = staged(report.withColumn("violation", F.when(F.col("removal_ratio") > most_removed, "removal_ratio")), "clean-report")
    bad = report.where("violation IS NOT NULL").select(F.col("scene_id").alias("_bad"))
    # Scenes with a violation may be many; those without a bad vertex are never looked up twice.
    kept = d.where("_finite").join(bad.hint("merge"), F.col("scene_id").eqNullSafe(F.col("_bad")), "left_anti")
    return kept.select(*points.columns), report
