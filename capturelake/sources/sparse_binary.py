"""Binary sparse models (cameras.bin, images.bin, points3D.bin), little-endian, read by ranges of records and written by pieces.

Records are of different lengths, so a file is walked once: only lengths are read from a memory map, and every ``RANGE_BYTES`` or
``RANGE_RECORDS`` a range of whole records begins. Ranges are then dealt to all tasks, each of which maps its range and takes all
fields of all records out with a few array operations. So a large file is read by many tasks, and no file is a row of Spark's. Files that
tasks cannot open (other stores than mounted folders) come through Spark's binary reader, whole.

Faults are rows, not errors: a record has a ``violation``, and a file that is cut off, goes on after its last record or has a camera model
without a number here has a row of its own with null ids. A file of no bytes at all has no rows, as Spark passes over it. ``model_violations`` adds what takes several records to see.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .binary_files import local_path, ordered, placed, write_pieces

RANGE_RECORDS, RANGE_BYTES = 100_000, 16 << 20
#: Fixed values of the format: names and numbers of parameters of the camera models, by their number.
MODELS = [("SIMPLE_PINHOLE", 3), ("PINHOLE", 4), ("SIMPLE_RADIAL", 4), ("RADIAL", 5), ("OPENCV", 8), ("OPENCV_FISHEYE", 8), ("FULL_OPENCV", 12), ("FOV", 5), ("SIMPLE_RADIAL_FISHEYE", 4), ("RADIAL_FISHEYE", 5), ("THIN_PRISM_FISHEYE", 12)]
#: Endings of image names.
IMAGE_NAME = r"(?i)^[^/\\\x00]+\.(bmp|jpeg|jpg|png|tif|tiff|webp)$"

_CAMERA = np.dtype([("camera_id", "<i4"), ("model", "<i4"), ("width", "<u8"), ("height", "<u8")])
_IMAGE = np.dtype([("image_id", "<i4"), ("q", "<f8", 4), ("t", "<f8", 3), ("camera_id", "<i4")])
_POINT = np.dtype([("point_id", "<u8"), ("xyz", "<f8", 3), ("rgb", "u1", 3), ("error", "<f8"), ("size", "<u8")])
_SEEN = np.dtype([("x", "<f8"), ("y", "<f8"), ("point_id", "<i8")])
_PAIR = np.dtype([("image_id", "<i4"), ("idx", "<i4")])

CAMERA_ROWS = "model_id string, camera_id long, model string, width long, height long, params array<double>, violation string"
IMAGE_ROWS = "model_id string, image_id long, q array<double>, t array<double>, camera_id long, name string, points array<struct<x: double, y: double, point_id: long>>, violation string"
POINT_ROWS = "model_id string, point_id long, x double, y double, z double, rgb array<int>, error double, track array<struct<image_id: long, idx: long>>, violation string"


class _Fault(Exception):
    pass


def _camera_end(data, at: int) -> int:
    model = struct.unpack_from("<i", data, at + 4)[0]
    if not 0 <= model < len(MODELS):
        raise _Fault("unknown_model")
    return at + _CAMERA.itemsize + 8 * MODELS[model][1]


def _image_end(data, at: int) -> int:
    end = data.find(b"\0", at + _IMAGE.itemsize)
    if end < 0:
        raise _Fault("truncated")
    return end + 9 + _SEEN.itemsize * struct.unpack_from("<Q", data, end + 1)[0]


def _point_end(data, at: int) -> int:
    return at + _POINT.itemsize + _PAIR.itemsize * struct.unpack_from("<Q", data, at + _POINT.itemsize - 8)[0]


def _walk(data, end_of, most: tuple[int, int]) -> Iterator[tuple[int, int, str | None]]:
    """Ranges (start, stop, None) of whole records, and (at, at, fault) where the file isn't whole."""
    size = len(data)
    if size < 8:
        yield 0, 0, "truncated"
        return
    left, at = struct.unpack_from("<Q", data, 0)[0], 8
    start, records, fault = at, 0, None
    while left and not fault:
        try:
            end = end_of(data, at)
            fault = "truncated" if end > size else None
        except struct.error:
            fault = "truncated"
        except _Fault as e:
            fault = str(e)
        if fault:
            break
        at, left, records = end, left - 1, records + 1
        if records >= most[0] or at - start >= most[1]:
            yield start, at, None
            start, records = at, 0
    if at > start:
        yield start, at, None
    if fault or at < size:
        yield at, at, fault or "trailing_bytes"


def _offsets(data, end_of) -> np.ndarray:
    """Where the records of a range begin, and its end."""
    out, at = [0], 0
    while at < len(data):
        at = end_of(data, at)
        out.append(at)
    return np.array(out, np.int64)


def _taken(raw: np.ndarray, at: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Records of a fixed layout at any byte places."""
    return np.ascontiguousarray(raw[at[:, None] + np.arange(kind.itemsize)]).view(kind)[:, 0]


def _lists(raw: np.ndarray, at: np.ndarray, n: np.ndarray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of lists, all elements) of lists of ``n`` elements that begin at ``at``."""
    bounds = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=bounds[1:])
    inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1], n)
    return bounds, _taken(raw, np.repeat(at, n) + inside * kind.itemsize, kind)


def _array(bounds: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)


def _fixed(x: np.ndarray, kind=None) -> pa.Array:
    return _array(np.arange(0, x.size + 1, x.shape[1]), pa.array(np.ascontiguousarray(x).ravel(), kind))


def _first(conditions: list[tuple[str, np.ndarray]], n: int) -> pa.Array:
    """The first violation that holds for each record."""
    out = np.full(n, None, object)
    for name, bad in reversed(conditions):
        out[bad] = name
    return pa.array(out.tolist(), pa.string())


def _any(bad: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a list has a bad element."""
    upto = np.concatenate([[0], np.cumsum(bad)])
    return upto[bounds[1:]] > upto[bounds[:-1]]


def _cameras(data: bytes) -> list[pa.Array]:
    raw, o = np.frombuffer(data, np.uint8), _offsets(data, _camera_end)[:-1]
    c = _taken(raw, o, _CAMERA)
    n = np.array([k for _, k in MODELS])[c["model"]]
    bounds, params = _lists(raw, o + _CAMERA.itemsize, n, np.dtype("<f8"))
    width, height = c["width"].astype(np.int64), c["height"].astype(np.int64)
    bad = _first([("identity", (c["camera_id"] <= 0) | (width <= 0) | (height <= 0)), ("not_finite", _any(~np.isfinite(params), bounds))], len(o))
    return [pa.array(c["camera_id"].astype(np.int64)), pa.array([MODELS[m][0] for m in c["model"].tolist()], pa.string()), pa.array(width), pa.array(height), _array(bounds, pa.array(params)), bad]


def _images(data: bytes) -> list[pa.Array]:
    raw, o = np.frombuffer(data, np.uint8), _offsets(data, _image_end)[:-1]
    head = _taken(raw, o, _IMAGE)
    names, ends = [], []
    for at in (o + _IMAGE.itemsize).tolist():
        end = data.index(b"\0", at)
        try:
            names.append(data[at:end].decode("utf-8"))
        except UnicodeDecodeError:
            names.append(None)
        ends.append(end + 1)
    ends = np.array(ends, np.int64)
    n = _taken(raw, ends, np.dtype("<u8")).astype(np.int64)
    bounds, seen = _lists(raw, ends + 8, n, _SEEN)
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(seen[f])) for f in _SEEN.names], list(_SEEN.names))
    finite = np.isfinite(head["q"]).all(1) & np.isfinite(head["t"]).all(1)
    odd = ~np.isfinite(seen["x"]) | ~np.isfinite(seen["y"]) | (seen["point_id"] < -1)
    bad = _first([("identity", (head["image_id"] <= 0) | (head["camera_id"] <= 0)), ("not_finite", ~finite), ("observation", _any(odd, bounds))], len(o))
    return [pa.array(head["image_id"].astype(np.int64)), _fixed(head["q"]), _fixed(head["t"]), pa.array(head["camera_id"].astype(np.int64)), pa.array(names, pa.string()), _array(bounds, points), bad]


def _points(data: bytes) -> list[pa.Array]:
    raw, o = np.frombuffer(data, np.uint8), _offsets(data, _point_end)[:-1]
    p = _taken(raw, o, _POINT)
    bounds, pairs = _lists(raw, o + _POINT.itemsize, p["size"].astype(np.int64), _PAIR)
    track = pa.StructArray.from_arrays([pa.array(pairs[f].astype(np.int64)) for f in _PAIR.names], list(_PAIR.names))
    ids = p["point_id"].astype(np.int64)
    finite = np.isfinite(p["xyz"]).all(1) & np.isfinite(p["error"])
    bad = _first([("identity", ids <= 0), ("not_finite", ~finite), ("track", _any((pairs["image_id"] <= 0) | (pairs["idx"] < 0), bounds))], len(o))
    return [pa.array(ids), *(pa.array(np.ascontiguousarray(p["xyz"][:, k])) for k in range(3)), _fixed(p["rgb"].astype(np.int32)), pa.array(np.ascontiguousarray(p["error"])), _array(bounds, track), bad]


def _names(kind: str) -> list[str]:
    return [c.split(" ", 1)[0] for c in kind.replace("struct<x: double, y: double, point_id: long>", "s").replace("struct<image_id: long, idx: long>", "s").split(", ")]


def _read(spark: SparkSession, path: str, end_of, decode, kind: str) -> DataFrame:
    found = spark.read.format("binaryFile").load(path)
    model = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("model_id")
    names, most = _names(kind), (RANGE_RECORDS, RANGE_BYTES)

    def rows(model_id: str, data: bytes) -> pa.RecordBatch:
        columns = decode(data)
        return pa.RecordBatch.from_arrays([pa.array([model_id] * len(columns[0]), pa.string()), *columns], names)

    def fault(model_id: str, what: str) -> pa.RecordBatch:
        empty = rows(model_id, b"").schema
        return pa.RecordBatch.from_arrays([pa.array([model_id]), *(pa.nulls(1, f.type) for f in list(empty)[1:-1]), pa.array([what])], names)

    try:
        local_path(path)
    except ValueError:

        def whole(batches):
            for b in batches:
                for model_id, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    for start, stop, what in _walk(data, end_of, most):
                        yield fault(model_id, what) if what else rows(model_id, data[start:stop])

        return found.select(model, "content").mapInArrow(whole, kind)

    def index(batches):
        for b in batches:
            for model_id, file in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with open(local_path(file), "rb") as f:
                    data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) if f.seek(0, 2) else b""
                for r in _walk(data, end_of, most):
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (model_id, file)] + [pa.array([x], pa.int64()) for x in r[:2]] + [pa.array([r[2]], pa.string())], ["model_id", "path", "start", "stop", "fault"])

    def ranges(batches):
        for b in batches:
            for model_id, file, start, stop, what in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if what:
                    yield fault(model_id, what)
                else:
                    with open(local_path(file), "rb") as f:
                        f.seek(start)
                        yield rows(model_id, f.read(stop - start))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = found.select(model, "path").mapInArrow(index, "model_id string, path string, start long, stop long, fault string")
    return found.repartition(parts, "path", "start").mapInArrow(ranges, kind)


def read_sparse_binary_cameras(spark: SparkSession, path: str) -> DataFrame:
    """Cameras of all models; the model is the file's folder."""
    return _read(spark, path, _camera_end, _cameras, CAMERA_ROWS)


def read_sparse_binary_images(spark: SparkSession, path: str) -> DataFrame:
    """Images with poses and observations; a name that is no staged image's is a violation where nothing else is."""
    d = _read(spark, path, _image_end, _images, IMAGE_ROWS)
    named = F.coalesce(F.col("name").rlike(IMAGE_NAME), F.lit(False))
    return d.withColumn("violation", F.when(F.col("violation").isNull() & ~named, "name").otherwise(F.col("violation")))


def read_sparse_binary_points(spark: SparkSession, path: str) -> DataFrame:
    """Points with their tracks."""
    return _read(spark, path, _point_end, _points, POINT_ROWS)


def model_violations(cameras: DataFrame, images: DataFrame, points: DataFrame) -> DataFrame:
    """(model_id, part, id, violation) of what takes several records to see: repeated ids and names, repeated pairs of tracks, models without cameras.

    Each fault is a row; a repeated id or name is one row, whatever its number. Cross references of observations, tracks and cameras are
    those of ``operators.sparse``.
    """

    def repeated(d, part, of, id_column, name):
        d = d.where(F.col(of[0]).isNotNull()).groupBy("model_id", *of).agg(F.count("*").alias("n"), F.min(id_column).alias("id")).where("n > 1")
        return d.select("model_id", F.lit(part).alias("part"), F.col("id").cast("long").alias("id"), F.lit(name).alias("violation"))

    pairs = points.select("model_id", "point_id", F.explode("track").alias("p")).select("model_id", "point_id", "p.image_id", "p.idx")
    out = repeated(cameras, "camera", ["camera_id"], "camera_id", "duplicate_id")
    for d, part, of, key, name in ((images, "image", ["image_id"], "image_id", "duplicate_id"), (images, "image", ["name"], "image_id", "duplicate_name"), (points, "point", ["point_id"], "point_id", "duplicate_id"), (pairs, "point", ["image_id", "idx"], "point_id", "duplicate_track")):
        out = out.unionByName(repeated(d, part, of, key, name))
    bare = images.select("model_id").distinct().join(cameras.where("camera_id IS NOT NULL").select("model_id").distinct().hint("merge"), "model_id", "left_anti")
    return out.unionByName(bare.select("model_id", F.lit("camera").alias("part"), F.lit(None).cast("long").alias("id"), F.lit("no_records").alias("violation")))


def _plain(column: pa.Array, kind: pa.DataType) -> np.ndarray:
    """A field's values in the type of the format; a null or a whole number that it cannot hold fails the job."""
    if column.null_count:
        raise ValueError("a null is no field of a record")
    return column.cast(kind, safe=not pa.types.is_floating(kind)).to_numpy(zero_copy_only=False)


def _listed(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(lengths, all elements) of lists; a null list is empty."""
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64), column.flatten()


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    n, values = _listed(column)
    if (n != size).any():
        raise ValueError(f"a vector of {size} numbers has another length")
    return _plain(values, pa.float64()).reshape(-1, size)


def _elements(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, all elements) of lists of structs; numbers with a fraction may be null, which is written as NaN."""
    n, values = _listed(column)
    if values.null_count:
        raise ValueError("a null is no element of a record")
    out = np.empty(len(values), kind)
    for f in kind.names:
        one = values.field(f)
        out[f] = _plain(pc.fill_null(one.cast(pa.float64(), safe=False), np.nan), pa.float64()) if kind[f].kind == "f" else _plain(one, pa.from_numpy_dtype(kind[f]))
    return n, out


def _laid_out(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds of records) of records that have a run of each part's bytes, in this order; a part is all its bytes and each record's number of them."""
    sizes = np.stack([n for _, n in parts], 1)
    bounds = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes.sum(1), out=bounds[1:])
    of = np.repeat(np.tile(np.arange(len(parts), dtype=np.uint8), len(sizes)), sizes.ravel())
    out = np.empty(bounds[-1], np.uint8)
    for k, (data, _) in enumerate(parts):
        out[of == k] = data.view(np.uint8)
    return out, bounds


def _each(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, np.full(len(data), data.dtype.itemsize, np.int64)


def _write(rows: DataFrame, by: str, file: str, columns: list, records, path: str, overwrite: bool) -> None:
    """Pieces of about ``RANGE_BYTES`` / 4 of the bytes that ``records`` makes of whole batches, in order of ``by`` within each model."""

    def pack(batches):
        name, parts, n, size = None, [], 0, 0
        for b in batches:
            data, bounds = records(*b.columns[1:])
            models, start = pc.run_end_encode(b.column(0)), 0
            for model, stop in zip(models.values.to_pylist(), models.run_ends.to_pylist(), strict=True):
                if not model or "/" in model:
                    raise ValueError(f"model {model!r} is no folder name")
                if model != name and parts:
                    yield f"{name}/{file}", n, b"".join(parts)
                    parts, n, size = [], 0, 0
                name = model
                while start < stop:
                    # As many records as reach the piece's size, the last one whole.
                    end = min(stop, int(np.searchsorted(bounds, bounds[start] + RANGE_BYTES // 4 - size)))
                    parts.append(data[bounds[start] : bounds[end]])
                    n, size, start = n + end - start, size + len(parts[-1]), end
                    if size >= RANGE_BYTES // 4:
                        yield f"{name}/{file}", n, b"".join(parts)
                        parts, n, size = [], 0, 0
        if parts:
            yield f"{name}/{file}", n, b"".join(parts)

    d = rows.select(F.col("model_id").cast("string").alias("model_id"), F.col(by).alias("_by"), *columns)
    d = ordered(d, ["model_id", "_by"]).drop("_by")
    write_pieces(placed(d, pack, lambda n, size: struct.pack("<Q", n)), path, overwrite)


def write_sparse_binary_cameras(cameras: DataFrame, path: str, overwrite: bool = False) -> None:
    """``<model_id>/cameras.bin`` of rows (model_id, camera_id, model, width, height, params), by id; a wrong number of parameters fails the job."""
    numbers = {name: number for number, (name, _) in enumerate(MODELS)}

    def records(camera_id, model, width, height, params):
        head = np.empty(len(camera_id), _CAMERA)
        head["camera_id"], head["width"], head["height"] = _plain(camera_id, pa.int32()), _plain(width, pa.uint64()), _plain(height, pa.uint64())
        head["model"] = [numbers[m] for m in model.to_pylist()]
        n, values = _listed(params)
        if (n != np.array([k for _, k in MODELS])[head["model"]]).any():
            raise ValueError("a camera has a wrong number of parameters")
        return _laid_out([_each(head), (_plain(values, pa.float64()), 8 * n)])

    _write(cameras, "camera_id", "cameras.bin", ["camera_id", "model", "width", "height", "params"], records, path, overwrite)


def write_sparse_binary_images(images: DataFrame, path: str, overwrite: bool = False) -> None:
    """``<model_id>/images.bin`` of rows (model_id, image_id, q, t, camera_id, name, points), by id; null points are none."""

    def records(image_id, q, t, camera_id, name, points):
        head = np.empty(len(image_id), _IMAGE)
        head["image_id"], head["camera_id"] = _plain(image_id, pa.int32()), _plain(camera_id, pa.int32())
        head["q"], head["t"] = _vectors(q, 4), _vectors(t, 3)
        names = [x.encode() + b"\0" for x in name.to_pylist()]
        n, seen = _elements(points, _SEEN)
        return _laid_out([_each(head), (np.frombuffer(b"".join(names), np.uint8), np.fromiter(map(len, names), np.int64, len(names))), _each(n.astype("<u8")), (seen, _SEEN.itemsize * n)])

    _write(images, "image_id", "images.bin", ["image_id", "q", "t", "camera_id", "name", "points"], records, path, overwrite)


def write_sparse_binary_points(points: DataFrame, path: str, overwrite: bool = False) -> None:
    """``<model_id>/points3D.bin`` of rows (model_id, point_id, x, y, z, rgb, error, track), by id; a null track is empty."""

    def records(point_id, x, y, z, rgb, error, track):
        n, pairs = _elements(track, _PAIR)
        head = np.empty(len(point_id), _POINT)
        head["point_id"], head["error"], head["size"] = _plain(point_id, pa.uint64()), _plain(error, pa.float64()), n
        head["xyz"] = np.stack([_plain(c, pa.float64()) for c in (x, y, z)], 1)
        k, colours = _listed(rgb)
        if (k != 3).any():
            raise ValueError("a colour has other than 3 numbers")
        head["rgb"] = _plain(colours, pa.uint8()).reshape(-1, 3)
        return _laid_out([_each(head), (pairs, _PAIR.itemsize * n)])

    _write(points, "point_id", "points3D.bin", ["point_id", "x", "y", "z", "rgb", "error", "track"], records, path, overwrite)
