"""A sink for binary files of any format: rows of bytes become named files, written side by side by many tasks.

A row is a piece of a file. ``ordered`` sorts rows by (file, order) in ranges, ``placed`` packs them into pieces, gives each its byte
offset from sums of lengths by range and puts a head in front; the data source ``binary_pieces`` then writes every piece at its offset in a file below ``_temporary``. Pieces do not
overlap, so a task that runs again, or twice at once, writes the same bytes to the same place. The commit at the driver
compares the bytes that tasks report with the files' ends and sizes and renames; a failed task or check leaves nothing behind.

Files are opened by the tasks, so the folder must be on storage that driver and executors mount.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.staging import new_folder, staged  # noqa: F401

#: Up to so many (range, file) pairs their offsets are sent to all executors; beyond it they are joined by a shuffle.
BROADCAST_RANGES = 200_000
PIECES = "file string, offset long, data binary, sha256 string"


def local_path(path: str) -> str:
    """The path as the tasks open it; other stores than mounted folders are refused."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path.split("?")[0]:
        raise ValueError(f"{path}: binary files are written to mounted folders only")
    return path


@dataclass
class Written(WriterCommitMessage):
    """By file: bytes written by a task and the greatest end of its pieces."""

    files: dict[str, tuple[int, int]]


class PieceWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.temporary = os.path.join(path, "_temporary", uuid.uuid4().hex)
        os.makedirs(self.temporary)

    def _target(self, file: str) -> str:
        """Where a task writes ``file``. Only the driver makes the job's folder: a task that outlives the job cannot bring it back."""
        target = self.temporary
        for part in file.split("/")[:-1]:
            target = os.path.join(target, part)
            try:
                os.mkdir(target)
            except FileExistsError:
                pass
        return os.path.join(self.temporary, file)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done: dict[str, tuple[int, int]] = {}
        name, out = None, -1
        try:
            for b in iterator:
                for file, offset, data, sha in zip(*(b.column(k) for k in range(4)), strict=True):
                    file, offset, data, sha = file.as_py(), offset.as_py(), data.as_buffer() if data.is_valid else None, sha.as_py()
                    if file is None or file.startswith("/") or not all(p not in ("", ".", "..") for p in file.split("/")):
                        raise ValueError(f"{file!r} isn't a relative file name")
                    if data is None:
                        raise ValueError(f"{file}: there are no bytes")
                    if sha is not None and hashlib.sha256(data).hexdigest() != sha:
                        raise ValueError(f"{file}: its bytes have another SHA-256 than {sha}")
                    if file != name:
                        if out >= 0:
                            os.close(out)
                            out = -1
                        name, out = file, os.open(self._target(file), os.O_RDWR | os.O_CREAT, 0o644)
                    at, view = offset, memoryview(data)
                    while len(view):
                        n = os.pwrite(out, view, at)
                        at, view = at + n, view[n:]
                    n, end = done.get(file, (0, 0))
                    done[file] = (n + len(memoryview(data)), max(end, at))
        finally:
            if out >= 0:
                os.close(out)
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        total: dict[str, tuple[int, int]] = {}
        for m in messages:
            for file, (n, end) in m.files.items() if m else ():
                a, b = total.get(file, (0, 0))
                total[file] = (a + n, max(b, end))
        try:
            for file, (n, end) in total.items():
                size = os.path.getsize(os.path.join(self.temporary, file))
                if not n == end == size:
                    raise ValueError(f"{file}: {n} bytes were written, its pieces end at {end} and the file at {size}")
                if not self.overwrite and os.path.lexists(os.path.join(self.path, file)):
                    raise FileExistsError(f"{file} is there already")
            for file in sorted(total):
                os.makedirs(os.path.dirname(os.path.join(self.path, file)), exist_ok=True)
                os.replace(os.path.join(self.temporary, file), os.path.join(self.path, file))
        finally:
            self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        gone = f"{self.temporary}-gone"
        try:
            os.rename(self.temporary, gone)  # at once, while tasks may still be writing
            shutil.rmtree(gone)
        except FileNotFoundError:
            pass
        for folder in (os.path.dirname(self.temporary), self.path):
            try:
                os.rmdir(folder)  # only where nothing is in it
            except OSError:
                pass


class PieceSink(DataSource):
    """Rows (file, offset, data, sha256); a piece with a hash is checked against it before it is written."""

    @classmethod
    def name(cls) -> str:
        return "binary_pieces"

    def schema(self) -> str:
        return PIECES

    def writer(self, schema: StructType, overwrite: bool) -> PieceWriter:
        return PieceWriter(local_path(self.options["path"]), overwrite)


def write_pieces(pieces: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write rows (file, offset, data, and sha256 or null). A file that is there already is an error unless ``overwrite``; then it is replaced."""
    spark = pieces.sparkSession
    spark.dataSource.register(PieceSink)
    found = {f.name for f in pieces.schema}
    sha = F.col("sha256") if "sha256" in found else F.lit(None).cast("string")
    d = pieces.select("file", F.col("offset").cast("long").alias("offset"), "data", sha.alias("sha256"))
    d.write.format("binary_pieces").mode("overwrite" if overwrite else "append").save(path)


def ordered(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` in global order of ``by``, by ranges; rows that are equal in it may be parted between tasks."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = rows.withColumn("_nth", F.monotonically_increasing_id())
    return d.repartitionByRange(parts, *by, "_nth").sortWithinPartitions(*by, "_nth").drop("_nth")


def placed(rows: DataFrame, pack: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[str, int, bytes]]], head: Callable[[int, int], bytes] | None = None) -> DataFrame:
    """(file, offset, data) of ``ordered`` rows: each piece after the ones before it and the file's head.

    ``pack`` makes pieces (file, number of records, bytes) of a range's rows, in their order; ``head`` makes a file's first bytes of its
    number of records and bytes. Pieces are written to the shared folder once, so that offsets hold for what is written later; the
    lengths of a file's ranges are summed from it. A range has the end of one file and whole files, so ranges are few.
    """

    def pieces(batches):
        part, ends = TaskContext.get().partitionId(), (None, 0)
        for file, n, data in pack(batches):
            at = ends[1] if ends[0] == file else 0
            ends = (file, at + len(data))
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([at], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([data], pa.binary())], ["file", "part", "n", "inside", "size", "data"])

    d = staged(rows.mapInArrow(pieces, "file string, part long, n long, inside long, size long, data binary"), "pieces")
    sums = staged(d.groupBy("file", "part").agg(F.sum("n").alias("n"), F.sum("size").alias("size")), "piece-sums")
    before = F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases, heads = sums.select("file", "part", before.alias("base")), None
    if head is not None:

        @F.pandas_udf("binary")
        def first(n, size):
            return n.__class__([head(int(a), int(b)) for a, b in zip(n, size, strict=True)], dtype=object)

        totals = sums.groupBy("file").agg(F.sum("n").cast("long").alias("n"), F.sum("size").cast("long").alias("size"))
        heads = staged(totals.select("file", first("n", "size").alias("data")), "piece-heads")
        bases = bases.join(heads.select("file", F.length("data").alias("head")).hint("merge"), "file").select("file", "part", (F.col("base") + F.col("head")).alias("base"))
    bases = staged(bases, "piece-bases")
    bases = F.broadcast(bases) if bases.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES else bases.hint("merge")
    out = d.join(bases, ["file", "part"]).select("file", (F.col("base") + F.col("inside")).alias("offset"), "data")
    return out if heads is None else out.unionByName(heads.select("file", F.lit(0).cast("long").alias("offset"), "data"))


def packed_lines(batches):
    """Pieces of lines (file, line): one for each file of a batch, as a piece is a row of its own from here on."""
    for b in batches:
        for file, rows in groupby(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True), lambda r: r[0]):
            lines = [text for _, text in rows]
            yield file, len(lines), "".join(f"{text}\n" for text in lines).encode()
