"""What the operators of this subpackage share: scratch tables, row keys, fixed-size histograms, word hashing.

Scratch tables live below ``spark.checkpoint.dir``. Where that is unset, a session in local mode takes a folder of its
own; on a cluster that is an error, as executors could not see it. They are written and read by Spark only, so lost
executors and remote stores are no concern of the callers. A session removes nothing by itself: results are lazy and may
still read them.

Batches of text come to Python bounded by ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB by default) and are worked
off in slices of ``SLICE_ROWS`` rows and about ``SLICE_BYTES``; a longer text is a slice of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_ROWS, SLICE_BYTES = 400, 8 << 20


def scratch_dir(spark: SparkSession) -> str:
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("capturelake.scratch", "")
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-capturelake-", dir="/tmp")
        spark.conf.set("capturelake.scratch", found)
    return found.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, survives executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a scratch table that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if scratch_dir(spark).split(":", 1)[-1].rstrip("/") in path:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _one_row_each(docs: DataFrame) -> bool:
    """Whether the rows are those of one relation, each at most once: nothing but projections and filters stands over it."""
    try:
        node = docs._jdf.queryExecution().analyzed()
    except AttributeError:  # a remote session shows no plans
        return False
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().apply(0)
    return node.nodeName().startswith("LogicalRelation")


def keyed(docs: DataFrame) -> DataFrame:
    """(row, doc): a key of each row's place in its file, the same in every scan, and the whole row as a struct.

    So a decision on a row reaches that row also where ids are null or repeated, and no column names can clash. What is no
    plain scan of files (a join, union, sample, or texts cut into rows, which would share their document's place) is written out first.
    """

    def scan(d):
        place = d.metadataColumn("_metadata")
        columns = F.struct(*[F.col(f"`{c}`") for c in d.columns])
        return d.select(F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("at")).alias("row"), columns.alias("doc"))

    if _one_row_each(docs):
        try:
            return scan(docs)
        except AnalysisException:  # a relation without files
            pass
    return scan(staged(docs, "rows"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``keyed`` documents whose key is not in ``gone`` (row), as they were."""
    left = docs.join(gone.select("row").hint("merge"), "row", "left_anti")
    return left.select("doc.*")


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of bounded size by the bytes of a text column."""
    for b in batches:
        lo = 0
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(), dtype=np.int64)
        while lo < b.num_rows:
            upto = (ends[lo - 1] if lo else 0) + SLICE_BYTES
            hi = max(lo + 1, min(lo + SLICE_ROWS, int(np.searchsorted(ends, upto, "right"))))
            yield b.slice(lo, hi - lo)
            lo = hi


def histogram(df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int, chunk: int = 4096) -> np.ndarray:
    """Sum over all partitions of the int64 array of fixed ``size`` that ``count`` makes of one partition.

    Partitions send their arrays in chunks; each chunk is summed as a stream by one task, so no task
    holds more than its chunks and the driver gets ``8 * size`` bytes whatever the input.
    """
    assert size <= 1 << 22, "the driver takes arrays of at most 32 MB"

    def partial(batches):
        yield from chunks(np.asarray(count(batches), dtype=np.int64), chunk)

    rows = df.mapInArrow(partial, CHUNKS).repartition(min(64, -(-size // chunk)), "chunk").mapInArrow(add_chunks, CHUNKS).collect()
    out = np.zeros(size, np.int64)
    for r in rows:
        place, n = unchunk(r["data"])
        out[r["chunk"] * chunk + place] = n
    return out


CHUNKS = "chunk int, data binary"


def chunks(total: np.ndarray, chunk: int) -> Iterator[pa.RecordBatch]:
    """The places that are not 0, by chunks: places as u16 and counts in the smallest type that holds them."""
    keys, data = [], []
    for k in range(0, len(total), chunk):
        part = total[k : k + chunk]
        place = np.flatnonzero(part)
        if len(place):
            n = part[place]
            kind = 2 if n.max() < 1 << 16 else 4 if n.max() < 1 << 32 else 8
            keys.append(k // chunk)
            data.append(bytes([kind]) + place.astype("<u2").tobytes() + n.astype(f"<u{kind}").tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(data, pa.binary())], ["chunk", "data"])


def unchunk(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    kind = data[0]
    n = (len(data) - 1) // (2 + kind)
    return np.frombuffer(data, "<u2", n, 1).astype(np.int64), np.frombuffer(data, f"<u{kind}", n, 1 + 2 * n).astype(np.int64)


def sum_chunks(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    """The sums of all chunks that come to this task, as arrays of 65,536."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            place, n = unchunk(data)
            sums.setdefault(k, np.zeros(1 << 16, np.int64))[place] += n
    return sums


def add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for k, total in sum_chunks(batches).items():
        for b in chunks(total, 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array([k] * b.num_rows, pa.int32()), b.column(1)], ["chunk", "data"])


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


#: Bytes that make up words: ASCII letters, digits, the underscore, and all of non-ASCII characters.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_"]] = True
WORD_BYTE[128:] = True
_P = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_P, -1, 1 << 64)
#: Bytes that are hashed at once; longer runs than ``LONG_RUN`` are hashed one by one with another function.
STEP, LONG_RUN = 1 << 18, 1 << 10
_TABLES: list[np.ndarray] = []


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and where each row starts (one more at the end); nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def run_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes; runs follow each other and do not overlap.

    A run's hash is a polynomial in its bytes, got as the difference of two running sums, so no run becomes a Python
    object. Very long runs, for which such polynomials are weak, get a cryptographic hash of all their bytes.
    """
    if not _TABLES:
        _TABLES.extend((_powers(_P, STEP + 1), _powers(_INVERSE, STEP + 1)))
    up, down = _TABLES
    h = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):  # pieces of whole runs
        base = int(start[lo])
        hi = max(lo + 1, int(np.searchsorted(stop, base + STEP, "right")))
        end = min(int(stop[hi - 1]), base + STEP)
        sums = np.zeros(end - base + 1, np.uint64)
        np.cumsum((data[base:end].astype(np.uint64) + np.uint64(1)) * up[: end - base], out=sums[1:])
        a, b = start[lo:hi] - base, np.minimum(stop[lo:hi] - base, end - base)
        h[lo:hi] = (sums[b] - sums[a]) * down[a]
        lo = hi
    for i in np.flatnonzero(stop - start > LONG_RUN).tolist():
        h[i] = int.from_bytes(blake2b(data[start[i] : stop[i]].tobytes(), digest_size=8).digest(), "little")
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of a batch of ``plain_words`` texts, where each text's words end). Nulls have no words."""
    data, offsets = column_bytes(column)
    inside = WORD_BYTE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = offsets[1:] - 1
    after[ends[ends >= 0]] = False
    start, stop = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return run_hashes(data, start, stop), np.searchsorted(start, offsets[1:], "left")


def plain_words(text):
    """The text in lower case, with non-ASCII characters that belong to no word (quotes, dashes, other full stops) as spaces."""
    return F.regexp_replace(F.lower(text), r"(?U)[^\w\x00-\x7F]", " ")


def hash_unit(column, seed: str):
    """A number in (0, 1) that depends on the column's value and the seed alone; DuckDB can compute it too."""
    return (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
