"""Token ids in a compact binary file format: canonical length-limited Huffman codes from global counts.

A file set is a folder with two Parquet tables. ``codebook`` has (symbol, length); canonical codes follow
from it. ``blocks`` has one row per independent block of whole documents in ascending doc_id order: part and
block number, the documents' ids and token counts, ``checkpoints`` (little-endian u64: bit offset of every
``EVERY``-th token) and ``bits`` (the codes, most significant bit first). A block is decoded from the
codebook alone, all stretches between checkpoints side by side by one table look-up per token.

Writing is by Spark: texts are tokenised where they are read, once, into a scratch table; ids are counted over all
documents; then ids, not texts, are dealt by ranges of the doc_id and coded partition by partition.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column_bytes, drop_staged, histogram, run_hashes, scratch_dir, slices, staged

LIMIT = 16
EVERY = 128
BLOCK_TOKENS = 1 << 16
END_ID = 2

#: White space that parts words in another way than a single space or line end: fixed values, as bytes of UTF-8.
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[9, 11, 12, 13, 28, 29, 30, 31]] = True
_WIDE_SPACES = [0xC285, 0xC2A0, 0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts in which pieces can't be told by single spaces and line ends: other white space, several in a row or at the end."""
    parts = (data == 32) | (data == 10)
    bad = _ASCII_SPACE[data]
    bad[:-1] |= parts[:-1] & parts[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    bad[last] |= parts[last]
    lead = np.flatnonzero(_LEADS[data])
    if len(lead):
        ahead = np.append(data, np.zeros(2, np.uint8))
        two = ahead[lead].astype(np.int64) << 8 | ahead[lead + 1]
        bad[lead[np.isin(np.where(ahead[lead] == 0xC2, two, two << 8 | ahead[lead + 2]), _WIDE_SPACES)]] = True
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, np.flatnonzero(bad), "right") - 1] = True
    return out


class Pieces:
    """Ids of the pieces of texts: each piece is a space or line end with the word behind it, or the first word.

    A byte-level BPE splits a text before each space that a word follows, and around a single line end, so the
    ids of a text are those of its pieces. Pieces are found and hashed (64 bits) for a whole batch at once; what a worker
    process has met before is looked up in a hash table of its own, and new pieces are encoded by the library.
    A text for which this doesn't hold (``odd_texts``, or one with a special token) is encoded as a whole, as is everything
    by a vocabulary that doesn't split there.

    Bounded: a full table is emptied.
    """

    #: Slots of the table as a power of 2, pieces looked up at once, and ids kept.
    BITS, AT_ONCE, MOST_IDS = 21, 1 << 19, 1 << 24

    def __init__(self, vocabulary: str):
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks already use all cores
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = id_type(self.tokenizer.get_vocab_size())
        probe = "It is, 7x a1b2 (so) don't ½é\nwe're\nx_y <a>"
        self.by_pieces = sum(map(self.encode, self.parts(probe)), []) == self.encode(probe) and "\u0120" in self.tokenizer.get_vocab()
        self.clear()

    def clear(self) -> None:
        self.keys, self.place = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.int32)
        self.start, self.size, self.ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, self.kind)]
        self.known = self.total = 0

    @staticmethod
    def parts(text: str) -> list[str]:
        return [p for p in text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0") if p]

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 where it isn't known."""
        out, left, slot = np.full(len(h), -1, np.int64), np.arange(len(h)), (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        while len(left):
            key = self.keys[slot]
            hit = key == h[left]
            out[left[hit]] = self.place[slot[hit]]
            on = ~hit & (key != 0)
            left, slot = left[on], (slot[on] + 1) & ((1 << self.BITS) - 1)
        return out

    def add(self, h: np.ndarray, pieces: list[str]) -> None:
        """Learn pieces with hashes that are not known."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        number = np.arange(self.known, self.known + len(got), dtype=np.int32)
        self.start.append(self.total + np.cumsum(size) - size)
        self.size.append(size)
        self.ids.append(np.fromiter((i for x in got for i in x), self.kind, int(size.sum())))
        self.known, self.total = self.known + len(got), self.total + int(size.sum())
        left, slot = np.arange(len(h)), (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]], self.place[slot[free]] = h[left[free]], number[left[free]]
            on = self.keys[slot] != h[left]  # another one was there, or came there last
            left, slot = left[on], (slot[on] + 1) & ((1 << self.BITS) - 1)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        for x in (self.start, self.size, self.ids):
            x[:] = [np.concatenate(x)]
        return self.start[0], self.size[0], self.ids[0]

    def of(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text; odd texts are encoded as a whole."""
        data, offsets = column_bytes(column)
        size, odd = np.diff(offsets), odd_texts(data, offsets)
        for token in self.special:
            odd = odd | pc.fill_null(pc.match_substring(column, token), False).to_numpy(zero_copy_only=False)
        whole = (odd | (not self.by_pieces)) & (size > 0)
        out: list[np.ndarray] = [np.zeros(0, self.kind)] * len(size)
        if whole.any():
            rows = np.flatnonzero(whole).tolist()
            texts = column.take(pa.array(rows)).to_pylist()
            for row, e in zip(rows, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                out[row] = np.array(e.ids, self.kind)
        cut = (data == 32) | (data == 10)
        cut[offsets[:-1][size > 0]] = True
        start = np.flatnonzero(cut)
        stop = np.append(start[1:], len(data))
        first = np.searchsorted(start, offsets)
        mine = ~np.repeat(whole, np.diff(first))
        if not mine.any():
            return out
        start, stop = start[mine], stop[mine]
        flat, sizes = [], []
        for lo in range(0, len(start), self.AT_ONCE):
            ids, n = self._of_pieces(data, start[lo : lo + self.AT_ONCE], stop[lo : lo + self.AT_ONCE])
            flat.append(ids)
            sizes.append(n)
        flat = np.concatenate(flat)
        # Where each text's pieces, and so its ids, end.
        upto = np.concatenate([[0], np.cumsum(mine)])[first]
        bound = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])[upto].tolist()
        return [o if w else flat[a:b] for a, b, o, w in zip(bound[:-1], bound[1:], out, whole, strict=True)]

    def _of_pieces(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each piece)."""
        h = run_hashes(data, start, stop) | np.uint64(1)
        found = self.find(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh, at = np.unique(h[new], return_index=True)
            if self.known + len(fresh) > 1 << (self.BITS - 1) or self.total > self.MOST_IDS:
                self.clear()
                new = np.arange(len(h))
                fresh, at = np.unique(h, return_index=True)
            rows, raw = new[at], memoryview(np.ascontiguousarray(data))
            self.add(fresh, [str(raw[a:b], "utf-8") for a, b in zip(start[rows].tolist(), stop[rows].tolist(), strict=True)])
            found = self.find(h)
        at, size, ids = self.tables()
        size = size[found]
        ends = np.cumsum(size)
        return ids[np.repeat(at[found] - (ends - size), size) + np.arange(int(ends[-1]))], size


def id_type(n: int):
    """Ids travel as 16 bits where the vocabulary allows it."""
    return np.uint16 if n <= 1 << 16 else np.uint32


def _ids(data: np.ndarray, kind) -> np.ndarray:
    """Bytes as ids; a slice may begin at an odd address."""
    return data.view(kind) if data.ctypes.data % 4 == 0 else np.frombuffer(data.tobytes(), kind)


_PIECES: dict[str, Pieces] = {}


def pieces_of(vocabulary: str) -> Pieces:
    """The pieces known to this worker process; its tasks share them."""
    if vocabulary not in _PIECES:
        _PIECES[vocabulary] = Pieces(vocabulary)
    return _PIECES[vocabulary]


def tokenise(docs: DataFrame, vocabulary: str, end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids) of each row, in no order; ids are little-endian u16, or u32 for large vocabularies."""

    def run(batches):
        known = pieces_of(vocabulary)
        end = np.array([end_id], known.kind)
        for b in slices(batches, 1):
            ids = [np.append(x, end) for x in known.of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], ["doc_id", "n_tokens", "ids"])

    d = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code length of each symbol, at most ``limit`` bits (package-merge), or 2 more than so many symbols need; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        limit = int(len(used) - 1).bit_length() + 2
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    packages, levels = np.zeros(0), []
    for _ in range(limit):
        both = np.concatenate([leaf, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(leaf))
        both = both[rank]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take, own = 2 * len(order) - 2, np.zeros(len(order), np.int64)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        own[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = own
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    n = lengths[order].astype(np.int64)
    # Each code is the sum of the ranges before it, in units of the longest code.
    longest = int(n.max(initial=1))
    before = np.concatenate([[0], np.cumsum(1 << (longest - n))[:-1]]) if len(n) else n
    codes[order] = before >> (longest - n)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """(checkpoints, bits) of the ids."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    starts = ends - n
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 32 + 2, np.uint64)
    if len(ids):
        value = codes[ids].astype(np.uint64) << (64 - (starts & 31) - n).astype(np.uint64)
        at = starts >> 5
        first = np.flatnonzero(np.diff(at, prepend=-1))
        words[at[first]] += np.add.reduceat(value >> np.uint64(32), first)
        words[at[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return starts[::EVERY].astype("<u8").tobytes(), words.astype(">u4").tobytes()[: (total + 7) // 8]


def decode_table(lengths: np.ndarray) -> np.ndarray:
    """For as many next bits as the longest code has: symbol * 32 + length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    n = lengths[order].astype(np.int64)
    longest = int(n.max(initial=1))
    table = np.repeat(order.astype(np.int64) * 32 + n, 1 << (longest - n))
    return np.concatenate([table, np.full((1 << longest) - len(table), 1)]).astype(np.uint32)


def unpack(checkpoints: list[bytes], bits: list[bytes], n_tokens: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Ids of several blocks one after the other."""
    n_tokens = np.asarray(n_tokens, np.int64)
    size = np.array([len(x) + 4 for x in bits], np.int64)
    data = np.frombuffer(b"".join(x + b"\0\0\0\0" for x in bits), np.uint8).astype(np.uint32)
    ahead = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    longest = len(table).bit_length() - 1  # of at most 25 bits, as a window of 32 begins up to 7 bits before
    mask = np.uint32(len(table) - 1)
    lanes = -(-n_tokens // EVERY)
    base = np.repeat((np.cumsum(size) - size) * 8, lanes)
    at = np.frombuffer(b"".join(checkpoints), "<u8").astype(np.int64) + base
    left = np.concatenate([np.minimum(EVERY, n - EVERY * np.arange(k)) for n, k in zip(n_tokens, lanes, strict=True)]) if len(at) else at
    out = np.empty((len(at), EVERY), np.uint32)
    last = len(ahead) - 1
    for j in range(EVERY):
        word = ahead[np.minimum(at >> 3, last)]
        found = table[(word >> (32 - longest - (at & 7)).astype(np.uint32)) & mask]
        out[:, j] = found >> np.uint32(5)
        at += found & np.uint32(31)
    return out[np.arange(EVERY) < left[:, None]]


def vocabulary_size(spark: SparkSession, vocabulary: str) -> int:
    """Asked of a worker, which has the vocabulary loaded anyway; the driver needs no tokenizer in its memory."""

    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pieces_of(vocabulary).tokenizer.get_vocab_size()] * b.num_rows, pa.int64())], ["n"])

    return spark.range(1, numPartitions=1).mapInArrow(size, "n long").first()[0]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, **columns) -> None:
    """Write the file set of all documents to the new folder ``path``.

    A null or empty text has the end id alone. Rows that share an id are kept, in an order of their ids that a rerun
    repeats; rows without an id come first. An empty table makes a file set without blocks. Special tokens in a text get their ids, as the library gives them.
    """
    spark = docs.sparkSession
    n_ids = max(vocabulary_size(spark, vocabulary), end_id + 1)
    kind = id_type(n_ids)
    tokens = staged(tokenise(docs, vocabulary, end_id, **columns), "tokens")

    def count(batches):
        total = np.zeros(n_ids, np.int64)
        for b in batches:
            total += np.bincount(_ids(column_bytes(b.column(0))[0], kind), minlength=n_ids)
        return total

    counts = histogram(tokens.select("ids"), count, n_ids)
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(list(zip(used.tolist(), lengths[used].tolist(), strict=True)), "symbol int, length int").coalesce(1).write.parquet(f"{path}/codebook")

    def code(batches):
        from pyspark import TaskContext

        part, row = TaskContext.get().partitionId(), 0
        for b in slices(batches, 2):
            data, offsets = column_bytes(b.column(2))
            ids, ends = _ids(data, kind), offsets[1:] // kind().itemsize
            doc = b.column(0)
            cut = np.unique(np.concatenate([[0, b.num_rows], np.searchsorted(ends, np.arange(BLOCK_TOKENS, ends[-1], BLOCK_TOKENS))]))
            out = []
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                first = int(ends[lo - 1]) if lo else 0
                n = np.diff(ends[lo:hi], prepend=first)
                out.append((part, row + lo, doc[lo:hi].to_pylist(), n.tolist(), int(n.sum()), *pack(ids[first : ends[hi - 1]], lengths, codes)))
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["part", "block", "doc_ids", "doc_tokens", "n_tokens", "checkpoints", "bits"])

    kinds = "part int, block long, doc_ids array<long>, doc_tokens array<long>, n_tokens long, checkpoints binary, bits binary"
    # Rows that share an id, or have none, are dealt by a hash of their ids as well: no range holds more than equal rows.
    order = ["doc_id", "salt", "ids"]
    dealt = tokens.withColumn("salt", F.xxhash64("ids")).repartitionByRange("doc_id", "salt").sortWithinPartitions(*order)
    dealt.select("doc_id", "n_tokens", "ids").mapInArrow(code, kinds).write.option("compression", "none").parquet(f"{path}/blocks")
    drop_staged(tokens)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids on demand.

    All rows that were written come back, also those without an id, of repeated ids and of null texts (the end id alone).
    A file set without blocks gives no rows.
    """
    book = spark.read.parquet(f"{path}/codebook").collect()  # a row per id of the vocabulary at most
    lengths = np.zeros(max((r["symbol"] for r in book), default=0) + 1, np.uint8)
    for r in book:
        lengths[r["symbol"]] = r["length"]
    blocks = spark.read.parquet(f"{path}/blocks")

    def read(batches):
        table = decode_table(lengths)
        for whole in batches:
            for lo in range(0, whole.num_rows, 16):
                b = whole.slice(lo, 16)
                doc_ids, counts = b.column(2).to_pylist(), b.column(3).to_pylist()
                ids = unpack(b.column(5).to_pylist(), b.column(6).to_pylist(), b.column(4).to_numpy(), table)
                n = np.array([k for c in counts for k in c], np.int64)
                ends = np.cumsum(n)
                own = np.concatenate([np.cumsum(c) - c for c in map(np.array, counts)]) if counts else n
                wide = ids.astype("<u4")
                parts = [wide[a:e] for a, e in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                rows = np.array([len(c) for c in counts])
                cols = [pa.array(np.repeat(b.column(0).to_numpy(), rows)), pa.array(np.repeat(b.column(1).to_numpy(), rows)), pa.array([x for d in doc_ids for x in d], pa.int64()), pa.array(own), pa.array(n), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["part", "block", "doc_id", "offset", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([p.tolist() for p in parts], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    docs = blocks.select("part", "block", "doc_ids", "doc_tokens", "n_tokens", "checkpoints", "bits").mapInArrow(read, "part int, block long, doc_id long, offset long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    # Starts: sums of whole parts (one row per file part), then of a part's blocks.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("part_start", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    upto = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    starts = blocks.select("part", "block", "n_tokens").withColumn("upto", upto).join(parts.hint("merge"), "part").select("part", "block", (F.col("part_start") + F.col("upto")).alias("block_start"))
    return docs.join(starts.hint("merge"), ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def new_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/token-files-{uuid.uuid4().hex}"
