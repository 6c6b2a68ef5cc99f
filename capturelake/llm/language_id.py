"""Language identification by prediction by partial matching.

Each language has a context tree over bytes of variable order: an order 3 context is a node where the sample saw
it often enough, else the order 2 context answers. Statistics are frozen after learning, so the probability of
a byte in a context is a constant: seen bytes share ``n / (n + d)`` by count and the escape, ``d / (n + d)``
with ``d`` distinct bytes, goes to the next shorter context without the bytes already seen; below order 0 all
bytes are alike. Code lengths therefore sit in one table, and a text costs one look-up a byte.

Counts are learned by Spark from a bounded sample; only the counts travel, each worker makes its table once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, slices

#: Learning takes about so many documents of each language, picked by a hash of the id.
SAMPLE_PER_LANGUAGE = 1_500
#: An order 3 context is a node from so many occurrences in all languages on.
NODE_COUNT = 16
STEP = 1 << 19


def held_out(key: Column) -> Column:
    """Documents that learning must not see; a row without an id is one."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The three values before each position, blanks before a text's start."""
    before = []
    for back in (1, 2, 3):
        p = np.full_like(data, 32)
        p[back:] = data[: len(data) - back]
        for s in range(back):
            p[np.minimum(starts + s, len(data) - 1)] = 32
        before.append(p)
    return tuple(before)


@dataclass
class Counts:
    """Sparse counts of (language, four bytes) and (language, three bytes)."""

    uid: str
    langs: list[str]
    four: tuple[np.ndarray, np.ndarray, np.ndarray]
    three: tuple[np.ndarray, np.ndarray, np.ndarray]


def learn(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Counts:
    """Counts over documents (id, text, lang) that are not held out.

    Rows without an id, text or lang are left out, empty texts count for nothing, repeated rows count each. An empty table
    gives counts without languages. The table of languages is small: one number of documents of each is collected.
    """
    d = docs.where(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in d.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        none = (np.zeros(0, np.int64),) * 3
        return Counts(uuid.uuid4().hex, [], none, none)
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, per_language / sizes[k])])
    number = F.create_map(*[F.lit(x) for n, k in enumerate(langs) for x in (k, n)])
    d = d.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).select(number[F.col("lang")].alias("n"), "text")

    def count(batches):
        for b in slices(batches, 1):
            langs_here = b.column(0).to_numpy(zero_copy_only=False)
            data, offsets = column_bytes(b.column(1))
            if not len(data):
                continue
            full = np.diff(offsets) > 0
            p1, p2, p3 = (p.astype(np.int64) for p in _grams(data, offsets[:-1][full]))
            lang = np.repeat(langs_here, np.diff(offsets)).astype(np.int64)
            three = (p2 << 16) | (p1 << 8) | data
            for order, key in ((4, (lang << 32) | (p3 << 24) | three), (3, (lang << 32) | three)):
                keys, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), order), pa.int32()), pa.array(keys), pa.array(n)], ["width", "key", "n"])

    g = d.mapInArrow(count, "width int, key long, n long").groupBy("width", "key").agg(F.sum("n").alias("n"))
    width_of, key, n = (c.to_numpy() for c in g.toArrow().columns)  # distinct grams of the bounded sample

    def part(width):
        here = width_of == width
        return key[here] >> 32, key[here] & 0xFFFFFFFF, n[here]

    return Counts(uuid.uuid4().hex, langs, part(4), part(3))


def _blend(counts: np.ndarray, lower: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Probabilities of each row's bytes; a column may stand for several bytes (``times``)."""
    n, d = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    left = (np.where(counts > 0, 0, lower) * times).sum(1, keepdims=True)
    open_ = left > 1e-12
    escape = np.where(open_, d / np.maximum(n + d, 1), 0)
    seen = counts / np.maximum(np.where(open_, n + d, n), 1)
    out = np.where(counts > 0, seen, escape * lower / np.where(open_, left, 1))
    return np.where(n > 0, out, lower)


class Coder:
    """Code lengths in bits of every (context, byte) by language."""

    def __init__(self, c: Counts):
        seen = np.zeros(256, bool)
        seen[32] = True
        for shift in (0, 8, 16):
            seen[(c.three[1] >> shift) & 255] = True
        a = int(seen.sum()) + 1
        self.code = np.full(256, a - 1, np.int64)
        self.code[seen] = np.arange(a - 1)
        self.a, self.langs = a, c.langs
        times = np.ones(a)
        times[-1] = max(1, 256 - (a - 1))
        code = self.code
        context = lambda key, n: sum(code[(key >> (8 * (i + 1))) & 255] * a**i for i in range(n))
        total = np.zeros(a**3, np.int64)
        np.add.at(total, context(c.four[1], 3), c.four[2])
        nodes = np.flatnonzero(total >= NODE_COUNT)
        self.row = np.tile(np.arange(a * a, dtype=np.int32), a)
        self.row[nodes] = a * a + np.arange(len(nodes))
        self.bits = np.empty(((a * a + len(nodes)) * a, len(c.langs)), np.float32)
        for n in range(len(c.langs)):
            key, m = c.three[1][c.three[0] == n], c.three[2][c.three[0] == n]
            two = np.zeros((a * a, a))
            np.add.at(two, (context(key, 2), code[key & 255]), m)
            one = two.reshape(a, a, a).sum(0)
            p = _blend(one.sum(0, keepdims=True), np.full((1, a), 1 / 256), times)
            p = _blend(one, np.repeat(p, a, 0), times)
            p = _blend(two, np.tile(p, (a, 1)), times)
            key, m = c.four[1][c.four[0] == n], c.four[2][c.four[0] == n]
            row = self.row[context(key, 3)] - a * a
            three = np.zeros((len(nodes), a))
            np.add.at(three, (row[row >= 0], code[key[row >= 0] & 255]), m[row >= 0])
            self.bits[:, n] = -np.log2(np.concatenate([p, _blend(three, p[nodes % (a * a)], times)])).ravel()

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(offsets) > 0)
        starts = offsets[:-1][full]
        for lo in range(0, len(data), STEP):
            hi = min(lo + STEP, len(data))
            base = max(0, lo - 3)
            first, last = np.searchsorted(starts, lo, "right") - 1, np.searchsorted(starts, hi, "left")
            here = starts[first:last]
            near = starts[(starts >= base) & (starts < hi)] - base
            x = self.code[data[base:hi]]
            p1, p2, p3 = _grams(data[base:hi], near)
            p1, p2, p3 = (self.code[p][lo - base :] for p in (p1, p2, p3))
            row = self.row[(p3 * self.a + p2) * self.a + p1]
            cost = self.bits[row.astype(np.int64) * self.a + x[lo - base :]]
            out[full[first:last]] += np.add.reduceat(cost, np.maximum(here - lo, 0), axis=0, dtype=np.float64)
        return out


_CODERS: dict[str, Coder] = {}


def coder(c: Counts) -> Coder:
    """The table of these counts, made once in each worker; a worker keeps the last one."""
    if c.uid not in _CODERS:
        _CODERS.clear()
        _CODERS[c.uid] = Coder(c)
    return _CODERS[c.uid]


def identify(docs: DataFrame, counts: Counts, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) of every whole text.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned. The score is the
    posterior probability of the shortest code if all languages are as likely; equal lengths go to the first
    language by name. Repeated rows and clashing column names are of no concern: two columns are read.
    """

    def score(batches):
        c = coder(counts) if counts.langs else None
        for b in slices(batches, 1):
            n = b.num_rows
            pred, p, rate = np.full(n, "und", object), np.zeros(n), np.zeros(n)
            has = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            if c is not None and has.any():
                data, offsets = column_bytes(b.column(1))
                bits = c.lengths(data, offsets)
                best = bits.argmin(1)
                least = bits[np.arange(n), best]
                sure = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
                pred, p, rate = np.where(has, np.array(c.langs, object)[best], "und"), np.where(has, sure, 0), np.where(has, least / np.maximum(np.diff(offsets), 1), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(p), pa.array(rate)], ["doc_id", "lang_pred", "score", "bits_per_byte"])

    d = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("has"))
    return d.mapInArrow(score, "doc_id long, lang_pred string, score double, bits_per_byte double")
