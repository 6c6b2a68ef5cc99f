"""Benchmark decontamination by latent semantic retrieval.

1. Passages are windows of ``WINDOW`` words at every ``STRIDE``-th word. Words (lower case, runs of letters, digits and
   non-ASCII characters) are hashed straight from a batch's bytes; a passage's vector is the sum of its words' buckets,
   weighted by the squared IDF over all documents.
2. A randomised SVD (range finder, one power iteration, then the Nystroem form of the second product) over all passages of
   all documents and of the benchmark gives one latent basis. Its two products with the matrix are Spark jobs over the words'
   buckets, which are written out once; the driver sees only matrices of fixed size.
3. Every passage of every whole document is projected and its cosine with all items found as blocks of a matrix
   product. The items are the stated query set; an item longer than a window asks by its own passages, and where there are
   items of fewer than ``SHORT`` words, these are also held against windows of a quarter of the length. One scan of the
   documents serves ``PASS_QUERIES`` of them. Of these candidates those go on whose words weigh at least ``OVERLAP`` of
   the passage or the item's passage, whichever is less.
4. A candidate becomes a match if the longest common subsequence of the item and a stretch of text there, at most half as
   long again as the item, covers enough of the item, and enough of its answer, the item's last sentence. A cover of
   ``SURE`` needs no answer; short items need more cover, as a few words meet by chance.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, histogram, keyed, plain_words, slices, staged, without, word_hashes

WINDOW, STRIDE = 48, 24
#: Items of fewer words are also searched with windows of SHORT words.
SHORT = 12
BUCKETS = 1 << 14
RANK, OVERSAMPLE = 96, 8
#: Half passages that a task multiplies at once, and rows that are summed up in one step of a sum by bucket.
HALVES, RUN = 1 << 13, 64
#: Queries that are compared at once, and about so many that one scan of the documents serves (their bits take 2 KB each).
BLOCK, PASS_QUERIES = 1_024, 16_384
COSINE, OVERLAP, COVER, ANSWER = 0.4, 0.5, 0.6, 0.5
#: Cover that is enough without the answer, and the least number of last words that make an answer.
SURE, LEAST_ANSWER = 0.8, 3
SEED = 11


def _buckets(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(50)).astype(np.int64)


def word_buckets(texts: DataFrame) -> DataFrame:
    """(x): the words of each text (text) as u16 buckets, written out; texts without words have no row."""

    def pack(batches):
        for b in slices(batches, 0):
            h, ends = word_hashes(b.column(0))
            x = _buckets(h).astype(np.uint16)
            rows = [r.tobytes() for r in np.split(x, ends[:-1]) if len(r)] if len(ends) else []
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["x"])

    return staged(texts.mapInArrow(pack, "x binary"), "word-buckets")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch of ``word_buckets``, and where each text's end."""
    data, offsets = column_bytes(column)
    return np.frombuffer(data.tobytes(), np.uint16), offsets[1:] // 2


def idf_weights(words: DataFrame) -> np.ndarray:
    """ln(1 + N / df) squared of each bucket over all documents' ``word_buckets``."""

    def count(batches):
        total = np.zeros(BUCKETS + 1, np.int64)
        for b in slices(batches, 0):
            x, ends = _unpacked(b.column(0))
            doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            total[:-1] += np.bincount(np.unique(doc * BUCKETS + x) % BUCKETS, minlength=BUCKETS)
            total[-1] += len(ends)
        return total

    total = histogram(words, count, BUCKETS + 1)
    return np.log1p(max(int(total[-1]), 1) / np.maximum(total[:-1], 1)) ** 2


def _passages(ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end word) of all windows, half a window apart; the last window of a text reaches its end."""
    stride = window // 2
    begins, n = ends - np.diff(ends, prepend=0), np.diff(ends, prepend=0)
    count = np.where(n > 0, np.maximum(-(-(n - window) // stride), 0) + 1, 0)
    doc = np.repeat(np.arange(len(ends)), count)
    first = begins[doc] + stride * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
    return doc, first, np.minimum(first + window, ends[doc])


def _embed(bucket: np.ndarray, basis: np.ndarray, first: np.ndarray, end: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Sum of the words' rows of each window; the last row of the basis is zero and stands for no word.

    Half windows are summed once: the second half of a window is the first of the text's next one.
    """
    stride = window // 2

    def half(start, stop):
        out = np.zeros((len(start), basis.shape[1]), basis.dtype)
        for k in range(stride):
            at = start + k
            out += basis[np.where(at < stop, bucket[np.minimum(at, len(bucket) - 1)], len(basis) - 1)]
        return out

    one = half(first, end)
    more = end > first + stride
    shared = np.zeros(len(first), bool)
    shared[:-1] = more[:-1] & (first[1:] == first[:-1] + stride)
    last = np.flatnonzero(more & ~shared)
    out = one.copy()
    out[np.flatnonzero(shared)] += one[np.flatnonzero(shared) + 1]
    out[last] += half(first[last] + stride, end[last])
    return out


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _sums(key: np.ndarray, row: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each different key, sum of its rows of ``z``) of sorted keys: runs of up to ``RUN`` rows side by side, then the sums of runs."""
    while True:
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.diff(np.append(first, len(key)))
        runs = -(-n // RUN)
        nth = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        start, size = np.repeat(first, runs) + RUN * nth, np.minimum(RUN, np.repeat(n, runs) - RUN * nth)
        down = np.argsort(-size, kind="stable")
        start = start[down]
        out = np.zeros((len(start), z.shape[1]), z.dtype)
        for k, m in enumerate(np.searchsorted(-size[down], -np.arange(size.max(initial=0)), "left").tolist()):
            out[:m] += np.take(z, row[start[:m] + k], axis=0)
        if len(first) == len(start):
            return key[start], out
        order = np.argsort(key[start], kind="stable")
        key, row, z = key[start][order], order, out


def _square_lengths(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared length of each row's vector; a bucket that occurs several times adds up first. The extra bucket ``BUCKETS`` weighs nothing."""
    x = np.sort(x.astype(np.uint32), axis=1).ravel()
    new = np.append(True, x[1:] != x[:-1])
    new[::WINDOW] = True
    first = np.flatnonzero(new)
    v = (weight[x[first]] * np.diff(np.append(first, len(x)))) ** 2
    return np.add.reduceat(v, np.searchsorted(first, np.arange(0, len(x), WINDOW)))


def add_products(total: np.ndarray, bucket: np.ndarray, ends: np.ndarray, weight: np.ndarray, q: np.ndarray, scale: float = 1.0) -> None:
    """Add ``scale^2 X^T L^-2 X q`` over all passages of some texts to ``total``: X counts a passage's words by bucket, L is the length of its weighted vector.

    ``q`` and ``weight`` have a last row of zeros for no word. Half windows are multiplied once; a passage is two that follow each other.
    """
    n = np.diff(ends, prepend=0)
    count = -(-n // STRIDE)
    doc = np.repeat(np.arange(len(n)), count)
    start = (ends - n)[doc] + STRIDE * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
    more = np.append(doc[1:] == doc[:-1], False)[: len(doc)]
    passage = more | (count[doc] == 1)
    for lo in range(0, len(doc), HALVES):
        # The last half is here for its passage with the one before; it comes again as the first of the next lot.
        hi = min(lo + HALVES, len(doc))
        i = np.flatnonzero(passage[lo:hi])
        if not len(i):
            continue
        two = more[lo:hi][i]
        at = start[lo : hi + 1, None] + np.arange(STRIDE)
        x = np.where(at < ends[doc[lo : hi + 1], None], bucket[np.minimum(at, len(bucket) - 1)], BUCKETS).astype(np.uint16)
        y = np.zeros((len(x), q.shape[1]), np.float32)
        for k in range(STRIDE):
            y += np.take(q, x[:, k], axis=0)
        both = np.full((len(i), WINDOW), BUCKETS, np.uint16)
        both[:, :STRIDE] = x[i]
        both[two, STRIDE:] = x[i[two] + 1]
        own = y[i]
        own[two] += y[i[two] + 1]
        own *= (scale**2 / np.maximum(_square_lengths(both, weight), 1e-12)).astype(np.float32)[:, None]
        z = np.zeros_like(y)
        z[i] = own
        z[i[two] + 1] += own[two]
        flat = x.ravel()
        order = np.argsort(flat, kind="stable")
        order = order[: int((flat < BUCKETS).sum())]
        key, sums = _sums(flat[order].astype(np.int64), order // STRIDE, z)
        total[key] += sums


class Product:
    """``A^T (A Q)`` over all passages, rows of A scaled to length 1; a picklable job."""

    def __init__(self, words: DataFrame, idf: np.ndarray):
        """``words``: (x, scale), rows of ``word_buckets`` with the weight of their passages."""
        self.words, self.idf = words, idf

    def __call__(self, q: np.ndarray) -> np.ndarray:
        width = q.shape[1]
        weight = np.append(self.idf, 0).astype(np.float32)
        q = np.append(q * self.idf[:, None], np.zeros((1, width)), 0).astype(np.float32)

        def multiply(batches):
            total = np.zeros((BUCKETS, width))
            for b in slices(batches, 0):
                scales = b.column(1).to_numpy()
                for scale in np.unique(scales).tolist():
                    bucket, ends = _unpacked(b.column(0).filter(pa.array(scales == scale)))
                    add_products(total, bucket, ends, weight, q, scale)
            for lo in range(0, BUCKETS, 512):
                if total[lo : lo + 512].any():
                    yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int32()), pa.array([total[lo : lo + 512].astype(np.float32).tobytes()], pa.binary())], ["lo", "data"])

        def add(batches):
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    part = np.frombuffer(data, np.float32).astype(float)
                    sums[k] = sums[k] + part if k in sums else part
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.astype(np.float32).tobytes() for v in sums.values()], pa.binary())], ["lo", "data"])

        # Single precision travels and is kept: the driver holds a few of these matrices at a time, of 7 MB each.
        out = np.zeros((BUCKETS, width), np.float32)
        for r in self.words.mapInArrow(multiply, "lo int, data binary").repartition(8, "lo").mapInArrow(add, "lo int, data binary").collect():
            out[r["lo"] : r["lo"] + 512] = np.frombuffer(r["data"], np.float32).reshape(-1, width)
        return out * self.idf[:, None].astype(np.float32)


def latent_basis(words: DataFrame, own: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """(BUCKETS + 1, rank at most) IDF-weighted basis from a randomised SVD of all passages; the last row is zero.

    ``words`` and ``own``: ``word_buckets`` of all documents and of all items.
    """
    halves = F.ceil(F.length("x") / (2.0 * STRIDE))
    passages = lambda d: d.agg(F.sum(F.greatest(halves - 1, F.lit(1)))).first()[0] or 1
    # The items weigh as much as the documents, so that the basis holds what sets them apart.
    scale = float(np.sqrt(passages(words) / passages(own)))
    product = Product(words.withColumn("scale", F.lit(1.0)).unionByName(own.withColumn("scale", F.lit(scale))), idf)
    width = min(rank + OVERSAMPLE, BUCKETS)
    q = np.linalg.qr(product(np.random.default_rng(SEED).standard_normal((BUCKETS, width), np.float32)))[0].astype(float)
    y = product(q).astype(float)
    # Nystroem: the matrix is about y (q^T y)^-1 y^T, so its vectors are those of y (q^T y)^(-1/2).
    value, vector = np.linalg.eigh(q.T @ y + y.T @ q)
    real = value > 1e-6 * value.max()
    half = y @ (vector[:, real] / np.sqrt(value[real] / 2))
    value, vector = np.linalg.eigh(half.T @ half)
    best = np.argsort(-value)[:rank]
    best = best[value[best] > 1e-6 * value.max()]
    basis = half @ (vector[:, best] / np.sqrt(value[best]))
    return np.append((basis * idf[:, None]).astype(np.float32), np.zeros((1, len(best)), np.float32), 0)


class Item:
    """A benchmark item, ready for comparison: each word's places as bits."""

    def __init__(self, item_id, text: str, raw: str):
        """``text``: the item's plain words; ``raw``: as it was, for its sentences."""
        h, ends = word_hashes(pa.array([text, *re.split(r"(?<=[.!?])\s+", raw.strip())], pa.string()))
        counts = np.diff(ends, prepend=0)
        self.id, self.words = item_id, h[: counts[0]].tolist()
        self.answer = min(max(int(next((n for n in counts[:0:-1] if n), 0)), LEAST_ANSWER), len(self.words))
        self.masks: dict[int, int] = {}
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i

    def covered(self, text: list) -> tuple[float, float]:
        """Shares of the item and of its answer that a longest common subsequence with the text covers."""
        n = len(self.words)
        marks = [m for w in text if (m := self.masks.get(w))]
        union = 0
        for m in marks:
            union |= m
        if union.bit_count() < COVER * n:
            return 0.0, 0.0
        full = (1 << n) - 1
        v = full
        for m in marks:
            u = v & m
            v = ((v + u) | (v - u)) & full
        tail = full
        last = ((1 << self.answer) - 1) << (n - self.answer)
        for m in marks:
            u = tail & m & last
            tail = ((tail + u) | (tail - u)) & full if u else tail
        tail_found = self.answer - (tail & last).bit_count()
        return (n - v.bit_count()) / n, tail_found / max(self.answer, 1)


    def least(self, cover: float) -> float:
        """Cover that a match needs: more than ``cover`` for items of fewer than 15 words."""
        return cover + (1 - cover) * 0.6 * min(max(15 - len(self.words), 0) / 9, 1)

    def best(self, text: list, cover: float) -> tuple[float, float, int, int]:
        """(cover, answer, begin, end) of the best stretch of the text, at most half as long again as the item, or zeros."""
        n, least = len(self.words), self.least(cover)
        span, out = n + max(4, n // 2), (0.0, 0.0, 0, 0)
        if self.covered(text)[0] < least:  # no stretch covers more than the whole
            return out
        for at in range(0, max(len(text) - span, 0) + max(1, n // 8), max(1, n // 8)):
            share, tail = self.covered(text[at : at + span])
            if share >= least and (share, tail) > out[:2]:
                out = (share, tail, at, min(at + span, len(text)))
        return out


class Queries:
    """Items as the passages that they are searched by; made once in each worker."""

    def __init__(self, items: list[tuple], basis: np.ndarray, idf: np.ndarray):
        self.items = [Item(*i) for i in items]
        column = pa.array([t for _, t, _ in items], pa.string())
        h, ends = word_hashes(column)
        bucket = _buckets(h)
        of, first, end = _passages(ends)
        self.scales = []
        short = np.diff(ends, prepend=0)[of] < SHORT
        for window, some in ((WINDOW, np.ones(len(of), bool)), (SHORT, short)):
            some = np.flatnonzero(some)
            for lo in range(0, len(some), BLOCK):
                q = some[lo : lo + BLOCK]
                bits = np.zeros((len(q), BUCKETS), bool)
                for j, k in enumerate(q.tolist()):
                    bits[j, bucket[first[k] : end[k]]] = True
                weight = np.array([idf[bucket[first[k] : end[k]]].sum() for k in q.tolist()])
                self.scales.append((window, of[q], _normal(_embed(bucket, basis, first[q], end[q])).T.copy(), np.packbits(bits, axis=1), weight))


_QUERIES: dict[str, Queries] = {}


def _found(d: DataFrame, benchmark: DataFrame, cosine: float, cover: float, answer: float, text: str, key: str, item_key: str, item_text: str) -> DataFrame:
    """(row, doc_id, item_id, cover, answer, cosine, first_word, end_word): the best place of each item in each row."""
    d = d.select("row", F.col(f"doc.`{key}`").cast("long").alias("id"), plain_words(F.col(f"doc.`{text}`")).alias("text"))
    kind = "row struct<file:long,at:long>, doc_id long, item_id long, cover double, answer double, cosine double, first_word long, end_word long"
    items = benchmark.select(F.col(item_key).cast("long").alias("item_id"), plain_words(F.col(item_text)).alias("text"), F.col(item_text).alias("raw")).where(F.col("text").rlike(r"(?U)\w"))
    passages = F.ceil(F.size(F.split("text", " ")) / float(STRIDE)).cast("long")
    n = items.agg(F.sum(passages)).first()[0]
    if not n:
        return d.sparkSession.createDataFrame([], kind)
    words = word_buckets(d.select("text"))
    idf = idf_weights(words)
    basis = latent_basis(words, word_buckets(items.select("text")), idf)
    passes, found = -(-n // PASS_QUERIES), None
    for k in range(passes):
        here = items if passes == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        own = [(r["item_id"], r["text"], r["raw"]) for r in here.collect()]
        if own:
            part = d.mapInArrow(_search(own, basis, idf, cosine, cover, answer), kind)
            found = part if found is None else found.unionByName(part)
    return found


def _search(own, basis, idf, cosine, cover, answer):
    uid = uuid.uuid4().hex

    def search(batches):
        if uid not in _QUERIES:
            _QUERIES.clear()
            _QUERIES[uid] = Queries(own, basis, idf)
        queries = _QUERIES[uid]
        for b in slices(batches, 2):
            words, ends = word_hashes(b.column(2))
            bucket = _buckets(words)
            begins = ends - np.diff(ends, prepend=0)
            best: dict[tuple[int, int], tuple] = {}
            for window in {x[0] for x in queries.scales}:
                doc, first, end = _passages(ends, window)
                for lo in range(0, len(doc), 4096):
                    f, e = first[lo : lo + 4096], end[lo : lo + 4096]
                    vectors = _normal(_embed(bucket, basis, f, e, window))
                    at = f[:, None] + np.arange(window)
                    at = np.where(at < e[:, None], bucket[np.minimum(at, len(bucket) - 1)], BUCKETS)
                    w = np.append(idf, 0)[at]
                    for of, latent, bits, weight in (x[1:] for x in queries.scales if x[0] == window):
                        near = vectors @ latent
                        i, j = np.divmod(np.flatnonzero(near >= cosine), near.shape[1])
                        own_at = np.minimum(at[i], BUCKETS - 1)
                        has = (bits[j[:, None], own_at >> 3] >> (7 - (own_at & 7)).astype(np.uint8)) & 1
                        shared = (w[i] * has).sum(1) >= OVERLAP * np.minimum(w[i].sum(1), weight[j])
                        for i, j in zip(i[shared].tolist(), j[shared].tolist(), strict=True):
                            k, item = int(doc[lo + i]), queries.items[of[j]]
                            if best.get((k, of[j]), (0,))[0] == 1.0:
                                continue
                            around = len(item.words) + max(4, len(item.words) // 2)
                            one, two = max(int(begins[k]), int(f[i]) - around), min(int(ends[k]), int(e[i]) + around)
                            share, tail, a, z = item.best(words[one:two].tolist(), cover)
                            if share and (tail >= answer or share >= SURE) and (share, tail) > best.get((k, of[j]), (0, 0))[:2]:
                                best[k, of[j]] = (share, tail, float(near[i, j]), one + a - int(begins[k]), one + z - int(begins[k]))
            hit = pa.array([k for k, _ in best], pa.int64())
            rows = [(queries.items[j].id, *m) for (_, j), m in best.items()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(hit), b.column(1).take(hit), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, (pa.int64(), *[pa.float64()] * 3, pa.int64(), pa.int64()), strict=True))], ["row", "doc_id", "item_id", "cover", "answer", "cosine", "first_word", "end_word"])

    return search


def matches(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, cover: float = COVER, answer: float = ANSWER, text: str = "text", key: str = "doc_id", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, cover, answer, cosine, first_word, end_word) for each item found in a document, best place first.

    Null and wordless documents and items match nothing; texts shorter than a window are one passage; repeated
    rows, and those without an id, each give their matches once per (doc_id, item_id). An empty table on either side gives
    no rows. Other columns are not looked at.
    """
    found = _found(keyed(docs), benchmark, cosine, cover, answer, text, key, item_key, item_text)
    best = F.max_by(F.struct("cover", "answer", "cosine", "first_word", "end_word"), F.struct("cover", "answer", "cosine", -F.col("first_word"))).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.*")


def without_matches(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, cover: float = COVER, answer: float = ANSWER, text: str = "text", key: str = "doc_id", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows in which no benchmark item was found, as they were.

    Each row is judged by its own text, whether its id is null or repeated or not; rows without text stay.
    """
    d = keyed(docs)
    return without(d, staged(_found(d, benchmark, cosine, cover, answer, text, key, item_key, item_text).select("row").distinct(), "contaminated"))
