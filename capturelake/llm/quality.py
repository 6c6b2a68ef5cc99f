"""Quality classification by importance resampling.

Two bag models over hashed n-grams are compared: one of the target (documents labelled good) and one of the raw
text (all documents). A document's log weight is the log ratio of its probabilities. Adding Gumbel noise and
keeping the k largest samples k documents without replacement in proportion to their weights.

N-grams: words, and pairs of neighbouring word shapes in which a word's exact repetition is a shape of
its own. The raw model counts every document. The target model and the cut are fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_unit, histogram, keyed, slices, staged, without

#: Buckets of each of the two hashed models' halves (words, shape pairs).
BUCKETS = 1 << 15
#: The fit takes about so many labelled documents, picked by a hash of the id.
LABELLED_ROWS = 20_000
BINS = 4096
GOOD_COUNTS = 4


class _Words(dict):
    """Word -> hash of the word (low half) and of its shape (high half); emptied when large."""

    runs = re.compile(r"(.)\1+")

    def __missing__(self, word: str) -> int:
        from zlib import crc32

        shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
        shape = self.runs.sub(r"\1+", shape)
        out = crc32(word.encode("utf-8", "surrogatepass")) | (crc32(shape.encode("utf-8", "surrogatepass")) & 0x7FFFFFFF) << 32
        if len(word) <= 64:  # words of no natural length are computed, not remembered
            if len(self) > 300_000:
                self.clear()
            self[word] = out
        return out


#: Shared by the tasks of a worker process.
_WORDS = _Words()


def features(texts: list[str | None], words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram, and the document (row) of each."""
    split = [t.split() if t else [] for t in texts]
    n = np.fromiter(map(len, split), np.int64, len(split))
    h = np.fromiter((words[w] for s in split for w in s), np.int64, int(n.sum()))
    doc = np.repeat(np.arange(len(split)), n)
    word, shape = h & 0xFFFFFFFF, h >> 32
    one = (word * 0x9E3779B1 >> 13) & (BUCKETS - 1)
    same = doc[1:] == doc[:-1]
    repeat = (word[1:] == word[:-1]) & same
    two = np.where(repeat, 7, (shape[:-1] * 31 + shape[1:]) * 0x9E3779B1 >> 11) & (BUCKETS - 1)
    return np.concatenate([one, BUCKETS + two[same]]), np.concatenate([doc, doc[1:][same]])


def fit(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """Log ratio of target and raw for each bucket; ``sample`` (id, good) has a documented bound and is sent to all."""
    flagged = docs.join(F.broadcast(sample.where("good = 1").select("id", F.lit(True).alias("target"))), "id", "left").select("text", F.coalesce("target", F.lit(False)))

    def count(batches):
        total, words = np.zeros(4 * BUCKETS, np.int64), _WORDS
        for b in slices(batches, 0):
            bucket, doc = features(b.column(0).to_pylist(), words)
            total[: 2 * BUCKETS] += np.bincount(bucket, minlength=2 * BUCKETS)
            good = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            if good.any():
                total[2 * BUCKETS :] += np.bincount(bucket[good[doc]], minlength=2 * BUCKETS)
        return total

    raw, target = histogram(flagged, count, 4 * BUCKETS).reshape(2, 2, BUCKETS).astype(float)
    if not target.sum():
        return np.zeros(2 * BUCKETS)
    # Smoothing towards the raw model keeps what the small sample never saw at a ratio near 1.
    prior = raw / np.maximum(raw.sum(1, keepdims=True), 1)
    strength = 2 * BUCKETS
    t = (target + strength * prior + 1e-9) / (target.sum(1, keepdims=True) + strength)
    r = (raw + strength * prior + 1e-9) / (raw.sum(1, keepdims=True) + strength)
    return np.log(t / r).ravel()


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(row, id, log_weight, n_grams) of every whole text (row, id, text).

    Null and wordless texts weigh 0. Rows are weighed one by one, whatever their ids; an empty table gives no rows.
    """

    def score(batches):
        words = _WORDS
        for b in slices(batches, 2):
            bucket, doc = features(b.column(2).to_pylist(), words)
            total = np.bincount(doc, ratio[bucket], minlength=b.num_rows).astype(float)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(total), pa.array(np.bincount(doc, minlength=b.num_rows))], ["row", "id", "log_weight", "n_grams"])

    return docs.select("row", "id", "text").mapInArrow(score, "row struct<file:long,at:long>, id long, log_weight double, n_grams long")


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The log weight that parts labelled documents best; the middle, if several do.

    The shares of both classes that fall on their side are summed; losing good documents counts GOOD_COUNTS times.
    """
    if not len(weights) or good.all() or not good.any():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    below = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    above = 1 - np.concatenate([[0], np.cumsum(g)]) / g.sum()
    value = below + GOOD_COUNTS * above
    ends = np.concatenate([[w[0] - 1], w, [w[-1] + 1]])
    ok = np.flatnonzero((value >= value.max() - 1e-12) & (np.diff(ends) > 0))
    return float((ends[ok[0]] + ends[ok[-1] + 1]) / 2)


def top_k_cut(rows: DataFrame, k: int) -> tuple[float, int] | None:
    """(key, id) of the k-th of the rows (gumbel, id) by key descending, id ascending: bins are halved down to it."""
    lo, hi = rows.agg(F.min("gumbel"), F.max("gumbel")).first()
    while True:
        here = rows.where(F.col("gumbel").between(lo, hi))
        if hi <= lo or (hi - lo) / BINS <= abs(hi) * 1e-15 or here.limit(BINS + 1).count() <= BINS:
            break
        step = (hi - lo) / BINS
        bins = {r["b"]: r["count"] for r in here.groupBy(F.least(F.floor((F.col("gumbel") - lo) / step), F.lit(BINS - 1)).alias("b")).count().collect()}
        for b in sorted(bins, reverse=True):
            if k <= bins[b]:
                break
            k -= bins[b]
        edge = here.where(F.least(F.floor((F.col("gumbel") - lo) / step), F.lit(BINS - 1)) == b).agg(F.min("gumbel"), F.max("gumbel")).first()
        lo, hi = edge[0], edge[1]
    got = here.orderBy(F.desc("gumbel"), "id").limit(k).agg(F.min("gumbel").alias("g")).first()["g"]
    above = here.where(F.col("gumbel") > got).count()
    last = here.where(F.col("gumbel") == got).orderBy("id").limit(k - above).agg(F.max("id")).first()[0]
    return got, last


def _resampled(docs: DataFrame, labels: DataFrame, k: int | None, seed: str, text: str, key: str, quality: str) -> DataFrame:
    """(row, doc_id, log_weight, gumbel, kept) of ``keyed`` documents."""
    d = docs.select("row", F.col(f"doc.`{key}`").cast("long").alias("id"), F.col(f"doc.`{text}`").alias("text"))
    known = labels.where(F.col(quality).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(F.min(quality).alias("good"))
    share = LABELLED_ROWS / max(1, known.count())
    sample = known.where(F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1 << 20)) < share * (1 << 20))
    ratio = fit(d, sample)
    scored = weigh(d, ratio).withColumn("gumbel", F.col("log_weight") - F.log(-F.log(hash_unit(F.col("id"), seed))))
    scored = staged(scored, "quality-weights")
    if k is None:
        # A row for each labelled row of the sample; rows that repeat an id count together, by their mean weight.
        seen = scored.join(F.broadcast(sample), "id").groupBy("id", "good").agg(F.avg("log_weight").alias("w")).select("w", "good").toArrow()
        cut = best_cut(seen.column(0).to_numpy(), seen.column(1).to_numpy() == 1)
        k = scored.where(F.col("log_weight") >= cut).count() if np.isfinite(cut) else None
    if k is None or k >= scored.count():
        kept = F.lit(True)
    elif k <= 0:
        kept = F.lit(False)
    else:
        at, last = top_k_cut(scored, k)
        kept = (F.col("gumbel") > at) | ((F.col("gumbel") == at) & F.coalesce(F.col("id") <= F.lit(last), F.lit(last is None)))
    return scored.select("row", F.col("id").alias("doc_id"), "log_weight", "gumbel", kept.alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: str = "gumbel-1", text: str = "text", key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """One row per document: doc_id, log_weight, gumbel, kept.

    ``k``: documents to keep; by default as many as weigh no less than the cut that parts good and bad labels
    best. Without labels of both kinds all are kept. A null or wordless text has log weight 0. Several labels of
    a document count as bad if one is; rows that share an id share their noise and are weighed each by its own text; rows
    without an id share theirs. Ties at the cut go to smaller ids, rows without an id last; rows with the same id and
    weight stay or go together. Other columns are not looked at. An empty table gives no rows.
    """
    return _resampled(keyed(docs), labels, k, seed, text, key, quality).select("doc_id", "log_weight", "gumbel", "kept")


def kept_documents(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: str = "gumbel-1", text: str = "text", key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """The rows that ``resample`` keeps, as they were; each row by its own decision, also where ids are null or repeated."""
    d = keyed(docs)
    return without(d, staged(_resampled(d, labels, k, seed, text, key, quality).where("NOT kept").select("row"), "rejected"))
