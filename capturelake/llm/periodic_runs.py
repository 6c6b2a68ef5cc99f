"""Periodic runs of words in each text, found by seeds that are extended along their diagonal.

A run is a stretch of consecutive words with smallest period ``q`` that is at least ``max(shortest, times * q)`` long and that
no neighbouring word extends. Along the diagonal of lag ``q`` (word ``i`` against word ``i + q``) it is a stretch of
matches of at least ``max(shortest, times * q) - q`` words, the guaranteed overlap.

Lags are taken in classes [1, 2), [2, 4), [4, 8) and so on; a class seeds with k-grams of the least overlap that its lags and greater ones guarantee. With
``times`` >= 3 that ``k`` is at least each period of the class, so within a run a k-gram comes back after exactly one period: if
it came back earlier, both distances were periods of a stretch as long as their sum, and the run had a smaller period. So
only occurrences that follow each other are paired: a text of n words has at most n pairs a class, whatever it repeats.
A table of the furthest word covered on each lag keeps seeds of one stretch from extending it again.

K-grams are compared by exact ranks: ranks of 2^(j+1)-grams come from pairs of ranks of 2^j-grams, and grams that occur
once in their document leave the table, so that for prose it is nearly empty after four words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, slices

TIMES, SHORTEST = 4, 6
#: The white space that parts words.
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last one) of every word, and where each text's words end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = WORD_BYTE[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    # A text that begins right after the last word of the one before it.
    seams = offsets[1:-1]
    seams = seams[(seams > 0) & (seams < len(data))]
    seams = seams[inside[seams + 1] & inside[seams]]
    first[seams], last[seams - 1] = True, True
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, stop, np.searchsorted(start, offsets[1:], "left")


def word_ids(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, by their bytes."""
    if not len(start):
        return np.zeros(0, np.int64)
    step = np.zeros(len(data) + 1, np.int8)
    step[start] += 1
    np.subtract.at(step, stop, 1)
    bodies = data[np.cumsum(step[:-1]).astype(bool)]
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(stop - start, out=ends[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(bodies)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _repeated(rank: np.ndarray, at: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, group) of the pairs (rank here, rank ``ahead``) that occur twice or more, by group and position."""
    key = rank[at] * (int(rank.max(initial=0)) + 1) + rank[at + ahead]
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key) + 1, bool)
    new[1:-1] = key[1:] != key[:-1]
    twice = ~(new[:-1] & new[1:])
    return at[order[twice]], np.cumsum(new[:-1])[twice]


def _reach(ids: np.ndarray, at: int, lag: int, bound: int, step: int) -> int:
    """How far words equal those ``lag`` ahead, from ``at`` on towards ``bound`` (exclusive) in steps of +1 or -1; chunks double."""
    size = 8
    while at != bound:
        n = min(size, abs(bound - at))
        block = slice(at, at + n) if step > 0 else slice(at - n + 1, at + 1)
        same = ids[block] == ids[block.start + lag : block.stop + lag]
        bad = np.flatnonzero(~(same if step > 0 else same[::-1]))
        if len(bad):
            return at + step * int(bad[0])
        at, size = at + step * n, size * 2
    return at


def find_runs(ids: np.ndarray, ends: np.ndarray, times: int = TIMES, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the texts whose words are numbered by ``ids``; text t ends before word ``ends[t]``.

    Starts count from the first text's first word. Sorted by start, then period.
    """
    assert times >= 3, "below three periods a k-gram may come back within one period"
    n = len(ids)
    if not n:
        return []
    begins = np.concatenate([[0], ends[:-1]])
    sizes = ends - begins
    begin, end = np.repeat(begins, sizes), np.repeat(ends, sizes)
    longest = int(sizes.max())
    # Ranks of single words tell texts apart, so that only grams of one text are equal.
    rank = np.repeat(np.arange(len(ends)), sizes) * (int(ids.max()) + 1) + ids
    if len(ends) > 1:
        rank = np.unique(rank, return_inverse=True)[1]
    level, found = 0, []
    lag = 1
    while max(shortest, times * lag) <= longest:
        k = min(max(shortest, times * q) - q for q in (lag, shortest // times, shortest // times + 1) if q >= lag)
        while 2 << level <= k:
            at = np.flatnonzero(rank >= 0)
            at = at[at + (2 << level) <= end[at]]
            at = at[rank[at + (1 << level)] >= 0]
            at, group = _repeated(rank, at, 1 << level)
            rank = np.full(n, -1, np.int64)
            rank[at] = group
            level += 1
        at = np.flatnonzero(rank >= 0)
        at = at[at + k <= end[at]]
        ahead = k - (1 << level)
        at = at[rank[at + ahead] >= 0]
        if not len(at):
            if 1 << level <= 2 * lag:  # longer grams do not repeat either
                break
            lag *= 2
            continue
        at, group = _repeated(rank, at, ahead)
        gap = at[1:] - at[:-1]
        seed = (group[1:] == group[:-1]) & (gap >= lag) & (gap < 2 * lag)
        seed &= np.maximum(gap * times, shortest) <= (end - begin)[at[:-1]]
        first, gap = at[:-1][seed], gap[seed]
        order = np.lexsort((first, gap))
        first, gap = first[order], gap[order]
        if len(first):
            # Seeds side by side on one diagonal are one stretch already.
            new = np.ones(len(first) + 1, bool)
            new[1:-1] = (gap[1:] != gap[:-1]) | (first[1:] != first[:-1] + 1)
            head, tail = np.flatnonzero(new[:-1]), np.flatnonzero(new[1:])
            covered: dict[int, int] = {}
            for i, j, q in zip(first[head].tolist(), first[tail].tolist(), gap[head].tolist(), strict=True):
                if i < covered.get(q, 0):
                    continue
                lo = _reach(ids, i - 1, q, int(begin[i]) - 1, -1) + 1
                hi = _reach(ids, j + k, q, int(end[i]) - q, 1)
                covered[q] = hi
                if hi - lo + q >= max(shortest, times * q):
                    found.append((lo, hi - lo + q, q))
        lag *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


_OUT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _batches(batches: Iterator[pa.RecordBatch], times: int, shortest: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 1):
        data, offsets = column_bytes(b.column(1))
        start, stop, ends = words_of(data, offsets)
        runs = find_runs(word_ids(data, start, stop), ends, times, shortest)
        begins = np.concatenate([[0], ends[:-1]])
        keep = np.ones(len(start), bool)
        for s, length, q in runs:
            keep[s + q : s + length] = False
        text = np.searchsorted(ends, [r[0] for r in runs], "right") if runs else np.zeros(0, np.int64)
        own = [(s - int(begins[t]), length, q) for (s, length, q), t in zip(runs, text.tolist(), strict=True)]
        bounds = np.zeros(b.num_rows + 1, np.int32)
        np.cumsum(np.bincount(text, minlength=b.num_rows), out=bounds[1:])
        columns = [pa.array([r[c] for r in own], pa.int64()) for c in range(3)]
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(columns, fields=list(_RUN)))
        # Kept words and one blank after each; the last one's goes again.
        size = np.where(keep, stop - start + 1, 0)
        to = np.cumsum(size) - size
        out = np.full(int(size.sum()), 0x20, np.uint8)
        kept = np.zeros(len(data) + 1, np.int8)
        kept[start[keep]] += 1
        np.subtract.at(kept, stop[keep], 1)
        place = np.ones(len(out), bool)
        place[(to + size)[keep] - 1] = False
        out[place] = data[np.cumsum(kept[:-1]).astype(bool)]
        upto = np.concatenate([[0], np.cumsum(size)])
        lo, hi = upto[begins], upto[ends]
        body = out.tobytes()
        collapsed = [body[a : e - 1].decode("utf-8", "replace") if e > a else "" for a, e in zip(lo.tolist(), hi.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ends - begins, pa.int64()), lists, pa.array(collapsed, pa.string())], ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, times: int = TIMES, shortest: int = SHORTEST, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text.

    Words are parted by ASCII white space and numbered from 0. ``collapsed`` has the words that no run contains after its
    first period, joined by single blanks. Null, empty and blank texts have no words, no runs and an empty collapsed text. Runs
    may overlap and several may start at one word. Rows are worked off by themselves: null ids and repeated rows come back
    as often as they are there. An empty table gives no rows. Other columns are not looked at.
    """
    d = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return d.mapInArrow(lambda batches: _batches(batches, times, shortest), f"id long, {_OUT}").withColumnRenamed("id", "doc_id")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every tenth document (by the CRC of its id) made periodic from some word on; rows without an id stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", h.alias("h"))
    d = d.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    n = F.size("words")
    g = F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    whole = F.concat_ws(" ", F.slice("words", F.lit(1), a), F.slice(tail, F.lit(1), n - a))
    return d.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), whole).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent, and digests of all runs and of the collapsed text."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # Exact, as the ratios are compared crosswise; of equal ones the first stays.
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))))
    d = found.withColumn("best", best)
    exponent = F.expr("(1000 * best.length) div best.period")
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", exponent.alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
