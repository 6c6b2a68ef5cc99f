"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words (lower case, word characters), weighted by count times a damped IDF:
``1 + ln(N / df) / (2 ln COMMON)``, at most 1.5. Document frequencies are exact and of all documents; only shingles that
more than one in ``COMMON`` documents has weigh less than 1.5, so there are at most ``COMMON`` times the mean number of
shingles of a document of them, however large the corpus, and a pair of texts is as similar in a large corpus as in a
small one of the same kind. Improved consistent weighted sampling (ICWS) draws ``BANDS * ROWS`` samples of a document
so that two documents share each with the probability of their weighted Jaccard similarity; four samples make a band
key. Documents that share a band key are candidates, every link is verified by the exact weighted Jaccard
similarity, and classes are the components of links.

Scale: texts with the same words are folded into one node first. In a bucket of candidates only pairs of different
classes so far are of interest, and they are formed between the members outside the bucket's largest class and all
members, at most twice as many as are open. Where these are few for each member, all are compared. In larger buckets
rounds compare every member with one hub, the member with most neighbours (for copies of one text that is the text
itself, as every copy shares more with it than with other copies), so work stays linear in the members. What is
then still open is compared wherever two texts share a shingle of their prefixes, the rarest shingles that weigh more
than 1 - ``least`` of the text: texts as similar as that always do, so no pair is given up.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import CHUNKS, add_chunks, chunks, keyed, mix, plain_words, slices, staged, sum_chunks, unchunk, without, word_hashes

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 4
#: A shingle that fewer than one in so many documents has weighs 1.5, the most.
COMMON = 1000
#: Buckets of the first count, in which shingles that may be common are found; and of one part of it.
BITS, CHUNK = 21, 1 << 15
POOL = 1 << 16
#: A bucket with no more open pairs than this for each of its members is compared in full.
PAIRS_PER_MEMBER = 16
#: Rounds for the others at most, one hub each, while these find links; an exact prefix filter then finds the rest.
HUB_ROUNDS = 2

_rng = np.random.default_rng(20240607)
_r, _lnc, _beta = _rng.gamma(2.0, 1.0, POOL), np.log(_rng.gamma(2.0, 1.0, POOL)), _rng.random(POOL)
_z = np.argsort(_lnc - _r)
#: ICWS variates in order of the lower bound they set: an element's draw is never below LOW - ln(weight).
R, LNC, BETA = _r[_z], _lnc[_z], _beta[_z]
LOW = np.append(LNC - R, np.inf)
ODD = (np.random.default_rng(7).integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class Shingles:
    """Distinct shingles of each text of a batch: ``doc`` (row), ``h`` (hash, ascending within a row), ``tf``."""

    def __init__(self, column: pa.Array):
        self.words, self.ends = word_hashes(column)
        n = np.diff(self.ends, prepend=0)
        begins = self.ends - n
        w = mix(self.words)
        # A text of fewer words is one shingle, filled up by no word.
        short = np.flatnonzero((n > 0) & (n < WIDTH))
        own = np.zeros(len(short), np.uint64)
        for j in range(WIDTH):
            there = n[short] > j
            own += np.where(there, w[np.where(there, begins[short] + j, 0)], np.uint64(1)) * MULTIPLIERS[j] if len(short) else own
        total = max(len(w) - WIDTH + 1, 0)
        h = np.zeros(total, np.uint64)
        for j in range(WIDTH):
            h += w[j : total + j] * MULTIPLIERS[j]
        doc = np.repeat(np.arange(len(n)), n)
        inside = doc[:total] == doc[WIDTH - 1 :] if total else np.zeros(0, bool)
        h, doc = np.concatenate([h[inside], own]), np.concatenate([doc[:total][inside], short])
        if len(short):
            order = np.argsort(doc, kind="stable")
            h, doc = h[order], doc[order]
        h = mix(h)
        cut = np.searchsorted(doc, np.arange(len(n) + 1))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            h[a:b].sort()
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, np.int64)
        self.doc, self.h, self.tf = doc[first], h[first], np.diff(np.append(first, len(h)))

    def digest(self, row: int) -> bytes | None:
        own = self.words[self.ends[row - 1] if row else 0 : self.ends[row]]
        return blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Weights:
    """IDF factors: those of common shingles by hash, 1.5 for all others."""

    hashes: np.ndarray
    factors: np.ndarray
    uid: str = field(default_factory=lambda: uuid.uuid4().hex)

    def of(self, s: Shingles) -> np.ndarray:
        """The weight of each shingle of the batch."""
        out = np.full(len(s.h), 1.5)
        if len(self.hashes) and len(s.h):
            some = np.flatnonzero(_maybe(self)[_bucket(s.h)])
            at = np.minimum(np.searchsorted(self.hashes, s.h[some]), len(self.hashes) - 1)
            hit = self.hashes[at] == s.h[some]
            out[some[hit]] = self.factors[at[hit]]
        return out * s.tf


_MAYBE: dict[str, np.ndarray] = {}


def _maybe(weights: Weights) -> np.ndarray:
    """The buckets that hold a common shingle; a worker process keeps the last ones."""
    if weights.uid not in _MAYBE:
        _MAYBE.clear()
        table = np.zeros(1 << BITS, bool)
        table[_bucket(weights.hashes)] = True
        _MAYBE[weights.uid] = table
    return _MAYBE[weights.uid]


def inverse_frequencies(texts: DataFrame, n: int) -> Weights:
    """IDF factors from all ``n`` documents (text): exact document frequencies of all common shingles.

    A first pass counts shingles in buckets. A common shingle lies in a bucket with as high a count; with ``2 ** BITS``
    buckets the others stay below that for texts of up to about 2,000 shingles on average, and for longer ones the second
    pass only has more to count. It counts the shingles of the high buckets one by one.
    """
    least = max(1.0, n / COMMON)

    def count(batches):
        total = np.zeros(1 << BITS, np.int64)
        for b in slices(batches, 0):
            np.add.at(total, _bucket(Shingles(b.column(0)).h), 1)
        yield from chunks(total, CHUNK)

    def high(batches):
        for k, total in sum_chunks(batches).items():
            for b in chunks((total >= least).astype(np.int64), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array([k] * b.num_rows, pa.int32()), b.column(1)], ["chunk", "data"])

    maybe = np.zeros(1 << BITS, bool)
    for r in texts.mapInArrow(count, CHUNKS).repartition((1 << BITS) // CHUNK, "chunk").mapInArrow(high, CHUNKS).collect():
        maybe[r["chunk"] * CHUNK + unchunk(r["data"])[0]] = True
    packed = np.packbits(maybe)

    def exact(batches):
        table, waiting, size = np.unpackbits(packed).astype(bool), [], 0

        def out():
            h, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        for b in slices(batches, 0):
            s = Shingles(b.column(0))
            waiting.append(s.h[table[_bucket(s.h)]])
            size += len(waiting[-1])
            if size > 1 << 21:
                yield out()
                waiting, size = [], 0
        if size:
            yield out()

    found = texts.mapInArrow(exact, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = found.toArrow()
    h, df = rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy()
    order = np.argsort(h)
    factor = 1 + np.clip(np.log(max(n, 1) / df[order]) / np.log(COMMON), 0, 1) / 2
    return Weights(h[order].copy(), factor)


def sample(s: Shingles, weights: np.ndarray, n_rows: int) -> np.ndarray:
    """ICWS samples, (rows, BANDS * ROWS); rows without shingles stay 0.

    An element's variates come from a pool that is sorted by the least value they allow, and its pool place is a
    hash of its own for each sample. So only elements with low places need a full draw; a row whose best draw does not
    beat the bound of the others is drawn again in full, which makes the result exact.
    """
    out = np.zeros((n_rows, BANDS * ROWS), np.uint64)
    if not len(s.h):
        return out
    ln_s = np.log(weights)
    rows, start, n = np.unique(s.doc, return_index=True, return_counts=True)
    most = np.zeros(n_rows)
    most[rows] = np.maximum.reduceat(ln_s, start)
    cut = np.zeros(n_rows, np.int64)
    cut[rows] = np.minimum(POOL, np.ceil(POOL * 24 / n))
    bound = LOW[cut] - most

    def draw(k, h, doc, ln, limit):
        place = ((h * ODD[k]) >> np.uint64(48)).astype(np.int64)
        some = np.flatnonzero(place < limit)
        place, ln, doc = place[some], ln[some], doc[some]
        r, beta = R[place], BETA[place]
        t = np.floor(ln / r + beta)
        a = LNC[place] - r * (t - beta) - r
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        if not len(first):
            return doc, a, np.zeros(0, np.uint64)
        least = np.minimum.reduceat(a, first)
        best = np.flatnonzero(a == np.repeat(least, np.diff(np.append(first, len(a)))))
        best = best[np.diff(doc[best], prepend=-1) != 0]
        return doc[best], least, mix(h[some][best] + t[best].astype(np.int64).astype(np.uint64) * MULTIPLIERS[0] + np.uint64(k))

    limits = cut[s.doc]
    for k in range(BANDS * ROWS):
        doc, least, value = draw(k, s.h, s.doc, ln_s, limits)
        sure = (least < bound[doc]) | (cut[doc] == POOL)
        out[doc[sure], k] = value[sure]
        again = np.zeros(n_rows, bool)
        again[rows] = True
        again[doc[sure]] = False
        if again.any():
            own = again[s.doc]
            doc, _, value = draw(k, s.h[own], s.doc[own], ln_s[own], POOL)
            out[doc, k] = value
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """(rows, BANDS) signed 64-bit keys; a band's number is part of its keys."""
    parts = samples.reshape(len(samples), BANDS, ROWS)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for j in range(ROWS):
        h = mix(h * MULTIPLIERS[1] + parts[:, :, j])
    return h.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    return float(low / (a[1].sum() + b[1].sum() - low)) if len(a[0]) and len(b[0]) else 0.0


def verified(pairs: DataFrame, texts: DataFrame, weights: Weights, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (node, text) are at least so similar."""

    def check(batches):
        for b in slices(slices(batches, 2), 3):
            ids = [b.column(0).to_numpy(), b.column(1).to_numpy()]
            own, at = np.unique(np.concatenate(ids), return_index=True)
            s = Shingles(pa.concat_arrays([b.column(2), b.column(3)]).take(pa.array(at)))
            w = weights.of(s)
            cut = np.searchsorted(s.doc, np.arange(len(own) + 1)).tolist()
            vector = [(s.h[i:j], w[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]
            x, y = (np.searchsorted(own, i).tolist() for i in ids)
            keep = np.array([similarity(vector[i], vector[j]) >= least for i, j in zip(x, y, strict=True)], bool)
            yield pa.RecordBatch.from_arrays([pa.array(i[keep]) for i in ids], ["a", "b"])

    one, two = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def prefix_pairs(members: DataFrame, texts: DataFrame, weights: Weights, least: float) -> DataFrame:
    """Pairs (a, b) of members (node, class) of different classes that may be at least so similar; none is missed.

    Shingles are put in one order, by how many members have their hash bucket, then by hash. What two texts have in common
    lies behind the first shingle they share, and must weigh least / (1 + least) of both texts' sum; so each text may have
    no more before that shingle than is left of its weight. Any order gives all pairs; rare shingles first give few others.
    """
    own = staged(texts.join(members.hint("merge"), "node").select("node", "class", "text"), "open-texts")

    def count(batches):
        total = np.zeros(1 << BITS, np.int64)
        for b in slices(batches, 0):
            np.add.at(total, _bucket(Shingles(b.column(0)).h), 1)
        yield from chunks(total, CHUNK)

    # One byte for each bucket is enough for an order: 0 for a bucket of one.
    often = np.zeros(1 << BITS, np.uint8)
    for r in own.select("text").mapInArrow(count, CHUNKS).repartition((1 << BITS) // CHUNK, "chunk").mapInArrow(add_chunks, CHUNKS).collect():
        place, n = unchunk(r["data"])
        often[r["chunk"] * CHUNK + place] = np.minimum(8 * np.log2(n), 255)

    def prefixes(batches):
        for b in slices(batches, 2):
            s = Shingles(b.column(2))
            w, f = weights.of(s), often[_bucket(s.h)]
            order = np.lexsort((s.h, f, s.doc))
            doc, w, f = s.doc[order], w[order], f[order]
            upto = np.append(0, np.cumsum(w))
            cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
            before, total = upto[:-1] - upto[cut[doc]], (upto[cut[1:]] - upto[cut[:-1]])[doc]
            # No text that is near has less than ``least`` of the other's weight. The tolerance is for rounding of sums only.
            some = np.flatnonzero((before <= total * (1 - least + 1e-9)) & (f > 0))
            at = pa.array(doc[some])
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(s.h[order][some].view(np.int64)), pa.array(before[some]), pa.array(total[some])], ["node", "class", "h", "before", "total"])

    prefix = staged(own.mapInArrow(prefixes, "node long, class long, h long, before double, total double"), "prefixes")
    other = prefix.select("h", F.col("node").alias("other"), F.col("class").alias("other_class"), F.col("before").alias("other_before"), F.col("total").alias("other_total"))
    common = (F.col("total") + F.col("other_total")) * (least / (1 + least) - 1e-9)
    fits = (F.col("total") - F.col("before") >= common) & (F.col("other_total") - F.col("other_before") >= common)
    one = prefix.alias("p").join(other.alias("o").hint("merge"), (F.col("p.h") == F.col("o.h")) & (F.col("node") < F.col("other")) & (F.col("class") != F.col("other_class")) & fits)
    return one.select(F.col("node").alias("a"), F.col("other").alias("b"))


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, label) with the least node of each component, for nodes with a link; ``known`` labels count as links.

    Labels pass along links and are then shortened, until their sum no longer falls.
    """
    pairs = links.select("a", "b") if known is None else links.select("a", "b").unionByName(known.select(F.col("node").alias("a"), F.col("label").alias("b")))
    both = staged(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    total = None
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label").hint("merge"), "b").select(F.col("a").alias("node"), "label")
        step = labels.unionByName(seen).groupBy("node").agg(F.min("label").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        seen = Observation()
        now = step.join(jump.hint("merge"), "label").select("node", F.least("label", "far").alias("label"))
        labels = staged(now.observe(seen, F.sum(F.col("label").cast("decimal(38,0)")).alias("total")), "labels")
        if seen.get["total"] == total:
            return labels
        total = seen.get["total"]


def _classes(docs: DataFrame, least: float, text: str, key: str) -> DataFrame:
    """(row, doc_id, class_id, rep_id, node, first) of ``keyed`` documents; ``first``: the class's first row by id."""
    d = docs.select("row", F.col(f"doc.`{key}`").cast("long").alias("id"), plain_words(F.col(f"doc.`{text}`")).alias("text"))
    weights = inverse_frequencies(d.select("text"), docs.count())

    def sketch(batches):
        for b in slices(batches, 2):
            s = Shingles(b.column(2))
            keys = band_keys(sample(s, weights.of(s), b.num_rows))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.digest(i) for i in range(b.num_rows)], pa.binary()), pa.array([x.tobytes() for x in keys], pa.binary())], ["row", "id", "digest", "bands"])

    slim = d.mapInArrow(sketch, "row struct<file:long,at:long>, id long, digest binary, bands binary")
    # Nodes are numbered here, once: the numbers are written out. Rows without an id come last in their class.
    slim = staged(slim.withColumn("uid", F.monotonically_increasing_id()), "sketches")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "uid")
    reps = slim.where("digest IS NOT NULL").groupBy("digest").agg(F.min(rank).alias("first"), F.first("bands").alias("bands"))
    reps = staged(reps.select("digest", F.col("first.uid").alias("node"), "first", "bands"), "representatives")

    def spread(batches):
        for b in batches:
            keys = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], ["key", "node"])

    every = reps.select("node", "bands").mapInArrow(spread, "key long, node long")
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = staged(every.join(shared.hint("merge"), "key"), "buckets")
    degree = staged(buckets.groupBy("node").agg(F.sum("n").alias("degree")), "candidates")
    buckets = staged(buckets.join(degree.hint("merge"), "node").select("key", "node", "degree", F.col("node").alias("class")), "bucket-members")
    wanted = slim.select("row", F.col("uid").alias("node")).join(degree.select("node").hint("merge"), "node")
    texts = staged(d.select("row", "text").join(staged(wanted, "candidate-rows").hint("merge"), "row").select("node", "text"), "candidate-texts")

    labels = tested = None
    round_, exact = 0, False
    while True:
        per_class = buckets.groupBy("key", "class").agg(F.count("*").alias("n"))
        mixed = per_class.groupBy("key").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"), F.max(F.struct("n", "class")).alias("top"))
        mixed = mixed.where("all * all > same").select("key", F.col("top.class").alias("top"), ((F.col("all") * F.col("all") - F.col("same")) / 2 > PAIRS_PER_MEMBER * F.col("all")).alias("big"))
        m = staged(buckets.join(staged(mixed, "mixed-buckets").hint("merge"), "key"), "open-members")
        small, large = m.where("NOT big"), m.where("big")
        other = small.where("class <> top").select("key", F.col("node").alias("other"), F.col("class").alias("other_class"))
        pairs = small.join(other.hint("merge"), "key").where("class <> other_class AND (class = top OR node < other)")
        pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        some = large.limit(1).count() > 0
        if some and exact:
            pairs = pairs.unionByName(prefix_pairs(staged(large.select("node", "class").distinct(), "open-nodes"), texts, weights, least))
        elif some:
            # The hub is the member with most neighbours, later the one of classes that are not the bucket's largest.
            of = large if round_ == 0 else large.where("class <> top")
            hubs = of.groupBy("key").agg(F.max_by(F.struct("node", "class"), F.struct("degree", -F.col("node"))).alias("hub"))
            hubs = staged(hubs.select("key", F.col("hub.node").alias("hub"), F.col("hub.class").alias("hub_class")), "hubs")
            pairs = pairs.unionByName(large.join(hubs.hint("merge"), "key").where("class <> hub_class").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested.hint("merge"), ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        found = staged(verified(pairs, texts, weights, least), "verified")
        linked = found.limit(1).count() > 0
        if linked or labels is None:
            labels = components(found, labels)
        if not some or exact:
            break
        round_ += 1
        exact = round_ == HUB_ROUNDS or not linked
        tested = pairs if tested is None else tested.unionByName(pairs)
        of = labels.select(F.col("node").alias("of"), "label")
        buckets = large.select("key", "node", "degree").join(of.hint("merge"), F.col("node") == F.col("of"), "left")
        buckets = staged(buckets.select("key", "node", "degree", F.coalesce("label", "node").alias("class")), "bucket-members")

    firsts = reps.select("node", "first").join(labels.hint("merge"), "node").groupBy("label").agg(F.min("first").alias("class_first"))
    named = labels.join(staged(firsts, "class-firsts").hint("merge"), "label").select("node", "class_first")
    out = reps.select("digest", "node", "first").join(staged(named, "node-classes").hint("merge"), "node", "left")
    out = staged(out.select(F.col("digest").alias("of"), "node", "first", F.coalesce("class_first", "first").alias("class_first")), "classes")
    out = slim.select("row", "id", "uid", "digest").join(out.hint("merge"), F.col("digest") == F.col("of"), "left")
    alone = F.col("of").isNull()
    return out.select("row", F.col("id").alias("doc_id"), F.when(alone, F.col("id")).otherwise(F.col("class_first.id")).alias("class_id"), F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("rep_id"), (alone | (F.col("class_first.uid") == F.col("uid"))).alias("first"))


def classes(docs: DataFrame, least: float = SIMILARITY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, class_id (the least id of its class), rep_id (the least id with the same words).

    Null texts and texts without a word are never near anything: class_id and rep_id are their own ids. Texts of fewer
    than five words are one shingle, so only equal words make them near. Rows that share an id are judged each by its
    own text. A row without an id is judged too; the id of a class is null only where all its rows have none. Other
    columns are not looked at. An empty table gives no rows.
    """
    return _classes(keyed(docs), least, text, key).select("doc_id", "class_id", "rep_id")


def one_of_each(docs: DataFrame, least: float = SIMILARITY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each class, as it was: that with the least id, nulls last; among equal ids one of them.

    Null texts and texts without a word stay, all of them.
    """
    d = keyed(docs)
    return without(d, staged(_classes(d, least, text, key).where("NOT first").select("row"), "near-copies"))
