"""Exact top-k by integer inner product: KD-trees per shard.

Vectors are dealt into shards of bounded size by a hash of their id. Each shard becomes a KD-tree: median splits on
the widest dimension, leaves and inner nodes with tight bounding boxes. The greatest inner product of a query and
a box is ``sum(max(q * low, q * high))``; a best-first traversal opens boxes in that order and stops at the
first bound below the query's kth score. Queries go out in blocks: first each block meets one shard, and the kth
scores found there travel with the block to all other shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Rows of a shard and queries of a block, about.
SHARD_ROWS, BLOCK_QUERIES = 4096, 128
LEAF = 64
#: Products and sums below this are exact in doubles; larger ones are computed with Python's integers.
EXACT = float(1 << 52)


def scaled(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as long, null if the vector or a component is null or not finite."""
    ok = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return F.when(ok, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


class Tree:
    """Nodes in order of creation; a node is a range of rows with a box, leaves have no children."""

    def __init__(self, ids: np.ndarray, uids: np.ndarray, x: np.ndarray):
        order = np.arange(len(x))
        self.low, self.high, self.child, self.span = [], [], [], []
        stack = [(0, len(x), -1, 0)]
        while stack:
            a, e, parent, side = stack.pop()
            rows = x[order[a:e]]
            low, high = rows.min(0), rows.max(0)
            me = len(self.low)
            self.low.append(low)
            self.high.append(high)
            self.child.append([-1, -1])
            self.span.append((a, e))
            if parent >= 0:
                self.child[parent][side] = me
            width = high - low
            if e - a > LEAF and width.max() > 0:
                mid = (e - a) // 2
                order[a:e] = order[a:e][np.argpartition(rows[:, width.argmax()], mid)]
                stack += [(a + mid, e, me, 1), (a, a + mid, me, 0)]
        self.ids, self.uids, self.x = ids[order], uids[order], x[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(queries, nodes): the greatest product that a point of the node's box can have."""
        return np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T

    def search(self, q_uids: np.ndarray, q: np.ndarray, kth: list, k: int) -> list[tuple[int, int, int, int]]:
        """(query number, number, id, score) of up to k best rows of each query with scores of at least its ``kth``."""
        out, bounds = [], self.bounds(q)
        for i, own in enumerate(q_uids.tolist()):
            bound, least = bounds[i], kth[i]
            queue, rows, scores = [(-bound[0], 0)], np.zeros(0, np.int64), np.zeros(0, self.x.dtype)
            while queue and -queue[0][0] >= least:
                _, node = heapq.heappop(queue)
                left, right = self.child[node]
                if left >= 0:
                    for c in (left, right):
                        if bound[c] >= least:
                            heapq.heappush(queue, (-bound[c], c))
                    continue
                a, e = self.span[node]
                score = self.x[a:e] @ q[i]
                good = np.flatnonzero((score >= least) & (self.uids[a:e] != own))
                if len(good):
                    rows, scores = np.append(rows, a + good), np.append(scores, score[good])
                    if len(rows) > k:
                        best = np.lexsort((self.uids[rows], self.ids[rows], -scores))[:k]
                        rows, scores = rows[best], scores[best]
                        least = max(least, scores[-1])
            out += [(own, int(u), int(r), int(s)) for u, r, s in zip(self.uids[rows].tolist(), self.ids[rows].tolist(), scores.tolist(), strict=True)]
        return out


def _matrix(data: bytes, width: int) -> np.ndarray:
    x = np.frombuffer(data, np.int64).reshape(-1, width)
    top = float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0
    return x.astype(np.float64) if top * top * max(width, 1) < EXACT else x.astype(object)


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether both are doubles whose products are exact, or both are Python's integers."""
    if a.dtype != np.float64 or b.dtype != np.float64:
        return a.dtype == b.dtype
    return float(np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(a.shape[1], 1) < EXACT


def _integers(a: np.ndarray) -> np.ndarray:
    return a if a.dtype == object else a.astype(np.int64).astype(object)


def _packed(rows: DataFrame, by: str) -> DataFrame:
    """(width, by, ids, uids, data): each group's rows as three blobs; groups are of bounded size by a hash of the row's number."""

    def pack(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("uid")
        x = np.array(t["v"].tolist(), np.int64)
        return pd.DataFrame({"width": [t["width"].iloc[0]], by: [t[by].iloc[0]], "ids": [t["id"].to_numpy(np.int64).tobytes()], "uids": [t["uid"].to_numpy(np.int64).tobytes()], "data": [x.tobytes()]})

    return rows.groupBy("width", by).applyInPandas(pack, f"width int, {by} int, ids binary, uids binary, data binary")


LOWEST = -(1 << 63) + 1
_FOUND = ["q_uid", "uid", "vec_id", "score"]


def _found(pairs: DataFrame, k: int) -> DataFrame:
    """(q_uid, uid, vec_id, score) of joined rows of a shard and a query block with the kth scores known for it."""

    def run(batches):
        tree, made = None, None
        for b in batches:
            for r in (r for lo in range(b.num_rows) for r in b.slice(lo, 1).to_pylist()):
                if made != (r["width"], r["shard"]):
                    made, x = (r["width"], r["shard"]), _matrix(r["data"], r["width"])
                    tree = Tree(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["uids"], np.int64), x)
                q = _matrix(r["q_data"], r["width"])
                if not _exact(tree.x, q):
                    tree.x, tree.low, tree.high, q = map(_integers, (tree.x, tree.low, tree.high, q))
                numbers, known = np.frombuffer(r["q_uids"], np.int64), {x["q_uid"]: x["score"] for x in r["known"] or []}
                rows = tree.search(numbers, q, [known.get(n, LOWEST) for n in numbers.tolist()], k)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 4)], _FOUND)

    return pairs.mapInArrow(run, ", ".join(f"{c} long" for c in _FOUND))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best others by score, ties to the smaller vec_id.

    Queries are the rows whose id is divisible by ``every``. Vectors that are null, empty, or hold a null or a value that
    isn't finite take no part, nor do rows without an id; vectors meet those of their own length only. Rows that share an id are
    rows of their own: each is a query with its own k results if the id is divisible, and a candidate of all others. Fewer
    than k candidates are all returned; an empty table gives no rows. Other columns are not looked at.
    """
    d = vectors.select(F.col(key).cast("long").alias("id"), scaled(F.col(vector), scale).alias("v")).where("id IS NOT NULL AND size(v) > 0")
    d = staged(d.select("id", "v", F.size("v").alias("width"), F.monotonically_increasing_id().alias("uid")), "vectors")
    n = d.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n // (every * BLOCK_QUERIES)))
    block = lambda c: F.pmod(F.xxhash64(c, F.lit(2)), F.lit(blocks)).cast("int")
    trees = staged(_packed(d.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(shards)).cast("int")), "shard"), "shards")
    asked = d.where(F.pmod("id", F.lit(every)) == 0)
    q = staged(_packed(asked.withColumn("block", block(F.col("uid"))), "block").select("width", "block", F.col("uids").alias("q_uids"), F.col("data").alias("q_data")), "query-blocks")

    home = q.withColumn("shard", F.pmod(F.col("block"), F.lit(shards)).cast("int"))
    nothing = F.lit(None).cast("array<struct<q_uid: bigint, score: bigint>>")
    first = staged(_found(home.withColumn("known", nothing).join(trees.hint("merge"), ["width", "shard"]), k), "first-scores")
    order = Window.partitionBy("q_uid").orderBy(F.desc("score"), "vec_id", "uid")
    kth = first.withColumn("r", F.row_number().over(order)).where(F.col("r") == k)
    known = kth.groupBy(block(F.col("q_uid")).alias("block")).agg(F.collect_list(F.struct("q_uid", "score")).alias("known"))  # one row of each of a block's queries

    rest = home.join(known.hint("merge"), "block", "left").withColumnRenamed("shard", "home")
    rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    rest = _found(rest.repartition("width", "shard").join(trees.hint("merge"), ["width", "shard"]), k)
    best = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select(F.col("uid").alias("q_uid"), F.col("id").alias("query_id"))
    return best.join(names.hint("merge"), "q_uid").select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len(embedding) > 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(b.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
