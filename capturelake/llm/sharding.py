"""Sharding by Karmarkar-Karp differencing: groups of equal texts, which stay together, go to shards of nearly equal bytes.

A partial partition holds ``shards`` sums. At first every item is one, with its size in one place and 0 in the others. The
two of the largest spread are combined again and again, the largest sums of one with the smallest of the other, until one is
left; the pairings, followed back, give each item its shard.

Differencing is sequential, so it gets a summary of bounded size: a group of at least ``1 / (shards * FINENESS)`` of
all bytes is an item of its own (there are at most ``shards * FINENESS`` of them), and the others are dealt by a hash of their text
into ``shards * FINENESS`` bundles, each an item. So at most ``2 * shards * FINENESS`` items meet in one task, whatever the input; small
tables have hardly more than one group in a bundle. The two tables that lead rows to shards are bounded alike and broadcast:
texts are read once, rows are shuffled once, for their places in the shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SHARDS = 24
FINENESS = 1024
#: Bytes of a document besides its text.
HEAD = 8


def differenced(sizes: list[int], shards: int) -> np.ndarray:
    """The shard of each item by Karmarkar-Karp differencing; ties of spread go to the item, or pair, that came first."""
    if not sizes:
        return np.zeros(0, np.int64)
    # Sums fall from left to right and the last is 0, as only differences count: the spread is the first.
    sums, sides = [], []
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    one = np.zeros(shards, np.int64)
    get = lambda k: np.concatenate([[sizes[k]], one[1:]]) if k < n else sums[k - n]
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = get(a) + get(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        for k in (a, b):
            if k >= n:
                sums[k - n] = None
        sums.append(both - both[-1])
        sides.append((a, b, order))
        heapq.heappush(heap, (-int(sums[-1][0]), n + len(sides) - 1))
    shard = np.zeros(n, np.int64)
    names: dict[int, np.ndarray] = {heap[0][1]: np.arange(shards)}
    for k in range(len(sides) - 1, -1, -1):
        a, b, order = sides[k]
        mine = np.empty(shards, np.int64)
        mine[order] = names.pop(n + k)
        for child, place in ((a, mine), (b, mine[::-1])):
            if child < n:
                shard[child] = place[0]
            else:
                names[child] = place
    if n == 1:
        shard[0] = 0
    return shard


def _dealt(items: DataFrame, shards: int) -> DataFrame:
    """(kind, item) -> shard, of a table of bounded size."""

    def deal(batches):
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        rows.sort(key=lambda r: (-r[2], r[0], r[1]))
        where = differenced([r[2] for r in rows], shards)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array(where, pa.int32())], ["kind", "item", "shard"])

    return items.select("kind", "item", "size").repartition(1).mapInArrow(deal, "kind int, item long, shard int")


def shard_documents(docs: DataFrame, shards: int = SHARDS, fineness: int = FINENESS, head: int = HEAD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null under this law).

    Size is the text's UTF-8 bytes and ``head``. Equal texts share a shard; a null text counts as an empty one. Slots count from 0 within a shard without gaps, by id (null first), size and CRC; which of fully equal
    rows gets which slot does not show. A group above the mean of all shards fills one by itself. Null and repeated ids are rows like others. The result does not depend
    on the order or partitions of the rows. An empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("text"))
    # Different texts of one hash would share a shard too, which no rule forbids.
    d = d.select("doc_id", (F.octet_length("text") + head).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("own"))
    d = staged(d, "shard-rows")
    groups = staged(d.groupBy("own").agg(F.sum("size").alias("size")), "shard-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    bundles = shards * fineness
    large = F.col("size") * F.lit(bundles).cast("decimal(20,0)") >= F.lit(total).cast("decimal(20,0)")
    bundle = F.pmod(F.xxhash64("own", F.lit(12)), F.lit(bundles))
    alone = groups.where(large).select(F.lit(0).alias("kind"), F.col("own").alias("item"), "size")
    rest = groups.where(~large).groupBy(bundle.alias("item")).agg(F.sum("size").alias("size")).select(F.lit(1).alias("kind"), "item", "size")
    where = staged(_dealt(alone.unionByName(rest), shards), "shard-items")
    # At most ``bundles`` rows each.
    alone = where.where("kind = 0").select(F.col("item").alias("own"), F.col("shard").alias("alone"))
    rest = where.where("kind = 1").select(F.col("item").alias("bundle"), F.col("shard").alias("dealt"))
    d = d.withColumn("bundle", bundle).join(F.broadcast(alone), "own", "left").join(F.broadcast(rest), "bundle", "left")
    d = d.select("doc_id", "size", "text_crc32", F.coalesce("alone", "dealt").alias("shard"))

    # Places in shards: rows are sorted by ranges, each range begins where the ones before it end.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["shard", "doc_id", "size", "text_crc32"]
    d = d.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "nth").sortWithinPartitions(*order, "nth").drop("nth")
    d = staged(d.withColumn("at", F.monotonically_increasing_id()), "shard-order").withColumn("part", F.shiftright("at", 33))
    # A row for each range and each further shard that it meets: at most parts + shards.
    ranges = d.groupBy("part", "shard").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = staged(ranges.select("part", "shard", (before - F.col("first")).alias("shift")), "shard-ranges")
    d = d.join(F.broadcast(ranges), ["part", "shard"])
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
