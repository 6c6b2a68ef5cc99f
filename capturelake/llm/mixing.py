"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / weight`` with ``u`` from a hash of its id (of its text, where it has none), so that
a rerun agrees. Within a source documents are taken in key order up to the source's word budget. A budget above
the source's size first takes complete epochs of all its documents and then selects the rest. All of it
is DataFrame functions.

A source may hold any share of the rows: keys are dealt into ``BUCKETS`` ranges of equal probability,
sums by (source, bucket) show in which bucket the budget ends, and only documents of that one bucket are
sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_unit, staged

BUCKETS = 4096
#: Up to so many sources their targets are sent to all executors; beyond it they are joined by a shuffle.
BROADCAST_SOURCES = 20_000
CAP = 3
CYCLE = 3
WORDS = r"[^\x20\x09-\x0D]+"


def text_weight(text: Column, size: Column) -> Column:
    """Quality weight of a text: 1 where its words have 2 to 12 characters on average, else one half."""
    mean = (F.length(text) - (size - 1)) / F.when(size > 0, size).cast("double")
    return F.when(mean.between(2.0, 12.0), 1.0).otherwise(0.5)


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> target: shares 1, 2, 3, 1, ... in code point order (null last) of all words.

    A target stops at CAP times its source's size and the excess is shared again by weight until none is above.
    That ends at ``min(CAP * size, level * weight)``; sorted by ``size / weight`` the capped sources come
    first, so one pass finds the level: that of the first source that isn't capped, the greatest. One row per source; sources without words get 0.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", (F.col("rank") - 1) % CYCLE + 1)
    d = d.withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
    d = d.withColumn("before_size", F.coalesce(F.sum("source_size").over(by_ratio), F.lit(0))).withColumn("before_weight", F.coalesce(F.sum("weight").over(by_ratio), F.lit(0)))
    d = d.withColumn("level", (F.col("total") - CAP * F.col("before_size")) / (F.col("weights") - F.col("before_weight")).cast("double"))
    d = d.withColumn("capped", CAP * F.col("source_size") <= F.col("level") * F.col("weight"))
    d = d.withColumn("final_level", F.max(F.when(~F.col("capped"), F.col("level"))).over(everything))
    return d.select("source", "source_size", F.when(F.col("capped"), (CAP * F.col("source_size")).cast("double")).otherwise(F.col("final_level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, seed: str = "mix-1", weight: Column | None = None, text: str = "text", source: str = "source", key: str = "doc_id", whole: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted).

    A null or wordless text has size 0 and is never taken; a null source is a source of its own; rows that share an id follow
    each other by a hash of their texts and are each counted; a row without an id has its place by its text. So reruns agree in
    any order of rows: only fully equal rows may change places. A document at the end of the budget is taken when
    that brings the sum nearer to the target. An empty table gives no rows. Other columns are not looked at.
    ``weight``: a positive quality weight, by default from the text's mean word length.
    ``whole``: also the document itself, a struct ``_row``.
    """
    row = ["_row"] if whole else []
    d = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"), *([F.struct(*docs.columns).alias("_row")] if whole else []))
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    d = d.withColumn("size", size)
    w = F.greatest(F.coalesce(weight if weight is not None else text_weight(F.col("text"), F.col("size")), F.lit(1.0)), F.lit(1e-6))
    # A row without an id is known by its text; rows that share an id are told apart by it where their order matters.
    d = d.withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    own = F.coalesce(F.col("doc_id").cast("string"), F.when(F.col("text").isNotNull(), F.col("digest")))
    d = d.select("doc_id", "source", "size", F.xxhash64("digest").alias("tie"), (-F.log(hash_unit(own, seed)) / w).alias("key"), *row)
    # Keys of weight 1 are exponential, so 1 - exp(-key) deals them evenly; for others it still keeps the order.
    d = d.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    slim = staged(d, "mix-keys")
    sums = staged(slim.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-sums")
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    ends = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))).alias("s")
    ends = ends.join(targets.alias("t").hint("merge"), F.col("s.source").eqNullSafe(F.col("t.source"))).where("s.upto > t.rest")
    ends = ends.groupBy(F.col("s.source").alias("source")).agg(F.min(F.struct(F.col("s.bucket").alias("bucket"), (F.col("s.upto") - F.col("s.words")).alias("before"))).alias("end"))
    plan = staged(targets.alias("t").join(ends.alias("e").hint("merge"), F.col("t.source").eqNullSafe(F.col("e.source")), "left").select("t.*", F.col("end.bucket").alias("last"), F.col("end.before").alias("before")), "mix-targets")

    side = plan.withColumnRenamed("source", "of")
    side = F.broadcast(side) if plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else side.hint("merge")
    d = slim.join(side, F.col("source").eqNullSafe(F.col("of")))
    within = Window.partitionBy("source").orderBy("key", "doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    rest = d.where(F.col("last").isNull() | (F.col("bucket") != F.col("last"))).withColumn("fits", F.col("last").isNull() | (F.col("bucket") < F.col("last")))
    edge = d.where(F.col("bucket") == F.col("last")).withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    edge = edge.withColumn("fits", F.col("ahead") + F.col("size") / 2.0 <= F.col("rest")).drop("ahead")
    taken = F.col("size") * (F.col("epochs") + F.when(F.col("fits") & (F.col("epochs") < CAP), 1).otherwise(0))
    return rest.unionByName(edge).select("doc_id", "size", "source_size", "target", taken.alias("taken"), *row)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as the mix takes them; the columns stay as they are.

    Each row is taken by its own size, also where ids are null or repeated. Null and wordless texts are never taken.
    """
    # Rows carry their own counts: ids may be null or repeated.
    d = mix(docs, whole=True, **options).where("taken > 0")
    return d.withColumn("_copy", F.explode(F.expr("sequence(1L, taken div size)"))).select("_row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
k AS (
  SELECT doc_id, source, size,
    -ln((CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), md5(text), 'null')), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496)
      / CASE WHEN size > 0 AND (length(text) - (size - 1)) / CAST(size AS DOUBLE) BETWEEN 2 AND 12 THEN 1.0 ELSE 0.5 END AS key FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS rnk FROM k GROUP BY source),
b AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(source_size) OVER w, 0) AS before_size, coalesce(sum(weight) OVER w, 0) AS before_weight
  FROM s WINDOW w AS (ORDER BY source_size / CAST(weight AS DOUBLE), rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, CAST(total - 3 * before_size AS DOUBLE) / CAST(weights - before_weight AS DOUBLE) AS lev FROM b),
c AS (SELECT *, 3 * source_size <= lev * weight AS capped FROM l),
t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE) ELSE max(CASE WHEN NOT capped THEN lev END) OVER () * weight END AS target FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
o AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN epochs < 3 AND ahead + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""
