"""Exact percentiles of many keys at once, by refining histograms instead of holding a key's values.

``percentile`` keeps all different values of a key in one task. Here only groups of at most ``MOST`` values go to it. For larger ones the ranks
that a percentile needs are looked for: values are counted by exponent, then by ``BINS`` equal parts of the part that holds the
rank, and so on until a part has one value or at most ``MOST``. Each pass is a scan with partial sums; a task's state is bounded by
the number of large groups and bins. Doubles have 52 bits below their exponent and a pass settles 12 of them, so five passes do for
any data; one or two are usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import staged

MOST, BINS = 50_000, 4096
#: Up to so many ranks of large groups they are sent to all executors; beyond it they are joined by a shuffle.
BROADCAST_RANKS = 100_000


def _exponent(v: Column) -> Column:
    """A whole number that rises with the value: by sign and binary exponent, infinities and NaN at the ends."""
    e = F.floor(F.log2(F.abs(v))).cast("long") + 1200
    size = F.when(F.abs(v) == float("inf"), 4000).otherwise(e)
    return F.when(F.isnan(v), 5000).when(v == 0, 0).when(v > 0, size).otherwise(-size).cast("long")


def _part(v: Column, lo: Column, hi: Column) -> Column:
    """Which of ``BINS`` equal parts of lo..hi holds the value; parts rise with it, and lo and hi are in different ones."""
    return F.least(F.floor((v - lo) / (hi - lo) * BINS), F.lit(BINS - 1)).cast("long")


def exact_percentiles(rows: DataFrame, key: Sequence[str], measures: dict[str, tuple[Column, float]]) -> DataFrame:
    """One row per key with each measure: the percentile (0..1) of a column, as ``percentile`` gives it.

    Nulls are skipped, NaN is the greatest value; a key without values has null. Null keys are keys.
    """
    k = list(key)
    columns: list[tuple[str, Column]] = []
    of: dict[str, int] = {}
    for name, (c, _) in measures.items():
        found = next((i for i, (text, _) in enumerate(columns) if text == str(c)), len(columns))
        if found == len(columns):
            columns.append((str(c), c.cast("double")))
        of[name] = found
    values = F.filter(F.array(*[F.struct(F.lit(i).alias("m"), c.alias("v")) for i, (_, c) in enumerate(columns)]), lambda s: s["v"].isNotNull())
    long = rows.select(*k, F.explode(values).alias("s")).select(*k, "s.m", "s.v")
    large = staged(long.groupBy(*k, "m").agg(F.count("*").alias("n")).where(F.col("n") > MOST), "large-groups")
    some = large.limit(1).count()

    def same(d, other, names):
        """``d`` joined with ``other``, which has ``names`` with a mark in front."""
        on = F.col("m") == F.col("_m")
        for c in k:
            on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return d.join(other, on, names)

    marked = lambda d: d.withColumnsRenamed({c: f"_{c}" for c in (*k, "m")})
    if not some:
        aggregates = [F.percentile(columns[of[name]][1], F.lit(q)).alias(name) for name, (_, q) in measures.items()]
        return rows.groupBy(*k).agg(*aggregates)

    def hinted(d):
        return F.broadcast(d) if d.limit(BROADCAST_RANKS + 1).count() <= BROADCAST_RANKS else d.hint("merge")

    small = same(long, hinted(marked(large.select(*k, "m"))), "left_anti")
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(of[name]).alias("of"), F.lit(float(q)).alias("q")) for name, (_, q) in measures.items()])
    asked = large.select(*k, "m", "n", F.explode(wanted).alias("w")).where("w.of = m").withColumn("at", F.col("w.q") * (F.col("n") - 1))
    asked = staged(asked.select(*k, "m", "w.name", "at", F.floor("at").alias("lower"), F.ceil("at").alias("upper")), "asked-ranks")
    ranks = asked.select(*k, "m", F.col("lower").alias("rank")).unionByName(asked.select(*k, "m", F.col("upper").alias("rank"))).distinct()
    ranks = staged(ranks.select(*k, "m", "rank", F.lit(0).cast("long").alias("base"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(None).cast("long").alias("n")), "ranks")
    done, first = [], True
    while True:
        bin_ = _exponent(F.col("v")) if first else _part(F.col("v"), F.col("lo"), F.col("hi"))
        inside = same(long, hinted(marked(ranks)), "inner")
        inside = inside if first else inside.where("v >= lo AND v <= hi")
        parts = inside.groupBy(*k, "m", "rank", "base", bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        # One row for each part of a group that is looked into: at most BINS.
        before = F.coalesce(F.sum("n").over(Window.partitionBy(*k, "m", "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        parts = parts.withColumn("base", F.col("base") + before).where("rank >= base AND rank < base + n")
        parts = staged(parts.select(*k, "m", "rank", "base", "lo", "hi", "n"), "ranks")
        one = F.col("lo").eqNullSafe(F.col("hi"))
        done.append(parts.where(one).select(*k, "m", "rank", F.col("lo").alias("value")))
        few = parts.where(~one & (F.col("n") <= MOST))
        picked = same(long, hinted(marked(staged(few, "ranks"))), "inner").where("v >= lo AND v <= hi")
        picked = picked.groupBy(*k, "m", "rank", "base").agg(F.array_sort(F.collect_list("v")).alias("all"))  # at most MOST values
        done.append(picked.select(*k, "m", "rank", F.get("all", (F.col("rank") - F.col("base")).cast("int")).alias("value")))
        ranks, first = parts.where(~one & (F.col("n") > MOST)), False
        if ranks.limit(1).count() == 0:
            break
    found = done[0]
    for d in done[1:]:
        found = found.unionByName(d)
    found = staged(found, "ranked")
    pick = lambda side: found.withColumnsRenamed({**{c: f"_{c}" for c in (*k, "m")}, "rank": f"{side}_rank", "value": side})
    out = asked
    for side, rank in (("_l", "lower"), ("_u", "upper")):
        out = same(out, hinted(pick(side)), "inner").where(F.col(rank) == F.col(f"{side}_rank")).drop(*[f"_{c}" for c in (*k, "m")], f"{side}_rank")
    value = F.when(F.col("lower") == F.col("upper"), F.col("_l")).otherwise(F.col("_l") * (F.col("upper") - F.col("at")) + F.col("_u") * (F.col("at") - F.col("lower")))
    out = out.select(*k, "name", value.alias("value"))
    held = small.groupBy(*k, "m").agg(F.percentile("v", F.array(*[F.lit(float(q)) for q in sorted({q for _, q in measures.values()})])).alias("all"))
    qs = sorted({q for _, q in measures.values()})
    each = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(of[name]).alias("of"), F.lit(qs.index(q)).alias("i")) for name, (_, q) in measures.items()])
    held = held.withColumn("w", F.explode(each)).where("w.of = m").select(*k, "w.name", F.get("all", F.col("w.i")).alias("value"))
    every = out.unionByName(held).groupBy(*k).agg(*[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in measures])
    # Keys without any value.
    bare = rows.select(*k).distinct().select(*k, *[F.lit(None).cast("double").alias(n) for n in measures])
    return every.unionByName(bare).groupBy(*k).agg(*[F.max(n).alias(n) for n in measures])


def joined(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of two tables with one row a key each, null keys included."""
    k = list(key)
    on = F.lit(True)
    for c in k:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(right.withColumnsRenamed({c: f"_{c}" for c in k}).hint("merge"), on).drop(*[f"_{c}" for c in k])
