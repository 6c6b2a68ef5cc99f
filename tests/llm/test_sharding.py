"""Sharding against plain differencing, its rules, and odd rows."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from capturelake.llm import sharding  # noqa: E402
from capturelake.llm.entry import QUERIES  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain(sizes, shards):
    """The final sums of differencing, with whole partitions as lists."""
    parts = [[(s, [i])] + [(0, [])] * (shards - 1) for i, s in enumerate(sizes)]
    order = list(range(len(parts)))
    while len(order) > 1:
        order.sort(key=lambda k: (parts[k][-1][0] - parts[k][0][0], k))
        a, b = order[0], order[1]
        both = [(x + y, i + j) for (x, i), (y, j) in zip(sorted(parts[a], key=lambda p: -p[0]), sorted(parts[b], key=lambda p: p[0]), strict=True)]
        both.sort(key=lambda p: -p[0])
        order = [k for k in order if k not in (a, b)] + [len(parts)]
        parts.append(both)
    return sorted(sum(sizes[i] for i in group) for _, group in parts[order[0]])


@pytest.mark.parametrize("shards, n", [(2, 5), (2, 60), (3, 1), (3, 41), (24, 7), (24, 300)])
def test_differencing_against_plain_code(shards, n):
    sizes = sorted(((i * 7919) % 1009 + 3 for i in range(n)), reverse=True)
    where = sharding.differenced(sizes, shards)
    sums = [0] * shards
    for s, k in zip(sizes, where.tolist(), strict=True):
        sums[k] += s
    assert sorted(sums) == plain(sizes, shards)
    if n > 20 * shards:
        assert max(sums) - min(sums) <= 8


def rules(rows, docs, shards):
    """Every row has its size and CRC, equal texts share a shard and slots count from 0."""
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    by, slots, sums = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        by[r.text_crc32, r.size].add(r.shard)
        slots[r.shard].append(r.slot)
        sums[r.shard] += r.size
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(len(s) == 1 for s in by.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sums


def test_query_keeps_its_rules(spark, data_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()]
    rows = QUERIES["op12_sharding"](spark, data_dir).collect()
    sums = rules(rows, docs, 24)
    mean = sum(sums.values()) / 24
    largest = max(Counter(t for _, t in docs).items(), key=lambda p: p[1] * len(p[0].encode()))
    assert max(sums.values()) <= max(1.01 * mean, largest[1] * (len(largest[0].encode()) + 8))
    # Another order and other partitions of the rows give the same result.
    again = sharding.shard_documents(spark.read.parquet(f"{data_dir}/documents.parquet").orderBy(F.desc("doc_id")).repartition(5)).collect()
    assert sorted(again) == sorted(rows)


def test_bundles_and_odd_rows(spark):
    """Many small groups share bundles; one group is larger than a shard; nulls, empty texts, repeated rows, clashing columns."""
    docs = [(i, f"text {i % 900} " + "x" * (i % 53)) for i in range(3000)] + [(None, "hot " * 50)] * 400 + [(7, None), (None, None), (7, None), (8, ""), (8, ""), (9, "y" * 30_000)]
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS)
    for c in ("size", "own", "shard", "at", "bundle", "part", "item"):
        d = d.withColumn(c, F.lit("clash"))
    rows = sharding.shard_documents(d, shards=4, fineness=8).collect()
    sums = rules(rows, docs, 4)
    assert max(sums.values()) == 400 * 208 or max(sums.values()) < 1.02 * sum(sums.values()) / 4
    assert sorted(sharding.shard_documents(d.repartition(6), shards=4, fineness=8).collect(), key=str) == sorted(rows, key=str)
    assert sharding.shard_documents(d.limit(0)).count() == 0
    assert [(r.shard, r.slot) for r in sharding.shard_documents(d.where("text = ''"), shards=3).orderBy("slot").collect()] in [[(k, 0), (k, 1)] for k in range(3)]
