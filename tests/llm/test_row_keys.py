"""Rows that went through explode, joins, unions and samples keep keys of their own; mixing does not depend on the order of rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from capturelake.llm import common, decontamination, mixing, near_dedup, quality, unit_dedup  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame([(i, f"text of number {i}", "en", "a", i) for i in range(5)], DOCS).write.parquet(path)
    return spark.read.parquet(path)


def test_keys_differ(spark, stored):
    parts = F.array(*[F.lit(x) for x in ("a", "b")])
    tables = {
        "scan": (stored.where("doc_id > 0").select("doc_id", "text").withColumnRenamed("text", "t"), 4), "explode": (stored.withColumn("chunk", F.explode(parts)), 10), "posexplode": (stored.select("*", F.posexplode(parts)), 10),
        "cross join": (stored.crossJoin(spark.range(3)), 15), "join": (stored.join(stored.select("doc_id", F.col("text").alias("other")), "doc_id"), 5), "union": (stored.unionByName(stored), 10), "sample": (stored.sample(True, 3.0, 5), None),
        "limit": (stored.limit(3), 3), "rows": (spark.createDataFrame([(1,), (1,)], "a int"), 2), "range": (spark.range(7), 7), "group": (stored.groupBy("lang").count(), 1), "sorted": (stored.orderBy("text"), 5),
    }
    for name, (d, n) in tables.items():
        rows = common.keyed(d).select("row").collect()
        assert len(set(rows)) == len(rows) and (n is None or len(rows) == n), name


def test_chunks_of_one_document_are_rows_of_their_own(spark, tmp_path):
    """Two documents cut to (0, b), (1, a), (1, b), (1, c), each a text of its own."""
    text = {c: " ".join(f"{c}{i}" for i in range(60)) + "." for c in "abc"}
    path = str(tmp_path / "d")
    spark.createDataFrame([(0, ["b"], 1), (1, ["a", "b", "c"], 1)], "doc_id long, parts array<string>, n int").write.parquet(path)
    cut = spark.read.parquet(path).select("doc_id", F.explode("parts").alias("part"))
    docs = cut.withColumn("text", F.create_map(*[F.lit(x) for p in text.items() for x in p])[F.col("part")])
    names = lambda d: sorted((r.doc_id, r.part) for r in d.collect())
    assert names(near_dedup.one_of_each(docs)) == [(0, "b"), (1, "a"), (1, "c")]
    clean = unit_dedup.cleaned(docs, "line").select("doc.doc_id", "doc.part", "clean_text").collect()
    assert {(r.doc_id, r.part): bool(r.clean_text) for r in clean} == {(0, "b"): True, (1, "a"): True, (1, "b"): False, (1, "c"): True}
    bench = spark.createDataFrame([(5, text["b"])], "item_id long, text string")
    assert names(decontamination.without_matches(docs, bench)) == [(1, "a"), (1, "c")]
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    kept = Counter(names(quality.kept_documents(docs, labels, k=4)))
    assert max(kept.values(), default=1) == 1 and set(kept) <= {(0, "b"), (1, "a"), (1, "b"), (1, "c")}


def test_mixing_agrees_in_any_order(spark):
    """Null ids, one id for many rows, equal rows and null texts: the same counts for each text in any order and partitions."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, None if i % 97 == 0 else " ".join(["word"] * (i % 23 + 1)) + f" {i % 400}", "en", "abc"[i % 7 % 3], i) for i in range(2000)] + [(5, "the same row", "en", "a", 1)] * 40
    d = spark.createDataFrame(rows, DOCS)
    counts = []
    for docs in (d, d.orderBy(F.desc("n_chars")), d.repartition(7, "text"), d.orderBy(F.rand(3)).coalesce(1)):
        with_text = mixing.mix(docs, whole=True).select("doc_id", F.col("_row.text").alias("text"), F.col("_row.source").alias("source"), "size", "target", "taken").collect()
        counts.append(Counter(map(str, with_text)))
    assert all(c == counts[0] for c in counts) and len(counts[0]) > 100
