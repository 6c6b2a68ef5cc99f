"""Queries of the subpackage against DuckDB, and the pipeline's stages on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

from capturelake.llm.entry import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, data_dir, name):
    con = duckdb.connect()
    for p in glob.glob(f"{data_dir}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    got = QUERIES[name](spark, data_dir)
    names = sorted(got.columns)
    want = con.sql(f"select {', '.join(f'\"{n}\"' for n in names)} from ({ORACLES[name]})").fetchall()
    flat = lambda rows: Counter(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)
    assert flat(got.select(*names).collect()) == flat(want)


def test_pipeline(spark, data_dir):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    seen = {r.doc_id for r in docs.select("doc_id").collect()}
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = seen
        docs = stage(spark, docs, data_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen = {r.doc_id for r in docs.select("doc_id").collect()}
        assert seen and seen <= before and (n == 3 or len(seen) < len(before))
    out = corpus_pipeline.run(spark, data_dir)
    assert out.count() > 0 and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_stages_with_odd_rows(spark, data_dir):
    """Null and repeated ids, null, empty and very long texts, equal rows, clashing columns, and an empty table."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    some = spark.read.parquet(f"{data_dir}/documents.parquet")
    item = spark.read.parquet(f"{data_dir}/benchmark.parquet").first().text
    base = some.orderBy("doc_id").limit(30).collect()
    long = " ".join(f"word{i}" for i in range(120_000))
    rows = [tuple(r) for r in base] + [(None, base[3].text, "en", "src0", 1), (None, item, None, None, None), (5, item, "en", "src1", 2), (5, None, "en", "src1", 0), (None, None, None, None, None), (900, "", "en", "", 0), (901, long, "en", "src2", 3), (902, long, "en", "src2", 3), (902, long, "en", "src2", 3)]
    docs = spark.createDataFrame(rows, some.schema)
    for c in ("row", "doc", "id", "label", "node", "class", "kept", "_metadata", "size", "key", "bucket", "removed"):
        docs = docs.withColumn(c, docs.doc_id.cast("string"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data_dir)
        assert out.columns == docs.columns
        kept[name] = Counter((r.doc_id, r.text) for r in out.select("doc_id", "text").collect())
        assert stage(spark, docs.limit(0), data_dir).count() == 0
    every = Counter((r[0], r[1]) for r in rows)
    near, clean, mixed = (kept[corpus_pipeline.STAGES[k][0]] for k in (1, 2, 3))
    assert not kept["quality classifier"] - every
    assert (None, base[3].text) not in near and near[901, long] == 1 and near[902, long] == 0 and near[None, None] == 1 == near[5, None]
    assert (None, item) not in clean and (5, item) not in clean and clean[5, None] == 1 and clean[902, long] == 2
    assert (5, None) not in mixed and set(mixed) <= set(every) and all(mixed[k] <= 3 * n for k, n in every.items())
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, data_dir)
    assert sorted(r.doc_id is None for r in tokens.collect()) == sorted(r[0] is None for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), data_dir).count() == 0


def test_pipeline_equals_its_operators(spark, data_dir):
    """The run's rows are those of the library's tokenizer over what the stages before it keep, in order."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data_dir)
    t, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in sorted(docs.select("doc_id", "text").collect()):
        ids = [*t.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, data_dir).collect())) == want
