"""A corpus pipeline of five stages over the operators of capturelake.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back as the
next one's docs. All but the last return the columns of docs, whatever these are called, and no rows for an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from capturelake.llm import decontamination, mixing, near_dedup, quality, token_output
from capturelake.llm.common import scratch_dir, staged, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier rejects go.

    Each row has its own decision, also where ids are null or repeated; null and wordless texts have log weight 0.
    """
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies stays, the one with the least id, null ids last.

    Null and wordless texts have no copies and stay. Of rows that repeat an id and a text one stays.
    """
    return near_dedup.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark item go, whatever their ids; rows without text stay."""
    return decontamination.without_matches(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; a source above its budget loses rows, a small one repeats some.

    Null and wordless texts have no size and are not taken; a null source is a source of its own.
    """
    return mixing.mixed_documents(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix in the block file format, read back: doc_id, start, n_tokens, ids_crc32.

    Every row comes back, null ids first; a null text has the end id alone. An empty table gives no rows.
    """
    import public_tokenizers

    path = token_output.new_folder(spark)
    token_output.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read_tokens(spark, path, with_ids=False)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-copy removal", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("source mixing", mix_sources),
    ("token output", write_ids),
]

#: SQL cannot express hashing, sampling and coding of these stages; tests hold each stage and the whole against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
