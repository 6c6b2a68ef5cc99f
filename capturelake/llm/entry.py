"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontamination, language_id, mixing, near_dedup, periodic_runs, quality, sharding, token_counts, token_output, unit_dedup, url_filter, vector_search, whitening
from .common import table


def op1_decontamination(spark, sf_dir):
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = language_id.learn(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    return language_id.identify(docs, counts).select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op3_token_output(spark, sf_dir):
    import public_tokenizers

    path = token_output.new_folder(spark)
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read_tokens(spark, path, with_ids=False)


def op4_substring_dedup(spark, sf_dir):
    return unit_dedup.repeated_units(table(spark, sf_dir, "documents"), "sentence", unit_dedup.PASSAGE_WORDS)


def op5_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.bad_hosts(pages)).select("page_id", "host", "path", "rule", "verdict")


def op7_vector_search(spark, sf_dir):
    return vector_search.nearest(table(spark, sf_dir, "embeddings"))


def op8_quality(spark, sf_dir):
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_near_dedup(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op10_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


_ALL = (op1_decontamination, op2_language_id, op3_token_output, op4_substring_dedup, op5_token_counts, op6_url_filter, op7_vector_search, op8_quality, op9_near_dedup, op10_mixing, op11_whitening, op12_sharding, op13_periodic_runs)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {"op4_substring_dedup": unit_dedup.ORACLE, "op6_url_filter": url_filter.ORACLE, "op7_vector_search": vector_search.ORACLE, "op10_mixing": mixing.ORACLE}
