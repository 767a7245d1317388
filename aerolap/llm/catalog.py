"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from aerolap.llm import (
    bpe,
    covertree,
    decontamination,
    jaccard,
    langid,
    licenses,
    merkle,
    mixing,
    oracle,
    packing,
    quality,
    sharding,
    toxicity,
    whitening,
)
from aerolap.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary(spark) -> bpe.Vocabulary:
    return bpe.Vocabulary(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op1_packed_rows(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(spark))


def op2_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_balanced_shards(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), n=24)


def op4_source_mix(spark, sf_dir):
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scorer = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", toxicity.score(F.col("text"), scorer, spark).alias("score"))
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_page_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                vocabulary(spark), out=None, digests=True)


def op8_quality_rules(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"), k=3, percent=90)


def op10_embedding_copies(spark, sf_dir):
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op11_whitened_embeddings(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark, sf_dir):
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_packed_rows, op2_license_scan, op3_balanced_shards, op4_source_mix, op5_toxicity,
    op6_page_language, op7_byte_bpe, op8_quality_rules, op9_ngram_jaccard, op10_embedding_copies,
    op11_whitened_embeddings, op12_decontamination, op13_merkle_manifest)}

#: Learning (5, 6), ids and packing (1, 7), propagation (3) and eigenvectors (11) are not SQL;
#: they are tested against brute force, round trips and held-out rows.
ORACLE_SQL = {
    "op2_license_scan": oracle.OP2_LICENSE_SCAN,
    "op4_source_mix": mixing.ORACLE_SQL,
    "op8_quality_rules": oracle.OP8_QUALITY_RULES,
    "op9_ngram_jaccard": oracle.OP9_NGRAM_JACCARD,
    "op10_embedding_copies": oracle.OP10_EMBEDDING_COPIES,
    "op12_decontamination": decontamination.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
}
