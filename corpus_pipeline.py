"""A corpus pipeline over ``documents``: five operators in a row.

Quality rules clean the texts and drop what they reject, toxic documents go,
one document of each group of near-copies stays (five-word shingles,
similarity 0.8), the sources are mixed to their target weights, and the mix
is encoded as token ids. Each stage takes what its predecessor kept, as
written Parquet; all but the last return the columns of ``documents``, whatever
further columns there are.

Defined results for odd input: a null, empty or short text fails the quality rules;
very long texts are handled whole by every stage; rows without an id are judged by
their texts and never count as copies; rows that repeat an id are told apart by
their texts, so of equal rows one stays and of different ones each is judged by
itself; ties (equal sizes, hashes or ids) are settled by id and text; a null source is a
source of its own; an empty table stays empty through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.llm import bpe, jaccard, mixing, quality, toxicity
from aerolap.llm.catalog import vocabulary
from aerolap.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    scorer = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return docs.where(toxicity.score(docs["text"], scorer, spark) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (packed) and the digest of the decoded bytes."""
    rows = bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"),
                                vocabulary(spark), digests=True)
    return rows.select("doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256")


STAGES = [("quality_rules", quality_rules), ("toxicity", drop_toxic),
          ("ngram_jaccard", drop_near_copies), ("source_mix", mix_sources),
          ("byte_bpe", encode)]

#: Learning, links and merges are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
