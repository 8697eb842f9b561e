"""The corpus pipeline: documents through five operators, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``, the last one returns doc_id and token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwarden.llm import decontaminate, host_rules, jaccard_join, piece_sampling, suffix_levels
from tillwarden.llm.text import table
from tillwarden.session import materialise

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Length of a repeated string in the third stage. Passages of more than 50 words are meant; of
#: those that repeat in the test corpus 98 of 100 have this many bytes, but only 74 have 400.
PASSAGE_BYTES = 200


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules themselves and whose host does."""
    return host_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    return jaccard_join.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; bytes covered by strings of PASSAGE_BYTES that start elsewhere too are cut out."""
    return suffix_levels.without_repeats(docs, PASSAGE_BYTES)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens: a sampled segmentation of each text, which decodes to it exactly."""
    encoded = piece_sampling.encode(docs, PIECES)
    return encoded.selectExpr("doc_id", "ids", "size(ids) AS n_tokens")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_items),
    ("SentencePiece encoding", token_ids),
]

#: Neither the similarity join nor the sampled segmentation can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, from the documents table; each result is written before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
