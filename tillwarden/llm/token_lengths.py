"""Exact token counts of a corpus for every context limit.

Documents are counted by encoded length once; everything else follows from that histogram by
suffix sums. With d(L) documents of exactly L tokens, a limit L keeps
``sum(min(length, L)) = tokens of documents up to L + L * documents longer than L`` tokens.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwarden.llm.text import chunks
from tillwarden.llm.word_encoder import WordEncoder
from tillwarden.session import materialise

#: Lengths that share a task when sums run over the histogram.
BLOCK = 4096


def document_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens of every whole text; missing and empty texts have 0 tokens."""

    def count(batches):
        encoder = WordEncoder(tokenizer)
        for chunk in chunks(batches):
            yield pa.RecordBatch.from_arrays([chunk.batch.column("doc_id"), pa.array(encoder.lengths(chunk))], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, n_docs: one row per length that occurs. Written once, since all that follows
    reads it more than once and texts should be encoded once."""
    return materialise(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")))


def limits(counts: DataFrame) -> DataFrame:
    """One row per length L that occurs, taken as a context limit: documents of that length,
    at most and longer than it, all tokens, tokens kept if every document is cut to L, and the
    share of documents that fit (so a quantile q is the least L with share_fitting >= q).

    Between two rows the sums are linear in the limit, so the rows answer every limit. Sums run
    within blocks of lengths; only one row per block goes through a single task.
    """
    rows = counts.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("_t", F.col("n_tokens") * F.col("n_docs"))
    above = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = (
        rows.groupBy("_block")
        .agg(F.sum("n_docs").alias("_d"), F.sum("_t").alias("_s"))
        .select(
            "_block",
            F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_docs_above"),
            F.coalesce(F.sum("_s").over(above), F.lit(0)).alias("_tokens_above"),
            F.sum("_d").over(everything).alias("_docs"),
            F.sum("_s").over(everything).alias("_tokens"),
        )
    )
    longer = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    docs_longer = F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("_docs_above")
    tokens_longer = F.coalesce(F.sum("_t").over(longer), F.lit(0)) + F.col("_tokens_above")
    return (
        rows.join(blocks, "_block")
        .withColumn("docs_longer", docs_longer)
        .withColumn("_tokens_longer", tokens_longer)
        .select(
            "n_tokens",
            "n_docs",
            (F.col("_docs") - F.col("docs_longer")).alias("docs_fitting"),
            "docs_longer",
            F.col("_tokens").alias("total_tokens"),
            (F.col("_tokens") - F.col("_tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("kept_tokens"),
            ((F.col("_docs") - F.col("docs_longer")) / F.col("_docs")).alias("share_fitting"),
        )
    )


def quantile(table: DataFrame, share: float) -> DataFrame:
    """The least limit that lets ``share`` of the documents fit (one row, none if no document)."""
    return table.filter(F.col("share_fitting") >= share).agg(F.min("n_tokens").alias("n_tokens")).filter("n_tokens IS NOT NULL")


def kept_at(counts: DataFrame, limit: int) -> DataFrame:
    """Tokens kept at any limit, from the histogram alone."""
    return counts.agg(F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("kept_tokens"))
