"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, size: int) -> DataFrame:
    """At most ``size`` documents with a label: label and the columns of ``docs`` (doc_id, text and
    others that have an order).

    The ids are those with the least hashes, so the sample depends on the rows only. Conflicting
    labels of an id count as the least; missing labels and ids are left out. Of rows that share
    an id the greatest text is taken, so that one id can't fill the sample. Only ``size`` ids are
    sent to the tasks.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & allowed)
    picked = known.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = F.max(F.struct("text", *rest)).alias("one")
    held = docs.withColumn("doc_id", F.col("doc_id").cast("long")).join(F.broadcast(picked), "doc_id")
    return held.groupBy("doc_id", "label").agg(one).select("doc_id", "label", "one.*")
