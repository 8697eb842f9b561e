"""Token ids as Parquet list columns that can be read selectively.

One row per document in ascending id order, in files that are ranges of ids. The list column is
dictionary encoded (token ids repeat a lot); the long columns are delta encoded (format v2
without a dictionary). Row groups and pages have a set size and a page index, so a reader that
asks for some ids opens few pages, and one that asks for lengths reads no token.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwarden.llm.text import chunks
from tillwarden.llm.word_encoder import WordEncoder

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
STORED = "doc_id long, n_tokens long, ids array<int>"


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens, ids of every whole text (missing: empty), ``end_id`` last."""

    def encode(batches):
        encoder = WordEncoder(tokenizer)
        for chunk in chunks(batches):
            ids, first = encoder(chunk)
            n = np.diff(first)
            end = first[1:] + np.arange(len(n))
            values = np.empty(len(ids) + len(n), np.int32)
            own = np.ones(len(values), bool)
            own[end] = False
            values[own], values[end] = ids, end_id
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, end + 1).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([chunk.batch.column("doc_id"), pa.array(n + 1), lists], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, STORED)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode documents into ``path``. Texts are dealt into ranges of ids (equal ids by the hash
    of their text, so one repeated id doesn't fill a file), then encoded where they are stored:
    text is smaller than its ids, and no id list is shuffled.

    Missing ids come last and stay missing; an empty table gives an empty folder of files.
    """
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_tie", F.xxhash64("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), "_tie"]
    ranged = ordered.repartitionByRange(n, *order).sortWithinPartitions(*order)
    (
        encoded(ranged, tokenizer, end_id)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.dictionary.page.size", str(2 << 20))
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .parquet(path)
    )


def lengths(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and n_tokens; no token page is read."""
    return spark.read.schema(STORED).parquet(path).select("doc_id", "n_tokens")


def read(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of documents first..last; row groups and pages outside of that range are skipped."""
    rows = spark.read.schema(STORED).parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    return rows if last is None else rows.filter(F.col("doc_id") <= last)


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the unsigned crc32 of the
    ids as little-endian unsigned 32-bit integers, all from the files.

    Token lists end in the first task; what moves on is a few longs per document. A file is a
    range of ids (a task that has been told to end files early writes several, in order), so its
    base is the total of the files before it: one row per file goes through a single task. Equal
    ids stand in the order in which they were written.
    """

    def crc(batches):
        for batch in batches:
            lists = batch.column("ids")
            values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
            bounds = zip(offsets[:-1], offsets[1:], strict=True)
            sums = np.array([zlib.crc32(values[a:b].tobytes()) for a, b in bounds], np.int64)
            kept = ["_file", "_row", "doc_id", "n_tokens"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(sums)], [*kept, "ids_crc32"])

    number = lambda pattern: F.regexp_extract("_metadata.file_name", pattern, 1).cast("long")
    part = number(r"part-(\d+)") * 1_000_000 + F.coalesce(number(r"-c(\d+)\."), F.lit(0))
    stored = spark.read.schema(STORED).parquet(path).select(part.alias("_file"), F.col("_metadata.row_index").alias("_row"), "*")
    rows = stored.mapInArrow(crc, "_file long, _row long, doc_id long, n_tokens long, ids_crc32 long")
    lengths = spark.read.schema(STORED).parquet(path).groupBy(part.alias("_file")).agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = lengths.select("_file", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(bases, "_file")
        .select("doc_id", (F.col("_base") + F.col("_within")).alias("start"), "n_tokens", "ids_crc32")
    )
