"""Positions in a global order without sorting everything in one task.

A window without PARTITION BY moves all rows to one task. Here the rows are range
partitioned instead and written once, so that every later pass sees
the same chunks, and only one total per chunk (at most ``spark.sql.shuffle.partitions``
rows) goes through an unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.session import materialise


def total_before(df: DataFrame, order: list[Column], weight: Column, name: str) -> DataFrame:
    """Adds the sum of ``weight`` over all rows strictly before this one in ``order``,
    which must be a total order."""
    chunked = materialise(
        df.repartitionByRange(*order).withColumns({"_chunk": F.spark_partition_id(), "_weight": weight})
    )
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    ahead = chunked.groupBy("_chunk").agg(F.sum("_weight").alias("_total")).select(
        "_chunk", F.sum("_total").over(earlier.orderBy("_chunk")).alias("_ahead")
    )
    inside = F.sum("_weight").over(earlier.partitionBy("_chunk").orderBy(*order))
    return (
        chunked.withColumn("_inside", inside)
        .join(ahead, "_chunk")
        .withColumn(name, (F.coalesce("_ahead", F.lit(0)) + F.coalesce("_inside", F.lit(0))).cast("long"))
        .drop("_chunk", "_weight", "_inside", "_ahead")
    )


def global_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1, 2, 3, ... in ``order`` (a total order)."""
    return total_before(df, order, F.lit(1), name).withColumn(name, F.col(name) + 1)


def global_rank(df: DataFrame, order: dict[str, Column], name: str) -> DataFrame:
    """RANK over the sort columns ``order`` = {column: its ordering}.

    Ties are counted first, so a value shared by a third of all rows is one row of
    the histogram, and is joined back by value.
    """
    keys = list(order)
    held = materialise(df)
    histogram = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ties"))
    ranks = total_before(histogram, list(order.values()), F.col("_ties"), name)
    return held.join(ranks.select(*keys, (F.col(name) + 1).alias(name)), keys)
