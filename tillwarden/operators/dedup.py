"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``, ties broken by every other column.

    The order is total up to identical rows, so the result does not depend on
    partitioning. Spark cuts each map task to one row per key before the shuffle
    (WindowGroupLimit), so a key with very many copies stays cheap.
    """
    rest = sorted(c for c in df.columns if c not in keys and c not in order)
    first = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_position", F.row_number().over(first)).where("_position = 1").drop("_position")
