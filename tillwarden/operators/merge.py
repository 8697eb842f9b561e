"""Incremental loads: high-water filter, keyed upsert, schema sync, defaults, ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEFORE_ALL = "0001-01-01 00:00:00"


def newer_than(source: DataFrame, target: DataFrame, column: str, partition: str | None = None) -> DataFrame:
    """Source rows strictly above the target's highest ``column``; all of them when
    the target is empty. ``partition`` names a source partition column that holds the
    date of ``column``: older partitions are then not even listed."""
    floor = F.lit(BEFORE_ALL).cast(target.schema[column].dataType)
    high_water = target.agg(F.coalesce(F.max(column), floor)).scalar()
    fresh = source if partition is None else source.where(F.col(partition) >= F.to_date(high_water))
    return fresh.where(F.col(column) > high_water)


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """The target in the source's columns: new ones NULL, dropped ones gone."""
    have = set(target.columns)
    return target.select(
        *(
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in source.schema.fields
        )
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows of ``source`` replace target rows of the same key; other target
    rows stay. ``source`` must hold each key once (``assert_unique``)."""
    kept = sync_columns(target, source).join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*source.columns).unionByName(source)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise when a key occurs twice; otherwise hand the frame back."""
    found = repeated_keys(df, keys).take(1)
    if found:
        raise ValueError(f"merge source repeats key {found[0].asDict()}")
    return df


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Column defaults: a missing column is added, a NULL is replaced."""
    return df.withColumns(
        {name: F.coalesce(F.col(name), value) if name in df.columns else value for name, value in defaults.items()}
    )


def next_id(table: DataFrame, column: str) -> int:
    """First free id of a table (one number comes to the driver)."""
    return (table.agg(F.max(column)).first()[0] or 0) + 1


def assign_ids(df: DataFrame, column: str, start: int = 1) -> DataFrame:
    """Unique ids >= ``start`` with gaps, as a sequence gives them; needs no shuffle.
    Write the result before reading it twice: ids follow the partitioning."""
    return df.withColumn(column, F.monotonically_increasing_id() + F.lit(start).cast("long"))
