"""The last known state of a key at the time of each row.

Keys may be arbitrarily hot, so a key's history never meets in one task: time is cut into
cells, a task sorts one (key, cell), and what is known when a cell begins comes from one row
per cell. Every row and every state is moved once; no pairs are formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.functions.scalars import at_micros, cell_of, micros

DAY = timedelta(days=1)


def _before(key: str) -> Window:
    """All cells of a key before this one. Rows are cells, so they are bounded by time / width."""
    return Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)


def carried(per_cell: DataFrame, key: str, state: str, name: str = "carried") -> DataFrame:
    """One row per (key, cell): adds the last ``state`` of the cells before."""
    return per_cell.withColumn(name, F.last(state, ignorenulls=True).over(_before(key)))


def totals_before(per_cell: DataFrame, key: str, totals: dict[str, Column]) -> DataFrame:
    """One row per (key, cell): adds aggregates over the cells before, NULL in the first."""
    return per_cell.withColumns({name: total.over(_before(key)) for name, total in totals.items()})


def as_of(
    rows: DataFrame,
    states: DataFrame,
    key: str,
    time: str,
    since: str,
    values: Sequence[str],
    width: timedelta = DAY,
) -> DataFrame:
    """``rows`` with the ``values`` of the last state of their key with ``since`` <= ``time``.

    States of one key and instant: the greatest values count. Rows without key or time, or
    before the first state, get NULLs; states without key or time are not looked at.
    """
    span = micros(width)
    state = F.struct(*values)
    known = (
        states.where(F.col(key).isNotNull() & F.col(since).isNotNull())
        .select(key, at_micros(states, since).alias("at"), state.alias("state"))
        .groupBy(key, "at")
        .agg(F.max("state").alias("state"))
        .withColumn("cell", cell_of(F.col("at"), span))
    )
    # One instant is asked once, however many rows it has.
    stamped = rows.withColumn("_at", at_micros(rows, time))
    asked = stamped.where(F.col(key).isNotNull() & F.col("_at").isNotNull()).select(key, F.col("_at").alias("at")).distinct()
    asked = asked.withColumn("cell", cell_of(F.col("at"), span))

    nothing = F.lit(None).cast(known.schema["state"].dataType)
    last = known.groupBy(key, "cell").agg(F.max_by("state", "at").alias("state"))
    cells = asked.select(key, "cell", nothing.alias("state")).distinct().unionByName(last)
    cells = cells.groupBy(key, "cell").agg(F.max("state").alias("state"))
    opening = carried(cells, key, "state").where(F.col("carried").isNotNull())
    marks = known.select(key, "cell", "at", "state", F.lit(False).alias("asks"))
    # What is known when a cell begins stands before all of it.
    marks = marks.unionByName(
        opening.select(key, "cell", (F.col("cell") * span - 1).alias("at"), F.col("carried").alias("state"), F.lit(False).alias("asks"))
    )
    points = marks.unionByName(asked.select(key, "cell", "at", nothing.alias("state"), F.lit(True).alias("asks")))
    upto = Window.partitionBy(key, "cell").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    answers = points.withColumn("state", F.last("state", ignorenulls=True).over(upto)).where("asks")
    answers = answers.select(F.col(key).alias("_key"), F.col("at").alias("_asked"), "state")
    joined = stamped.join(answers, (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_asked")), "left")
    return joined.select(*rows.columns, *(F.col(f"state.{v}").alias(v) for v in values))
