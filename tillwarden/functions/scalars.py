"""Small column expressions shared by the models."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds (exclusive) and names of the amount buckets and rate bands.
AMOUNT_BUCKETS = ((10, "micro"), (100, "small"), (500, "medium"), (1000, "large"))
LARGEST_BUCKET = "very_large"
RATE_REFERENCE_PCT, RATE_ALARM_PCT = 2.0, 5.0
RATE_BANDS = ((2.0, "0-2"), (5.0, "2-5"))
TOP_RATE_BAND = "5-10"


def instant(as_of: datetime | str) -> Column:
    """The run's clock as a literal; no model reads the machine's clock."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def duration(span: timedelta) -> str:
    """Text form for ``window``/``withWatermark``."""
    return f"{micros(span)} microseconds"


EPOCH = "1970-01-01 00:00:00"


def plain_moment(at: Column) -> Column:
    """Zone-less time from microseconds since 1970."""
    span = F.make_dt_interval(secs=(at.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)"))
    return F.lit(EPOCH).cast("timestamp_ntz") + span


def plain_micros(time: Column) -> Column:
    """Microseconds since 1970 of a zone-less time, as it stands: the session's zone and its
    clock changes play no part."""
    since = time - F.lit(EPOCH).cast("timestamp_ntz")
    part = lambda name, unit: F.extract(F.lit(name), since).cast("long") * unit
    seconds = (F.extract(F.lit("SECOND"), since) * 1_000_000).cast("long")
    return part("DAY", 86_400_000_000) + part("HOUR", 3_600_000_000) + part("MINUTE", 60_000_000) + seconds


def utc_time(instant_: Column) -> Column:
    """An instant as zone-less UTC time, whatever the session's zone."""
    return plain_moment(F.unix_micros(instant_))


def at_micros(df: DataFrame, time: str) -> Column:
    """Microseconds since 1970, of instants or zone-less times."""
    return F.unix_micros(time) if df.schema[time].dataType.typeName() == "timestamp" else plain_micros(F.col(time))


def cell_of(at: Column, width: int) -> Column:
    """Number of the time cell (floor division, also before 1970)."""
    return F.floor((at - F.pmod(at, F.lit(width))) / width)


def interval(span: timedelta) -> Column:
    return F.lit(span)


def how_many(condition: Column) -> Column:
    """Number of rows where the condition holds, never NULL."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def cents(amount: Column) -> Column:
    """Money to the cent. Sums of it do not depend on the order of the rows."""
    return amount.cast("decimal(18,2)")


def money_total(amount: Column, where: Column | None = None) -> Column:
    """Exact sum (decimal); with ``where`` only those rows count, others add zero."""
    value = cents(amount)
    return F.sum(value if where is None else F.when(where, value).otherwise(F.lit(0).cast("decimal(18,2)")))


def dollars(total: Column) -> Column:
    return total.cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL when ``whole`` is 0."""
    return part.cast("double") / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


def in_range(value: Column, low: float, high: float) -> Column:
    """The value if low <= value <= high, else NULL."""
    return F.when(value.between(low, high), value)


def ladder(steps: Iterable[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Label of the first step whose test holds. A NULL test does not hold."""
    (test, label), *rest = steps
    chosen = F.when(test, label)
    for test, label in rest:
        chosen = chosen.when(test, label)
    return chosen if otherwise is None else chosen.otherwise(otherwise)


def amount_bucket(amount: Column) -> Column:
    return ladder([(amount < bound, name) for bound, name in AMOUNT_BUCKETS], LARGEST_BUCKET)


def rate_band(rate_pct: Column) -> Column:
    return ladder([(rate_pct < bound, name) for bound, name in RATE_BANDS], TOP_RATE_BAND)


def is_weekend(time: Column) -> Column:
    """Saturday or Sunday (Spark numbers Sunday 1 ... Saturday 7)."""
    return F.dayofweek(time).isin(1, 7)


def padded_id(prefix: str, number: Column, width: int = 5) -> Column:
    """``prefix`` + zero-padded number; numbers wider than ``width`` stay whole."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text))
