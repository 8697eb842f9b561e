"""Rules over several events of one customer, and lookups of a customer's past.

Customers may be arbitrarily hot, so nothing here gathers a customer's whole history:
time is cut into cells, and (customer, cell) is what a task sorts. Rows of one instant
are counted before they are shuffled.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.config import DEFAULT_RULES, RuleConfig
from tillwarden.functions.scalars import at_micros, cell_of, duration, micros, plain_moment
from tillwarden.operators.asof import as_of
from tillwarden.operators.merge import with_defaults

KEY, TIME, COUNTRY = "customer_id", "event_time", "merchant_country"
CELL_WINDOWS = 4  # a cell spans four look-back windows, so a quarter of the points reach into the next


def _at(df: DataFrame, time: str = TIME) -> Column:
    return at_micros(df, time)


def _moment(at: Column, like: DataFrame, time: str = TIME) -> Column:
    """The time column's own type back from microseconds."""
    return F.timestamp_micros(at) if like.schema[time].dataType.typeName() == "timestamp" else plain_moment(at)


def _reach(at: Column, look_back: int, width: int) -> Column:
    """Cells from which the point is still inside the look-back."""
    return F.explode(F.sequence(cell_of(at, width), cell_of(at + look_back, width)))


def _edge(at: Column, delta: Column, asks: Column) -> Column:
    return F.struct(at.alias("at"), delta.cast("long").alias("delta"), asks.alias("asks"))


def _running(edges: DataFrame, name: str) -> DataFrame:
    """Sum of the deltas up to each asked instant, same instant included."""
    upto = Window.partitionBy(KEY, "cell").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    asked = edges.withColumn(name, F.sum("delta").over(upto)).where("asks")
    return asked.select(KEY, "cell", "at", name)


def _per_instant(sums: DataFrame, name: str, like: DataFrame) -> DataFrame:
    return sums.select(KEY, _moment(F.col("at"), like).alias(TIME), name)


def trailing_count(df: DataFrame, look_back: timedelta, name: str = "recent_transactions") -> DataFrame:
    """One row per (customer, instant): transactions in [instant - look_back, instant].

    Each instant enters the running sum with its count and leaves it one microsecond
    after the look-back: linear in the rows, whatever the length of the window.
    """
    span, width = micros(look_back), micros(look_back) * CELL_WINDOWS
    at = F.col("at")
    points = df.select(KEY, _at(df).alias("at")).groupBy(KEY, "at").agg(F.count(F.lit(1)).alias("n"))
    reached = points.select(KEY, "at", "n", _reach(at, span, width).alias("cell"))
    edges = reached.repartition(KEY, "cell").select(
        KEY,
        "cell",
        F.inline(
            F.array(
                _edge(at, F.col("n"), F.col("cell") == cell_of(at, width)),
                _edge(at + span + 1, -F.col("n"), F.lit(False)),
            )
        ),
    )
    return _per_instant(_running(edges, name), name, df)


def trailing_countries(df: DataFrame, look_back: timedelta, name: str = "recent_countries") -> DataFrame:
    """One row per (customer, instant): distinct countries in [instant - look_back, instant].

    A country counts from each sighting until the look-back ends or the next sighting
    takes over, so at any instant it counts at most once.
    """
    span, width = micros(look_back), micros(look_back) * CELL_WINDOWS
    at = F.col("at")
    sightings = df.select(KEY, _at(df).alias("at"), COUNTRY).distinct()
    reached = sightings.select(KEY, "at", COUNTRY, _reach(at, span, width).alias("cell"))
    following = Window.partitionBy(KEY, "cell", COUNTRY).orderBy("at")
    one = F.col(COUNTRY).isNotNull().cast("int")
    edges = (
        reached.repartition(KEY, "cell")
        .withColumn("next_at", F.lead("at").over(following))
        .select(
            KEY,
            "cell",
            F.inline(
                F.array(
                    _edge(at, one, F.col("cell") == cell_of(at, width)),
                    _edge(F.least(at + span + 1, F.col("next_at")), -one, F.lit(False)),
                )
            ),
        )
    )
    # several countries at one instant ask for the same sum
    return _per_instant(_running(edges, name).dropDuplicates([KEY, "cell", "at"]), name, df)


def with_velocity(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Every transaction with its customer's trailing count and ``velocity_flag``."""
    counts = trailing_count(df, rules.velocity_window)
    return df.join(counts, [KEY, TIME], "left").withColumn(
        "velocity_flag", F.col("recent_transactions") > rules.velocity_limit
    )


def with_country_spread(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Every transaction with its customer's trailing country count and ``multi_country_flag``."""
    counts = trailing_countries(df, rules.geo_window)
    return df.join(counts, [KEY, TIME], "left").withColumn(
        "multi_country_flag", F.col("recent_countries") >= rules.geo_min_countries
    )


def _windowed_alert(df: DataFrame, measure: str, rule: str) -> DataFrame:
    return df.select(
        KEY,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        measure,
        F.lit(rule).alias("rule"),
        F.lit("CRITICAL").alias("risk_level"),
    )


def velocity_alerts(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Tumbling windows with more than the allowed transactions (tables and streams)."""
    window = F.window(TIME, duration(rules.velocity_window)).alias("window")
    counts = df.groupBy(KEY, window).agg(F.count(F.lit(1)).alias("txn_count"))
    return _windowed_alert(counts.where(F.col("txn_count") > rules.velocity_limit), "txn_count", "VELOCITY")


def multi_country_alerts(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Sliding windows in which a customer paid in several countries (tables and streams).

    The collected set holds distinct countries only, so it is bounded by their number.
    """
    window = F.window(TIME, duration(rules.geo_window), duration(rules.geo_slide)).alias("window")
    sets = df.groupBy(KEY, window).agg(F.size(F.collect_set(COUNTRY)).cast("long").alias("countries"))
    return _windowed_alert(sets.where(F.col("countries") >= rules.geo_min_countries), "countries", "MULTI_COUNTRY")


def first_of_each_run(alerts: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """One alert per uninterrupted run of sliding windows: the first. Batch only;
    the rows per customer are windows, bounded by time / slide."""
    before = F.lag("window_start").over(Window.partitionBy(KEY).orderBy("window_start"))
    gap = F.col("window_start") - F.lit(rules.geo_slide)
    return alerts.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") < gap)).drop(
        "_before"
    )


def first_multi_country_alerts(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """``first_of_each_run`` for streams: windows with several countries follow each other at
    one slide's distance, so they are sessions with a gap of one and a half slides."""
    window = F.window(TIME, duration(rules.geo_window), duration(rules.geo_slide)).alias("window")
    sets = df.groupBy(KEY, window).agg(F.size(F.collect_set(COUNTRY)).cast("long").alias("countries"))
    hits = sets.where(F.col("countries") >= rules.geo_min_countries)
    run = F.session_window(F.window_time("window"), duration(rules.geo_slide * 1.5)).alias("run")
    first = F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "countries")
    firsts = hits.groupBy(KEY, run).agg(F.min(first).alias("first"))
    return firsts.select(
        KEY,
        F.col("first.start").alias("window_start"),
        F.col("first.end").alias("window_end"),
        F.col("first.countries").alias("countries"),
        F.lit("MULTI_COUNTRY").alias("rule"),
        F.lit("CRITICAL").alias("risk_level"),
    )


def repeat_offences(df: DataFrame, alerts: DataFrame, look_back: timedelta = timedelta(minutes=10)) -> DataFrame:
    """Transactions whose customer had an alert in [event_time - look_back, event_time].

    With cells as long as the look-back, only two facts per (customer, cell) matter: the
    first alert of the transaction's own cell (every alert there is recent enough) and
    the last one of the cell before (every alert there is early enough). So the alerts
    shrink to one row per (customer, cell) before they meet the transactions.
    """
    span = micros(look_back)
    at = _at(df)
    cells = (
        alerts.select(KEY, _at(alerts).alias("alert_at"))
        .groupBy(KEY, cell_of(F.col("alert_at"), span).alias("cell"))
        .agg(F.min("alert_at").alias("first_at"), F.max("alert_at").alias("last_at"))
    )
    nothing = F.lit(None).cast("long")
    facts = (
        cells.select(
            KEY,
            F.inline(
                F.array(
                    F.struct("cell", F.col("first_at").alias("own_first"), nothing.alias("prior_last")),
                    F.struct((F.col("cell") + 1).alias("cell"), nothing.alias("own_first"), F.col("last_at").alias("prior_last")),
                )
            ),
        )
        .groupBy(KEY, "cell")
        .agg(F.min("own_first").alias("own_first"), F.max("prior_last").alias("prior_last"))
    )
    stamped = df.withColumns({"_at": at, "cell": cell_of(at, span)})
    hit = (F.col("own_first") <= F.col("_at")) | (F.col("prior_last") >= F.col("_at") - span)
    return (
        stamped.alias("t")
        .join(
            facts.alias("f"),
            (F.col(f"t.{KEY}") == F.col(f"f.{KEY}")) & (F.col("t.cell") == F.col("f.cell")) & hit,
            "left_semi",
        )
        .drop("_at", "cell")
    )


PROFILE = ("risk_tier", "total_fraud_alerts", "last_alert_time")


def _known_or_not(df: DataFrame) -> DataFrame:
    """A customer without a profile is UNKNOWN and has no alerts."""
    known = with_defaults(df, {"risk_tier": F.lit("UNKNOWN"), "total_fraud_alerts": F.lit(0).cast("long")})
    return known.withColumn("repeat_offender", F.col("total_fraud_alerts") > 0)


def with_profile(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Transactions with their customer's risk profile as it is in ``profiles``."""
    return _known_or_not(df.join(profiles.select(KEY, *PROFILE), KEY, "left"))


def with_profile_as_of(df: DataFrame, versions: DataFrame) -> DataFrame:
    """Transactions with their customer's risk profile as it was at their event time.
    ``versions`` (``alert_views.profile_versions``) says from when each version counts."""
    return _known_or_not(as_of(df, versions, KEY, TIME, "valid_from", PROFILE))
