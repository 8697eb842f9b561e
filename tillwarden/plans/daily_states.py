"""Gold models and profiles from states of whole days.

A state holds what the rows of one day add to a model, by everything that the model counts
distinct or takes a mode or a maximum of: counts per (customer, country), per (category, country)
and which (category, customer) there were. States of different days can be put together in any
order, and a day is taken back by computing it anew, so a late alert or a corrected row costs its
day and nothing else. A run reads the rows of changed days; models are made from the states.

States are folders by day in the store. Refreshing them again gives the same folders, so a run
that stops half-way is simply done again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.operators import quality
from tillwarden.plans import alert_views, gold
from tillwarden.sources.tables import TableStore

DAY = "state_day"
#: Column of the loaders' tables that holds the day on which a row was loaded.
LOADED_DAY = "load_day"


class DayStates:
    """One state: ``make`` turns rows with their DAY into parts with a count ``n``; ``day`` says what
    day a row is of."""

    def __init__(self, path: str, rows: DataFrame, day: Column, make: Callable[[DataFrame], DataFrame]):
        self.path, self.rows, self.day, self.make = path, rows, day, make

    def _parts(self, rows: DataFrame) -> DataFrame:
        return self.make(rows.withColumn(DAY, self.day))

    def refresh(self, days: Sequence[str] | None, rows: DataFrame | None = None) -> None:
        """Make the states of ``days`` (None: of all there are) anew, from ``rows`` if all that
        belong to these days are among them."""
        rows = self.rows if rows is None else rows
        if days is None:
            parts, how = self._parts(rows.where(self.day.isNotNull())), "static"
        else:
            # A day may have lost its last row: one row without a count takes the place of what it had.
            wanted = [date.fromisoformat(d) for d in days]
            empty = rows.sparkSession.createDataFrame([(d, 0) for d in wanted], f"{DAY} date, n long")
            parts, how = self._parts(rows.where(self.day.isin(wanted))).unionByName(empty, allowMissingColumns=True), "dynamic"
        parts.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", how).partitionBy(DAY).parquet(self.path)

    def read(self) -> DataFrame:
        """All parts; only what is asked of them is read."""
        schema = self._parts(self.rows).schema
        return self.rows.sparkSession.read.schema(schema).parquet(self.path).where("n > 0")


class Marks:
    """What states have taken, as an empty file named by its number; it is put there when they are done."""

    def __init__(self, store: TableStore, name: str):
        self.store, self.folder = store, f"{store.root}/{name}_marks"

    def newest(self) -> int | None:
        return next(iter(self.store._numbered(self.folder, "taken-")), None)

    def put(self, number: int) -> None:
        if number != self.newest():
            self.store._create(f"{self.folder}/taken-{number}", "")
        for old in self.store._numbered(self.folder, "taken-"):
            if old < number:
                self.store._delete(f"{self.folder}/taken-{old}")


class GoldStates:
    """The states behind the three gold models, over a merged table of flagged transactions that
    notes the ``transaction_date`` of what changes."""

    def __init__(self, store: TableStore, source: str):
        self.store, self.source = store, source
        self.marks = Marks(store, f"{source}_days")
        day = F.col("transaction_date")
        made = {
            "totals": lambda rows: gold.day_totals(rows, *(v.alias(name) for name, v in quality.flag_checks())).withColumns(
                {DAY: day, "n": F.col("total_transactions")}
            ),
            "customers": lambda rows: gold.customer_parts(rows, DAY),
            "merchants": lambda rows: gold.merchant_parts(rows, DAY, "merchant_country"),
            "present": lambda rows: rows.groupBy(DAY, "merchant_category", "customer_id").agg(F.count(F.lit(1)).alias("n")),
        }
        rows = store.read(source)
        self.states = {name: DayStates(f"{store.root}/{source}_days/{name}", rows, day, make) for name, make in made.items()}

    def current(self) -> bool:
        """Whether all loads have been taken."""
        return self.marks.newest() == self.store.load_number(self.source)

    def refresh(self) -> list[str] | None:
        """Take the loads that have not been taken; returns the days that were made anew (None: all)."""
        there, taken = self.store.load_number(self.source), self.marks.newest()
        days = None if taken is None else self.store.changed_days(self.source, taken)
        if days is None or days:
            for state in self.states.values():
                state.refresh(days)
        self.marks.put(there)
        return days

    def checks(self, rate_bounds: tuple[float, float]) -> DataFrame:
        """``quality.model_checks`` without a look at the table: violations are counted with its
        days, and a merge refuses repeated keys."""
        names = [name for name, _ in quality.flag_checks()]
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "flagged_transactions", *names)]
        counted = self.states["totals"].read().agg(*sums).first().asDict()  # one row
        rate = quality.rate_violations(counted["flagged_transactions"], counted["n"], *rate_bounds)
        found = {name: counted[name] for name in names} | {"rate_is_flagged": rate, "unique_transaction_id": 0}
        return quality.report(self.store.spark, self.source, found)

    def fraud_summary_daily(self, as_of: datetime | str) -> DataFrame:
        return gold.shown_days(self.states["totals"].read(), as_of)

    def high_risk_customers(self, as_of: datetime | str) -> DataFrame:
        parts = gold.merged_customer_parts(self.states["customers"].read())
        return gold.ranked_customers(gold.customer_totals(parts), as_of)

    def merchant_risk_scores(self, as_of: datetime | str) -> DataFrame:
        category = "merchant_category"
        sums = [F.sum(c).alias(c) for c in gold.MERCHANT_SUMS]
        per_country = self.states["merchants"].read().groupBy(category, "merchant_country").agg(*sums)
        totals = per_country.groupBy(category).agg(
            F.sum("n").alias("total_transactions"),
            F.sum("flags").alias("total_flags"),
            *(F.sum(c).alias(c) for c in gold.MERCHANT_SUMS[2:]),
            F.count("merchant_country").alias("countries_seen"),
        )
        pairs = self.states["present"].read().select(category, "customer_id").distinct()
        people = pairs.groupBy(F.col(category).alias("_category")).agg(F.count("customer_id").alias("unique_customers"))
        whole = totals.join(people, F.col(category).eqNullSafe(F.col("_category"))).drop("_category")
        return gold.rated_merchants(whole, as_of)


class AlertDays:
    """Alert counts per day, customer and country, for profiles over the last 30 days.

    A refresh reads the states of the days that lie wholly in the window and the alerts of the
    two days at its ends, of which the window takes a part; older alerts are not opened.
    """

    def __init__(self, store: TableStore, alerts: DataFrame):
        self.store, self.alerts = store, alerts
        self.marks = Marks(store, "alert_days")
        make = lambda rows: alert_views.alert_parts(rows, F.col(DAY))
        self.days = DayStates(f"{store.root}/alert_days", alerts, F.to_date("event_time"), make)

    def refresh(self, batch: str) -> list[str] | None:
        """Take the batches that have not been taken, by the number in ``batch``; returns the days
        that were made anew (None: all)."""
        taken = self.marks.newest()
        news = self.alerts if taken is None else self.alerts.where(F.col(batch) > taken)
        newest = news.agg(F.max(batch)).first()[0]  # one value
        if newest is None:
            if taken is None:
                self.days.refresh(None)
            return []
        days, held = None, self.alerts.where(F.col(batch) <= newest)  # later ones are the next run's
        if taken is not None:
            found = news.where(F.col(batch) <= newest).select(F.to_date("event_time").alias("day")).distinct()
            days = sorted(str(r["day"]) for r in found.where("day IS NOT NULL").collect())  # dates
        if days is None or days:
            self.days.refresh(days, loaded_since(held, days[0]) if days else held)
        self.marks.put(newest)
        return days

    def profile_facts(self, as_of: datetime | str, last_country: str = "greatest") -> DataFrame:
        """``alert_views.profile_facts`` over 30 days, by states."""
        last = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(str(as_of))
        first = last - alert_views.PROFILE_WINDOW
        whole = F.col(DAY).between(F.lit(first.date() + timedelta(days=1)), F.lit(last.date() - timedelta(days=1)))
        columns = ("customer_id", "merchant_country", "n", "score", "latest")
        ends = loaded_since(self.alerts, str(first.date())).where(alert_views.in_window(as_of))
        ends = alert_views.alert_parts(ends.where(F.to_date("event_time").isin(first.date(), last.date())))
        parts = self.days.read().where(whole).select(*columns).unionByName(ends.select(*columns))
        return alert_views.profile_totals(parts, last_country)


def loaded_since(alerts: DataFrame, day: str) -> DataFrame:
    """The alerts loaded on ``day`` or later, if the table says when. An alert's event is no later
    than its loading, so alerts of events of that day or later are among them."""
    return alerts.where(F.col(LOADED_DAY) >= F.lit(date.fromisoformat(day))) if LOADED_DAY in alerts.columns else alerts

