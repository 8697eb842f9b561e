"""The daily run: freshness, layers, checks, profiles. A failing step stops the rest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.operators import quality
from tillwarden.operators.dedup import keep_first
from tillwarden.plans import alert_views, layers
from tillwarden.plans.daily_states import AlertDays, GoldStates, loaded_since
from tillwarden.schemas import CUSTOMER_RISK_PROFILES
from tillwarden.session import one_run
from tillwarden.sources.tables import LOAD_DATE, LOAD_NUMBER, TableStore

STEPS = ("freshness", "bronze", "silver", "gold", "checks", "profiles")
KEY = ["transaction_id"]
#: Columns by which single rows of the flags are looked up.
FIND = ("transaction_id", "customer_id")
#: The raw loader's number of the batch that wrote a row.
BATCH = "batch_id"


def run(
    store: TableStore,
    raw: DataFrame,
    alerts: DataFrame,
    as_of: datetime | str,
    layers_wanted: Sequence[str] | None = None,
    rate_bounds: tuple[float, float] = quality.RATE_BOUNDS_PCT,
    ingest_date: str | None = None,
) -> list[str]:
    """Bring the store's tables up to ``as_of`` and return the steps done. Safe to repeat, also
    at the same ``as_of`` and after a failure: each step takes the loads of the step before
    that it has not taken yet, by number. ``ingest_date`` names a partition column of ``raw``
    that holds the date of ``ingested_at``; older partitions are then not listed. The raw loader's
    ``batch_id``, where ``raw`` has it, is the load number of its rows; without it raw rows are
    taken by ``ingested_at``, and rows that turn up at or below the highest one are not. Alerts with
    ``batch_id`` (and ``load_day``, the day of their loading) are taken by number too; without it
    all of them are looked through at every run."""
    wanted = STEPS if layers_wanted is None else [s for s in STEPS if s in layers_wanted]
    with one_run(store.spark):
        for step in wanted:
            _RUN[step](store, raw, alerts, as_of, rate_bounds, ingest_date)
    return list(wanted)


def _freshness(store, raw, alerts, as_of, rate_bounds, ingest_date):
    quality.require(quality.freshness(raw, as_of))


def _bronze(store, raw, alerts, as_of, rate_bounds, ingest_date):
    """Rows of the loader's batches not taken yet, or (without batches) above the highest ingest
    time taken. Rows without a required value wait in ``rejected_transactions`` instead of the layers."""
    name = "raw_transactions"
    store.recover(name)
    by = BATCH if BATCH in raw.columns else "ingested_at"
    mark = store.marks(name).get(by)
    fresh = raw
    if mark is not None and by == BATCH:
        fresh = raw.where(F.col(BATCH) > mark)
    elif mark is not None:
        moment = F.lit(mark).cast("timestamp_ntz")
        fresh = raw if ingest_date is None else raw.where(F.col(ingest_date) >= F.to_date(moment))
        fresh = fresh.where(F.col("ingested_at") > moment)
    fresh = fresh.drop(ingest_date) if ingest_date else fresh
    newest = F.max(by) if by == BATCH else F.max(by).cast("string")
    newest = fresh.agg(newest).first()[0]  # one value
    if newest is None:
        return
    if by == BATCH:
        fresh = fresh.where(F.col(BATCH) <= newest).drop(BATCH)  # later ones are the next run's
    complete, incomplete = layers.split_incomplete(fresh)
    if not incomplete.isEmpty():
        # By the number that the load is about to get, so a repeated run replaces what it brought.
        store.append("rejected_transactions", incomplete, store.load_number(name) + 1)
    if store.load_number(name):
        complete = keep_first(complete, KEY, ["ingested_at"])
    rows = layers.bronze_raw_transactions(complete, as_of)
    store.merge(name, rows, KEY, "dbt_loaded_at", {by: newest})


def _silver(store, raw, alerts, as_of, rate_bounds, ingest_date):
    store.recover("clean_transactions")
    taken, there = store.marks("clean_transactions").get("raw_transactions", 0), store.load_number("raw_transactions")
    if there > taken:
        bronze = store.since("raw_transactions", taken).drop(LOAD_DATE, LOAD_NUMBER)
        rows = layers.silver_clean_transactions(bronze, as_of)
        store.merge("clean_transactions", rows, KEY, "silver_loaded_at", {"raw_transactions": there})
    _flags(store, alerts, as_of)


def _flags(store, alerts, as_of):
    """Newly cleaned transactions, and older ones whose flags are not those of their earliest
    alert: what the flags hold decides which alerts are news, whenever these arrived. Alerts with
    the loader's ``batch_id`` are asked by number, so only new ones are compared with the flags.
    The outdated ids are written once, with the days on which their rows were cleaned, and of the
    cleaned rows only those days are read."""
    name, outdated_name = "fraud_flags", "outdated_flags"
    store.recover(name)
    marks, there = store.marks(name), store.load_number("clean_transactions")
    taken, batch = marks.get("clean_transactions", 0), marks.get("alerts")
    newest = alerts.agg(F.max(BATCH)).first()[0] if BATCH in alerts.columns else None  # one value
    if newest is not None:
        alerts = alerts.where(F.col(BATCH) <= newest)  # later ones are the next run's
    news = alerts if batch is None else alerts.where(F.col(BATCH) > batch)
    load, days = store.since("clean_transactions", taken), []
    if store.exists(name) and (batch is None or newest != batch):
        outdated = layers.outdated_flags(store.read(name), news, all_alerts=batch is None)
        outdated = store.overwrite(outdated_name, outdated)
        days = [r[0] for r in outdated.select(layers.CLEANED_ON).distinct().collect()]  # dates
        older = store.read("clean_transactions").where(F.col(LOAD_DATE).isin(days) & (F.col(LOAD_NUMBER) <= taken))
        load = load.unionByName(older.join(outdated.select(*KEY), KEY, "left_semi")) if days else load
    if there == taken and not days:
        return
    first = load.agg(F.min("transaction_date")).first()[0]  # one value
    # A day more, for clocks that disagree: alerts of these rows are not loaded before.
    facts = alerts if first is None else loaded_since(alerts, str(first - timedelta(days=1)))
    rows = layers.silver_fraud_flags(load.drop(LOAD_DATE, LOAD_NUMBER), facts, as_of)
    done = {"clean_transactions": there} | ({} if newest is None else {"alerts": newest})
    store.merge(name, rows, KEY, "fraud_flags_loaded_at", done, changed="transaction_date", unique=True, find=FIND)


def _gold(store, raw, alerts, as_of, rate_bounds, ingest_date):
    """From states by day, of which only those of changed days are made anew."""
    states = GoldStates(store, "fraud_flags")
    states.refresh()
    store.overwrite("fraud_summary_daily", states.fraud_summary_daily(as_of))
    store.overwrite("high_risk_customers", states.high_risk_customers(as_of), lookup_by="customer_id")
    store.overwrite("merchant_risk_scores", states.merchant_risk_scores(as_of))


def _checks(store, raw, alerts, as_of, rate_bounds, ingest_date):
    """By the counts that the gold step has made; without that step, over the table."""
    states = GoldStates(store, "fraud_flags")
    report = states.checks(rate_bounds) if states.current() else quality.model_checks(store.read("fraud_flags"), rate_bounds)
    quality.require(report)


def _profiles(store, raw, alerts, as_of, rate_bounds, ingest_date):
    """Alerts with the loader's ``batch_id`` are counted by day once; the refresh reads 30 days of counts."""
    name = "customer_risk_profiles"
    known = store.read(name) if store.exists(name) else store.spark.createDataFrame([], CUSTOMER_RISK_PROFILES)
    if BATCH in alerts.columns:
        days = AlertDays(store, alerts)
        days.refresh(BATCH)
        facts = days.profile_facts(as_of)
    else:
        facts = alert_views.profile_facts(alerts, as_of)
    store.overwrite(name, alert_views.refreshed_profiles(known, facts, as_of), lookup_by="customer_id")


_RUN = {
    "freshness": _freshness,
    "bronze": _bronze,
    "silver": _silver,
    "gold": _gold,
    "checks": _checks,
    "profiles": _profiles,
}
