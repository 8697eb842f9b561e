"""Velocity alerts at the payment that is one too many, not at the end of a window.

Built-in windows only speak when they close, so this rule keeps state of its own: per customer
the instants of the look-back and how many payments each had. A payment can only add to the
counts of instants, so an instant whose count has passed the limit stays above it, and in
whatever order payments come, in the end the same instants have been told: those that
``behaviour.with_velocity`` flags.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillwarden.config import PIPELINE_RULES, RuleConfig
from tillwarden.functions.scalars import micros
from tillwarden.operators.behaviour import KEY, TIME

#: An instant (microseconds), its payments, and whether an alert was given.
INSTANT = np.dtype([("at", "<i8"), ("n", "<i8"), ("told", "?")])


def counted(known: np.ndarray, arrived: np.ndarray) -> np.ndarray:
    """Instants in order, after the payments at the times ``arrived``."""
    at, n = np.unique(arrived, return_counts=True)
    new = np.zeros(len(at), INSTANT)
    new["at"], new["n"] = at, n
    both = np.concatenate([known, new])
    both = both[np.argsort(both["at"], kind="stable")]
    head = np.flatnonzero(np.concatenate([[True], both["at"][1:] != both["at"][:-1]]))
    out = both[head]
    out["n"] = np.add.reduceat(both["n"], head)
    return out


def trailing(instants: np.ndarray, look_back: int) -> np.ndarray:
    """Payments in [instant - look_back, instant], of each instant."""
    upto = np.concatenate([[0], np.cumsum(instants["n"])])
    return upto[1:] - upto[np.searchsorted(instants["at"], instants["at"] - look_back, "left")]


class Bursts(StatefulProcessor):
    """State of a customer: one value, the instants later than the watermark minus the look-back.
    It goes when the watermark has passed the last of them by the look-back."""

    def __init__(self, look_back: int, limit: int):
        self.look_back, self.limit = look_back, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.instants = handle.getValueState("instants", "packed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = np.concatenate([frame["at"].to_numpy(np.int64) for frame in rows])
        held = self.instants.get() if self.instants.exists() else None
        known = np.frombuffer(held[0], INSTANT) if held else np.zeros(0, INSTANT)
        instants = counted(known, arrived)
        recent = trailing(instants, self.look_back)
        fresh = (recent > self.limit) & ~instants["told"]
        if fresh.any():
            yield pd.DataFrame({KEY: key[0], "at": instants["at"][fresh], "recent_transactions": recent[fresh]})
        instants["told"] |= fresh
        # Rows to come are later than the watermark and look no further back than this.
        instants = instants[instants["at"] >= timerValues.getCurrentWatermarkInMs() * 1000 - self.look_back]
        if len(instants):
            self.instants.update((instants.tobytes(),))
            self.handle.registerTimer(int(instants["at"][-1] + self.look_back) // 1000 + 1)
        else:
            self.instants.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Later payments have registered later timers, so only the last one finds nothing left."""
        if self.instants.exists():
            instants = np.frombuffer(self.instants.get()[0], INSTANT)
            if instants["at"][-1] < timerValues.getCurrentWatermarkInMs() * 1000 - self.look_back:
                self.instants.clear()
        yield from ()

    def close(self) -> None:
        pass


def early_velocity_alerts(stream: DataFrame, rules: RuleConfig = PIPELINE_RULES) -> DataFrame:
    """customer_id, event_time, recent_transactions, rule, risk_level of every instant at which a
    customer has passed the allowed number within the trailing window; given in the batch in
    which that shows, with the number as known then. A later row of an earlier time can make an
    instant pass the limit, which is then told. Needs a watermark on event_time and the RocksDB
    state store (``jobs.large_state``); rows without customer or time never alert."""
    timed = stream.where(F.col(KEY).isNotNull() & F.col(TIME).isNotNull()).select(KEY, TIME, F.unix_micros(TIME).alias("at"))
    told = timed.groupBy(KEY).transformWithStateInPandas(
        Bursts(micros(rules.velocity_window), rules.velocity_limit),
        f"{KEY} string, at long, recent_transactions long",
        "Append",
        "EventTime",
    )
    return told.select(
        KEY,
        F.timestamp_micros("at").alias(TIME),
        "recent_transactions",
        F.lit("VELOCITY").alias("rule"),
        F.lit("CRITICAL").alias("risk_level"),
    )
