"""Data checks. Each gives rows (check_name, table_name, violations, passed)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwarden.config import RISK_LEVELS
from tillwarden.functions.scalars import how_many, instant, interval, ratio
from tillwarden.operators.merge import repeated_keys

# Age limit of the newest rows, allowed share of flagged rows.
MAX_AGE = timedelta(hours=2)
RATE_BOUNDS_PCT = (1.0, 5.0)


class CheckFailed(Exception):
    """At least one check did not pass."""


def freshness(raw: DataFrame, as_of: datetime | str, max_age: timedelta = MAX_AGE, table: str = "transactions_raw"):
    """Fails unless a row was ingested within ``max_age`` before ``as_of``."""
    recent = raw.where(F.col("ingested_at").between(instant(as_of) - interval(max_age), instant(as_of)))
    rows = recent.agg(F.count(F.lit(1)).alias("n"))
    return rows.select(
        F.lit("freshness").alias("check_name"),
        F.lit(table).alias("table_name"),
        F.when(F.col("n") == 0, 1).otherwise(0).cast("long").alias("violations"),
        (F.col("n") > 0).alias("passed"),
    )


def not_null(column: str) -> tuple[str, Column]:
    return f"not_null_{column}", how_many(F.col(column).isNull())


def accepted_values(column: str, values: Sequence[str]) -> tuple[str, Column]:
    """Values outside the list; a NULL is the business of ``not_null``."""
    return f"accepted_values_{column}", how_many(~F.col(column).isin(*values))


def rate_between(flag: str, low_pct: float, high_pct: float) -> tuple[str, Column]:
    """One violation when the share of flagged rows is out of bounds; an empty table passes."""
    share = ratio(how_many(F.col(flag)), F.count(F.lit(1))) * 100
    return f"rate_{flag}", F.when(~share.between(low_pct, high_pct), 1).otherwise(0).cast("long")


def column_checks(df: DataFrame, table: str, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Any number of aggregate checks in one pass over the table."""
    counted = df.agg(*(violations.alias(name) for name, violations in checks))
    rows = F.array(
        *(F.struct(F.lit(name).alias("check_name"), F.col(name).alias("violations")) for name, _ in checks)
    )
    return counted.select(F.inline(rows)).select(
        "check_name", F.lit(table).alias("table_name"), "violations", (F.col("violations") == 0).alias("passed")
    )


def counted_while(df: DataFrame, checks: Sequence[tuple[str, Column]], write: Callable[[DataFrame], object]) -> dict[str, int]:
    """Hand ``df`` to ``write`` and return the violations of the checks, counted in the same pass:
    what is written is not read again."""
    observation = Observation()
    write(df.observe(observation, *(violations.alias(name) for name, violations in checks)))
    return observation.get


def report(spark: SparkSession, table: str, violations: Mapping[str, int]) -> DataFrame:
    """Counted violations in the form that every check has."""
    made = [(name, table, int(n), n == 0) for name, n in violations.items()]
    return spark.createDataFrame(made, "check_name string, table_name string, violations long, passed boolean")


def flag_checks() -> list[tuple[str, Column]]:
    """The checks of a flagged table that add up over parts of it."""
    return [not_null("transaction_id"), not_null("customer_id"), accepted_values("risk_level", RISK_LEVELS)]


def rate_violations(flagged: int, rows: int, low_pct: float, high_pct: float) -> int:
    """``rate_between`` from counts."""
    return int(rows > 0 and not low_pct <= flagged / rows * 100 <= high_pct)


def unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Counts the keys that occur more than once (NULL keys are left to ``not_null``)."""
    repeated = repeated_keys(df.where(F.col(key).isNotNull()), [key]).agg(F.count(F.lit(1)).alias("violations"))
    return repeated.select(
        F.lit(f"unique_{key}").alias("check_name"),
        F.lit(table).alias("table_name"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def model_checks(flags: DataFrame, rate_bounds: tuple[float, float] = RATE_BOUNDS_PCT) -> DataFrame:
    """The checks after a build: keys present and unique, known levels, plausible flag rate."""
    name = "fraud_flags"
    in_one_pass = column_checks(
        flags,
        name,
        [*flag_checks(), rate_between("is_flagged", *rate_bounds)],
    )
    return in_one_pass.unionByName(unique(flags, name, "transaction_id"))


def all_checks(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def failures(report: DataFrame) -> DataFrame:
    """One message per failed check."""
    return report.where(~F.col("passed")).select(
        "check_name",
        "table_name",
        F.format_string("Check %s failed on %s: %d violations", "check_name", "table_name", "violations").alias(
            "message"
        ),
    )


def require(report: DataFrame) -> None:
    """Raise with all messages when a check failed (a report has a handful of rows)."""
    messages = [row["message"] for row in failures(report).collect()]
    if messages:
        raise CheckFailed("; ".join(sorted(messages)))
