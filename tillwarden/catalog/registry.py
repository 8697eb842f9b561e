"""Named queries: a function (spark, sf_dir) -> DataFrame and the SQL with the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its checking SQL."""

    def keep(function: Query) -> Query:
        ENTRIES[function.__name__] = Entry(function, sql)
        return function

    return keep
