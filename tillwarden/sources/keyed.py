"""Tables laid out by key: rows of a key always stand in the same bucket.

An upsert shuffles the load to the buckets and reads the table where it stands; a lookup of one
key opens one bucket. Every upsert writes the table anew into a version folder, which counts once
it is complete: for tables of one row per customer that change all over, not for event tables
(``TableStore.merge`` rewrites only the dates that change).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.operators.merge import assert_unique
from tillwarden.sources.tables import KEPT_VERSIONS, TableStore


class KeyedTable:
    """One table of a store, by ``key``. The number of buckets is set when it is first written and
    read from its folder after that."""

    def __init__(self, store: TableStore, name: str, key: str, buckets: int = 64):
        self.store, self.name, self.key = store, name, key
        self.folder = f"{store.root}/{name}"
        self._catalog: dict[int, str] = {}
        found = store._children(self.folder)
        self.buckets = next((int(c.split("=")[1]) for c in found if c.startswith("buckets=")), buckets)

    def _path(self, version: int) -> str:
        return f"{self.folder}/buckets={self.buckets}/v={version}"

    def _versions(self) -> list[int]:
        """Numbers of the complete versions, newest first."""
        numbers = self.store._numbered(f"{self.folder}/buckets={self.buckets}", "v=")
        return [n for n in numbers if self.store._there(f"{self._path(n)}/_SUCCESS")]

    def _write(self, rows: DataFrame, version: int) -> None:
        self.store._delete(self._path(version))
        name = f"keyed_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", self._path(version))
        writer.format("parquet").saveAsTable(name)
        self._catalog[version] = name
        for old in self.store._numbered(f"{self.folder}/buckets={self.buckets}", "v="):
            if old <= version - KEPT_VERSIONS:
                self.store._delete(self._path(old))

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self) -> DataFrame:
        """The newest complete version. Only the session's catalog can say that files are
        bucketed, so the version is entered there under a name of its own."""
        version = self._versions()[0]
        spark = self.store.spark
        if version not in self._catalog:
            name = f"keyed_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(self._path(version)).schema)
            spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self._path(version)}'"
            )
            self._catalog[version] = name
        return spark.table(self._catalog[version])

    def merged(self, load: DataFrame) -> DataFrame:
        """The table with the rows of ``load`` in place of those of the same key: columns of the
        table that the load lacks keep what they had, new columns are NULL in other rows. Rows of
        either side without a key stay as they are."""
        table, key = self.read(), self.key
        # The key stands beside each row, so that the table's buckets are seen to be those of the join.
        old = table.select(F.col(key).alias("_old_key"), F.struct("*").alias("old"))
        new = load.select(F.col(key).alias("_new_key"), F.struct("*").alias("new")).repartition(self.buckets, "_new_key")
        both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
        fresh = F.col("new").isNotNull()

        def value(name: str) -> Column:
            mine = F.col(f"new.`{name}`") if name in load.columns else F.col(f"old.`{name}`")
            kept = F.col(f"old.`{name}`") if name in table.columns else F.lit(None)
            return F.when(fresh, mine).otherwise(kept).alias(name)

        return both.select(*(value(c) for c in dict.fromkeys([*table.columns, *load.columns])))

    def upsert(self, load: DataFrame) -> None:
        """``load`` must hold each key once. A run that stops leaves the version before in force."""
        assert_unique(load.where(F.col(self.key).isNotNull()), [self.key])
        versions = self._versions()
        if versions:
            self._write(self.merged(load), versions[0] + 1)
        else:
            self._write(load.repartition(self.buckets, self.key), 1)

    def rows_of(self, asked: DataFrame, few: int = 1000) -> DataFrame:
        """The rows of the keys in ``asked``. Up to ``few`` different keys (that many come to the
        driver) are asked for by value, which opens their buckets only; more are joined with the
        table's buckets where they stand."""
        keys = asked.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        some = [r[0] for r in keys.limit(few + 1).collect()]
        if len(some) <= few:
            return self.read().where(F.col(self.key).isin(some))
        return self.read().join(keys.repartition(self.buckets, self.key), self.key, "left_semi")

    def lookup(self, value: object) -> DataFrame:
        """The row of one key; one bucket is opened."""
        return self.read().where(F.col(self.key) == F.lit(value))


__all__ = ["KeyedTable"]
