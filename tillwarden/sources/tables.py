"""Parquet tables in one folder: rebuilt whole, or merged by key.

* ``overwrite`` writes a new version folder; readers see it once Spark has put its
  ``_SUCCESS`` file there, so a lost job leaves the old version in force.
* ``merge`` writes the load-date partitions that change into a new folder and then publishes
  them with one small pointer file. Nothing that the table consists of is overwritten or
  deleted before that, so a merge that fails at any point leaves the table as it was, and
  repeating it is a new merge.

Every merged row carries the number of the load that brought it (``load_number``), and each
pointer can carry marks of what its sources had given: what is new for the next step is asked
by number, never by clock.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from tillwarden.operators.merge import assert_unique, upsert

LOAD_DATE, LOAD_NUMBER = "load_date", "load_number"
#: Partition column: the merge that wrote a row's file (a row keeps its load number).
WRITTEN = "merge"
#: Folder prefix of appended loads.
APPENDED = "added"
KEPT_VERSIONS = 2
#: Loads whose changed dates are kept with the pointer.
KEPT_CHANGES = 64


def findable(columns: Sequence[str], row_group_bytes: int | None = None) -> dict[str, str]:
    """Options of a Parquet writer: a Bloom filter for each of the columns in every row group,
    as large as its values need. Smaller row groups make a lookup read less."""
    options = {"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}
    options |= {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return options if row_group_bytes is None else options | {"parquet.block.size": str(row_group_bytes)}


class MergeConflict(Exception):
    """Two merges of one table at once: the second gives up, before it has written anything."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, location: str):
        return self._hadoop.Path(location)

    def _there(self, location: str) -> bool:
        return self._fs.exists(self._path(location))

    def _children(self, location: str) -> list[str]:
        if not self._there(location):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(location))]

    def _numbered(self, location: str, prefix: str) -> list[int]:
        """Numbers of the children ``prefix`` + number, newest first."""
        found = (c[len(prefix):] for c in self._children(location) if c.startswith(prefix))
        return sorted((int(n) for n in found if n.isdigit()), reverse=True)

    def _delete(self, location: str) -> None:
        self._fs.delete(self._path(location), True)

    # Tables rebuilt whole

    def _version(self, name: str) -> int:
        """Newest complete version, 0 when there is none."""
        folder = f"{self.root}/{name}"
        return next((n for n in self._numbered(folder, "v=") if self._there(f"{folder}/v={n}/_SUCCESS")), 0)

    def _folder(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version}"

    def overwrite(self, name: str, df: DataFrame, lookup_by: str | None = None, find: Sequence[str] = ()) -> DataFrame:
        """``lookup_by`` orders the files by that column, so that a lookup of one value
        reads the few row groups whose minimum and maximum enclose it; columns in ``find`` get
        Bloom filters, so that a lookup by them skips row groups without the value. The version
        before stays for its readers, older ones are deleted."""
        version = self._version(name) + 1
        ordered = df if lookup_by is None else df.repartitionByRange(lookup_by).sortWithinPartitions(lookup_by)
        ordered.write.options(**findable(find)).mode("overwrite").parquet(self._folder(name, version))
        for old in self._numbered(f"{self.root}/{name}", "v="):
            if old <= version - KEPT_VERSIONS:
                self._delete(self._folder(name, old))
        return self.spark.read.parquet(self._folder(name, version))

    # Tables merged by key

    def _pointer(self, name: str) -> dict | None:
        """The newest readable pointer; one that a crash cut short does not count."""
        folder = f"{self.root}/{name}"
        for number in self._numbered(folder, "pointer-"):
            if (pointer := self._parsed(f"{folder}/pointer-{number}")) is not None:
                return pointer
        return None

    def _parsed(self, location: str) -> dict | None:
        java = self.spark._jvm.java.io
        lines = java.BufferedReader(java.InputStreamReader(self._fs.open(self._path(location)), "UTF-8"))
        try:
            return json.loads(lines.readLine() or "")
        except ValueError:
            return None
        finally:
            lines.close()

    def _create(self, location: str, content: str) -> None:
        """A new file; fails where there is one."""
        try:
            out = self._fs.create(self._path(location), False)
        except Exception as error:
            raise MergeConflict(f"{location} is there: another merge is at work, or one has failed and waits for recover()") from error
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()

    def _publish(self, name: str, pointer: dict) -> None:
        self._create(f"{self.root}/{name}/pointer-{pointer['number']}", json.dumps(pointer))

    def _parts(self, name: str, pointer: dict, dates: Sequence[str] | None = None) -> list[str]:
        wanted = pointer["parts"] if dates is None else {d: pointer["parts"][d] for d in dates}
        return [f"{self.root}/{name}/{WRITTEN}={n}/{LOAD_DATE}={d}" for d, n in sorted(wanted.items())]

    def _read_parts(self, name: str, pointer: dict, dates: Sequence[str] | None = None) -> DataFrame:
        """Rows of the published partitions, with the partition columns last."""
        columns = StructType.fromJson(pointer["columns"])
        full = StructType([*columns.fields, StructField(WRITTEN, IntegerType()), StructField(LOAD_DATE, DateType())])
        parts = self._parts(name, pointer, dates)
        if not parts:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", f"{self.root}/{name}").parquet(*parts)

    def merge(
        self,
        name: str,
        rows: DataFrame,
        keys: Sequence[str],
        loaded: str,
        marks: dict[str, object] | None = None,
        changed: str | None = None,
        unique: bool = False,
        find: Sequence[str] = (),
    ) -> int:
        """Put ``rows`` into the table and return the load's number; ``loaded`` is their load
        time column. Whole rows replace those of the same key. The first load of a table may
        hold copies of a key (unless ``unique``), later ones may not. ``marks`` is kept with the load, and so are the
        values of the date column ``changed`` in the rows that came or went (see ``changed_days``).
        Columns in ``find`` get Bloom filters.

        Three jobs read data: one writes the load, one looks up its keys and finds the
        partitions that hold a replaced row, one writes the partitions that change.
        A merge first takes its number; where another one has it, it fails.
        """
        pointer = self._pointer(name) or {"number": 0, "parts": {}, "columns": None, "marks": {}}
        number = pointer["number"] + 1
        target = f"{self.root}/{name}/{WRITTEN}={number}"
        self._create(f"{target}/_taken", "")
        staged = f"{self.root}/{name}/load-{number}"
        stamped = rows.withColumns({LOAD_NUMBER: F.lit(number).cast("long"), LOAD_DATE: F.to_date(loaded)})
        stamped.write.mode("overwrite").parquet(staged)
        load = self.spark.read.schema(stamped.schema).parquet(staged)
        columns = StructType([f for f in stamped.schema.fields if f.name != LOAD_DATE])
        new_dates = {str(r[0]) for r in load.select(LOAD_DATE).distinct().collect()}  # one value per load day
        days = {r[0] for r in load.select(changed).distinct().collect()} if changed else set()  # dates
        hit: set[str] = set()
        result = load
        if new_dates and (pointer["number"] or unique):
            assert_unique(load, keys)
        if pointer["number"] and new_dates:
            table = self._read_parts(name, pointer)
            went = [changed] if changed and changed in table.columns else []
            found = table.select(LOAD_DATE, *went, *keys).join(load.select(*keys), list(keys), "left_semi")
            found = found.select(LOAD_DATE, *went).distinct().collect()  # dates
            hit = {str(r[0]) for r in found}
            days |= {r[1] for r in found} if went else set()
            touched = sorted(hit | (new_dates & set(pointer["parts"])))
            if touched:
                kept = self._read_parts(name, pointer, touched).drop(WRITTEN)
                result = upsert(kept, load, keys)
        result.write.options(**findable(find)).partitionBy(LOAD_DATE).mode("append").parquet(target)
        prefix = f"{LOAD_DATE}="
        written = {c[len(prefix):]: number for c in self._children(target) if c.startswith(prefix)}
        parts = {d: n for d, n in pointer["parts"].items() if d not in hit | new_dates} | written
        before = dict(pointer["marks"])
        log = {n: d for n, d in pointer.get("changed", {}).items() if int(n) > number - KEPT_CHANGES}
        log |= {str(number): sorted(str(d) for d in days if d is not None)} if changed else {}
        self._publish(
            name,
            {
                "number": number,
                "parts": parts,
                "columns": columns.jsonValue(),
                "marks": before | (marks or {}),
                "changed": log,
            },
        )
        self._delete(staged)
        self.clean(name)
        return number

    def clean(self, name: str) -> None:
        """Delete what neither the table nor its state before the last merge consists of, and
        what failed merges have left."""
        folder = f"{self.root}/{name}"
        pointers = self._numbered(folder, "pointer-")
        if not pointers:
            return
        kept = pointers[:KEPT_VERSIONS]
        used = set(kept)
        for number in kept:
            pointer = self._parsed(f"{folder}/pointer-{number}")
            used |= set(pointer["parts"].values()) if pointer else set()
        for number in self._numbered(folder, f"{WRITTEN}="):
            if number not in used and number < pointers[0]:
                self._delete(f"{folder}/{WRITTEN}={number}")
        for number in pointers[KEPT_VERSIONS:]:
            self._delete(f"{folder}/pointer-{number}")

    def recover(self, name: str, keys: Sequence[str] = ()) -> None:
        """Delete what an interrupted merge has left. The table itself needs no repair. Not to be
        called while another merge is at work."""
        pointer = self._pointer(name)
        done = pointer["number"] if pointer else 0
        folder = f"{self.root}/{name}"
        for number in self._numbered(folder, "pointer-"):
            if number > done:
                self._delete(f"{folder}/pointer-{number}")
        for number in self._numbered(folder, "load-"):
            self._delete(f"{folder}/load-{number}")
        for number in self._numbered(folder, f"{WRITTEN}="):
            if number > done:
                self._delete(f"{folder}/{WRITTEN}={number}")

    def marks(self, name: str) -> dict:
        """Marks of the last load, empty when there is none."""
        pointer = self._pointer(name)
        return pointer["marks"] if pointer else {}

    def load_number(self, name: str) -> int:
        """Number of the last load, 0 when there is none."""
        pointer = self._pointer(name)
        return pointer["number"] if pointer else 0

    def changed_days(self, name: str, number: int) -> list[str] | None:
        """Dates of the rows that came or went in the loads after ``number``, of the column that
        ``merge`` was told; None when that is not known any more."""
        pointer = self._pointer(name)
        if pointer is None:
            return None
        loads = [pointer["changed"].get(str(n)) for n in range(number + 1, pointer["number"] + 1)]
        return None if None in loads else sorted({day for load in loads for day in load})

    def append(self, name: str, rows: DataFrame, number: int) -> None:
        """Rows of one more load, by its number: the same load done again replaces itself, and no
        other load is read."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/{APPENDED}={number}")

    def since(self, name: str, number: int) -> DataFrame:
        """Rows brought by loads after ``number``. They were written by merges after it, so
        only those folders are read."""
        pointer = self._pointer(name)
        dates = [d for d, n in pointer["parts"].items() if n > number]
        return self._read_parts(name, pointer, dates).where(F.col(LOAD_NUMBER) > number).drop(WRITTEN)

    # Both kinds

    def exists(self, name: str) -> bool:
        folder = f"{self.root}/{name}"
        return bool(self._numbered(folder, "pointer-") or self._numbered(folder, f"{APPENDED}=") or self._version(name))

    def read(self, name: str) -> DataFrame:
        """The table as it is now. A merged table has the columns of its latest load: a
        column added since is NULL in older rows, a dropped one is gone."""
        pointer = self._pointer(name)
        if pointer:
            return self._read_parts(name, pointer).drop(WRITTEN)
        appended = self._numbered(f"{self.root}/{name}", f"{APPENDED}=")
        if appended:
            folders = (f"{self.root}/{name}/{APPENDED}={n}" for n in appended)
            return self.spark.read.option("mergeSchema", "true").parquet(*folders)
        return self.spark.read.parquet(self._folder(name, self._version(name)))

    def newest_load(self, name: str) -> DataFrame | None:
        """Rows of the latest load date: they hold the table's highest load and ingest time."""
        pointer = self._pointer(name)
        return self._read_parts(name, pointer, [max(pointer["parts"])]).drop(WRITTEN) if pointer and pointer["parts"] else None

    def view(self, name: str, df: DataFrame) -> None:
        """A named view for SQL users of this session."""
        df.createOrReplaceTempView(name)


__all__ = ["LOAD_DATE", "LOAD_NUMBER", "MergeConflict", "TableStore", "findable"]
