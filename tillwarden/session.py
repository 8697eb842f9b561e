"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def utc(spark: SparkSession) -> SparkSession:
    """Event times carry no zone; UTC makes casts to and from ``timestamp`` exact."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    All executors must reach it. Only a session of one process (tests, a laptop)
    without the setting gets a local temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named is None and sc.getCheckpointDir() is None and not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tillwarden-"))
    return (named or sc.getCheckpointDir()).rstrip("/")


#: Folders of the runs that are under way, innermost last.
_RUNS: list[list[str]] = []


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for one run's tables and offsets."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _RUNS:
        _RUNS[-1].append(path)
    return path


@contextmanager
def one_run(spark: SparkSession) -> Iterator[None]:
    """Folders that are made inside are deleted at the end, also of a run that fails: what is to
    stay must have been written elsewhere by then."""
    _RUNS.append([])
    try:
        yield
    finally:
        for path in _RUNS.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Compute once and keep as files in the shared folder: several passes over the result
    read only the columns they need, Spark knows its size, and a lost executor costs no
    recomputation."""
    path = new_run_dir(df.sparkSession, "table")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
