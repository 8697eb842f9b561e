"""Tables by key, lookups that skip row groups, unknown fields, checks counted in the write, profiles in the state."""

import json
import re

import pytest
from helpers import START, at, frame, rows
from test_plans import plan
from test_streams import MESSAGES, Topic, body

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, VariantType
from tillwarden.operators import quality
from tillwarden.schemas import TRANSACTIONS_RAW
from tillwarden.sources import messages as topics
from tillwarden.sources.keyed import KeyedTable
from tillwarden.sources.tables import TableStore
from tillwarden.streaming import jobs

PROFILES = "customer_id STRING, total BIGINT, tier STRING"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


# Tables by key

def people(spark, *made):
    return frame(spark, PROFILES, list(made))


def test_upserts_by_key(store, spark):
    KeyedTable(store, "p", "customer_id", 4).upsert(people(spark, ("a", 1, "x"), ("b", 1, "x"), (None, 5, "none")))
    KeyedTable(store, "p", "customer_id").upsert(people(spark, ("b", 2, None), ("c", 2, "y"), (None, 6, "new")))
    table = KeyedTable(store, "p", "customer_id", 99)
    assert table.buckets == 4  # as it was first written
    assert rows(table.read()) == [("a", 1, "x"), ("b", 2, None), ("c", 2, "y"), (None, 5, "none"), (None, 6, "new")]
    assert rows(table.lookup("c")) == [("c", 2, "y")] and table.lookup("z").count() == 0
    table.upsert(people(spark, ("a", 3, "x")).drop("tier").withColumn("added", F.lit(True)))
    assert rows(table.read().where("customer_id <= 'b'")) == [("a", 3, "x", True), ("b", 2, None, None)]
    with pytest.raises(ValueError):
        table.upsert(people(spark, ("a", 1, "x"), ("a", 2, "x")))


def test_only_the_load_is_shuffled(store, spark):
    KeyedTable(store, "p", "customer_id", 4).upsert(people(spark, *((f"c{k}", k, "x") for k in range(500))))
    table = KeyedTable(store, "p", "customer_id")
    load = people(spark, *((f"c{k}", k, "y") for k in range(490, 510)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(table.merged(load))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert text.count("Exchange") == 1 and "Bucketed: true" in text and "SortMergeJoin" in text
    assert 0 < scanned(table.lookup("c7")) < 250
    table.upsert(load)
    assert rows(table.read().groupBy("tier").count()) == [("x", 490), ("y", 20)]


def test_rows_of_few_and_of_many_keys(store, spark):
    KeyedTable(store, "p", "customer_id", 16).upsert(people(spark, *((f"c{k}", k, "x") for k in range(2000))))
    table = KeyedTable(store, "p", "customer_id")
    asked = frame(spark, "customer_id STRING", [("c7",), ("c7",), (None,), ("z",), ("c1999",)])
    few, many = table.rows_of(asked), table.rows_of(asked, few=1)
    assert rows(few) == rows(many) == [("c1999", 1999, "x"), ("c7", 7, "x")]
    assert 0 < scanned(few) <= 2000 / 4 and "Exchange" in plan(many) and "Bucketed: true" in plan(many)


def test_an_unfinished_version_of_a_keyed_table_is_not_read(store, spark, tmp_path):
    table = KeyedTable(store, "p", "customer_id", 2)
    table.upsert(people(spark, ("a", 1, "x")))
    table.upsert(people(spark, ("a", 2, "x")))
    (tmp_path / "p" / "buckets=2" / "v=2" / "_SUCCESS").unlink()
    again = KeyedTable(store, "p", "customer_id")
    assert rows(again.read(), "total") == [(1,)]
    again.upsert(people(spark, ("a", 3, "x")))
    assert rows(KeyedTable(store, "p", "customer_id").read(), "total") == [(3,)]


# Lookups

def scanned(df):
    """Rows that the file scan of a lookup gave to the filter."""
    execution = df._jdf.queryExecution()
    df.collect()
    pending, found = [execution.executedPlan()], 0
    while pending:
        node = pending.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        pending += [children.apply(k) for k in range(children.size())]
        if "QueryStage" in node.nodeName():
            pending.append(node.plan())
    return found


def test_a_lookup_opens_the_row_groups_that_may_hold_the_id(spark, tmp_path):
    """Ids in no order, so minimum and maximum of a row group exclude nothing; a hot id and NULLs besides."""
    from tillwarden.sources.tables import findable

    n = 60_000
    ids = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.sha2(F.col("id").cast("string"), 256))
    df = spark.range(n).select(ids.alias("k"), F.col("id").alias("v")).coalesce(1)
    df.write.parquet(f"{tmp_path}/plain", mode="overwrite")
    df.write.options(**findable(["k"], 256 << 10)).parquet(f"{tmp_path}/found")
    found, plain = (spark.read.parquet(f"{tmp_path}/{p}") for p in ("found", "plain"))
    wanted = [r["k"] for r in df.where("v % 9973 = 2 AND k <> 'hot'").collect()]
    for k in wanted:
        assert rows(found.where(F.col("k") == k)) == rows(plain.where(F.col("k") == k)) and found.where(F.col("k") == k).count() == 1
    one = scanned(found.where(F.col("k") == wanted[0]))
    assert 0 < one <= n / 8 and scanned(plain.where(F.col("k") == wanted[0])) > 2 * one
    assert scanned(found.where(F.col("k") == F.sha2(F.lit("absent"), 256))) <= n / 20
    assert found.where("k = 'hot'").count() == n / 3


def test_store_tables_get_the_filters_they_are_asked_for(store, spark, tmp_path):
    import pyarrow.parquet as pq

    made = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(at(0)).alias("loaded"))
    store.overwrite("v", made, find=["k"])
    store.merge("m", made, ["k"], "loaded", find=["k"])
    for name in ("v", "m"):
        file = next(p for p in (tmp_path / name).rglob("*.parquet") if "load-" not in str(p))
        raw = file.read_bytes()
        assert pq.ParquetFile(file).metadata.num_rows and len(raw) > 0
        assert scanned(store.read(name).where(F.col("k") == "0" * 64)) < 5000


# Fields that the schema does not know

def test_unknown_fields_are_kept_reported_and_filled_in(spark, topic, tmp_path):
    topic.send(
        body(1), body(2, loyalty="gold"), body(3, loyalty=None, device={"os": "x", "v": 2}), body(4, loyalty="7", points=3),
        body(5, points=2.5), "{broken", json.dumps([1, 2]), body(6, **{"odd name": True}),
    )
    jobs.finish(jobs.start_raw_loader(topic.stream(), f"{tmp_path}/t", f"{tmp_path}/o", trigger=None, keep_unknown=True))
    loaded = jobs.loaded_rows(spark, f"{tmp_path}/t", StructType([*TRANSACTIONS_RAW.fields, StructField(topics.EXTRA, VariantType())]))
    assert rows(loaded.where(F.col(topics.EXTRA).isNull()), "transaction_id") == [("1",)]
    assert rows(topics.drift(loaded)) == [
        ("device", "OBJECT<os: STRING, v: BIGINT>", 1), ("loyalty", "STRING", 3), ("odd name", "BOOLEAN", 1), ("points", "DECIMAL(2,1)", 2),
    ]
    filled = topics.backfilled(topics.backfilled(loaded, "loyalty", "string"), "odd name", "boolean")
    assert rows(filled, "transaction_id", "loyalty", "odd name") == [
        ("1", None, None), ("2", "gold", None), ("3", None, None), ("4", "7", None), ("5", None, None), ("6", None, True),
    ]
    # A column that has come by now: what rows have of it stands.
    typed = loaded.withColumn("points", F.when(F.col("transaction_id") == "4", 9))
    assert rows(topics.backfilled(typed, "points", "int"), "transaction_id", "points")[3:5] == [("4", 9), ("5", 2)]
    assert rows(topics.backfilled(loaded, "loyalty", "int").where("loyalty is not null"), "transaction_id", "loyalty") == [("4", 7)]


def test_messages_without_unknown_fields_have_no_drift(spark):
    df = frame(spark, MESSAGES, [("c", body(1), START), ("c", None, START), ("c", "", START)])
    assert topics.drift(df.select(topics.unknown_fields())).count() == 0


# Checks counted in the write

CHECKS = "k STRING, level STRING, flag BOOLEAN"


def wanted():
    return [quality.not_null("k"), quality.accepted_values("level", ("LOW", "HIGH"))]


def test_checks_are_counted_while_a_table_is_written(spark, tmp_path):
    df = frame(spark, CHECKS, [("a", "LOW", True), (None, "odd", False), (None, None, None)])
    counted = quality.counted_while(df, wanted(), lambda rows: rows.write.parquet(f"{tmp_path}/t"))
    assert counted == {"not_null_k": 2, "accepted_values_level": 1}
    mine, theirs = quality.report(spark, "t", counted), quality.column_checks(spark.read.parquet(f"{tmp_path}/t"), "t", wanted())
    assert rows(mine) == rows(theirs) and mine.dtypes == theirs.dtypes
    none = quality.counted_while(df.limit(0), wanted(), lambda rows: rows.write.parquet(f"{tmp_path}/none"))
    assert none == {"not_null_k": 0, "accepted_values_level": 0}


def test_streams_and_tables_give_the_same_figures(spark, tmp_path):
    made = [("a", "LOW", True), (None, "odd", False), ("hot", "HIGH", True)] * 40 + [(None, None, None)]
    whole = frame(spark, CHECKS, made)
    whole.repartition(3).write.parquet(f"{tmp_path}/source")
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/source")
    jobs.finish(jobs.to_checked_batches(stream, f"{tmp_path}/out", f"{tmp_path}/offsets", wanted, trigger=None))
    report = jobs.checked_report(spark, f"{tmp_path}/out", "t")
    assert rows(report) == rows(quality.column_checks(whole, "t", wanted()))
    assert spark.read.parquet(f"{tmp_path}/out/rows").count() == len(made)
    written = spark.read.parquet(f"{tmp_path}/out/checks").where("check_name = 'rows'")
    assert written.agg(F.sum("violations")).first()[0] == len(made) and written.count() > 1


@pytest.mark.parametrize("flagged, total", [(0, 0), (0, 10), (1, 100), (5, 100), (6, 100), (1, 1)])
def test_rates_from_counts(spark, flagged, total):
    df = frame(spark, CHECKS, [("a", "LOW", k < flagged) for k in range(total)])
    name, check = quality.rate_between("flag", 1.0, 5.0)
    assert quality.rate_violations(flagged, total, 1.0, 5.0) == df.agg(check.alias(name)).first()[0]


# Profiles in the state

def test_profiles_come_out_of_the_state(spark, topic, tmp_path):
    alert = lambda n, customer, second, **more: body(n, customer, second, amount=5000.0, **more)
    topic.send(alert(1, "a", 0), alert(2, "hot", 5, merchant_country="GB"), *(alert(f"h{k}", "hot", k) for k in range(50)))
    start = lambda: jobs.start_profiles(
        jobs.scored(topic.stream()).where(F.col("fraud_score") > 0), f"{tmp_path}/changes", f"{tmp_path}/offsets", trigger=None
    )
    try:
        for more in ([], [alert(3, "a", 60, merchant_country=None), alert(4, "b", 70, merchant_country="RU")], [alert(5, None, 80)]):
            if more:
                topic.send(*more)
            jobs.finish(start())
            mine, theirs = jobs.profiles_in_state(spark, f"{tmp_path}/offsets"), jobs.current_profiles(spark, f"{tmp_path}/changes")
            assert rows(mine, *theirs.columns) == rows(theirs)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert re.search(r"[Ss]tate", plan(mine)) and "changes" not in plan(mine)


# Compaction of a loader's batches

def test_compacted_batches_read_the_same_and_by_number(spark, topic, tmp_path):
    load = lambda: jobs.finish(jobs.start_raw_loader(topic.stream(), f"{tmp_path}/t", f"{tmp_path}/o", trigger=None))
    read = lambda: jobs.loaded_rows(spark, f"{tmp_path}/t", TRANSACTIONS_RAW)
    for n in range(4):
        topic.send(*(body(f"{n}-{k}") for k in range(5)))
    load()
    before = rows(read(), "transaction_id", "id", "batch_id")
    assert jobs.compact_loaded(spark, f"{tmp_path}/t", TRANSACTIONS_RAW, 1) == 1
    assert rows(read(), "transaction_id", "id", "batch_id") == before
    assert jobs.compact_loaded(spark, f"{tmp_path}/t", TRANSACTIONS_RAW) == 2  # the newest stays: its ids are looked at
    assert jobs.compact_loaded(spark, f"{tmp_path}/t", TRANSACTIONS_RAW) == 2
    assert rows(read(), "transaction_id", "id", "batch_id") == before
    assert read().where("batch_id > 2").count() == 5 and {p.name for p in (tmp_path / "t" / "rows").iterdir()} == {"batch_id=3"}
    topic.send(body("new"))
    load()
    ids = [r["id"] for r in read().collect()]
    assert len(ids) == 21 == len(set(ids)) and rows(read().where("batch_id = 4"), "transaction_id") == [("new",)]
    # One that stopped half-way does not count.
    assert jobs.compact_loaded(spark, f"{tmp_path}/t", TRANSACTIONS_RAW) == 3
    files = [p for p in (tmp_path / "t" / "compacted" / "upto=3").rglob("*.parquet")]
    assert len(files) <= read().select("load_day").distinct().count() and read().count() == 21
    (tmp_path / "t" / "compacted" / "upto=4").mkdir()
    assert read().count() == 21


def test_folders_of_a_run_go_at_its_end(spark, tmp_path):
    from tillwarden import session

    made = []
    with pytest.raises(OSError), session.one_run(spark):
        made.append(session.materialise(spark.range(3)).inputFiles()[0])
        with session.one_run(spark):
            made.append(session.materialise(spark.range(3)).inputFiles()[0])
        assert spark.read.parquet(made[0]).count() >= 0
        raise OSError
    import os

    assert not any(os.path.exists(f.removeprefix("file://")) for f in made)
    kept = session.materialise(spark.range(3)).inputFiles()[0]
    assert os.path.exists(kept.removeprefix("file://"))
