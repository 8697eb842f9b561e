import pytest
from helpers import at, frame, rows

from pyspark.sql import functions as F
from tillwarden.operators.quality import CheckFailed
from tillwarden.plans import nightly
from tillwarden.schemas import FRAUD_ALERTS
from tillwarden.sources.tables import TableStore
from test_models import raw

COLUMNS = "k STRING, v BIGINT, loaded_at TIMESTAMP_NTZ"
DAY = 86400


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def load(spark, *pairs, day=0):
    return frame(spark, COLUMNS, [(k, v, at(day * DAY)) for k, v in pairs])


def test_overwrite_reads_its_own_table(store, spark):
    store.overwrite("t", load(spark, ("a", 1)))
    store.overwrite("t", store.read("t").withColumn("v", F.col("v") + 1))
    assert rows(store.read("t"), "k", "v") == [("a", 2)]


def test_unfinished_version_is_not_read(store, spark, tmp_path):
    store.overwrite("t", load(spark, ("a", 1)))
    store.overwrite("t", load(spark, ("a", 2)))
    (tmp_path / "t" / "v=2" / "_SUCCESS").unlink()
    assert rows(store.read("t"), "v") == [(1,)]


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_merge_replaces_by_key_and_touches_only_hit_partitions(store, spark, tmp_path):
    store.merge("t", load(spark, ("a", 1), ("b", 1)), ["k"], "loaded_at")
    store.merge("t", load(spark, ("c", 2), day=1), ["k"], "loaded_at")
    kept = files(tmp_path / "t")
    store.merge("t", load(spark, ("c", 3), ("d", 3), day=2), ["k"], "loaded_at")
    assert rows(store.read("t"), "k", "v") == [("a", 1), ("b", 1), ("c", 3), ("d", 3)]
    after = files(tmp_path / "t")
    assert all(after[p] == t for p, t in kept.items() if "2024-03-01" in str(p))
    assert not any("2024-03-02" in str(p) for p in store.read("t").inputFiles())  # its only row moved on


class Broken(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "publish", "cut"])
@pytest.mark.parametrize("first", [True, False])
def test_failed_merge_leaves_the_table_and_can_be_repeated(store, spark, tmp_path, monkeypatch, step, first):
    """A failure before the new partitions are written, before they are published, or while the
    pointer is; also of a first load that holds copies."""
    if not first:
        store.merge("t", load(spark, ("a", 1), ("b", 1)), ["k"], "loaded_at")
    new = load(spark, ("b", 2), ("b", 3) if first else ("c", 2), day=0 if first else 1)
    before = rows(store.read("t")) if not first else None

    def fail(*_, **__):
        raise Broken

    with monkeypatch.context() as patch:
        if step == "write":
            patch.setattr(store, "_children", fail)
        else:
            plain = store._publish
            cut = lambda name, pointer: (plain(name, pointer), [p.write_text(p.read_text()[:20]) for p in (tmp_path / "t").glob(f"pointer-{pointer['number']}")], fail())
            patch.setattr(store, "_publish", fail if step == "publish" else cut)
            for crc in (tmp_path / "t").glob(".pointer*"):
                crc.unlink()
        with pytest.raises(Exception):
            store.merge("t", new, ["k"], "loaded_at")
    for crc in (tmp_path / "t").glob(".pointer*"):
        crc.unlink()  # the checksum of the file that was cut above
    assert (rows(store.read("t")) if not first else store._pointer("t")) == before
    store.recover("t")
    store.merge("t", new, ["k"], "loaded_at")
    assert rows(store.read("t"), "k", "v") == ([("b", 2), ("b", 3)] if first else [("a", 1), ("b", 2), ("c", 2)])


def test_loads_are_known_by_number_and_marks_are_kept(store, spark):
    store.merge("t", load(spark, ("a", 1)), ["k"], "loaded_at", {"seen": 4})
    store.merge("t", load(spark, ("b", 2), ("a", 3)), ["k"], "loaded_at")  # the same load date
    assert (store.load_number("t"), store.marks("t")) == (2, {"seen": 4})
    assert rows(store.since("t", 1), "k", "v") == [("a", 3), ("b", 2)] and store.since("t", 2).count() == 0
    assert store.load_number("none") == 0 and store.marks("none") == {}


def test_new_rows_are_read_from_new_folders_only(store, spark):
    for day in range(3):
        store.merge("t", load(spark, (f"k{day}", day), day=day), ["k"], "loaded_at")
    assert all("merge=3" in f for f in store.since("t", 2).inputFiles())


def test_old_folders_and_versions_go(store, spark, tmp_path):
    for n in range(5):
        store.merge("t", load(spark, ("a", n)), ["k"], "loaded_at")
        store.overwrite("v", load(spark, ("a", n)))
    names = lambda t: sorted(p.name for p in (tmp_path / t).iterdir() if not p.name.startswith("."))
    assert names("t") == ["merge=4", "merge=5", "pointer-4", "pointer-5"] and names("v") == ["v=4", "v=5"]
    assert rows(store.read("t"), "v") == [(4,)]


def test_merge_refuses_repeated_keys(store, spark):
    store.merge("t", load(spark, ("a", 1)), ["k"], "loaded_at")
    with pytest.raises(ValueError):
        store.merge("t", load(spark, ("b", 1), ("b", 2), day=1), ["k"], "loaded_at")


def test_merged_table_has_the_latest_columns(store, spark):
    store.merge("t", load(spark, ("a", 1)), ["k"], "loaded_at")
    store.merge("t", load(spark, ("b", 2), day=1).drop("v").withColumn("w", F.lit("new")), ["k"], "loaded_at")
    assert rows(store.read("t"), "k", "w") == [("a", None), ("b", "new")]
    assert "v" not in store.read("t").columns


def test_views(store, spark):
    store.view("some_view", load(spark, ("a", 1)))
    assert spark.sql("SELECT count(*) FROM some_view").first()[0] == 1


BOUNDS = (0.0, 100.0)


def alerts_for(spark, *ids):
    blank = dict.fromkeys(FRAUD_ALERTS.names)
    made = [
        blank | dict(transaction_id=i, customer_id="c", event_time=at(0), alerted_at=at(0), risk_level="HIGH",
                     merchant_country="RU", amount_flag=False, merchant_flag=True, geo_flag=False)
        for i in ids
    ]
    df = spark.createDataFrame([tuple(r[n] for n in FRAUD_ALERTS.names) for r in made], FRAUD_ALERTS)
    return df.withColumn("fraud_score", F.lit(35).cast("decimal(5,2)"))


def test_nightly_in_two_loads_equals_one(spark, tmp_path):
    day1 = raw(spark, {"transaction_id": "a"}, {"transaction_id": "b"}, {"transaction_id": "a", "amount": 3.0})
    day2 = day1.unionByName(raw(spark, {"transaction_id": "c", "ingested_at": at(DAY)}, {"transaction_id": "b", "ingested_at": at(DAY)}))
    alerts = alerts_for(spark, "a", "c")
    two, one = (TableStore(spark, str(tmp_path / name)) for name in ("two", "one"))
    nightly.run(two, day1, alerts, at(60), None, BOUNDS)
    nightly.run(two, day2, alerts, at(DAY + 60), None, BOUNDS)
    nightly.run(one, day2, alerts, at(DAY + 60), None, BOUNDS)
    for table in ("clean_transactions", "fraud_flags", "merchant_risk_scores", "high_risk_customers"):
        hidden = ("load_date", "load_number", "dbt_loaded_at", "silver_loaded_at", "fraud_flags_loaded_at", "refreshed_at")
        assert rows(two.read(table).drop(*hidden)) == rows(one.read(table).drop(*hidden)), table
    before = rows(two.read("fraud_flags"))
    nightly.run(two, day2, alerts, at(DAY + 120), None, BOUNDS)
    assert rows(two.read("fraud_flags")) == before


def test_repeat_at_the_same_as_of_takes_new_rows_and_late_alerts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    day1 = raw(spark, {"transaction_id": "a"}, {"transaction_id": "b"})
    nightly.run(store, day1, alerts_for(spark, "a"), at(60), None, BOUNDS)
    more = day1.unionByName(raw(spark, {"transaction_id": "c", "ingested_at": at(30)}))
    late = alerts_for(spark, "b", "c").withColumn("alerted_at", F.lit(at(50)))
    nightly.run(store, more, alerts_for(spark, "a").unionByName(late), at(60), None, BOUNDS)
    for table in ("raw_transactions", "clean_transactions", "fraud_flags"):
        assert rows(store.read(table), "transaction_id") == [("a",), ("b",), ("c",)], table
    assert rows(store.read("fraud_flags"), "is_flagged") == [(True,)] * 3


def flags_of(store):
    return rows(store.read("fraud_flags"), "transaction_id", "is_flagged", "alerted_at")


def test_alerts_after_a_first_run_without_any(spark, tmp_path):
    day1 = raw(spark, {"transaction_id": "a"}, {"transaction_id": "b"})
    more = day1.unionByName(raw(spark, {"transaction_id": "c", "ingested_at": at(30), "event_time": at(20)}))
    for name, second in (("same", day1), ("more", more)):
        store = TableStore(spark, str(tmp_path / name))
        nightly.run(store, day1, alerts_for(spark), at(60), None, BOUNDS)
        nightly.run(store, second, alerts_for(spark, "a"), at(120), None, BOUNDS)
        assert flags_of(store)[:2] == [("a", True, at(0)), ("b", False, None)], name


def test_alerts_at_or_below_the_newest_one_seen(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    day1 = raw(spark, *({"transaction_id": i} for i in "abcd"))
    came = lambda when, *ids: alerts_for(spark, *ids).withColumn("alerted_at", F.lit(at(when)))
    first = came(50, "a")
    nightly.run(store, day1, first, at(60), None, BOUNDS)
    lagging = came(50, "b").unionByName(came(10, "c")).unionByName(came(20, "a"))  # of a, an earlier one
    more = day1.unionByName(raw(spark, {"transaction_id": "e", "ingested_at": at(30), "event_time": at(20)}))
    nightly.run(store, day1, first.unionByName(lagging), at(120), None, BOUNDS)
    expected = [("a", True, at(20)), ("b", True, at(50)), ("c", True, at(10)), ("d", False, None)]
    assert flags_of(store) == expected
    # An alert of a new transaction counts whatever event time it carries; one without facts is taken once.
    alerts = first.unionByName(lagging).unionByName(came(5, "e")).unionByName(came(5, "d").withColumn("risk_level", F.lit(None).cast("string")))
    nightly.run(store, more, alerts, at(180), None, BOUNDS)
    assert flags_of(store) == [*expected[:3], ("d", True, at(5)), ("e", True, at(5))]
    number = store.load_number("fraud_flags")
    nightly.run(store, more, alerts, at(180), None, BOUNDS)
    assert store.load_number("fraud_flags") == number


def test_rows_of_a_later_batch_that_arrived_earlier(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    batch = lambda n, when, *ids: raw(spark, *({"transaction_id": i, "ingested_at": at(when)} for i in ids)).withColumn("batch_id", F.lit(n).cast("long"))
    day1 = batch(0, 30, "a")
    nightly.run(store, day1, alerts_for(spark), at(60), ["bronze"])
    more = day1.unionByName(batch(1, 30, "b")).unionByName(batch(2, 10, "c", "c"))
    nightly.run(store, more, alerts_for(spark), at(120), ["bronze"])
    assert rows(store.read("raw_transactions"), "transaction_id") == [("a",), ("b",), ("c",)]
    assert "batch_id" not in store.read("raw_transactions").columns
    nightly.run(store, more, alerts_for(spark), at(180), ["bronze"])
    assert store.load_number("raw_transactions") == 2


def test_incomplete_rows_wait_aside(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    bad = raw(spark, {"transaction_id": "a"}, {"transaction_id": None}, {"transaction_id": None}, {"transaction_id": "d", "amount": None})
    for _ in range(2):
        nightly.run(store, bad, alerts_for(spark), at(60), None, BOUNDS)
    assert rows(store.read("raw_transactions"), "transaction_id") == [("a",)]
    assert store.read("rejected_transactions").where("transaction_id = 'd'").count() == 1


def test_failed_step_stops_the_run(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(CheckFailed, match="freshness"):
        nightly.run(store, raw(spark, {}), alerts_for(spark, "a"), at(3 * 3600))
    assert not store.exists("raw_transactions")


def test_one_layer_can_be_run_alone(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert nightly.run(store, raw(spark, {}), alerts_for(spark, "a"), at(9 * 3600), ["bronze"]) == ["bronze"]
    assert store.exists("raw_transactions") and not store.exists("clean_transactions")
