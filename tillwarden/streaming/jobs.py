"""Streaming jobs over message topics.

Each job is one query with its own checkpoint folder, so readers of a topic are
independent and resume where they stopped. Jobs differ only in the frame they write;
rules and windows are the batch operators. File sinks record finished batches, so a
replayed batch leaves no second copy.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tillwarden.config import (
    ALERT_TOPIC,
    LOADER_TRIGGER,
    PIPELINE_RULES,
    SCORING_TRIGGER,
    WATERMARK,
    RuleConfig,
)
from tillwarden.functions.scalars import cell_of, micros, plain_micros, utc_time
from tillwarden.operators import behaviour, quality
from tillwarden.operators.dedup import keep_first
from tillwarden.operators.merge import assign_ids, next_id
from tillwarden.operators.rules import apply_fraud_detection
from tillwarden.plans.alert_views import PROFILE_FACTS, count_tier
from tillwarden.plans.layers import raw_rows
from tillwarden.schemas import ALERT_MESSAGE, FRAUD_ALERTS, REQUIRED_RAW_COLUMNS
from tillwarden.sources import messages as topics
from tillwarden.sources.keyed import KeyedTable
from tillwarden.streaming.bursts import early_velocity_alerts

# Columns of the monitoring output, rows per screen.
CONSOLE_COLUMNS = (
    "customer_id", "transaction_id", "amount", "merchant_category", "merchant_country", "risk_level", "fraud_score",
    "fraud_reason",
)
CONSOLE_ROWS = 20
LOOK_BACK = timedelta(minutes=10)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def large_state(spark: SparkSession) -> None:
    """Keep the state of windows, ids and profiles on disk instead of the heap, and write
    only changes to the checkpoint. Set before a query starts; a query keeps its store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


# Frames

def transactions(messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    return topics.decode(messages, watermark=watermark)


def scored(messages: DataFrame, rules: RuleConfig = PIPELINE_RULES, watermark: str = WATERMARK) -> DataFrame:
    return apply_fraud_detection(transactions(messages, watermark), rules)


def without_redelivery(stream: DataFrame) -> DataFrame:
    """Each transaction_id once within the watermark; ids older than it leave the state."""
    return stream.dropDuplicatesWithinWatermark(["transaction_id"])


def velocity_alerts(stream: DataFrame, rules: RuleConfig = PIPELINE_RULES) -> DataFrame:
    """Closed tumbling windows above the limit; rows behind the watermark are not counted."""
    return behaviour.velocity_alerts(stream, rules)


def multi_country_alerts(stream: DataFrame, rules: RuleConfig = PIPELINE_RULES) -> DataFrame:
    return behaviour.multi_country_alerts(stream, rules)


def first_multi_country_alerts(stream: DataFrame, rules: RuleConfig = PIPELINE_RULES) -> DataFrame:
    """One alert per uninterrupted run of sliding windows: the first. The watermark closes
    windows and then runs, so the state holds open ones only."""
    return behaviour.first_multi_country_alerts(stream, rules)


def repeat_offences(stream: DataFrame, alerts: DataFrame, look_back: timedelta = LOOK_BACK) -> DataFrame:
    """Stream rows whose customer had an alert in [event_time - look_back, event_time], two streams
    against each other: no table is read. Both need a watermark on event_time.

    Rows meet by customer and time cell, an alert being sent to the one or two cells it reaches, so
    a row looks through one cell of its customer's alerts. The time bounds and the watermarks say
    when a kept row can't meet anything any more; the state then lets it go.
    """
    span, time = micros(look_back), behaviour.TIME
    at = F.unix_micros(time)
    reached = F.explode(F.sequence(cell_of(at, span), cell_of(at + span, span)))
    hits = alerts.select(F.col(behaviour.KEY).alias("_who"), F.col(time).alias("_alerted"), reached.alias("_reached"))
    rows = stream.withColumn("_cell", cell_of(at, span))
    recent = (F.col("_alerted") <= F.col(time)) & (F.col("_alerted") >= F.col(time) - F.expr(f"INTERVAL '{span / 1e6:.6f}' SECOND"))
    same = (F.col(behaviour.KEY) == F.col("_who")) & (F.col("_cell") == F.col("_reached"))
    return rows.join(hits, same & recent, "left_semi").drop("_cell")


def running_profiles(alerts: DataFrame) -> DataFrame:
    """A customer's totals over all alerts so far: one state row per customer, and each
    batch emits only the customers it changed (update mode)."""
    totals = alerts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_fraud_alerts"),
        F.sum("fraud_score").cast("long").alias("cumulative_fraud_score"),
        F.max("event_time").alias("last_alert_time"),
        F.max("merchant_country").alias("last_seen_country"),
    )
    return totals.withColumn("risk_tier", count_tier(F.col("total_fraud_alerts"))).select("customer_id", *PROFILE_FACTS)


# Sinks

def _writer(df: DataFrame, checkpoint: str, trigger: str | None, mode: str = "append") -> DataStreamWriter:
    """``trigger`` is an interval; None takes what is there and stops."""
    when = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**when)


def to_files(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = SCORING_TRIGGER, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    return _writer(df, checkpoint, trigger).format("parquet").partitionBy(*partition_by).start(path)


def to_topic_files(df: DataFrame, path: str, checkpoint: str, trigger: str | None = SCORING_TRIGGER) -> StreamingQuery:
    """Messages into a folder that ``read_messages`` can read; they get their arrival time
    here, as a broker would stamp it, and one subfolder per topic if they name one."""
    arrived = df.withColumn("timestamp", F.current_timestamp())
    return to_files(arrived, path, checkpoint, trigger, ("topic",) if "topic" in df.columns else ())


def to_kafka(
    df: DataFrame, servers: str, checkpoint: str, topic: str | None = ALERT_TOPIC, trigger: str | None = SCORING_TRIGGER
) -> StreamingQuery:
    """``topic=None`` when the frame names a topic per row (``routed_messages``)."""
    writer = _writer(df, checkpoint, trigger).format("kafka").option("kafka.bootstrap.servers", servers)
    return (writer if topic is None else writer.option("topic", topic)).start()


def to_console(df: DataFrame, checkpoint: str, trigger: str | None = SCORING_TRIGGER) -> StreamingQuery:
    return (
        _writer(df.select(*CONSOLE_COLUMNS), checkpoint, trigger)
        .format("console")
        .option("truncate", False)
        .option("numRows", CONSOLE_ROWS)
        .start()
    )


def to_numbered_batches(
    df: DataFrame, path: str, checkpoint: str, mode: str, trigger: str | None = LOADER_TRIGGER
) -> StreamingQuery:
    """Each batch overwrites its own ``batch_id`` folder, so a replay changes nothing.
    For output modes the file sink does not take."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _writer(df, checkpoint, trigger, mode).foreachBatch(write).start()


def to_checked_batches(
    df: DataFrame, path: str, checkpoint: str, checks: Callable[[], list[tuple[str, Column]]], trigger: str | None = LOADER_TRIGGER
) -> StreamingQuery:
    """Each batch into its own folder of ``path``/rows, and the violations of ``checks`` in it,
    counted while it is written, into ``path``/checks. A replay changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        put = lambda rows: rows.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        counted = quality.counted_while(batch, [("rows", F.count(F.lit(1))), *checks()], put)
        figures = batch.sparkSession.createDataFrame(list(counted.items()), "check_name string, violations long")
        figures.coalesce(1).write.mode("overwrite").parquet(f"{path}/checks/batch_id={batch_id}")

    return _writer(df, checkpoint, trigger).foreachBatch(write).start()


def checked_report(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The report over all batches so far, from their counts alone."""
    counts = spark.read.schema("check_name string, violations long").parquet(f"{path}/checks").where("check_name <> 'rows'")
    totals = counts.groupBy("check_name").agg(F.sum("violations").alias("violations"))
    return totals.select("check_name", F.lit(table).alias("table_name"), "violations", (F.col("violations") == 0).alias("passed"))


def _folders(spark: SparkSession, path: str, prefix: str = "batch_id=") -> list[int]:
    """Numbers of the batch folders, ascending, by listing (no file is opened)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(hadoop))
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())


def _complete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


# Jobs

def start_alerts(messages, path, checkpoint, rules: RuleConfig = PIPELINE_RULES, trigger=SCORING_TRIGGER):
    """Score, keep the alerts, write them as messages."""
    return to_topic_files(topics.prepare_kafka_output(scored(messages, rules)), path, checkpoint, trigger)


def start_routing(messages, path, checkpoint, rules: RuleConfig = PIPELINE_RULES, trigger=SCORING_TRIGGER):
    """Score once and write alerts, approved and unscored transactions, one folder per topic."""
    return to_topic_files(topics.routed_messages(scored(messages, rules)), path, checkpoint, trigger)


def _start_loader(
    messages: DataFrame,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    path: str,
    checkpoint: str,
    id_column: str,
    date_of: str,
    trigger: str | None,
) -> StreamingQuery:
    """Each batch of messages becomes rows below ``path``/rows and, for what is no valid row,
    ``path``/rejects; both in a folder per batch, so a replay changes nothing.

    Rows are partitioned by the date of ``date_of`` and get ids above those of the batches
    before, unique and with gaps. ``split`` gives (rows, rejects).
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, rejects = split(batch)
        before = [n for n in _folders(spark, f"{path}/rows") if n < batch_id]
        start = 1
        for n in reversed(before):  # the newest batch that has rows, as a rule the first
            ids = StructType([StructField(id_column, LongType())])
            last = next_id(spark.read.schema(ids).parquet(f"{path}/rows/batch_id={n}"), id_column)
            if last > 1:
                start = last
                break
        stamped = assign_ids(rows.drop(id_column), id_column, start)
        dated = stamped.withColumn("load_day", F.to_date(date_of)).select(id_column, *rows.drop(id_column).columns, "load_day")
        dated.write.mode("overwrite").partitionBy("load_day").parquet(f"{path}/rows/batch_id={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{path}/rejects/batch_id={batch_id}")

    return _writer(messages, checkpoint, trigger).foreachBatch(load).start()


def loaded_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A loader's rows, with the number of their batch (batch_id) and their day (load_day)."""
    full = StructType([*schema.fields, StructField("batch_id", LongType()), StructField("load_day", DateType())])
    compacted = _compacted(spark, path)
    if compacted is None:
        return spark.read.schema(full).parquet(f"{path}/rows")
    upto, folder = compacted
    later = [f"{path}/rows/batch_id={n}" for n in _folders(spark, f"{path}/rows") if n > upto]
    rows = spark.read.schema(full).parquet(folder)
    return rows.unionByName(spark.read.schema(full).option("basePath", f"{path}/rows").parquet(*later)) if later else rows


def _compacted(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The newest complete compaction of a loader's batches: up to which one, and its folder."""
    folder = f"{path}/compacted"
    whole = [n for n in _folders(spark, folder, "upto=") if _complete(spark, f"{folder}/upto={n}")]
    return (whole[-1], f"{folder}/upto={whole[-1]}") if whole else None


def compact_loaded(spark: SparkSession, path: str, schema: StructType, upto: int | None = None) -> int | None:
    """Put a loader's batches up to ``upto`` (all but the newest if that is less) into one folder
    per day and delete theirs; returns the last one that was taken. Rows keep the number of their
    batch, so readers that go by number see nothing twice. The loader can go on meanwhile, and a
    compaction that stops half-way changes nothing."""
    batches = _folders(spark, f"{path}/rows")
    before = _compacted(spark, path)
    taken = [n for n in batches[:-1] if (upto is None or n <= upto) and (before is None or n > before[0])]
    if not taken:
        return before[0] if before else None
    last = taken[-1]
    rows = loaded_rows(spark, path, schema).where(F.col("batch_id") <= last)
    # A day's rows meet in as many tasks as their size asks for, each of which writes one file.
    rows.hint("rebalance", "load_day").write.mode("overwrite").partitionBy("load_day").parquet(f"{path}/compacted/upto={last}")
    old = [f"{path}/rows/batch_id={n}" for n in taken] + ([before[1]] if before else [])
    for folder in old:
        _delete(spark, folder)
    return last


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def loaded_rejects(spark: SparkSession, path: str) -> DataFrame:
    """What a loader could not load: the message, its arrival and the reason."""
    return spark.read.parquet(f"{path}/rejects").drop("batch_id")


def _with_reason(decoded: DataFrame, required: tuple[str, ...]) -> DataFrame:
    missing = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required)))
    reason = F.when(F.col(topics.MALFORMED).isNotNull(), "malformed").when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))
    return decoded.withColumn("reason", reason)


def start_alert_loader(messages, path, checkpoint, trigger=LOADER_TRIGGER):
    """Alert messages into the alert table (``loaded_rows``). A batch is limited at the source
    (``kafka_options(batch_rows=LOADER_BATCH_ROWS)``, or ``maxFilesPerTrigger``)."""

    def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        whole = topics.decode(batch, ALERT_MESSAGE, keep=("value",))
        marked = _with_reason(whole, ("transaction_id", "customer_id"))
        rejects = marked.where(F.col("reason").isNotNull()).select(F.col("value").cast("string").alias("message"), "kafka_timestamp", "reason")
        return topics.alert_rows(batch).where(F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull()), rejects

    return _start_loader(messages, split, path, checkpoint, "alert_id", "alerted_at", trigger)


def start_raw_loader(messages, path, checkpoint, as_of=None, trigger=LOADER_TRIGGER, keep_unknown=False):
    """Transaction messages into the raw table (``loaded_rows``); unreadable messages, those
    without a value and those without a required one into the rejects. ``ingested_at`` is the
    broker's arrival time unless ``as_of`` sets it. ``keep_unknown`` adds the column ``extra``:
    messages with fields that the schema lacks, whole (``topics.drift``, ``topics.backfilled``)."""

    def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        more = [topics.EXTRA] if keep_unknown else []
        batch = batch.withColumn(topics.EXTRA, topics.unknown_fields()) if keep_unknown else batch
        decoded = topics.decode(batch, keep=("value", *more))
        marked = _with_reason(decoded, REQUIRED_RAW_COLUMNS)
        rejects = marked.where(F.col("reason").isNotNull()).select(F.col("value").cast("string").alias("message"), "kafka_timestamp", "reason")
        good = marked.where(F.col("reason").isNull()).drop("reason", "value", topics.MALFORMED)
        arrived = good if as_of is not None else good.withColumn("ingested_at", utc_time(F.col("kafka_timestamp")))
        return raw_rows(arrived, as_of, more), rejects

    return _start_loader(messages, split, path, checkpoint, "id", "ingested_at", trigger)


def _start_lookup(stream, look_up: Callable[[DataFrame], DataFrame], path, checkpoint, trigger) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        look_up(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _writer(stream, checkpoint, trigger).foreachBatch(write).start()


def start_repeat_offences(stream, read_alerts: Callable[[], DataFrame], path, checkpoint, look_back=LOOK_BACK, trigger=SCORING_TRIGGER):
    """Stream rows whose customer was flagged shortly before. ``read_alerts`` opens the alert
    table anew for each batch, so alerts that came after the start are seen. What it opens is read
    whole: see ``start_loaded_offences`` and ``repeat_offences`` for large alert tables."""
    return _start_lookup(stream, lambda batch: behaviour.repeat_offences(batch, read_alerts(), look_back), path, checkpoint, trigger)


def start_loaded_offences(stream, alerts_path, path, checkpoint, look_back=LOOK_BACK, trigger=SCORING_TRIGGER):
    """The same by the alert loader's table, of which a batch opens only the days from its
    earliest payment minus the look-back on."""

    def look_up(batch: DataFrame) -> DataFrame:
        first = batch.agg(F.min(behaviour.TIME).alias("first")).select(utc_time(F.col("first"))).first()[0]  # one value
        moment = None if first is None else first - look_back
        return behaviour.repeat_offences(batch, alerts_since(batch.sparkSession, alerts_path, moment), look_back)

    return _start_lookup(stream, look_up, path, checkpoint, trigger)


def alerts_since(spark: SparkSession, path: str, moment: datetime | None) -> DataFrame:
    """The alert loader's rows of the days from ``moment`` on, with event times as instants. An
    alert is written on the day it was raised, which is no earlier than the payment's."""
    rows = loaded_rows(spark, path, FRAUD_ALERTS)
    if moment is not None:
        rows = rows.where(F.col("load_day") >= F.lit(moment.date()))
    return rows.withColumn("event_time", F.timestamp_micros(plain_micros(F.col("event_time"))))


def start_accounted(stream, path, checkpoint, late: Callable[[Column], Column] | None = None, trigger=SCORING_TRIGGER):
    """Every row of a stream with a watermark into ``path``/kept or, if an operator with state would
    drop it as late, into ``path``/late: together all rows that were sent.

    ``late`` says of a row and a watermark (an instant) whether the operator would drop the row: by
    default what ``event_time`` alone decides, ``window_closed`` for windows. The watermark is the
    one that operators measure late rows by, that of the batch before, as the query's own offset
    log has it; so a replayed batch is split as it was.
    """
    too_late = late or (lambda watermark: F.col(behaviour.TIME) <= watermark)

    def split(batch: DataFrame, batch_id: int) -> None:
        mark = F.timestamp_millis(F.lit(_watermark(batch.sparkSession, checkpoint, batch_id - 1)))
        dropped = F.coalesce(too_late(mark), F.lit(False))
        batch.where(~dropped).write.mode("overwrite").parquet(f"{path}/kept/batch_id={batch_id}")
        batch.where(dropped).withColumn("watermark", mark).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")

    return _writer(stream, checkpoint, trigger).foreachBatch(split).start()


def window_closed(width: timedelta) -> Callable[[Column], Column]:
    """Late for tumbling windows: the row's window has ended by the watermark."""
    span = micros(width)
    end = F.timestamp_micros((cell_of(F.unix_micros(behaviour.TIME), span) + 1) * span)
    return lambda watermark: end <= watermark


def _watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Milliseconds: the watermark of a batch, as the query noted it before it ran the batch; 0
    before the first."""
    if batch_id < 0:
        return 0
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id}").where(F.col("value").startswith("{"))
    marks = lines.select(F.get_json_object("value", "$.batchWatermarkMs").cast("long").alias("mark"))
    return marks.where("mark IS NOT NULL").first()["mark"]


def start_profile_lookup(stream, read_profiles: Callable[[], DataFrame], path, checkpoint, trigger=SCORING_TRIGGER):
    """Stream rows with their customer's profile as it is when the batch runs."""
    return _start_lookup(stream, lambda batch: behaviour.with_profile(batch, read_profiles()), path, checkpoint, trigger)


def start_keyed_lookup(stream, profiles: KeyedTable, path, checkpoint, trigger=SCORING_TRIGGER):
    """The same by a table laid out by customer, of which a batch opens its own customers' buckets."""
    return _start_lookup(stream, lambda batch: behaviour.with_profile(batch, profiles.rows_of(batch)), path, checkpoint, trigger)


def start_real_time(messages, folder, rules: RuleConfig = PIPELINE_RULES, trigger=SCORING_TRIGGER) -> list[StreamingQuery]:
    """The scoring path: alerts on the console and all transactions to their topics below
    ``folder``/topics. Pass the queries' session to ``run_until_stopped``."""
    alerts = scored(messages, rules).where(F.col("fraud_score") > 0)
    return [
        to_console(alerts, f"{folder}/console-offsets", trigger),
        start_routing(messages, f"{folder}/topics", f"{folder}/offsets", rules, trigger),
    ]


def start_early_velocity(stream, path, checkpoint, rules: RuleConfig = PIPELINE_RULES, trigger=SCORING_TRIGGER):
    """An alert as soon as a payment is one too many within the trailing window."""
    large_state(stream.sparkSession)
    return to_files(early_velocity_alerts(stream, rules), path, checkpoint, trigger)


def start_profiles(alerts, path, checkpoint, trigger=LOADER_TRIGGER):
    """Customers' running profiles, with their state on disk; ``current_profiles`` reads the
    state of now, ``compact_profiles`` keeps its reading short."""
    large_state(alerts.sparkSession)
    return to_numbered_batches(running_profiles(alerts), path, checkpoint, "update", trigger)


def start_change_feed(spark, table_path, schema, path, checkpoint):
    """Write the rows added to a table folder since the last run as new batches, then stop."""
    added = spark.readStream.schema(schema).parquet(table_path)
    return to_numbered_batches(added, path, checkpoint, "append", trigger=None)


def changes_after(spark: SparkSession, path: str, schema: StructType, mark: int = -1) -> tuple[DataFrame, int]:
    """(rows of all batches after ``mark``, the new mark). The reader keeps the mark; when
    nothing was written since, there are no rows and the mark stays."""
    new = [n for n in _folders(spark, path) if n > mark and _complete(spark, f"{path}/batch_id={n}")]
    if not new:
        return spark.createDataFrame([], schema), mark
    return spark.read.schema(schema).parquet(*(f"{path}/batch_id={n}" for n in new)), new[-1]


def newest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last batch written by ``to_numbered_batches``; only that one is opened."""
    newest = next(n for n in reversed(_folders(spark, path)) if _complete(spark, f"{path}/batch_id={n}"))
    return spark.read.parquet(f"{path}/batch_id={newest}")


def _profile_parts(spark: SparkSession, path: str) -> tuple[list[tuple[str, int]], int]:
    """Folders that make up the profiles, with their numbers: the newest compacted state and
    the batches after it."""
    bases = [n for n in _folders(spark, path, "upto=") if _complete(spark, f"{path}/upto={n}")]
    base = bases[-1] if bases else -1
    later = [n for n in _folders(spark, path) if n > base and _complete(spark, f"{path}/batch_id={n}")]
    return [(f"{path}/upto={base}", base)] * (base >= 0) + [(f"{path}/batch_id={n}", n) for n in later], max([base, *later])


def current_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Each customer's row of the latest batch that changed it."""
    parts, _ = _profile_parts(spark, path)
    rows = reduce(DataFrame.unionByName, (spark.read.parquet(f).withColumn("_newest", F.lit(-n)) for f, n in parts))
    return keep_first(rows, ["customer_id"], ["_newest"]).drop("_newest")


def profiles_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Each customer's profile from the state of the writing query itself, as of its last finished
    batch: nothing it has written is read, and nothing needs compacting."""
    state = spark.read.format("statestore").load(checkpoint)
    # The state's values stand in the order of the aggregates and are named after their functions.
    names = ("total_fraud_alerts", "cumulative_fraud_score", "last_alert_time", "last_seen_country")
    held = state.schema["value"].dataType.fields
    named = StructType([StructField(name, field.dataType) for name, field in zip(names, held, strict=True)])
    facts = state.select("key.customer_id", F.col("value").cast(named).alias("facts")).select("customer_id", "facts.*")
    facts = facts.withColumn("cumulative_fraud_score", F.col("cumulative_fraud_score").cast("long"))
    return facts.withColumn("risk_tier", count_tier(F.col("total_fraud_alerts")))


def compact_profiles(spark: SparkSession, path: str) -> None:
    """Write the current state as one folder and delete what it was made from. The writing
    query can go on: a batch that ends meanwhile is newer than the compacted state."""
    parts, upto = _profile_parts(spark, path)
    if len(parts) < 2:
        return
    current_profiles(spark, path).write.mode("overwrite").parquet(f"{path}/upto={upto}")
    for folder, _ in parts:
        _delete(spark, folder)


def finish(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself, and pass on its failure."""
    query.awaitTermination()


def run_until_stopped(spark: SparkSession) -> None:
    """Wait until any query ends or the user interrupts, then stop all of them."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()
