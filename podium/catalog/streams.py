"""Streaming features over the events, enriched with customers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from podium.catalog.messages import EVENT_MESSAGE, events, spoiled_records
from podium.catalog.registry import query, settled, table
from podium.config import FeatureConfig, ParkingConfig, RollingConfig, SizingConfig, StreamConfig, TopicConfig
from podium.functions import message, parse_messages
from podium.operators import enrich, latest_per_key, rolling_averages
from podium.session import work_folder
from podium.sinks import read_history, read_latest, write_topic
from podium.sinks.topic import write_records
from podium.sources import read_table, read_topic, stream_once, stream_topic
from podium.streaming import (
    Dimension,
    decided,
    feature_schema,
    prepare_dimension,
    read_features,
    read_rejects,
    run_feature_stream,
    run_parked_stream,
    run_refreshed_stream,
    run_rolling_stream,
)
from podium.streaming.features import await_all, start, start_feature_stream

EVENT_FEATURES = FeatureConfig(
    key="user_id",
    fact_keys=("event_type",),
    dim_keys=("c_mktsegment",),
    fact_measures=("value",),
    dim_measures=("c_acctbal",),
    measure_type="double",
    time_column="calculated_at",
)

# The state holds one row per group, a few hundred whatever the number of events.
STATE_PARTITIONS = 8

_LATEST = """
SELECT event_type, c_mktsegment, round(avg(value) + 1e-9, 6) AS avg_value,
       round(avg(c_acctbal) + 1e-9, 6) AS avg_c_acctbal, TRUE AS has_time
FROM events JOIN customer ON user_id = c_custkey
WHERE event_type <> 'error' GROUP BY ALL
"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "user_id")


def event_stream(root: str, **changes) -> StreamConfig:
    stream = StreamConfig(
        topic=TopicConfig(f"{root}/topic"),
        checkpoint=f"{root}/checkpoint",
        history=f"{root}/history",
        features=EVENT_FEATURES,
        sentinel_column="event_type",
        sentinel="error",
        required=("c_mktsegment",),
        state_partitions=STATE_PARTITIONS,
    )
    return replace(stream, **changes)


def publish_weekly(spark: SparkSession, sf_dir: str, topic: TopicConfig) -> Iterator[str]:
    """Publish one calendar week of events per step, oldest first."""
    rows = table(spark, sf_dir, "events")
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week")
    for start in sorted(row["week"] for row in rows.select(week).distinct().collect()):
        monday = F.lit(start).cast("timestamp_ntz")
        inside = (F.col("ts") >= monday) & (F.col("ts") < monday + F.expr("INTERVAL 7 DAYS"))
        loaded = rows.where(inside).withColumn("ts", F.col("ts").cast("timestamp"))
        write_topic(loaded, topic, load_id=start)
        yield start


def rounded(averages: DataFrame, *more) -> DataFrame:
    f = EVENT_FEATURES
    return averages.select(
        *more,
        *f.keys,
        *(settled(f"avg_{m}", 6).alias(f"avg_{m}") for m in f.measures),
        F.col(f.time_column).isNotNull().alias("has_time"),
    )


def _quarters(spark: SparkSession, topic: TopicConfig) -> TopicConfig:
    """Rate limit that takes the waiting files in about four micro-batches."""
    files = read_topic(spark, topic).select(F.input_file_name()).distinct().count()
    return replace(topic, max_per_trigger=max(1, -(-files // 4)))


@query(_LATEST)
def stream_enrich_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate-limited replay from the earliest message, running averages, newest row per group."""
    stream = event_stream(work_folder(spark, "update"))
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        pass
    stream = replace(stream, topic=_quarters(spark, stream.topic))
    dim = customers(spark, sf_dir)
    run_feature_stream(spark, stream, dim, EVENT_MESSAGE)
    history = read_features(spark, stream, EVENT_MESSAGE, dim)
    return rounded(latest_per_key(history, EVENT_FEATURES.keys))


@query(_LATEST)
def stream_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same features when the dimension may not be broadcast."""
    stream = event_stream(
        work_folder(spark, "large"),
        sizing=SizingConfig(broadcast_bytes=-1),
        state_partitions=None,  # the join shuffles too
    )
    write_topic(events(spark, sf_dir), stream.topic, load_id="all")
    dim = customers(spark, sf_dir)
    run_feature_stream(spark, stream, dim, EVENT_MESSAGE)
    history = read_features(spark, stream, EVENT_MESSAGE, dim)
    return rounded(latest_per_key(history, EVENT_FEATURES.keys))


_EVERY_BATCH = """
WITH w AS (
  SELECT date_trunc('week', ts) AS week, event_type, c_mktsegment, count(*) AS n,
         sum(value) AS v, sum(c_acctbal) AS a
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'error' GROUP BY ALL)
SELECT CAST(b.batch_id AS BIGINT) AS batch_id, event_type, c_mktsegment,
       round(sum(v) OVER g / sum(n) OVER g + 1e-9, 6) AS avg_value,
       round(sum(a) OVER g / sum(n) OVER g + 1e-9, 6) AS avg_c_acctbal, TRUE AS has_time
FROM w JOIN (SELECT week, row_number() OVER (ORDER BY week) - 1 AS batch_id
             FROM (SELECT DISTINCT date_trunc('week', ts) AS week FROM events)) b USING (week)
WINDOW g AS (PARTITION BY event_type, c_mktsegment ORDER BY week)
"""


@query(_EVERY_BATCH)
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per weekly load on one checkpoint: every batch adds its changed groups."""
    stream = event_stream(work_folder(spark, "history"))
    dim = customers(spark, sf_dir)
    dimension = prepare_dimension(spark, dim, stream, EVENT_MESSAGE)
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        run_feature_stream(spark, stream, dimension, EVENT_MESSAGE)
    return rounded(read_features(spark, stream, EVENT_MESSAGE, dim), "batch_id")


@query(_LATEST)
def stream_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode next to the main query: a snapshot of all groups."""
    root = work_folder(spark, "complete")
    stream = event_stream(root, snapshot=f"{root}/snapshot")
    write_topic(events(spark, sf_dir), stream.topic, load_id="all")
    run_feature_stream(spark, stream, customers(spark, sf_dir), EVENT_MESSAGE)
    return rounded(spark.read.parquet(stream.snapshot))


@query(
    """
SELECT event_type, count(*) AS n_rows, count(c_mktsegment) AS n_matched
FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey
GROUP BY ALL
"""
)
def stream_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event enriched as it arrives; those without a customer stay."""
    root = work_folder(spark, "left")
    topic = TopicConfig(f"{root}/topic")
    write_topic(events(spark, sf_dir), topic, load_id="all")
    wanted = StructType([EVENT_MESSAGE["user_id"], EVENT_MESSAGE["event_type"]])
    facts = parse_messages(stream_topic(spark, topic), wanted)
    dim = customers(spark, sf_dir).where("c_acctbal > 0").select("user_id", "c_mktsegment")
    joined = enrich(facts, dim, "user_id", how="left")
    await_all([start(joined.writeStream.option("path", f"{root}/rows"), f"{root}/checkpoint")])
    return spark.read.parquet(f"{root}/rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("c_mktsegment").alias("n_matched")
    )


@query(_LATEST)
def stream_replayed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly loads, each published twice under its name with a run after either: the second adds nothing."""
    stream = event_stream(work_folder(spark, "replayed"))
    dim = customers(spark, sf_dir)
    dimension = prepare_dimension(spark, dim, stream, EVENT_MESSAGE)
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        run_feature_stream(spark, stream, dimension, EVENT_MESSAGE)
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        pass
    run_feature_stream(spark, stream, dimension, EVENT_MESSAGE)
    return rounded(latest_per_key(read_features(spark, stream, EVENT_MESSAGE, dim), EVENT_FEATURES.keys))


@query(f"SELECT *, TRUE AS refused FROM ({_LATEST})")
def history_of_another_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second checkpoint on a history of one batch is refused, and the history stays as it was."""
    stream = event_stream(work_folder(spark, "foreign"))
    dim = customers(spark, sf_dir)
    write_topic(events(spark, sf_dir), stream.topic, load_id="all")
    run_feature_stream(spark, stream, dim, EVENT_MESSAGE)
    try:
        run_feature_stream(spark, replace(stream, checkpoint=f"{stream.checkpoint}-2"), dim, EVENT_MESSAGE)
        refused = False
    except ValueError:
        refused = True
    history = read_features(spark, stream, EVENT_MESSAGE, dim)
    return rounded(latest_per_key(history, EVENT_FEATURES.keys)).withColumn("refused", F.lit(refused))


@query(f"SELECT *, CAST(2 AS BIGINT) AS n_streams FROM ({_LATEST})")
def topic_of_another_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two checkpoints publish to one topic: the messages of both are there."""
    root = work_folder(spark, "two")
    dim = customers(spark, sf_dir)
    first = event_stream(root, out_topic=TopicConfig(f"{root}/out"))
    second = replace(first, checkpoint=f"{root}/checkpoint-2", history=f"{root}/history-2")
    write_topic(events(spark, sf_dir), first.topic, load_id="all")
    for stream in (first, second):
        run_feature_stream(spark, stream, dim, EVENT_MESSAGE)
    rows = rounded(parse_messages(read_topic(spark, first.out_topic), feature_schema(first, EVENT_MESSAGE, dim)))
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n_streams"))


@query(
    """
WITH w AS (SELECT *, date_trunc('week', ts) AS week FROM events WHERE event_type <> 'error'),
b AS (SELECT week, row_number() OVER (ORDER BY week) - 1 AS i FROM (SELECT DISTINCT date_trunc('week', ts) AS week FROM events))
SELECT event_type, c_mktsegment, round(avg(value) + 1e-9, 6) AS avg_value,
       round(avg(c_acctbal) + 1e-9, 6) AS avg_c_acctbal, TRUE AS has_time
FROM w JOIN b USING (week) JOIN customer ON user_id = c_custkey AND c_custkey % 5 <= i GROUP BY ALL
"""
)
def stream_refreshed_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that gains a fifth of its rows before each weekly load; a round per load."""
    root = work_folder(spark, "refreshed")
    stream = event_stream(root)
    dim = customers(spark, sf_dir)
    for i, _ in enumerate(publish_weekly(spark, sf_dir, stream.topic)):
        dim.where(F.col("user_id") % 5 == i).write.mode("append").parquet(f"{root}/customers")
        run_refreshed_stream(
            spark, stream, lambda: spark.read.parquet(f"{root}/customers"), EVENT_MESSAGE, rounds=1
        )
    return rounded(latest_per_key(read_features(spark, stream, EVENT_MESSAGE, dim), EVENT_FEATURES.keys))


@query(_LATEST)
def stream_compacted_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per weekly load, the history compacted after every second batch; the newest rows from the last snapshot on."""
    stream = event_stream(work_folder(spark, "compacted"), compact_every=2)
    dim = customers(spark, sf_dir)
    dimension = prepare_dimension(spark, dim, stream, EVENT_MESSAGE)
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        run_feature_stream(spark, stream, dimension, EVENT_MESSAGE)
    schema = feature_schema(stream, EVENT_MESSAGE, dim)
    return rounded(read_latest(spark, stream.history, schema, EVENT_FEATURES.keys))


@query(_EVERY_BATCH)
def stream_output_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch in the output topic twice, as after a replay on Kafka; a reader meets each row once."""
    root = work_folder(spark, "once")
    stream = event_stream(root, out_topic=TopicConfig(f"{root}/out"))
    dim = customers(spark, sf_dir)
    dimension = prepare_dimension(spark, dim, stream, EVENT_MESSAGE)
    for week in publish_weekly(spark, sf_dir, stream.topic):
        run_feature_stream(spark, stream, dimension, EVENT_MESSAGE)
    write_records(read_topic(spark, stream.out_topic), stream.out_topic, load_id="again")
    rows = stream_once(
        spark, stream.out_topic, feature_schema(stream, EVENT_MESSAGE, dim), EVENT_FEATURES.keys, "calculated_at", "1 day"
    )
    await_all([start(rows.writeStream.option("path", f"{root}/rows"), f"{root}/reader")])
    return rounded(spark.read.parquet(f"{root}/rows"), "batch_id")


@query(_LATEST)
def stream_versioned_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode into a table whose versions appear whole: at no time is there none to read."""
    root = work_folder(spark, "versions")
    stream = event_stream(root, snapshot=f"{root}/snapshot", snapshot_versioned=True)
    dim = customers(spark, sf_dir)
    dimension = prepare_dimension(spark, dim, stream, EVENT_MESSAGE)
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        run_feature_stream(spark, stream, dimension, EVENT_MESSAGE)
    return rounded(read_table(spark, stream.snapshot))


@query(
    """
SELECT reason, wrong, count(*) AS n_rows, TRUE AS has_place FROM events, (VALUES
  ('wrong type', 'user_id'), ('wrong type', 'user_id'), ('wrong type', 'user_id'),
  ('incomplete', 'value'), ('incomplete', 'value'), ('no json', NULL), ('no json', NULL), ('no object', NULL), ('empty', NULL), ('missing', NULL)
) v(reason, wrong) GROUP BY ALL
UNION ALL
SELECT 'features', NULL, count(*), TRUE FROM (SELECT DISTINCT event_type, c_mktsegment FROM events JOIN customer ON user_id = c_custkey
                                       WHERE event_type <> 'error')
"""
)
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and spoiled messages of every event in one topic: features of the good ones, the others kept with the reason."""
    root = work_folder(spark, "rejects")
    stream = event_stream(root, rejects=f"{root}/rejects")
    # The spoiled id of the variants is the stream's key here.
    records = spoiled_records(spark, sf_dir).withColumn("value", F.replace("value", F.lit('"event_id"'), F.lit('"user_id"')))
    good = events(spark, sf_dir).select(F.lit(None).cast("binary").alias("key"), message().cast("binary").alias("value"))
    spoiled = records.where(~F.col("variant").isin("good", "more fields"))
    spoiled = spoiled.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    write_records(good.union(spoiled), stream.topic, load_id="all")
    dim = customers(spark, sf_dir)
    run_feature_stream(spark, stream, dim, EVENT_MESSAGE)
    wrong = F.when(F.size("wrong") > 0, F.array_join("wrong", ","))
    found = read_rejects(spark, stream).groupBy("reason", wrong.alias("wrong"))
    found = found.agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.col("source").contains("/topic/")).alias("has_place"))
    latest = latest_per_key(read_features(spark, stream, EVENT_MESSAGE, dim), EVENT_FEATURES.keys)
    nothing = F.lit(None).cast("string")
    return found.union(latest.agg(F.lit("features"), nothing, F.count(F.lit(1)), F.lit(True)))


def _late_customers(spark: SparkSession, sf_dir: str, root: str, timeout: str) -> tuple[StreamConfig, ParkingConfig]:
    """Weekly loads; a fifth of the customers comes a week after each of the first five, the rest of a week's after its load."""
    stream = event_stream(root)
    parking = ParkingConfig(f"{root}/parked", TopicConfig(f"{root}/ready"), event_time="ts", timeout=timeout)
    dim = customers(spark, sf_dir)

    def after(n: int) -> None:
        known = dim.where(F.col("user_id") % 5 < n)
        run_parked_stream(spark, stream, parking, lambda: known, EVENT_MESSAGE, rounds=1)

    i = -1
    for i, _ in enumerate(publish_weekly(spark, sf_dir, stream.topic)):
        after(i)
    after(max(i + 1, 5))
    return stream, parking


@query(_LATEST)
def stream_parked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events before their customers: they wait, and all of them count in the end."""
    stream, _ = _late_customers(spark, sf_dir, work_folder(spark, "parked"), "1000 days")
    history = read_features(spark, stream, EVENT_MESSAGE, customers(spark, sf_dir))
    return rounded(latest_per_key(history, EVENT_FEATURES.keys))


@query(
    """
WITH b AS (SELECT week, row_number() OVER (ORDER BY week) - 1 AS i, newest FROM (
    SELECT date_trunc('week', ts) AS week, max(max(ts)) OVER (ORDER BY date_trunc('week', ts)) AS newest FROM events GROUP BY week)),
last AS (SELECT max(i) AS i FROM b),
e AS (
  SELECT event_type, ts, b.i, CASE WHEN c_custkey IS NOT NULL THEN least(greatest(b.i, c_custkey % 5 + 1), last.i + 1) END AS met, last.i AS last
  FROM events JOIN b ON date_trunc('week', ts) = week CROSS JOIN last LEFT JOIN customer ON user_id = c_custkey),
s AS (
  SELECT event_type, met, ts < (SELECT newest FROM b WHERE b.i = coalesce(met - 1, last)) - INTERVAL 10 DAY
                          AND e.i <= coalesce(met - 1, last) AS late FROM e)
SELECT event_type, CASE WHEN late THEN 'expired' WHEN met IS NULL THEN 'parked' ELSE 'ready' END AS status, count(*) AS n_rows
FROM s GROUP BY ALL
"""
)
def stream_expired_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loads, when messages wait ten days: how many went on, wait, or were given up."""
    root = work_folder(spark, "expired")
    _, parking = _late_customers(spark, sf_dir, root, "10 days")
    kind = StructType([EVENT_MESSAGE["event_type"]])
    rows = parse_messages(decided(spark, parking), kind, keep=["status"])
    return rows.groupBy("event_type", "status").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"SELECT sink, l.* FROM ({_LATEST}) l, (VALUES ('steady'), ('flaky')) s(sink)")
def stream_failing_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that fails at first: the other gets the batch, the run fails, the next run completes both."""
    root = work_folder(spark, "flaky")
    stream = event_stream(root)
    dim = customers(spark, sf_dir)
    write_topic(events(spark, sf_dir), stream.topic, load_id="all")
    tries = []

    def keep(name: str) -> Callable[[DataFrame, int], None]:
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{root}/{name}/{batch_id}")

    def flaky(batch: DataFrame, batch_id: int) -> None:
        tries.append(batch_id)
        if len(tries) == 1:
            raise ConnectionError("not this time")
        keep("flaky")(batch, batch_id)

    sinks = {"flaky": flaky, "steady": keep("steady")}
    with suppress(StreamingQueryException):
        run_feature_stream(spark, stream, dim, EVENT_MESSAGE, sinks)
    run_feature_stream(spark, stream, dim, EVENT_MESSAGE, sinks)
    found = [
        rounded(spark.read.parquet(f"{root}/{name}/0"), F.lit(name).alias("sink")) for name in ("steady", "flaky")
    ]
    return found[0].unionByName(found[1])


@query(f"SELECT batch_id, count(*) AS n_rows FROM ({_EVERY_BATCH}) GROUP BY batch_id")
def stream_batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each micro-batch as the query's progress tells them; an empty load reaches no sink."""
    stream = event_stream(work_folder(spark, "rows"))
    dimension = prepare_dimension(spark, customers(spark, sf_dir), stream, EVENT_MESSAGE)
    told, reached = {}, set()
    sinks = {"seen": lambda batch, batch_id: reached.add(batch_id)}

    def run() -> None:
        started = start_feature_stream(spark, stream, dimension, EVENT_MESSAGE, sinks)
        await_all(started)
        for progress in started[0].recentProgress:
            told[progress.batchId] = progress.observedMetrics["batch"]["n_rows"]

    for _ in publish_weekly(spark, sf_dir, stream.topic):
        run()
    write_topic(events(spark, sf_dir).where("false"), stream.topic, load_id="empty")
    run()
    rows = [(batch_id, n) for batch_id, n in told.items() if batch_id in reached]
    return spark.createDataFrame(rows, "batch_id long, n_rows long")


@query(_LATEST)
def stream_triggered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that goes on, a micro-batch per second, over a topic whose lost files are tolerated."""
    stream = event_stream(work_folder(spark, "triggered"), trigger="1 second")
    stream = replace(stream, topic=replace(stream.topic, tolerate_loss=True))
    dim = customers(spark, sf_dir)
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        pass
    (running,) = start_feature_stream(spark, stream, dim, EVENT_MESSAGE)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return rounded(latest_per_key(read_features(spark, stream, EVENT_MESSAGE, dim), EVENT_FEATURES.keys))


_WINDOWS = """
WITH e AS (
  SELECT ts, event_type, c_mktsegment, value, c_acctbal
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'error'),
w AS (SELECT *, unnest({starts}) AS s FROM e)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, c_mktsegment, round(avg(value) + 1e-9, 6) AS avg_value,
       round(avg(c_acctbal) + 1e-9, 6) AS avg_c_acctbal
FROM w WHERE s + INTERVAL 1 DAY <= (SELECT max(ts) FROM e) - INTERVAL 1 HOUR GROUP BY ALL
"""
_TUMBLING = "[time_bucket(INTERVAL 1 DAY, ts)]"
_SLIDING = "[time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]"


def _shown(windows: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    shown = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")}
    return windows.withColumns(shown | {f"avg_{m}": settled(f"avg_{m}", 6) for m in measures})


def _rolling(
    spark: SparkSession, stream: StreamConfig, dimension: DataFrame | Dimension, rolling: RollingConfig
) -> DataFrame:
    """Process what is waiting; the windows closed so far."""
    schema = run_rolling_stream(spark, stream, rolling, dimension, EVENT_MESSAGE)
    history = read_history(spark, stream.history, schema).drop("batch_id", "calculated_at")
    return _shown(history, EVENT_FEATURES.measures)


@query(_WINDOWS.format(starts=_TUMBLING))
def stream_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows over weekly loads, each load a run on one checkpoint."""
    stream = event_stream(work_folder(spark, "rolling"))
    dimension = prepare_dimension(spark, customers(spark, sf_dir), stream, EVENT_MESSAGE)
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        found = _rolling(spark, stream, dimension, RollingConfig("ts"))
    return found


@query(_WINDOWS.format(starts=_TUMBLING))
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first week comes once more, changed, when its windows are closed: nothing of it counts."""
    stream = event_stream(work_folder(spark, "late"))
    dimension = prepare_dimension(spark, customers(spark, sf_dir), stream, EVENT_MESSAGE)
    for _ in publish_weekly(spark, sf_dir, stream.topic):
        _rolling(spark, stream, dimension, RollingConfig("ts"))
    late = events(spark, sf_dir).where("ts < timestamp '2024-01-08'").withColumn("value", F.col("value") + 1000)
    write_topic(late, stream.topic, load_id="late")
    return _rolling(spark, stream, dimension, RollingConfig("ts"))


@query(_WINDOWS.format(starts=_SLIDING))
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = event_stream(work_folder(spark, "sliding"))
    write_topic(events(spark, sf_dir), stream.topic, load_id="all")
    return _rolling(spark, stream, customers(spark, sf_dir), RollingConfig("ts", slide="12 hours"))


@query(
    f"""
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, round(avg(value) + 1e-9, 6) AS avg_value, count(*) AS n_rows
FROM (SELECT event_type, value, unnest({_SLIDING}) AS s FROM events) GROUP BY ALL
"""
)
def batch_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows over a batch: every window is closed."""
    rows = events(spark, sf_dir)
    windows = rolling_averages(rows, "ts", "1 day", ["event_type"], ["value"], "12 hours")
    return _shown(windows, ("value",))
