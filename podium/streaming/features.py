"""Feature stream: messages, enriched with a dimension, averaged, written to history, topic and table."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import IntegerType, NumericType, StructField, StructType

from podium.config import StreamConfig
from podium.functions.messages import parse_messages
from podium.operators.aggregates import collapse_dimension, collapsed_averages
from podium.operators.joins import SALT, align_keys, enrich, hot_keys, join_salted, salt_dimension
from podium.operators.rows import number_columns, valid_features
from podium.operators.sizing import SideProfile, fits_broadcast, profile_side
from podium.schemas import averages
from podium.session import read_if_present, settings
from podium.sinks.fanout import FanOut, Sink
from podium.sinks.files import overwrite_parquet, replace_table
from podium.sinks.history import claim_history, compact_history, read_history, stream_id, with_batch_id
from podium.sinks.jdbc import append_batch
from podium.sinks.topic import write_topic
from podium.sources.topic import read_topic, stream_topic


@dataclass(frozen=True)
class Dimension:
    """A dimension as of the start of a run, with its measured size.

    One too large to broadcast is salted for the hot keys and stored in buckets.
    """

    rows: DataFrame
    profile: SideProfile
    hot: Mapping[int, Sequence] | None = None


def prepare_dimension(
    spark: SparkSession, dim: DataFrame, stream: StreamConfig, schema: StructType, kind: str = "main"
) -> Dimension:
    """Filter, merge and store the dimension once per run, next to the checkpoint of that kind of query.

    The stored copy is what each micro-batch joins: the database is not scanned again, and the size
    that was measured stays true for the whole run. The next run replaces the copy.
    """
    f = stream.features
    unknown = {*stream.required} - {f.key, *f.keys, *f.measures, stream.sentinel_column}
    if unknown:
        raise ValueError(f"required columns that the features do not use: {sorted(unknown)}")
    dim = dim.select(f.key, *f.dim_keys, *f.dim_measures)
    dim = number_columns(dim, f.dim_measures, f.measure_type)
    if isinstance(schema[f.key].dataType, NumericType):
        # Not even a cast shall come between the buckets and the messages. A key that the message's
        # type cannot hold, like a fraction, meets no message.
        own, cast = F.col(f.key), F.col(f.key).try_cast(schema[f.key].dataType)
        if isinstance(dim.schema[f.key].dataType, NumericType):
            dim = dim.where(cast == own)
        dim = dim.withColumn(f.key, cast)
    required = [c for c in stream.required if c in dim.columns]
    dim = valid_features(dim, f.dim_measures, [f.key, *required])
    path = f"{stream.checkpoint}/{kind}-dimension"
    overwrite_parquet(collapse_dimension(dim, f), path)
    stored = spark.read.parquet(path)
    profile = profile_side(stored, [f.key])
    if fits_broadcast(profile, stream.sizing):
        return Dimension(stored, profile)
    hot = _remembered_hot_keys(spark, stream, schema)
    return Dimension(_bucketed(spark, stored, stream, hot, kind), profile, hot)


def _remembered_hot_keys(
    spark: SparkSession, stream: StreamConfig, schema: StructType
) -> dict[int, list]:
    """Hot keys of the messages waiting at the first run, kept next to the checkpoint.

    Later runs need not read old messages again; outdated keys cost time, not rows.
    """
    key = schema[stream.features.key]
    path = f"{stream.checkpoint}/hot-keys"
    kind = StructType([StructField("parts", IntegerType()), StructField("key", key.dataType)])
    stored = read_if_present(spark, path, kind)
    if stored is None:
        try:
            waiting = parse_messages(read_topic(spark, stream.topic), StructType([key]))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":  # nothing was published yet
                return {}
            raise
        hot = hot_keys(waiting, key.name, stream.sizing)
        if hot or not waiting.isEmpty():
            rows = [(parts, k) for parts, keys in hot.items() for k in keys]
            overwrite_parquet(spark.createDataFrame(rows, kind), path)
        return hot
    hot = {}
    for parts, k in stored.collect():
        hot.setdefault(parts, []).append(k)
    return hot


def _bucketed(
    spark: SparkSession, dim: DataFrame, stream: StreamConfig, hot: Mapping[int, Sequence], kind: str
) -> DataFrame:
    """Store the salted dimension in one bucket per shuffle partition.

    Every micro-batch then shuffles its messages only.
    """
    key = stream.features.key
    path = f"{stream.checkpoint}/{kind}-dimension-buckets"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"podium_dimension_{sha256(path.encode()).hexdigest()[:16]}"
    (
        salt_dimension(dim, key, hot)
        .repartition(buckets, key, SALT)
        .write.bucketBy(buckets, key, SALT)
        .sortBy(key, SALT)
        .mode("overwrite")
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name)


def enriched_stream(
    spark: SparkSession,
    stream: StreamConfig,
    dimension: Dimension,
    schema: StructType,
    event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Valid, enriched facts of the topic, with a watermark when there is an event time."""
    f = stream.features
    wanted = {f.key, *f.fact_keys, *f.fact_measures, stream.sentinel_column, event_time}
    # Fields that nothing needs are not parsed.
    schema = StructType([field for field in schema.fields if field.name in wanted])
    facts = parse_messages(stream_topic(spark, stream.topic), schema)
    if event_time:
        facts = facts.withWatermark(event_time, delay)
    facts = number_columns(facts, f.fact_measures, f.measure_type)
    required = [c for c in stream.required if c in facts.columns]
    facts = valid_features(
        facts, f.fact_measures, required, stream.sentinel_column, stream.sentinel
    )
    if dimension.hot is None:
        return enrich(facts, dimension.rows, f.key, sizing=stream.sizing, profile=dimension.profile)
    facts, dim = align_keys(facts, dimension.rows, f.key)
    return join_salted(facts, dim, f.key, dimension.hot)


def feature_stream(
    spark: SparkSession, stream: StreamConfig, dimension: Dimension, schema: StructType
) -> DataFrame:
    """Running averages since the start of the stream, per group.

    The query progress tells the rows of each micro-batch, without a count of its own.
    """
    joined = enriched_stream(spark, stream, dimension, schema)
    running = collapsed_averages(joined, stream.features, stream.features.time_column)
    return running.observe("batch", F.count(F.lit(1)).alias("n_rows"))


def start(writer: DataStreamWriter, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Start a query; without a trigger it takes what is waiting and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        return writer.trigger(processingTime=trigger).start()
    return writer.trigger(availableNow=True).start()


def state_settings(stream: StreamConfig, dimension: Dimension) -> dict[str, str]:
    """The checkpoint fixes these at first start.

    A query has one number of shuffle partitions. Only where the dimension is broadcast is the state alone in
    them; a join that shuffles keeps the session's number.
    """
    partitions = stream.state_partitions if dimension.hot is None else None
    return {"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}


def sinks_of(stream: StreamConfig, owner: int, keys: Sequence[str] = ()) -> dict[str, Sink]:
    """The configured sinks; rows of a batch are told apart by the group columns and ``keys``.

    Messages and table rows carry the stream's and the batch's id: another checkpoint may use the same
    sinks, and readers recognise a repeated row.
    """
    keys = [*keys, *stream.features.keys]
    found: dict[str, Sink] = {}
    if stream.out_topic:
        found["topic"] = lambda batch, batch_id: write_topic(
            with_batch_id(batch, batch_id, owner), stream.out_topic, keys, load_id=f"{owner}-{batch_id}"
        )
    if stream.out_table:
        found["table"] = lambda batch, batch_id: append_batch(
            batch, stream.out_table, batch_id, keys, owner
        )
    return found


def _compaction(spark: SparkSession, stream: StreamConfig, schema: StructType) -> Sink:
    def sink(batch: DataFrame, batch_id: int) -> None:
        if (batch_id + 1) % stream.compact_every == 0:
            compact_history(spark, stream.history, schema, stream.features.keys)

    return sink


def start_feature_stream(
    spark: SparkSession,
    stream: StreamConfig,
    dim: DataFrame | Dimension,
    schema: StructType,
    sinks: dict[str, Sink] | None = None,
) -> list[StreamingQuery]:
    """Start the main query (changed groups) and, if asked for, the diagnostic one (all groups)."""
    dimension = dim if isinstance(dim, Dimension) else prepare_dimension(spark, dim, stream, schema)
    running = feature_stream(spark, stream, dimension, schema)
    owner = stream_id(spark, f"{stream.checkpoint}/main")
    claim_history(spark, stream.history, owner)
    with settings(spark, state_settings(stream, dimension)):
        sinks = dict(sinks_of(stream, owner) if sinks is None else sinks)
        if stream.compact_every:
            sinks["compaction"] = _compaction(spark, stream, running.schema)
        fan_out = FanOut(stream.history, sinks)
        main = running.writeStream.outputMode("update").foreachBatch(fan_out)
        started = [start(main, f"{stream.checkpoint}/main", stream.trigger)]
        if stream.rejects:
            from podium.streaming.rejects import start_rejects

            started.append(start_rejects(spark, stream, schema))
        if stream.snapshot:
            everything = running.writeStream.outputMode("complete").foreachBatch(
                lambda batch, _: (replace_table if stream.snapshot_versioned else overwrite_parquet)(batch, stream.snapshot)
            )
            started.append(
                start(everything, f"{stream.checkpoint}/snapshot", stream.snapshot_trigger)
            )
    return started


def await_all(started: list[StreamingQuery]) -> None:
    """Wait for every query; when one fails stop the others and raise its error at once."""
    waiting = list(started)
    try:
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(1)]
    finally:
        for query in waiting:
            query.stop()


def run_feature_stream(
    spark: SparkSession,
    stream: StreamConfig,
    dim: DataFrame | Dimension,
    schema: StructType,
    sinks: dict[str, Sink] | None = None,
) -> None:
    """Run to the end of what is waiting, or on and on with a trigger.

    Runs that follow each other may share one prepared ``Dimension``.
    """
    await_all(start_feature_stream(spark, stream, dim, schema, sinks))


def run_refreshed_stream(
    spark: SparkSession,
    stream: StreamConfig,
    dim: Callable[[], DataFrame],
    schema: StructType,
    sinks: dict[str, Sink] | None = None,
    rounds: int | None = None,
) -> None:
    """Take what is waiting every ``refresh_seconds``, each time with the dimension as it is then.

    ``dim`` opens the dimension anew; it is stored and measured again for each round, so that one that
    has outgrown the limit is no longer broadcast. The rounds share one checkpoint and so one running state.
    Messages are joined once, with the rows of their round.
    """
    bounded = replace(stream, trigger=None, snapshot_trigger=None)
    done = 0
    while rounds is None or done < rounds:
        began = time.monotonic()
        run_feature_stream(spark, bounded, dim(), schema, sinks)
        done += 1
        if rounds is None or done < rounds:
            time.sleep(max(0.0, (stream.refresh_seconds or 0.0) - (time.monotonic() - began)))


def feature_schema(stream: StreamConfig, schema: StructType, dim: DataFrame) -> StructType:
    """Schema of the history: key types follow the message and the dimension."""
    f = stream.features
    found = averages(f.keys, f.measures, f.time_column)
    for column in found.fields:
        if column.name in f.fact_keys:
            column.dataType = schema[column.name].dataType
        elif column.name in f.dim_keys:
            column.dataType = dim.schema[column.name].dataType
    return found


def read_features(
    spark: SparkSession, stream: StreamConfig, schema: StructType, dim: DataFrame
) -> DataFrame:
    return read_history(spark, stream.history, feature_schema(stream, schema, dim))
