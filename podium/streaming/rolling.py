"""Event-time windows over an enriched stream; closed windows are appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from podium.config import RollingConfig, StreamConfig
from podium.operators.aggregates import collapsed_windows, window_bounds
from podium.session import settings
from podium.sinks.fanout import FanOut
from podium.sinks.history import claim_history, stream_id
from podium.streaming.features import (
    Dimension,
    await_all,
    enriched_stream,
    prepare_dimension,
    sinks_of,
    start,
    state_settings,
)


def rolling_stream(
    spark: SparkSession,
    stream: StreamConfig,
    rolling: RollingConfig,
    dimension: Dimension,
    schema: StructType,
) -> DataFrame:
    """Averages per event-time window and group; the stream waits ``delay`` for late rows."""
    joined = enriched_stream(
        spark, stream, dimension, schema, event_time=rolling.event_time, delay=rolling.delay
    )
    joined = joined.observe(
        "times",
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(rolling.event_time).isNull()).alias("n_without_time"),
    )
    averaged = collapsed_windows(
        joined, stream.features, rolling.event_time, rolling.size, rolling.slide, rolling.offset,
        stream.features.time_column, rolling.panes,
    )
    return window_bounds(averaged)


def run_rolling_stream(
    spark: SparkSession,
    stream: StreamConfig,
    rolling: RollingConfig,
    dim: DataFrame | Dimension,
    schema: StructType,
) -> StructType:
    """Append each window to all sinks when the watermark closes it; returns the history's schema.

    The join keeps no state, so order does not matter to it. Rows later than the delay may be dropped. If
    none of the messages read has an event time, that is an error.
    """
    dimension = dim if isinstance(dim, Dimension) else prepare_dimension(
        spark, dim, stream, schema, "rolling"
    )
    windows = rolling_stream(spark, stream, rolling, dimension, schema)
    owner = stream_id(spark, f"{stream.checkpoint}/rolling")
    claim_history(spark, stream.history, owner)
    fan_out = FanOut(stream.history, sinks_of(stream, owner, ("window_start", "window_end")))
    writer = windows.writeStream.outputMode("append").foreachBatch(fan_out)
    with settings(spark, state_settings(stream, dimension)):
        query = start(writer, f"{stream.checkpoint}/rolling", stream.trigger)
    await_all([query])
    told = [p.observedMetrics.get("times") for p in query.recentProgress]
    read = sum(m["n_rows"] for m in told if m)
    if read and read == sum(m["n_without_time"] for m in told if m):
        raise ValueError(f"none of {read} messages has a time in {rolling.event_time}: no window can close")
    return windows.schema
