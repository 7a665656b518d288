"""Messages that the feature stream cannot use, kept with the reason and their place in the topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from podium.config import StreamConfig
from podium.functions.messages import judge_messages
from podium.sinks.fanout import FanOut
from podium.sinks.history import claim_history, read_history, stream_id
from podium.sources.topic import stream_topic
from podium.streaming.features import start

#: Kafka tells partition and offset; of a file-backed topic the source is the file.
REJECT = StructType(
    [
        StructField("source", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("raw", StringType()),
        StructField("reason", StringType()),
        StructField("wrong", ArrayType(StringType())),
    ]
)


def rejected(spark: SparkSession, stream: StreamConfig, schema: StructType) -> DataFrame:
    """The stream's messages that are not whole (see ``REJECT``); a feature's key and measures are required."""
    records = stream_topic(spark, stream.topic)
    f = stream.features
    needed = {f.key, *f.fact_keys, *f.fact_measures, stream.sentinel_column}
    schema = StructType([field for field in schema.fields if field.name in needed])
    required = [c for c in (f.key, *f.fact_measures) if c in schema.fieldNames()]
    if stream.topic.format == "kafka":
        places = [F.col("topic").alias("source"), F.col("partition"), F.col("offset")]
    else:
        places = [F.col("_metadata.file_path").alias("source"), F.lit(None).cast("int").alias("partition")]
        places.append(F.lit(None).cast("long").alias("offset"))
    placed = records.select(*(p.alias(f"__{name}") for p, name in zip(places, ("source", "partition", "offset"))), "value")
    judged = judge_messages(placed, schema, keep=["__source", "__partition", "__offset"], required=required)
    judged = judged.where("reason is not null")
    return judged.select(*(F.col(f"__{c}").alias(c) for c in ("source", "partition", "offset")), "raw", "reason", "wrong")


def start_rejects(spark: SparkSession, stream: StreamConfig, schema: StructType) -> StreamingQuery:
    """Keep the rejected messages of each micro-batch in ``stream.rejects``, whole and final as a history is."""
    owner = stream_id(spark, f"{stream.checkpoint}/rejects")
    claim_history(spark, stream.rejects, owner)
    writer = rejected(spark, stream, schema).writeStream.foreachBatch(FanOut(stream.rejects, {}))
    return start(writer, f"{stream.checkpoint}/rejects", stream.trigger)


def read_rejects(spark: SparkSession, stream: StreamConfig) -> DataFrame:
    """All rejected messages with their ``batch_id``."""
    return read_history(spark, stream.rejects, REJECT)
