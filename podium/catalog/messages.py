"""Messages: publish, parse, round trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from podium.catalog.registry import query, table
from podium.config import PublishConfig, TopicConfig
from podium.functions import is_number, message, parse_messages
from podium.plans import publish_facts
from podium.session import work_folder
from podium.sinks import write_topic
from podium.sources import read_topic, stream_topic
from podium.streaming.features import await_all, start

EVENT_MESSAGE = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)

TURN_MESSAGE = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("turn", LongType()),
        StructField("role", StringType()),
        StructField("text", StringType()),
    ]
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an instant as event time (the session runs in UTC)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
FROM events
"""
)
def publish_parse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a JSON message, read back as a stream."""
    root = work_folder(spark, "roundtrip")
    topic = TopicConfig(f"{root}/topic")
    publish_facts(
        spark, PublishConfig(topic, key_columns=("user_id",), load_id="events"), events(spark, sf_dir)
    )
    parsed = parse_messages(stream_topic(spark, topic), EVENT_MESSAGE)
    await_all([start(parsed.writeStream.option("path", f"{root}/parsed"), f"{root}/checkpoint")])
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return spark.read.parquet(f"{root}/parsed").withColumn("ts", stamp)


@query("SELECT conv_id, turn, role, text FROM conversations")
def publish_text_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per line: line breaks inside texts survive."""
    topic = TopicConfig(f"{work_folder(spark, 'turns')}/topic", format="text")
    write_topic(table(spark, sf_dir, "conversations"), topic)
    return parse_messages(read_topic(spark, topic), TURN_MESSAGE)


@query(
    """
SELECT event_type, count(k) AS n_rows, CAST(sum(k) AS BIGINT) AS sum_k
FROM (SELECT event_type, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
GROUP BY ALL
"""
)
def parse_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType([StructField("k", LongType())])
    rows = parse_messages(table(spark, sf_dir, "events"), schema, "props", keep=["event_type"])
    return rows.groupBy("event_type").agg(F.count("k").alias("n_rows"), F.sum("k").alias("sum_k"))


@query(
    """
SELECT variant, count(*) AS n_rows,
       CASE WHEN has_id THEN count(*) ELSE 0 END AS n_ids,
       CASE WHEN has_type THEN count(*) ELSE 0 END AS n_types,
       CASE WHEN has_value THEN count(*) FILTER (WHERE event_type <> 'error') ELSE 0 END AS n_valid
FROM events, (VALUES
  ('good', TRUE, TRUE, TRUE), ('more fields', TRUE, TRUE, TRUE), ('text id', FALSE, TRUE, TRUE),
  ('decimal id', FALSE, TRUE, TRUE), ('huge id', FALSE, TRUE, TRUE), ('no value', TRUE, TRUE, FALSE),
  ('object type', TRUE, TRUE, FALSE), ('cut off', FALSE, FALSE, FALSE),
  ('list', FALSE, FALSE, FALSE), ('no json', FALSE, FALSE, FALSE), ('empty', FALSE, FALSE, FALSE),
  ('missing', FALSE, FALSE, FALSE)) v(variant, has_id, has_type, has_value)
GROUP BY variant, has_id, has_type, has_value
"""
)
def malformed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a good message and spoiled in eleven ways; what each field parses to."""
    records = spoiled_records(spark, sf_dir)
    schema = StructType([f for f in EVENT_MESSAGE.fields if f.name in ("event_id", "event_type", "value")])
    parsed = parse_messages(records, schema, keep=["variant"])
    valid = is_number(F.col("value")) & (F.col("event_type") != "error")
    return parsed.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("event_id").alias("n_ids"),
        F.count("event_type").alias("n_types"),
        F.count_if(valid).alias("n_valid"),
    )


def spoiled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(variant, value) of every event, as a good message and spoiled in eleven ways."""
    number, kind, value = F.col("event_id").cast("string"), F.col("event_type"), F.col("value")
    good = F.col("good")

    def with_id(text: Column) -> Column:
        rest = message("event_type", "value")
        return F.concat(F.lit('{"event_id":'), text, F.lit(","), F.substring(rest, 2, 1 << 30))

    spoiled = {
        "good": good,
        "more fields": message("event_id", "event_type", "value", "props", "user_id"),
        "text id": with_id(F.concat(F.lit('"'), number, F.lit('"'))),
        "decimal id": with_id(F.concat(number, F.lit(".0"))),
        "huge id": with_id(F.concat(F.lit("99999999999999999999"), number)),
        "no value": message("event_id", "event_type"),
        "object type": message(
            F.col("event_id"), F.struct(kind.alias("a")).alias("event_type"), value.cast("string").alias("v")
        ),
        "cut off": F.substring(good, 1, F.length(good) - 1),
        "list": F.concat(F.lit("["), good, F.lit(","), good, F.lit("]")),
        "no json": F.concat(F.lit("event "), number),
        "empty": F.lit(""),
        "missing": F.lit(None).cast("string"),
    }
    variants = F.array(
        *(F.struct(F.lit(name).alias("variant"), text.alias("value")) for name, text in spoiled.items())
    )
    rows = table(spark, sf_dir, "events")
    rows = rows.withColumn("good", message("event_id", "event_type", "value"))
    return rows.select(F.explode(variants).alias("r")).select("r.*")
