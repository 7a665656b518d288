"""Relation schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Field names and types of the event-result message.
RESULT_MESSAGE = StructType(
    [
        StructField("athlete", StringType()),
        StructField("athlete_id", IntegerType()),
        StructField("country_noc", StringType()),
        StructField("edition", StringType()),
        StructField("edition_id", IntegerType()),
        StructField("event", StringType()),
        StructField("isTeamSport", StringType()),
        StructField("medal", StringType()),
        StructField("pos", StringType()),
        StructField("result_id", IntegerType()),
        StructField("sport", StringType()),
    ]
)

# The same message with its optional event time, which rolling features need.
TIMED_RESULT_MESSAGE = StructType([*RESULT_MESSAGE.fields, StructField("timestamp", TimestampType())])

# Records of a file-backed topic, shaped like the Kafka source's key and value.
TOPIC_RECORD = StructType([StructField("key", BinaryType()), StructField("value", BinaryType())])

def averages(keys: tuple[str, ...], measures: tuple[str, ...], time_column: str | None) -> StructType:
    """Schema of a feature table, in column order."""
    columns = [StructField(k, StringType()) for k in keys]
    columns += [StructField(f"avg_{m}", DoubleType()) for m in measures]
    if time_column:
        columns.append(StructField(time_column, TimestampType()))
    return StructType(columns)
