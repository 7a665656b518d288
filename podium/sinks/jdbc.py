"""Database sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.config import JdbcConfig
from podium.sinks.history import with_batch_id


def append_rows(df: DataFrame, table: JdbcConfig) -> None:
    """Append rows; at most ``num_partitions`` connections write at once."""
    (
        df.write.format("jdbc")
        .options(**table.connection())
        .option("dbtable", table.table)
        .option("batchsize", table.batch_size)
        .option("numPartitions", table.num_partitions)
        .mode("append")
        .save()
    )


def append_batch(
    batch: DataFrame, table: JdbcConfig, batch_id: int, keys: Sequence[str], stream: int = 0
) -> None:
    """Append a micro-batch exactly once, tagged with its stream and batch id.

    Tasks write to a staging table of this attempt. One transaction on the driver's connection then takes
    the batch's rows out of the target and puts the staged ones in, each group once: rows that a task
    repeated, because it died between its commit and its report, share the hash of the group
    columns and differ in a random mark, of which the least stays.
    """
    spark = batch.sparkSession
    tagged = with_batch_id(batch, batch_id, stream)
    append_rows(spark.createDataFrame([], tagged.schema), table)  # creates the table if missing
    mine = uuid.uuid4().hex[:8]
    staging = replace(table, table=f"{table.table}_{mine}", partition_column=None)
    group = F.xxhash64(*(F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys))
    mark = (F.rand() * (1 << 62)).cast("long")
    append_rows(tagged.withColumns({"staged_group": group, "staged_mark": mark}), staging)
    quote = _quoting(spark, table)
    columns = ", ".join(quote(c) for c in tagged.columns)
    same, mark_ = quote("staged_group"), quote("staged_mark")
    run_transaction(
        spark,
        table,
        # Unqualified: an index lies in its table's schema.
        before=[f"CREATE INDEX staged_{mine} ON {staging.table} ({same})"],
        statements=[
            f"DELETE FROM {table.table} WHERE {quote('stream_id')} = {stream} AND {quote('batch_id')} = {batch_id}",
            f"INSERT INTO {table.table} ({columns}) SELECT {columns} FROM {staging.table} s WHERE NOT EXISTS "
            f"(SELECT 1 FROM {staging.table} o WHERE o.{same} = s.{same} AND o.{mark_} < s.{mark_})",
        ],
        after=[f"DROP TABLE {staging.table}"],
    )


def _quoting(spark: SparkSession, table: JdbcConfig) -> Callable[[str], str]:
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(table.url)
    return dialect.quoteIdentifier


def run_transaction(
    spark: SparkSession, table: JdbcConfig, before: Sequence[str], statements: Sequence[str], after: Sequence[str]
) -> None:
    """Run ``statements`` in one transaction; what comes before and after commits by itself."""
    jvm = spark._jvm
    settings = table.connection()
    if table.driver:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(table.driver)
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in settings:
            properties.setProperty(name, settings[name])
    connection = jvm.java.sql.DriverManager.getConnection(table.url, properties)
    try:
        statement = connection.createStatement()
        for sql in before:
            statement.executeUpdate(sql)
        connection.setAutoCommit(False)
        try:
            for sql in statements:
                statement.executeUpdate(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        connection.setAutoCommit(True)
        for sql in after:
            statement.executeUpdate(sql)
    finally:
        connection.close()
