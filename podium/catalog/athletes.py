"""The default settings, on athletes and results made from customers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.catalog.registry import query, settled, table
from podium.catalog.streams import STATE_PARTITIONS
from podium.config import (
    BIO_TABLE,
    RESULTS_TABLE,
    FeatureConfig,
    LakeConfig,
    RollingConfig,
    StreamConfig,
    TopicConfig,
)
from podium.operators import latest_per_key
from podium.plans import run_lake
from podium.schemas import RESULT_MESSAGE, TIMED_RESULT_MESSAGE
from podium.session import work_folder
from podium.sinks import read_history, write_topic
from podium.streaming import read_features, run_feature_stream, run_rolling_stream

_SQL = """
WITH results AS (
  SELECT o_custkey AS athlete_id, o_orderdate AS "timestamp",
         CASE o_orderstatus WHEN 'O' THEN 'USA' WHEN 'F' THEN 'FRA' ELSE 'GER' END AS event_noc,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Gold' WHEN '2-HIGH' THEN 'Silver'
              WHEN '3-MEDIUM' THEN 'Bronze' WHEN '4-NOT SPECIFIED' THEN 'nan' END AS medal,
         CASE WHEN year(o_orderdate) % 2 = 0 THEN 'Figure Skating' ELSE 'Judo' END AS sport
  FROM orders),
bio AS (
  SELECT c_custkey AS athlete_id, 'N' || c_nationkey AS bio_noc, c_acctbal AS height, c_nationkey,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Male'
              WHEN c_mktsegment <> 'FURNITURE' THEN 'Female' END AS sex
  FROM customer)
"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    year = F.year("o_orderdate")
    medal = (
        F.when(priority == "1-URGENT", "Gold")
        .when(priority == "2-HIGH", "Silver")
        .when(priority == "3-MEDIUM", "Bronze")
        .when(priority == "4-NOT SPECIFIED", "nan")
    )
    country = F.when(status == "O", "USA").when(status == "F", "FRA").otherwise("GER")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Athlete "), F.col("o_custkey")).alias("athlete"),
        F.col("o_custkey").alias("athlete_id"),
        country.alias("country_noc"),
        F.concat(year, F.lit(" Summer Games")).alias("edition"),
        year.alias("edition_id"),
        priority.alias("event"),
        (status == "P").cast("string").alias("isTeamSport"),
        medal.alias("medal"),
        status.alias("pos"),
        F.col("o_orderkey").alias("result_id"),
        F.when(year % 2 == 0, "Figure Skating").otherwise("Judo").alias("sport"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


def bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    sex = F.when(segment.isin("BUILDING", "MACHINERY"), "Male").when(segment != "FURNITURE", "Female")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("athlete_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("N"), nation).alias("country_noc"),
        sex.alias("sex"),
        F.when(nation == 7, "nan").otherwise(F.col("c_acctbal").cast("string")).alias("height"),
        F.when(nation == 3, "63-65").when(nation != 4, (50 + nation).cast("string")).alias("weight"),
    )


@query(
    f"""{_SQL}
SELECT replace(sport, ' ', '') AS sport, coalesce(medal, 'None') AS medal,
       coalesce(sex, 'None') AS sex, bio_noc AS country_noc, c_nationkey = 7 AS nan_height,
       CASE WHEN c_nationkey <> 7 THEN avg(CAST(abs(height) AS FLOAT)) END AS avg_height,
       avg(CASE c_nationkey WHEN 3 THEN 6365.0 WHEN 4 THEN NULL ELSE 50.0 + c_nationkey END)
         AS avg_weight
FROM results JOIN bio USING (athlete_id)
GROUP BY sport, medal, sex, bio_noc, c_nationkey
"""
)
def athlete_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers with cleaned texts: bio-side country, NaN heights kept, '63-65' read as 6365."""
    root = work_folder(spark, "athletes")
    for name, rows in ((BIO_TABLE, bio), (RESULTS_TABLE, results)):
        rows(spark, sf_dir).write.option("header", True).csv(f"{root}/landing/{name}.csv")
    layers = (f"{root}/{layer}" for layer in ("landing", "bronze", "silver", "gold"))
    gold = run_lake(spark, LakeConfig(*layers))
    height = F.col("avg_height")
    return gold.select(
        *FeatureConfig().keys,
        F.isnan(height).alias("nan_height"),
        F.when(~F.isnan(height), height).alias("avg_height"),
        "avg_weight",
    )


def _stream(root: str) -> StreamConfig:
    return StreamConfig(
        TopicConfig(f"{root}/topic"),
        checkpoint=f"{root}/checkpoint",
        history=f"{root}/history",
        state_partitions=STATE_PARTITIONS,
    )


_STREAM_ROWS = """
FROM results JOIN bio USING (athlete_id)
WHERE c_nationkey NOT IN (3, 4, 7) AND sex IS NOT NULL AND medal <> 'nan'
"""


@query(
    f"""{_SQL}
SELECT sport, medal, event_noc AS country_noc, sex, round(avg(height) + 1e-9, 6) AS avg_height,
       round(avg(50.0 + c_nationkey) + 1e-9, 6) AS avg_weight
{_STREAM_ROWS} GROUP BY ALL
"""
)
def athlete_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw texts: event-side country, rows without a usable height, weight, sex or medal dropped."""
    stream = _stream(work_folder(spark, "athletes"))
    write_topic(results(spark, sf_dir), stream.topic, load_id="all")
    dim = bio(spark, sf_dir)
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    newest = latest_per_key(read_features(spark, stream, RESULT_MESSAGE, dim), stream.features.keys)
    return newest.select(
        *stream.features.keys,
        *(settled(f"avg_{m}", 6).alias(f"avg_{m}") for m in stream.features.measures),
    )


@query(
    f"""{_SQL}, valid AS (SELECT *, date_trunc('week', "timestamp") AS s {_STREAM_ROWS})
SELECT strftime(s, '%Y-%m-%d') AS week, sport, medal, event_noc AS country_noc, sex,
       round(avg(height) + 1e-9, 6) AS avg_height, round(avg(50.0 + c_nationkey) + 1e-9, 6) AS avg_weight
FROM valid
WHERE s + INTERVAL 7 DAY <= (SELECT max("timestamp") FROM results WHERE medal <> 'nan') - INTERVAL 1 DAY
GROUP BY ALL
"""
)
def athlete_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly features by the time in the messages; closed weeks only."""
    stream = _stream(work_folder(spark, "athletes"))
    write_topic(results(spark, sf_dir), stream.topic, load_id="all")
    # Weeks start on Monday, the epoch on a Thursday.
    weeks = RollingConfig(size="7 days", delay="1 day", offset="4 days")
    schema = run_rolling_stream(spark, stream, weeks, bio(spark, sf_dir), TIMED_RESULT_MESSAGE)
    return read_history(spark, stream.history, schema).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("week"),
        *stream.features.keys,
        *(settled(f"avg_{m}", 6).alias(f"avg_{m}") for m in stream.features.measures),
    )
