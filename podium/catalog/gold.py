"""Joins and averages."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.catalog.registry import query, settled, table
from podium.config import FeatureConfig, LakeConfig, SizingConfig
from podium.functions import clean_text, try_number
from podium.operators import enrich, feature_averages, number_columns, valid_features
from podium.plans import feature_table, run_lake
from podium.session import work_folder
from podium.sinks import replace_table
from podium.sources import read_table

ORDER_FEATURES = FeatureConfig(
    key="custkey",
    fact_keys=("o_orderstatus", "o_orderpriority"),
    dim_keys=("c_mktsegment", "c_nationkey"),
    fact_measures=("o_totalprice",),
    dim_measures=("c_acctbal",),
    time_column=None,
)

# Nothing is small enough to broadcast: the plan for large dimensions.
LARGE = SizingConfig(broadcast_bytes=-1)

_AVG_STATS = """
SELECT o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey,
       avg(CAST(o_totalprice AS FLOAT)) AS avg_o_totalprice,
       avg(CAST(c_acctbal AS FLOAT)) AS avg_c_acctbal
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY ALL
"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")


@query(_AVG_STATS)
def gold_avg_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(_orders(spark, sf_dir), _customers(spark, sf_dir), ORDER_FEATURES)


@query(_AVG_STATS)
def gold_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, dim = _orders(spark, sf_dir), _customers(spark, sf_dir)
    return feature_table(facts, dim, ORDER_FEATURES, LARGE)


@query(
    """
SELECT o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey, TRUE AS has_timestamp
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY ALL
"""
)
def gold_time_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = replace(ORDER_FEATURES, time_column="timestamp")
    gold = feature_table(_orders(spark, sf_dir), _customers(spark, sf_dir), features)
    return gold.select(*features.keys, F.col("timestamp").isNotNull().alias("has_timestamp"))


@query(
    """
WITH f AS (
  SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'None'
              ELSE CAST(o_custkey AS VARCHAR) END AS k, o_orderstatus, o_totalprice
  FROM orders),
d AS (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'None'
              ELSE CAST(c_custkey AS VARCHAR) END AS k, c_nationkey, c_acctbal
  FROM customer)
SELECT o_orderstatus, c_nationkey,
       round(avg(CAST(o_totalprice AS FLOAT)) + 1e-7, 4) AS avg_o_totalprice,
       round(avg(CAST(c_acctbal AS FLOAT)) + 1e-7, 4) AS avg_c_acctbal
FROM f JOIN d USING (k) GROUP BY ALL
"""
)
def gold_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing keys are cleaned to one token on both sides and meet as one very hot key."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    building = F.col("c_mktsegment") == "BUILDING"
    key = F.col("custkey").cast("string")
    facts = _orders(spark, sf_dir).withColumn("custkey", clean_text(F.when(~urgent, key)))
    dim = _customers(spark, sf_dir).withColumn("custkey", clean_text(F.when(~building, key)))
    features = replace(ORDER_FEATURES, fact_keys=("o_orderstatus",), dim_keys=("c_nationkey",))
    return feature_table(facts, dim, features).select(
        *features.keys, *(settled(f"avg_{m}", 4).alias(f"avg_{m}") for m in features.measures)
    )


_KEEP_SIDE = """
SELECT {side}.n_name AS nation, count(*) AS n_rows,
       CAST(sum(l_quantity) AS DOUBLE) AS sum_quantity
FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
GROUP BY ALL
"""


def _two_nations(spark: SparkSession, sf_dir: str, keep_from: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))

    def with_nation(df: DataFrame, key: str) -> DataFrame:
        return enrich(df, nation.withColumnRenamed("n_nationkey", key), key)

    suppliers = with_nation(
        table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey")
        ),
        "s_nationkey",
    )
    customers = with_nation(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey")
        ),
        "c_nationkey",
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey"
    )
    facts = enrich(lines, suppliers, "l_suppkey").select("l_orderkey", "l_quantity", "nation")
    dim = enrich(orders, customers, "o_custkey").select("l_orderkey", "nation")
    joined = enrich(facts, dim, "l_orderkey", keep_from=keep_from, sizing=LARGE)
    return joined.groupBy("nation").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_quantity")
    )


@query(_KEEP_SIDE.format(side="sn"))
def join_keep_fact_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_nations(spark, sf_dir, "facts")


@query(_KEEP_SIDE.format(side="cn"))
def join_keep_dim_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_nations(spark, sf_dir, "dim")


@query(
    """
SELECT event_type, count(*) AS n_rows, round(avg(c_acctbal) + 1e-9, 6) AS avg_c_acctbal
FROM events LEFT JOIN customer ON user_id = c_custkey
WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal IS NOT NULL AND event_type <> 'error'
GROUP BY ALL
"""
)
def join_left_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join whose filter on the dimension makes it inner; 'nan' measures drop out."""
    balance = F.when(F.col("c_mktsegment") == "MACHINERY", "nan").otherwise(
        F.col("c_acctbal").cast("string")
    )
    dim = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), balance.alias("c_acctbal")
    )
    dim = number_columns(dim, ["c_acctbal"])
    joined = enrich(table(spark, sf_dir, "events"), dim, "user_id", how="left")
    valid = valid_features(joined, ["c_acctbal"], sentinel_column="event_type", sentinel="error")
    return valid.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), settled(F.avg("c_acctbal"), 6).alias("avg_c_acctbal")
    )


@query(
    """
SELECT o_orderstatus, count(*) AS n_rows, count(c_name) AS n_matched
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
GROUP BY ALL
"""
)
def join_left_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _customers(spark, sf_dir).where("c_acctbal > 0").select("custkey", "c_name")
    facts = _orders(spark, sf_dir).select("custkey", "o_orderkey", "o_orderstatus")
    joined = enrich(facts, dim, "custkey", how="left", sizing=LARGE)
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("c_name").alias("n_matched")
    )


@query(
    """
WITH f AS (
  SELECT CASE WHEN l_returnflag = 'N' THEN 1 WHEN l_returnflag = 'A' THEN NULL
              ELSE l_suppkey END AS k, l_quantity FROM lineitem)
SELECT s_nationkey, count(*) AS n_rows, CAST(sum(l_quantity) AS DOUBLE) AS sum_quantity
FROM f LEFT JOIN supplier ON k = s_suppkey GROUP BY ALL
"""
)
def join_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the facts on one supplier, a quarter without one, and no broadcast."""
    key = (
        F.when(F.col("l_returnflag") == "N", F.lit(1).cast("long"))
        .when(F.col("l_returnflag") == "A", F.lit(None))
        .otherwise(F.col("l_suppkey"))
    )
    facts = table(spark, sf_dir, "lineitem").select(
        key.alias("s_suppkey"), "l_orderkey", "l_linenumber", "l_quantity"
    )
    dim = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = enrich(facts, dim, "s_suppkey", how="left", sizing=LARGE)
    return joined.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_quantity")
    )


@query(
    """
SELECT user_id, round(c_acctbal, 6) AS c_acctbal, count(*) AS n_rows
FROM (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id FROM events)
JOIN (SELECT c_custkey AS user_id, c_acctbal FROM customer) USING (user_id) GROUP BY ALL
"""
)
def join_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys, some of them no number, meet numeric keys without failing."""
    key = F.when(F.col("event_type") == "error", "x").otherwise(F.col("user_id").cast("string"))
    facts = table(spark, sf_dir, "events").select(key.alias("user_id"))
    dim = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    joined = enrich(facts, dim, "user_id")
    return joined.groupBy("user_id", F.round("c_acctbal", 6).alias("c_acctbal")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    """
SELECT c_mktsegment, count(*) FILTER (WHERE c_nationkey = 7) > 0 AS is_nan,
       CASE WHEN count(*) FILTER (WHERE c_nationkey = 7) = 0
            THEN avg(CAST(c_acctbal AS FLOAT)) END AS avg_c_acctbal, count(*) AS n_rows
FROM (SELECT CASE WHEN c_nationkey < 20 THEN c_mktsegment ELSE 'OTHER' END AS c_mktsegment,
             c_nationkey, c_acctbal FROM customer) GROUP BY ALL
"""
)
def nan_poisoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfiltered batch averages: one NaN makes its group NaN."""
    segment = F.when(F.col("c_nationkey") < 20, F.col("c_mktsegment")).otherwise("OTHER")
    text = F.when(F.col("c_nationkey") == 7, "nan").otherwise(F.col("c_acctbal").cast("string"))
    rows = table(spark, sf_dir, "customer").select(
        segment.alias("c_mktsegment"), try_number(text, "float").alias("c_acctbal")
    )
    averaged = rows.groupBy("c_mktsegment").agg(
        F.avg("c_acctbal").alias("average"), F.count(F.lit(1)).alias("n_rows")
    )
    return averaged.select(
        "c_mktsegment",
        F.isnan("average").alias("is_nan"),
        F.when(~F.isnan("average"), F.col("average")).alias("avg_c_acctbal"),
        "n_rows",
    )


@query(
    """
SELECT c_mktsegment, c_nationkey, avg(CAST(c_acctbal AS FLOAT)) AS avg_c_acctbal
FROM customer GROUP BY ALL
"""
)
def feature_group_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = number_columns(table(spark, sf_dir, "customer"), ["c_acctbal"], "float")
    return feature_averages(rows, ["c_mktsegment", "c_nationkey"], ["c_acctbal"])


@query(
    r"""
WITH f AS (
  SELECT DISTINCT o_custkey,
         regexp_replace(o_orderstatus, '[^a-zA-Z0-9,.\\"'']', '', 'g') AS o_orderstatus,
         regexp_replace(o_orderpriority, '[^a-zA-Z0-9,.\\"'']', '', 'g') AS o_orderpriority,
         o_orderkey, CAST(CAST(o_totalprice AS VARCHAR) AS FLOAT) AS o_totalprice FROM orders),
d AS (
  SELECT DISTINCT c_custkey, c_nationkey,
         regexp_replace(c_mktsegment, '[^a-zA-Z0-9,.\\"'']', '', 'g') AS c_mktsegment,
         CAST(regexp_replace(CAST(c_acctbal AS VARCHAR), '[^a-zA-Z0-9,.\\"'']', '', 'g') AS FLOAT)
           AS c_acctbal FROM customer)
SELECT o_orderstatus, o_orderpriority, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       avg(o_totalprice) AS avg_o_totalprice, avg(c_acctbal) AS avg_c_acctbal
FROM f JOIN d ON o_custkey = c_custkey GROUP BY ALL
"""
)
def lake_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers as CSV through every layer; the cleaner also strips minus signs."""
    root = work_folder(spark, "lake")
    for name, rows in (("orders", _orders(spark, sf_dir)), ("customer", _customers(spark, sf_dir))):
        rows.write.option("header", True).csv(f"{root}/landing/{name}.csv")
    lake = LakeConfig(
        landing=f"{root}/landing",
        bronze=f"{root}/bronze",
        silver=f"{root}/silver",
        gold=f"{root}/gold",
        tables=("orders", "customer"),
        facts_table="orders",
        dim_table="customer",
        features=ORDER_FEATURES,
    )
    return run_lake(spark, lake)


@query(
    """
SELECT o_orderstatus, c_mktsegment, CAST(3 AS BIGINT) AS n_plans,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2))) AS DOUBLE) / count(*) + 1e-7, 4) AS avg_o_totalprice,
       round(CAST(sum(CAST(c_acctbal AS DECIMAL(12, 2))) AS DOUBLE) / count(*) + 1e-7, 4) AS avg_c_acctbal
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""
)
def gold_decimal_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal averages are the same to the last digit however the sides are joined."""
    features = replace(
        ORDER_FEATURES, fact_keys=("o_orderstatus",), dim_keys=("c_mktsegment",), measure_type="decimal(12,2)"
    )
    dim = _customers(spark, sf_dir)
    dim = dim.union(dim)  # two rows per key, one group
    plans = (SizingConfig(), SizingConfig(broadcast_rows_per_key=1), LARGE)
    found = [feature_table(_orders(spark, sf_dir), dim, features, sizing) for sizing in plans]
    rows = found[0].union(found[1]).union(found[2])
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n_plans"))
    return counted.select(
        *features.keys,
        "n_plans",
        *(settled(F.col(f"avg_{m}").cast("double"), 4).alias(f"avg_{m}") for m in features.measures),
    )


@query(
    """
WITH o AS (SELECT *, 'before' AS state FROM orders WHERE o_orderkey % 3 <> 0
           UNION ALL SELECT *, 'failed' FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT *, 'after' FROM orders)
SELECT state, o_orderstatus, c_mktsegment, avg(CAST(o_totalprice AS FLOAT)) AS avg_o_totalprice FROM o JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""
)
def lake_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table replaced three times: the second run fails in the middle of its write, and readers keep the first."""
    root = work_folder(spark, "gold-versions")
    features = replace(ORDER_FEATURES, fact_keys=("o_orderstatus",), dim_keys=("c_mktsegment",), dim_measures=())
    orders, dim = _orders(spark, sf_dir), _customers(spark, sf_dir)
    most = orders.where("o_orderkey % 3 <> 0")
    states = {}

    def replaced(rows: DataFrame, state: str) -> None:
        try:
            replace_table(rows, f"{root}/gold")
        except PySparkException:
            if state != "failed":
                raise
        states[state] = read_table(spark, f"{root}/gold").withColumn("state", F.lit(state))

    whole = feature_table(orders, dim, features)
    replaced(feature_table(most, dim, features), "before")
    measure = "avg_o_totalprice"
    broken = F.when(F.hash("o_orderstatus", "c_mktsegment") % 2 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col(measure))
    replaced(whole.withColumn(measure, broken.cast(whole.schema[measure].dataType)), "failed")
    replaced(whole, "after")
    return states["before"].unionByName(states["failed"]).unionByName(states["after"])
