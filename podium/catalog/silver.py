"""Landing, cleaning, numbers and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.catalog.registry import query, table
from podium.functions import try_number
from podium.operators import clean_strings, distinct_rows, valid_features
from podium.plans import clean_layer
from podium.session import work_folder
from podium.sinks import overwrite_parquet
from podium.sources import ingest_landing, read_parquet


def _through_csv(
    spark: SparkSession, rows: DataFrame, name: str, multi_line: bool = False
) -> DataFrame:
    root = work_folder(spark, "csv")
    writer = rows.write.option("header", True)
    if multi_line:
        # A multi-line file is read by one task: keep files small.
        writer = writer.option("escape", '"').option("maxRecordsPerFile", 50_000)
    writer.csv(f"{root}/landing/{name}.csv")
    landed = ingest_landing(spark, f"{root}/landing", name, multi_line)
    overwrite_parquet(landed, f"{root}/bronze/{name}")
    return read_parquet(spark, f"{root}/bronze/{name}")


def _cleaned(column: str, kept: str = "") -> str:
    return rf"""regexp_replace({column}, '[^a-zA-Z0-9,.\\"''{kept}]', '', 'g')"""


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer
"""
)
def bronze_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_csv(spark, table(spark, sf_dir, "customer"), "customer")


@query(
    """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars
FROM documents
"""
)
def bronze_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_csv(spark, table(spark, sf_dir, "documents"), "documents", multi_line=True)


@query(
    f"""
SELECT DISTINCT p_partkey, {_cleaned("p_name")} AS p_name, {_cleaned("p_brand")} AS p_brand,
       {_cleaned("p_type")} AS p_type, p_size, p_retailprice
FROM part
"""
)
def silver_clean_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_layer(table(spark, sf_dir, "part"))


@query(f"SELECT DISTINCT {_cleaned('text')} AS text, lang FROM documents")
def silver_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_layer(table(spark, sf_dir, "documents").select("text", "lang"))


@query(f"SELECT page_id, {_cleaned('url')} AS url, {_cleaned('html')} AS html FROM pages")
def silver_clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_strings(table(spark, sf_dir, "pages"))


@query(
    f"""
SELECT DISTINCT {_cleaned("role", " ")} AS role, {_cleaned("text", " ")} AS text FROM conversations
"""
)
def silver_keep_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("role", "text")
    return clean_layer(rows, keep_spaces=True)


@query(
    f"""
SELECT c_custkey, {_cleaned("c_name")} AS c_name, c_nationkey, c_acctbal,
       coalesce({_cleaned("nullif(c_mktsegment, 'BUILDING')")}, 'None') AS c_mktsegment
FROM customer
"""
)
def silver_null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return clean_strings(table(spark, sf_dir, "customer").withColumn("c_mktsegment", segment))


@query(
    f"""
SELECT c_custkey, {_cleaned("c_name")} AS c_name, c_nationkey, c_acctbal,
       {_cleaned("nullif(c_mktsegment, 'BUILDING')")} AS c_mktsegment
FROM customer
"""
)
def silver_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return clean_strings(table(spark, sf_dir, "customer").withColumn("c_mktsegment", segment), null_token=None)


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM lineitem")
def distinct_line_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"]
    return distinct_rows(table(spark, sf_dir, "lineitem").select(*terms))


@query(
    """
SELECT DISTINCT r.*
FROM (SELECT event_id % 100 AS event_id, strftime(ts, '%Y-%m-%d') AS ts, user_id, event_type,
             CAST(floor(value / 10) AS BIGINT) AS value, substr(props, 1, 7) AS props
      FROM events) r
"""
)
def distinct_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates over all columns of the whole table, made coarser so that rows repeat."""
    coarse = {
        "event_id": F.col("event_id") % 100,
        "ts": F.date_format("ts", "yyyy-MM-dd"),
        "value": F.floor(F.col("value") / 10),
        "props": F.substring("props", 1, 7),
    }
    return distinct_rows(table(spark, sf_dir, "events").withColumns(coarse))


@query(
    """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 100.0 ELSE o_totalprice END AS o_totalprice
FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P'
  AND (o_orderpriority <> '3-MEDIUM' OR o_orderstatus = 'O')
"""
)
def numeric_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as text, many of them no number; rows without a usable price or status drop."""
    price, priority, status = (
        F.col("o_totalprice").cast("string"), F.col("o_orderpriority"), F.col("o_orderstatus")
    )
    junk = F.when(status == "F", "None").when(status == "P", "1,85")
    text = (
        F.when(priority == "1-URGENT", "nan")
        .when(priority == "2-HIGH", F.when(status == "F", "NaN").when(status == "P", ""))
        .when(priority == "3-MEDIUM", junk.otherwise(F.concat(F.lit(" "), price, F.lit(" "))))
        .when(priority == "5-LOW", "1e2")
        .otherwise(price)
    )
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", try_number(text).alias("o_totalprice"), F.nullif(status, F.lit("P")).alias("status")
    )
    return valid_features(rows, ["o_totalprice"], required=["status"]).drop("status")


@query(
    """
SELECT label, count(*) AS n_rows
FROM (SELECT CASE event_type WHEN 'error' THEN 'nan' WHEN 'view' THEN NULL
                             WHEN 'click' THEN 'NaN' ELSE event_type END AS label FROM events)
WHERE label <> 'nan' GROUP BY ALL
"""
)
def sentinel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the exact sentinel and missing labels drop; 'NaN' stays."""
    kind = F.col("event_type")
    label = (
        F.when(kind == "error", "nan")
        .when(kind == "view", F.lit(None))
        .when(kind == "click", "NaN")
        .otherwise(kind)
    )
    rows = table(spark, sf_dir, "events").select(label.alias("label"))
    kept = valid_features(rows, sentinel_column="label")
    return kept.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
