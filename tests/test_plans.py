"""Physical plans that must hold at scale."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

import __spark_entry__ as registered
from podium.catalog.gold import ORDER_FEATURES
from podium.config import SizingConfig
from podium.functions import parse_messages
from podium.operators import clean_strings, enrich, number_columns, valid_features
from podium.plans import feature_table
from podium.sinks import read_history, write_batch

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        frame.explain("formatted")
    return told.getvalue()


def read(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_gold_broadcasts_and_shuffles_only_partial_averages(spark):
    plan = plan_of(registered.queries()["gold_avg_stats"](spark, SF_DIR))
    assert "BroadcastHashJoin" in plan and "partial_sum" in plan
    assert plan.count("hashpartitioning") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in plan


def test_large_dimension_is_collapsed_before_the_join(spark):
    plan = plan_of(registered.queries()["gold_large_dimension"](spark, SF_DIR))
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert plan.count("partial_count(1)") >= 2


def test_repeated_dimension_rows_do_not_move_the_facts(spark):
    facts = read(spark, "orders").withColumnRenamed("o_custkey", "custkey")
    dim = read(spark, "customer").withColumnRenamed("c_custkey", "custkey")
    repeated = dim.crossJoin(spark.range(6)).withColumn("c_acctbal", F.col("c_acctbal") + F.col("id"))
    plan = plan_of(feature_table(facts, repeated, ORDER_FEATURES))
    assert "BroadcastHashJoin" in plan
    # The collapsed dimension and the final averages.
    assert plan.count("hashpartitioning") == 2


def test_left_join_becomes_inner_and_filters_reach_the_scans(spark):
    plan = plan_of(registered.queries()["join_left_filtered"](spark, SF_DIR))
    assert "Join type: Inner" in plan and "LeftOuter" not in plan
    assert "Not(EqualTo(event_type,error))" in plan and "IsNotNull(user_id)" in plan


def test_salt_is_part_of_a_large_join(spark):
    plan = plan_of(registered.queries()["join_hot_keys"](spark, SF_DIR))
    assert "SortMergeJoin" in plan and "__salt" in plan


def test_measured_side_beyond_the_limit_is_never_broadcast(spark):
    facts = read(spark, "orders").withColumnRenamed("o_custkey", "c_custkey")
    dim = read(spark, "customer")
    assert "BroadcastHashJoin" in plan_of(enrich(facts, dim, "c_custkey"))
    tight = SizingConfig(broadcast_bytes=1000)
    assert "BroadcastHashJoin" not in plan_of(enrich(facts, dim, "c_custkey", sizing=tight))


def test_cleaning_stays_in_generated_code(spark):
    plan = plan_of(clean_strings(read(spark, "documents")))
    assert "Python" not in plan and plan.count("Project") >= 1
    assert "codegen id" in plan


def test_numbers_filter_in_one_stage(spark):
    rows = number_columns(read(spark, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("string")), ["c_acctbal"])
    plan = plan_of(valid_features(rows, ["c_acctbal"], ["c_mktsegment"]))
    assert "Exchange" not in plan and "IsNotNull(c_mktsegment)" in plan


@pytest.mark.parametrize("name", ["publish_text_topic", "parse_event_props", "malformed_messages"])
def test_messages_need_no_python(spark, name):
    assert "Python" not in plan_of(registered.queries()[name](spark, SF_DIR))


def test_message_is_parsed_once(spark):
    topic = spark.createDataFrame([], "key binary, value binary")
    schema = StructType([StructField("v", DoubleType()), StructField("k", StringType())])
    parsed = valid_features(parse_messages(topic, schema), ["v"], ["k"])
    optimized = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json") <= 1
    physical = spark.read.schema("key binary, value binary").parquet(f"{SF_DIR}/events.parquet")
    plan = plan_of(valid_features(parse_messages(physical, schema), ["v"], ["k"]))
    assert plan.count("from_json") == 1


def test_history_reads_only_the_batches_asked_for(spark, tmp_path):
    rows = spark.range(5).selectExpr("id AS k")
    for batch_id in range(3):
        write_batch(rows, str(tmp_path), batch_id)
    plan = plan_of(read_history(spark, str(tmp_path), rows.schema).where("batch_id = 2"))
    assert "PartitionFilters: [isnotnull(batch_id" in plan
