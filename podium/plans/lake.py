"""Batch lake: landing CSV, bronze Parquet, cleaned silver, averaged gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from podium.config import FeatureConfig, LakeConfig, SizingConfig
from podium.operators.aggregates import joined_averages
from podium.operators.rows import clean_strings, distinct_rows, number_columns
from podium.sinks.files import overwrite_parquet, replace_table
from podium.sources.files import ingest_landing, read_parquet, read_table


def clean_layer(
    df: DataFrame, null_token: str | None = "None", keep_spaces: bool = False
) -> DataFrame:
    return distinct_rows(clean_strings(df, null_token, keep_spaces))


def feature_table(
    facts: DataFrame,
    dim: DataFrame,
    features: FeatureConfig = FeatureConfig(),
    sizing: SizingConfig = SizingConfig(),
) -> DataFrame:
    """Averages per group of facts joined with their dimension, measures parsed tolerantly."""
    if features.fact_measures:
        facts = number_columns(facts, features.fact_measures, features.measure_type)
    dim = number_columns(dim, features.dim_measures, features.measure_type)
    return joined_averages(facts, dim, features, sizing)


def _write(df: DataFrame, path: str, lake: LakeConfig) -> None:
    if lake.versioned:
        replace_table(df, path)
    else:
        overwrite_parquet(df, path)


def _read(spark: SparkSession, path: str, lake: LakeConfig) -> DataFrame:
    return read_table(spark, path) if lake.versioned else read_parquet(spark, path)


def landing_to_bronze(spark: SparkSession, lake: LakeConfig) -> None:
    for table in lake.tables:
        _write(ingest_landing(spark, lake.landing, table, lake.multi_line), f"{lake.bronze}/{table}", lake)


def bronze_to_silver(spark: SparkSession, lake: LakeConfig) -> None:
    for table in lake.tables:
        cleaned = clean_layer(
            _read(spark, f"{lake.bronze}/{table}", lake), lake.null_token, lake.keep_spaces
        )
        _write(cleaned, f"{lake.silver}/{table}", lake)


def silver_to_gold(spark: SparkSession, lake: LakeConfig) -> None:
    facts = _read(spark, f"{lake.silver}/{lake.facts_table}", lake)
    dim = _read(spark, f"{lake.silver}/{lake.dim_table}", lake)
    _write(feature_table(facts, dim, lake.features, lake.sizing), f"{lake.gold}/avg_stats", lake)


STAGES = {
    "landing_to_bronze": landing_to_bronze,
    "bronze_to_silver": bronze_to_silver,
    "silver_to_gold": silver_to_gold,
}


def run_lake(spark: SparkSession, lake: LakeConfig) -> DataFrame:
    """All stages in order. Each replaces its output, so a failed run is simply run again.

    With ``versioned`` tables readers keep the version before until a stage has written all of its output.
    """
    for stage in STAGES.values():
        stage(spark, lake)
    return _read(spark, f"{lake.gold}/avg_stats", lake)
