"""The batch lake on a small golden fixture."""

from __future__ import annotations

import math
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from podium.config import BIO_TABLE, RESULTS_TABLE, LakeConfig, SizingConfig
from podium.plans import bronze_to_silver, landing_to_bronze, run_lake, silver_to_gold

BIO = """athlete_id,country_noc,sex,height,weight
1,USA,Male,180,80.5
1,USA,Male,180,80.5
2,FRA,Female,165.5,63-65
3,GER,Male,nan,70
4,,Female,,55
,ITA,Male,190,90
"""
RESULTS = """athlete_id,country_noc,medal,sport
1,USA,Gold,Figure Skating
1,URS,Gold,Figure Skating
2,FRA,nan,Judo
3,GER,,Judo
4,SWE,Silver,Judo
9,XXX,Gold,Judo
,ITA,Gold,Judo
"""

GOLD = {
    ("FigureSkating", "Gold", "Male", "USA", 180.0, 80.5),
    ("Judo", "Gold", "Male", "ITA", 190.0, 90.0),
    ("Judo", "None", "Male", "GER", "NaN", 70.0),
    ("Judo", "Silver", "Female", "None", None, 55.0),
    ("Judo", "nan", "Female", "FRA", 165.5, 6365.0),
}


@pytest.fixture
def lake(tmp_path) -> LakeConfig:
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / f"{BIO_TABLE}.csv").write_text(BIO)
    (landing / f"{RESULTS_TABLE}.csv").write_text(RESULTS)
    return LakeConfig(*(str(tmp_path / layer) for layer in ("landing", "bronze", "silver", "gold")))


def _gold(frame):
    def shown(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else value

    keys = ["sport", "medal", "sex", "country_noc", "avg_height", "avg_weight"]
    return {tuple(shown(v) for v in row) for row in frame.select(*keys).collect()}


def test_gold(spark, lake):
    gold = run_lake(spark, lake)
    assert _gold(gold) == GOLD and gold.count() == len(GOLD)
    assert dict(gold.dtypes)["timestamp"] == "timestamp"
    assert gold.where("timestamp IS NULL").isEmpty()
    silver = spark.read.parquet(f"{lake.silver}/{BIO_TABLE}")
    assert silver.count() == 5 and {t for _, t in silver.dtypes} == {"string"}
    assert spark.read.parquet(f"{lake.silver}/{RESULTS_TABLE}").count() == 7


def test_gold_of_a_large_dimension(spark, lake):
    assert _gold(run_lake(spark, replace(lake, sizing=SizingConfig(broadcast_bytes=-1)))) == GOLD


def test_running_again_changes_nothing(spark, lake):
    run_lake(spark, lake)
    assert _gold(run_lake(spark, lake)) == GOLD
    assert spark.read.parquet(f"{lake.bronze}/{BIO_TABLE}").count() == 6


def test_kept_nulls_do_not_join(spark, lake):
    gold = _gold(run_lake(spark, replace(lake, null_token=None, keep_spaces=True)))
    assert ("Figure Skating", "Gold", "Male", "USA", 180.0, 80.5) in gold
    assert ("Judo", "Silver", "Female", None, None, 55.0) in gold
    assert not any(row[3] == "ITA" for row in gold)


def test_missing_inputs_are_errors(spark, lake):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        bronze_to_silver(spark, lake)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        silver_to_gold(spark, lake)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        landing_to_bronze(spark, replace(lake, landing=f"{lake.landing}-missing"))
    assert not Path(lake.silver).exists() and not Path(lake.gold).exists()


def test_failed_stage_runs_again(spark, lake):
    missing = Path(lake.landing) / f"{RESULTS_TABLE}.csv"
    missing.rename(f"{missing}.late")
    with pytest.raises(AnalysisException):
        run_lake(spark, lake)
    Path(f"{missing}.late").rename(missing)
    assert _gold(run_lake(spark, lake)) == GOLD
