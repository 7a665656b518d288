from podium.plans.lake import (
    bronze_to_silver,
    clean_layer,
    feature_table,
    landing_to_bronze,
    run_lake,
    silver_to_gold,
)
from podium.plans.publish import publish_facts

__all__ = [
    "bronze_to_silver",
    "clean_layer",
    "feature_table",
    "landing_to_bronze",
    "publish_facts",
    "run_lake",
    "silver_to_gold",
]
