from podium.streaming.features import (
    Dimension,
    enriched_stream,
    feature_schema,
    feature_stream,
    prepare_dimension,
    read_features,
    run_feature_stream,
    run_refreshed_stream,
)
from podium.streaming.parking import decided, run_parked_stream
from podium.streaming.rejects import read_rejects
from podium.streaming.rolling import run_rolling_stream

__all__ = [
    "Dimension",
    "decided",
    "enriched_stream",
    "feature_schema",
    "feature_stream",
    "prepare_dimension",
    "read_features",
    "read_rejects",
    "run_feature_stream",
    "run_parked_stream",
    "run_refreshed_stream",
    "run_rolling_stream",
]
