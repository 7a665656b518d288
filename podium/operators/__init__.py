from podium.operators.aggregates import (
    feature_averages,
    joined_averages,
    latest_per_key,
    rolling_averages,
)
from podium.operators.joins import enrich, hot_keys
from podium.operators.rows import clean_strings, distinct_rows, number_columns, stamp, valid_features
from podium.operators.sizing import (
    SideProfile,
    fits_broadcast,
    may_broadcast,
    most_rows_per_key,
    profile_side,
)

__all__ = [
    "SideProfile",
    "clean_strings",
    "distinct_rows",
    "enrich",
    "feature_averages",
    "fits_broadcast",
    "hot_keys",
    "joined_averages",
    "latest_per_key",
    "may_broadcast",
    "most_rows_per_key",
    "number_columns",
    "profile_side",
    "rolling_averages",
    "stamp",
    "valid_features",
]
