from podium.sinks.fanout import FanOut, SinkFailure
from podium.sinks.files import overwrite_parquet, replace_table
from podium.sinks.history import compact_history, read_history, read_latest, write_batch
from podium.sinks.jdbc import append_batch, append_rows
from podium.sinks.topic import write_topic

__all__ = [
    "FanOut",
    "SinkFailure",
    "append_batch",
    "append_rows",
    "compact_history",
    "overwrite_parquet",
    "read_history",
    "read_latest",
    "replace_table",
    "write_batch",
    "write_topic",
]
