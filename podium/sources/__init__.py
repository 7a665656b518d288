from podium.sources.files import ingest_landing, read_csv, read_parquet, read_table
from podium.sources.jdbc import read_jdbc
from podium.sources.topic import read_topic, stream_once, stream_topic

__all__ = ["ingest_landing", "read_csv", "read_jdbc", "read_parquet", "read_table", "read_topic", "stream_once", "stream_topic"]
