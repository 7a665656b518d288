"""spark-submit --py-files podium.zip jobs/feature_stream.py --config stream.json

Give the connector jars (Kafka, database driver) to spark-submit with --packages or --jars.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from podium.config import StreamJobConfig, load
from podium.schemas import RESULT_MESSAGE, TIMED_RESULT_MESSAGE
from podium.session import build_session
from podium.sources import read_jdbc, read_parquet
from podium.streaming import run_feature_stream, run_parked_stream, run_refreshed_stream, run_rolling_stream


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Average features of a result stream, running or per window.")
    parser.add_argument("--config", required=True)
    job = load(StreamJobConfig, parser.parse_args(arguments).config)
    if (job.dim_table is None) == (job.dim_path is None):
        raise ValueError("give one of dim_table and dim_path")
    spark = build_session("podium-feature-stream")

    def dim() -> DataFrame:
        return read_jdbc(spark, job.dim_table) if job.dim_table else read_parquet(spark, job.dim_path)

    if job.rolling:
        run_rolling_stream(spark, job.stream, job.rolling, dim(), TIMED_RESULT_MESSAGE)
    elif job.parking:
        run_parked_stream(spark, job.stream, job.parking, dim, TIMED_RESULT_MESSAGE)
    elif job.stream.refresh_seconds:
        run_refreshed_stream(spark, job.stream, dim, RESULT_MESSAGE)
    else:
        run_feature_stream(spark, job.stream, dim(), RESULT_MESSAGE)


if __name__ == "__main__":
    main()
