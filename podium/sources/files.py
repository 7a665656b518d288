"""File sources. Paths are any file system Spark reads; a missing input is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from podium.sinks.files import table_versions, version_path


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header row; every column is a string unless a schema is given.

    Without ``multi_line`` a quoted line break ends the record, and large files are split among
    tasks. With it a file is read by one task, so land such data as many files.
    """
    reader = spark.read.option("header", True)
    if multi_line:
        reader = reader.option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table that ``replace_table`` keeps; an error before the first one."""
    known = table_versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no version of a table in {path}")
    return spark.read.parquet(version_path(path, known[-1]))


def ingest_landing(spark: SparkSession, landing: str, table: str, multi_line: bool = False) -> DataFrame:
    """One landed table: ``<landing>/<table>.csv``, a file or a folder of files."""
    return read_csv(spark, f"{landing}/{table}.csv", multi_line=multi_line)
