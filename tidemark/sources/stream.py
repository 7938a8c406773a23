"""File-folder stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Watch a folder of headered CSV files that all follow ``schema``."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def read_parquet_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Watch a folder (or glob) of Parquet files that all follow ``schema``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
