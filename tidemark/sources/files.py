"""Batch readers and writers: CSV with a declared schema, Parquet, inline rows."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def input_path(variable: str, default: str, env: Mapping[str, str] | None = None) -> str:
    """Take an input location from an environment variable, else the default."""
    chosen = (os.environ if env is None else env).get(variable) or default
    if not chosen:
        raise FileNotFoundError(f"no input path: set {variable}")
    return chosen


def read_csv(
    spark: SparkSession, path: str, schema: StructType, mode: str = "PERMISSIVE"
) -> DataFrame:
    """Headered CSV under an explicit schema; nothing is inferred.

    ``enforceSchema=false`` makes a file whose header disagrees with the schema
    fail instead of loading values into the wrong columns. A missing path
    raises Spark's own ``PATH_NOT_FOUND``.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", mode)
        .csv(path)
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder laid out as ``<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Headered CSV, one file per partition as the data lies (no coalesce)."""
    df.write.mode(mode).option("header", True).csv(path)


def inline_table(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    """A small table from driver-side rows (timings, fitted coefficients)."""
    return spark.createDataFrame(list(rows), ddl)
