"""Session views, catalog tables and their inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Overwrite a catalog table and return it as read back.

    Managed in the session warehouse by default, external when ``path`` is set.
    """
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current database: namespace, tableName, isTemporary."""
    return spark.sql("SHOW TABLES")


def describe_columns(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of every column, without a scan."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, nullable boolean"
    )


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows, still lazy; bound a result with this before collecting it."""
    return df.limit(n)
