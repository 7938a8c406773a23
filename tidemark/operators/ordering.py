"""Sorts, top rows and arg-max, always with a tie-break so that results repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import month_number


def sort_descending(df: DataFrame, by: str, *tie_break: str) -> DataFrame:
    """Range-partitioned total order, largest first."""
    return df.orderBy(F.desc(by), *tie_break)


def top_rows(
    df: DataFrame, n: int, by: str, *tie_break: str, rank_as: str | None = "rank"
) -> DataFrame:
    """The ``n`` largest rows with their rank.

    Spark plans sort plus limit as a per-task heap, so only ``n`` rows per task
    travel; the rank window sees those ``n`` rows and no others.
    """
    top = df.orderBy(F.desc(by), *tie_break).limit(n)
    if rank_as is None:
        return top
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(by), *tie_break)
    return top.withColumn(rank_as, F.row_number().over(order))


def best_row(df: DataFrame, by: str, *tie_break: str, lowest: bool = False) -> DataFrame:
    """Arg-max (or arg-min) row; ties go to the smallest tie-break value."""
    return df.orderBy(F.asc(by) if lowest else F.desc(by), *tie_break).limit(1)


def calendar_order(df: DataFrame, month: str) -> DataFrame:
    """Add ``month_no`` and sort January to December, unknown names last."""
    return df.withColumn("month_no", month_number(F.col(month))).orderBy(
        F.asc_nulls_last("month_no"), month
    )
