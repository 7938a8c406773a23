"""Grouped counts, rates and averages. Each is one scan and one keyed shuffle of
partial aggregates; a hot key costs one partial row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import flag, percent_of_rows, ratio


def row_count(df: DataFrame, count_as: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(count_as))


def frequency(df: DataFrame, *keys: str, count_as: str = "count") -> DataFrame:
    """Rows per key or key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as))


def segment_summary(
    df: DataFrame,
    key: str,
    measure: str,
    positive: Column,
    avg_as: str = "avg_measure",
    count_as: str = "customers",
    positive_as: str = "positives",
    digits: int = 2,
) -> DataFrame:
    """Average measure, size and number of positives per segment."""
    return df.groupBy(key).agg(
        F.round(F.avg(measure), digits).alias(avg_as),
        F.count(F.lit(1)).alias(count_as),
        F.sum(flag(positive)).alias(positive_as),
    )


def rate_by(
    df: DataFrame,
    key: str,
    positive: Column,
    rate_as: str = "rate_pct",
    count_as: str | None = "customers",
    digits: int = 2,
) -> DataFrame:
    """Percentage of positives per key."""
    columns = [percent_of_rows(positive, digits).alias(rate_as)]
    if count_as:
        columns.append(F.count(F.lit(1)).alias(count_as))
    return df.groupBy(key).agg(*columns)


def volume_by(
    df: DataFrame,
    key: str,
    measure: str,
    count_as: str = "contacts",
    avg_as: str = "avg_measure",
    digits: int = 1,
) -> DataFrame:
    """Row volume and average measure per key."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(count_as), F.round(F.avg(measure), digits).alias(avg_as)
    )


def average_by(
    df: DataFrame, key: str, measure: str, avg_as: str = "avg_measure", digits: int = 1
) -> DataFrame:
    return df.groupBy(key).agg(F.round(F.avg(measure), digits).alias(avg_as))


def average_for_value(
    df: DataFrame, key: str, measure: str, values: Sequence[str], digits: int = 1
) -> DataFrame:
    """One row with ``avg_<value>`` for each named key value, in one pass."""
    return df.agg(
        *[
            F.round(F.avg(F.when(F.col(key) == v, F.col(measure))), digits).alias(f"avg_{v}")
            for v in values
        ]
    )


def overall_rate(
    df: DataFrame, positive: Column, rate_as: str = "rate_pct", digits: int | None = None
) -> DataFrame:
    """Share of positive rows in percent, in a single pass."""
    rate = F.avg(flag(positive)) * 100
    return df.agg((rate if digits is None else F.round(rate, digits)).alias(rate_as))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, count)`` for many categorical columns in one scan."""
    long = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def distinct_counts(
    df: DataFrame, columns: Sequence[str], relative_error: float | None = None
) -> DataFrame:
    """``(column, distinct_values)``; null counts as a value.

    Exact by default. With ``relative_error`` a HyperLogLog estimate is kept
    per column instead of the set of values.
    """
    if relative_error is None:
        return (
            category_counts(df, columns)
            .groupBy("column")
            .agg(F.count(F.lit(1)).alias("distinct_values"))
        )
    estimates = df.agg(
        *[
            (
                F.approx_count_distinct(c, relative_error)
                + F.max(flag(F.col(c).isNull())).cast("bigint")
            ).alias(c)
            for c in columns
        ]
    )
    return estimates.unpivot([], list(columns), "column", "distinct_values")


def cross_tab(
    df: DataFrame, row_key: str, column_key: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Counts of ``column_key`` values as columns, absent combinations as 0.

    Conditional counts need one shuffle where a pivot needs two. Without a value
    list the values are looked up first, within Spark's own pivot limit; rows
    without a value are counted in a column ``null`` if there are any.
    """
    if values is None:
        limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = (
            df.select(column_key).distinct().limit(limit + 1).collect()
        )
        if len(found) > limit:
            raise ValueError(f"{column_key} has more than {limit} values; pass a value list")
        values = sorted(row[0] for row in found if row[0] is not None)
        values += [None] * any(row[0] is None for row in found)
    return df.groupBy(row_key).agg(
        *[F.count_if(F.col(column_key).eqNullSafe(F.lit(v))).alias("null" if v is None else str(v)) for v in values]
    )


def share_of_total(df: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """Count and percentage of all rows per category.

    The total is a scalar subquery over the grouped counts (it reuses their
    shuffle), so no window pulls all categories into one task.
    """
    counts = frequency(df, key)
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.select(
        key, "count", F.round(100 * F.col("count") / total, digits).alias("share_pct")
    )


def keyed_averages(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], count_as: str = "rows"
) -> DataFrame:
    """``avg_<measure>`` for each measure and the row count per key combination."""
    return df.groupBy(*keys).agg(
        *[F.avg(m).alias(f"avg_{m}") for m in measures], F.count(F.lit(1)).alias(count_as)
    )


def roll_up_segments(
    segments: DataFrame, count: str, average: str, by: Sequence[str] = (), digits: int = 2
) -> DataFrame:
    """Aggregate a per-segment aggregate once more.

    ``avg_of_group_avgs`` gives every segment the same weight;
    ``weighted_avg`` weights it by its rows and so is the mean over the rows
    (up to the rounding already in ``average``).
    """
    return segments.groupBy(*by).agg(
        F.sum(count).cast("bigint").alias("total_txns"),
        F.round(F.avg(average), digits).alias("avg_of_group_avgs"),
        F.round(
            ratio(F.sum(F.col(count) * F.col(average)), F.sum(count), None), digits
        ).alias("weighted_avg"),
    )


def history_peak(history: DataFrame, column: str, peak_as: str = "peak") -> DataFrame:
    return history.agg(F.max(column).alias(peak_as))


def append_snapshots(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Stack snapshots by column name."""
    for other in rest:
        first = first.unionByName(other)
    return first
