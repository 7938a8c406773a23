"""Ranks, tiles and neighbours over one very large order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keyed_joins import attach, settle


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows dealt out by ranges of the order that Spark samples, with the number of their range, written once."""
    return settle(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))


def number_rows(df: DataFrame, value: str, tie: Sequence[str], tiles: int | None = None, descending: bool = False) -> DataFrame:
    """``df`` with ``row_no``, ``rank``, ``dense_rank`` by ``value``, and ``tile`` if ``tiles`` are asked for.

    ``tie`` orders rows of equal value, and together with ``value`` should name a
    row; equal rows get numbers in no fixed order. Ranks count from 1. Nulls come
    first, last if ``descending``, and are equal to each other. Tiles are
    as equal as can be, the first ones one row larger, as in ``ntile``.

    Rows are sorted within ranges only. The rows and the different values of the
    ranges before are added, one row a range; a value that lies in several ranges
    takes its rank from the first of them and counts there.
    """
    along = F.desc(value) if descending else F.asc(value)
    ranged = _ranged(df, [along, *[F.asc(t) for t in tie]])
    inside = Window.partitionBy("__range").orderBy(along, *tie)
    by_value = Window.partitionBy("__range").orderBy(along)
    local = ranged.withColumns({
        "__row": F.row_number().over(inside), "__rank": F.rank().over(by_value), "__dense": F.dense_rank().over(by_value),
    })
    # One row a range: its size, its different values, its first and last value.
    ends = local.groupBy("__range").agg(
        F.count(F.lit(1)).alias("__size"), F.max("__dense").alias("__values"),
        F.min_by(F.struct(value), "__row").alias("__first"), F.max_by(F.struct(value), "__row").alias("__last"),
        F.min(F.when(F.col("__dense") == 1, F.col("__row"))).alias("__one"),
        F.count_if(F.col("__dense") == 1).alias("__firsts"), F.max(F.col("__rank")).alias("__last_rank"),
    )
    along_ranges = Window.partitionBy(F.lit(0)).orderBy("__range")
    before = along_ranges.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__start", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    ends = ends.withColumn("__goes_on", F.coalesce(F.lag("__last").over(along_ranges).eqNullSafe(F.col("__first")), F.lit(False)))
    # Of a value that goes on from the range before, the rank where it began: the last range in which another value came before it.
    began = F.when(~F.col("__goes_on") | (F.col("__values") > 1), F.col("__start") + F.col("__last_rank"))
    ends = ends.withColumn("__carried", F.last(began, ignorenulls=True).over(before))
    shared = F.sum(F.col("__values") - F.col("__goes_on").cast("long")).over(before)
    whole = F.sum("__size").over(Window.partitionBy(F.lit(0)))
    ends = ends.select(
        "__range", "__start", "__goes_on", "__carried", F.coalesce(shared, F.lit(0)).alias("__distinct"), whole.alias("__all")
    )
    out = attach(local, settle(ends), ["__range"])
    first_value = F.col("__goes_on") & (F.col("__dense") == 1)
    row = F.col("__start") + F.col("__row")
    columns = {
        "row_no": row,
        "rank": F.when(first_value, F.col("__carried")).otherwise(F.col("__start") + F.col("__rank")),
        "dense_rank": F.col("__distinct") + F.col("__dense") - F.col("__goes_on").cast("long"),
    }
    if tiles:
        small, larger = F.expr(f"__all div {tiles}"), F.col("__all") % tiles
        edge = larger * (small + 1)
        columns["tile"] = F.when(row <= edge, F.floor((row - 1) / (small + 1)) + 1).otherwise(
            larger + F.floor((row - 1 - edge) / F.greatest(small, F.lit(1))) + 1
        )
    return out.select(*df.columns, *[c.cast("long").alias(n) for n, c in columns.items()])


def previous_value(df: DataFrame, order: Sequence[str], value: str, as_name: str = "previous") -> DataFrame:
    """``df`` with the ``value`` of the row before in ``order``, null for the first row.

    ``order`` should name a row. Rows are sorted within ranges; the first row of
    a range takes the last value of the last range before that has rows.
    """
    columns = [F.asc(c) for c in order]
    ranged = _ranged(df, columns)
    inside = Window.partitionBy("__range").orderBy(*columns)
    local = ranged.withColumns({"__row": F.row_number().over(inside), "__held": F.lag(F.struct(value)).over(inside)})
    last = local.groupBy("__range").agg(F.max_by(F.struct(value), "__row").alias("__last"))
    carried = F.lag("__last").over(Window.partitionBy(F.lit(0)).orderBy("__range"))
    out = attach(local, settle(last.select("__range", carried.alias("__carried"))), ["__range"])
    held = F.when(F.col("__row") == 1, F.col("__carried")).otherwise(F.col("__held"))
    return out.withColumn(as_name, held[value]).select(*df.columns, as_name)
