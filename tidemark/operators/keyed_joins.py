"""Bounded intermediate results: settle them once, then join them back to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def settle(df: DataFrame, bounded: bool = False) -> DataFrame:
    """Compute ``df`` once and return it without its lineage.

    Where the caller's own arguments bound the rows (``bounded``) it becomes a
    local relation. Else it is written to the shared folder and read back; Spark
    then knows its size and chooses the joins by it.
    """
    spark = df.sparkSession
    if bounded:
        return spark.createDataFrame(df.toArrow(), df.schema)
    path = scratch_path(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, in the session's folder or, in a test, a scratch one."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def attach(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join of ``facts`` to ``rows`` on same-named keys.

    There is no broadcast hint: Spark broadcasts ``facts`` if their size is known
    to be small and otherwise shuffles, splitting hot keys adaptively. Without
    keys the (settled) facts are one row, which becomes constants.
    """
    if not keys:
        only = facts.first()
        return rows.withColumns({c: F.lit(only[c]) for c in facts.columns}) if only else (
            rows.where(F.lit(False)).select("*", *[F.lit(None).alias(c) for c in facts.columns])
        )
    renamed = facts.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = " AND ".join(f"`{k}` <=> `__{k}`" for k in keys)
    return rows.join(renamed, F.expr(condition), how).drop(*[f"__{k}" for k in keys])


def running_sums(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """``df`` with ``{c}_before`` and ``{c}_total`` for each column of ``sums``.

    ``{c}_before`` sums the rows of the same ``by`` that come earlier in
    ``order``, whose values differ within a group. Rows are dealt out by ranges
    that Spark samples from the data and written with the number of their range;
    a group of any size lies in as many ranges as its share of the rows. Sums
    run inside each range, and the totals of the ranges before it, one row per
    range and group, are added.
    """
    keys = list(by)
    along = F.desc(order) if descending else F.asc(order)
    ranged = settle(
        df.repartitionByRange(*keys, along).withColumn("__range", F.spark_partition_id())
    )
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        Window.partitionBy(*keys, "__range").orderBy(along)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    none = F.lit(0)
    starts = ranged.groupBy(*keys, "__range").agg(*[F.sum(c).alias(c) for c in sums]).select(
        *keys, "__range",
        *[F.coalesce(F.sum(c).over(earlier), none).alias(f"__{c}_start") for c in sums],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in sums],
    )
    local = ranged.withColumns(
        {f"{c}_before": F.coalesce(F.sum(c).over(inside), none) for c in sums}
    )
    return (
        attach(local, starts, [*keys, "__range"])
        .withColumns({f"{c}_before": F.col(f"{c}_before") + F.col(f"__{c}_start") for c in sums})
        .drop("__range", *[f"__{c}_start" for c in sums])
    )
