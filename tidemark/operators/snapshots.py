"""Counted set operations on tables: what two snapshots hold more and less often, and which keys changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counted(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each different row with ``n_old`` and ``n_new``, how often either table has it; nulls are equal to each other.

    Rows are merged before they are moved; a row that makes up a third of a
    table is one partial count per task.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = old.withColumns({"n_old": one, "n_new": none}).unionByName(new.withColumns({"n_old": none, "n_new": one}))
    return both.groupBy(*old.columns).agg(F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"))


def multiset_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """The columns, ``change`` and ``times``: rows that ``new`` has more often (``added``) or less often (``removed``).

    One shuffle of partial counts. Tables without a difference give no rows.
    """
    more = F.col("n_new") - F.col("n_old")
    return _counted(old, new).where(more != 0).select(
        *old.columns, F.when(more > 0, "added").otherwise("removed").alias("change"), F.abs(more).alias("times")
    )


def multiset_intersection(old: DataFrame, new: DataFrame) -> DataFrame:
    """The columns and ``times``: rows that both tables have, as often as the one that has them less often."""
    both = _counted(old, new).withColumn("times", F.least("n_old", "n_new"))
    return both.where("times > 0").select(*old.columns, "times")


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``*keys, change, n_removed, n_added``: keys whose rows are not the same in both tables, repeats counted.

    ``change`` is ``added`` or ``removed`` where one table does not have the key at
    all, else ``changed``. Null keys are equal to each other.
    """
    counted = _counted(old, new).groupBy(*keys).agg(
        F.sum(F.greatest(F.col("n_old") - F.col("n_new"), F.lit(0))).alias("n_removed"),
        F.sum(F.greatest(F.col("n_new") - F.col("n_old"), F.lit(0))).alias("n_added"),
        F.sum("n_old").alias("__old"), F.sum("n_new").alias("__new"),
    )
    change = F.when(F.col("__old") == 0, "added").when(F.col("__new") == 0, "removed").otherwise("changed")
    return counted.where("n_removed + n_added > 0").select(*keys, change.alias("change"), "n_removed", "n_added")
