"""Sketches kept per batch and merged, and exact distinct counts inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_in_groups(df: DataFrame, keys: Sequence[str], value: str, as_name: str = "n_distinct") -> DataFrame:
    """``*keys, n_rows, <as_name>, top_times``: rows, different values and the most frequent one's count in each group.

    Two levels: rows are merged by key and value where they are read and meet by
    a hash of both, so that a key with a third of all rows is dealt over all
    tasks; then the groups' partial counts are added. Null keys form a group; a
    null value is a row and no value.
    """
    pairs = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__times"))
    held = F.when(F.col(value).isNotNull(), F.col("__times"))
    return pairs.groupBy(*keys).agg(
        F.sum("__times").alias("n_rows"), F.count(held).alias(as_name), F.coalesce(F.max(held), F.lit(0)).alias("top_times")
    )


def batch_sketches(df: DataFrame, by: Sequence[str], distinct: str, measure: str, log2_slots: int = 12, k: int = 200) -> DataFrame:
    """``*by, n_rows, n_measured, distinct_state, quantile_state``: states that can be stored per batch and merged later.

    The first counts different values of ``distinct`` (relative error about
    ``1.04 / 2 ** (log2_slots / 2)``), the second holds ranks of ``measure``
    (error about ``1.65 / k`` of the rows at 200). Each has a fixed size at most,
    whatever the batch. Nulls are left out of both.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(measure).alias("n_measured"), F.expr(f"hll_sketch_agg({distinct}, {log2_slots})").alias("distinct_state"),
        F.expr(f"kll_sketch_agg_double(cast({measure} as double), {k})").alias("quantile_state"),
    )


def merge_sketches(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of several batches as one per ``by``: a new batch is added without reading the old rows again."""
    return states.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_measured").alias("n_measured"), F.expr("hll_union_agg(distinct_state)").alias("distinct_state"),
        F.expr("kll_merge_agg_double(quantile_state)").alias("quantile_state"),
    )


def read_sketches(states: DataFrame, by: Sequence[str] = (), ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``*by, n_rows, n_distinct, quantiles``: the estimates that states give; quantiles are null without a measured row."""
    at = ", ".join(f"{r}D" for r in ranks)
    return states.select(
        *by, "n_rows", F.expr("hll_sketch_estimate(distinct_state)").alias("n_distinct"),
        F.expr(f"CASE WHEN n_measured > 0 THEN kll_sketch_get_quantile_double(quantile_state, array({at})) END").alias("quantiles"),
    )
