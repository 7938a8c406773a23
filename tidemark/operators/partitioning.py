"""Partition inspection and the partition-count sweep."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.grouping import append_snapshots, keyed_averages
from tidemark.operators.ordering import best_row
from tidemark.sources.files import inline_table

# The sweep's default partition counts.
SWEEP_COUNTS = [1, 2, 4, 8, 16]


def spread_evenly(df: DataFrame, partitions: int) -> DataFrame:
    """Round-robin into ``partitions`` equal parts."""
    return df.repartition(partitions)


def partition_sizes(df: DataFrame) -> DataFrame:
    """``(partition, rows)`` of every partition that holds rows."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def sweep_results(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], counts: Sequence[int] | dict
) -> DataFrame:
    """The two-key aggregate at each partition count, labelled.

    ``counts`` is a list of counts, or a mapping from label to count. Columns
    are pruned before the round-robin exchange.
    """
    labelled = counts if isinstance(counts, dict) else {n: n for n in counts}
    slim = df.select(*keys, *measures)
    return append_snapshots(
        *[
            keyed_averages(spread_evenly(slim, n), keys, measures).withColumn(
                "partitions", F.lit(label).cast("int")
            )
            for label, n in labelled.items()
        ]
    )


def timed(action: Callable[[], object], runs: int = 3) -> float:
    """Median wall time in seconds."""
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def sweep_timings(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    counts: Sequence[int] = SWEEP_COUNTS,
    runs: int = 3,
) -> DataFrame:
    """``(partitions, time_sec)``: median time of the two-key aggregate.

    One untimed run comes first, so the smallest count does not pay for warm-up.
    """

    def run(n: int) -> None:
        result = keyed_averages(spread_evenly(df.select(*keys, *measures), n), keys, measures)
        result.write.format("noop").mode("overwrite").save()

    run(counts[-1])
    rows = [(n, timed(lambda n=n: run(n), runs)) for n in counts]
    return inline_table(df.sparkSession, rows, "partitions int, time_sec double")


def fastest_setting(timings: DataFrame) -> DataFrame:
    return best_row(timings, "time_sec", "partitions", lowest=True)
