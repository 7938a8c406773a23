"""Replaying a table as a sequence of arriving batches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sampling import assign_batches, sample_batch
from tidemark.sources.files import write_csv
from tidemark.sources.stream import read_csv_stream
from tidemark.streaming.live import LiveTable, segment_totals


def disjoint_batches(df: DataFrame, key: str, batches: int, seed: int | None = 42):
    """Yield the batches of a split that covers every row once."""
    tagged = assign_batches(df, key, batches, seed)
    for number in range(1, batches + 1):
        yield tagged.where(F.col("batch_no") == number).drop("batch_no")


def overlapping_batches(df: DataFrame, key: str, batches: int = 5, rows: int = 400, portable: bool = False):
    """Yield independent samples of ``rows`` rows; a row may come more than once."""
    for seed in range(batches):
        yield sample_batch(df, key, rows, seed, portable)


def replay(
    batches: Iterable[DataFrame], key: str, measure: str, folder: str
) -> LiveTable:
    """Let batches arrive in a watched CSV folder and drain after each.

    A batch is written by all tasks in parallel; all its files together are one
    micro-batch, so history gets one entry per batch at any size.
    """
    live: LiveTable | None = None
    incoming = f"{folder}/incoming"
    for batch in batches:
        write_csv(batch, incoming, mode="append")
        if live is None:
            stream = read_csv_stream(batch.sparkSession, incoming, batch.schema)
            live = LiveTable(segment_totals(stream, key, measure), folder)
        live.drain()
    if live is None:
        raise ValueError("nothing to replay")
    return live
