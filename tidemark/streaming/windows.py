"""Event-time operators with a watermark: sliding windows, sessions, de-duplication, interval joins, and late rows.

Each function takes a stream or a table. On a stream a watermark follows the
latest event time by ``delay``; state behind it is written out and dropped, so
state holds what lies within the delay, not the stream. Event times are
timestamps; rows without one are in no window, session or pair, and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keyed_joins import attach
from tidemark.streaming.live import drain


def with_delay(df: DataFrame, time: str, delay: str) -> DataFrame:
    """``df`` without rows that have no event time, and with a watermark if it is a stream.

    Times without a zone are those of the session's zone.
    """
    timed = df.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay) if df.isStreaming else timed


def _totals(measure: str, digits: int) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(measure), digits).alias(f"sum_{measure}")]


def sliding_totals(
    df: DataFrame, time: str, by: Sequence[str], measure: str, width: str, slide: str, delay: str, digits: int = 2
) -> DataFrame:
    """``window_start, window_end, *by, n_rows, sum_<measure>`` of windows of ``width`` that begin every ``slide``.

    A window holds its start and not its end. In append mode each window comes
    once, when the watermark has passed its end; a row counts in those of its
    windows that are still open when it arrives. Rows are added up per window
    before they are moved. Null keys form a group; null measures are left out
    of the sum, which is null if there is no other.
    """
    spans = with_delay(df, time, delay).groupBy(F.window(time, width, slide), *by).agg(*_totals(measure, digits))
    return spans.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *by, "n_rows", f"sum_{measure}",
    )


def session_totals(
    df: DataFrame, time: str, by: Sequence[str], measure: str, gap: str, delay: str, digits: int = 2
) -> DataFrame:
    """``session_start, session_end, *by, n_rows, sum_<measure>``: runs of a key's rows with at most ``gap`` between.

    A session ends ``gap`` after its last row; sessions merge when a row closes
    the gap between them, also over batches. In append mode a session comes once,
    when the watermark has passed its end. Sessions of a task are merged before
    they are moved; null keys form a group.
    """
    spans = with_delay(df, time, delay).groupBy(F.session_window(time, gap), *by).agg(*_totals(measure, digits))
    return spans.select(
        F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
        *by, "n_rows", f"sum_{measure}",
    )


def drop_repeats(df: DataFrame, time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """The first row to arrive of each key; on a stream a key is forgotten ``delay`` after its first event time.

    A repeat whose event time lies within ``delay`` of the first is always
    dropped, also in a later batch. Null keys are equal to each other.
    """
    timed = with_delay(df, time, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else timed.dropDuplicates(list(keys))


def interval_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, within: str, delay: str, how: str = "inner"
) -> DataFrame:
    """Pairs of equal ``on`` in which the right row comes at the left one's time or up to ``within`` after it.

    All columns of both sides but the right ``on``; other names must differ.
    ``how`` is ``inner`` or ``left_outer``; on streams an unmatched left row comes
    when no right row can follow any more. Both sides are kept only for
    ``within`` and the delay. Null keys match nothing.
    """
    a, b = with_delay(left, left_time, delay), with_delay(right, right_time, delay)
    b = b.withColumnsRenamed({c: f"__{c}" for c in on})
    held = F.expr(
        " AND ".join(f"`{c}` = `__{c}`" for c in on)
        + f" AND `{right_time}` >= `{left_time}` AND `{right_time}` <= `{left_time}` + interval {within}"
    )
    return a.join(b, held, how).drop(*[f"__{c}" for c in on])


def watermarks(arrivals: DataFrame, batch: str, time: str, delay: str) -> DataFrame:
    """``batch, n_rows, watermark``: the watermark that holds while each batch is read.

    It is the latest event time of all batches before, in whole milliseconds,
    less the delay; null for the first one. The window has one row per batch.
    """
    latest = arrivals.groupBy(batch).agg(F.count(time).alias("n_rows"), F.max(time).alias("latest"))
    before = Window.partitionBy(F.lit(0)).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    whole = F.date_trunc("millisecond", F.max("latest").over(before))
    return latest.select(batch, "n_rows", (whole - F.expr(f"interval {delay}")).alias("watermark"))


def late_rows(arrivals: DataFrame, batch: str, time: str, delay: str) -> DataFrame:
    """``batch, n_rows, n_late, watermark``: rows of each batch whose event time lies behind its watermark.

    Rows without event time are not counted. Batches join their rows as facts;
    a batch of any size is counted in parts.
    """
    marks = watermarks(arrivals, batch, time, delay)
    late = F.count_if(F.col(time) < F.col("watermark"))
    rows = attach(arrivals.where(F.col(time).isNotNull()).select(batch, time), marks, [batch])
    return rows.groupBy(batch, "n_rows", "watermark").agg(late.alias("n_late")).select(batch, "n_rows", "n_late", "watermark")


def arrive(
    batches: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame], folder: str, timeout_sec: float | None = None
) -> DataFrame:
    """Everything that the stream ``build`` makes of a watched folder gives, in append mode, while batches arrive in it.

    Each batch is written by all tasks in parallel and drained as one
    micro-batch, after which the watermark moves on; state and watermark go over
    to the next by the checkpoint. Repeated arrivals of a batch are new rows.
    """
    out, stream = f"{folder}/rows", None
    for batch in batches:
        batch.write.mode("append").parquet(f"{folder}/incoming")
        spark = batch.sparkSession
        if stream is None:
            stream = build(spark.readStream.schema(batch.schema).parquet(f"{folder}/incoming"))
        writer = stream.writeStream.outputMode("append").format("parquet")
        drain(spark, writer.option("checkpointLocation", f"{folder}/checkpoint").option("path", out), timeout_sec)
    if stream is None:
        raise ValueError("no batch arrives")
    return spark.read.schema(stream.schema).parquet(out)
