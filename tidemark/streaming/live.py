"""Running aggregates over a stream, with one snapshot of the live table per batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import LongType, StructType

from tidemark.operators.grouping import roll_up_segments
from tidemark.session import scratch_path


def segment_totals(df: DataFrame, key: str, measure: str, digits: int = 2) -> DataFrame:
    """Rows and rounded average per segment, for a batch or a stream alike.

    On a stream the state is one entry per segment and complete mode rewrites
    them all, so the key must be a category. Partial aggregation runs before
    the exchange to the state store, so a hot segment costs one row per task.
    """
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.round(F.avg(measure), digits).alias(f"avg_{measure}"),
    )


@contextmanager
def _few_state_partitions(spark: SparkSession) -> Iterator[None]:
    """Start a stream with no more state partitions than there are cores.

    Each state partition is a task and several files in every batch. Segments
    are few and already combined on the map side, so more partitions than cores
    hold nothing. A stream fixes its number at its first start; the session's
    setting is put back at once.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_memory_table(live: DataFrame, name: str, available_now: bool = False) -> StreamingQuery:
    """Complete-mode aggregate in the in-memory table ``name``.

    The table lives on the driver: for interactive use with few segments.
    """
    writer = live.writeStream.outputMode("complete").format("memory").queryName(name)
    writer = writer.option("checkpointLocation", scratch_path(live.sparkSession, "memory"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    with _few_state_partitions(live.sparkSession):
        return writer.start()


def query_status(query: StreamingQuery) -> dict:
    """Name, id, activity and last error of a query."""
    failure = query.exception()
    return {
        "name": query.name,
        "id": str(query.id),
        "active": query.isActive,
        "error": str(failure) if failure else None,
    }


def drain(
    spark: SparkSession, writer: DataStreamWriter, timeout_sec: float | None = None
) -> None:
    """Process everything that has arrived, then stop.

    Raises the query's own error if it fails, ``TimeoutError`` if it does not end
    within ``timeout_sec``, where that is given.
    """
    with _few_state_partitions(spark):
        query = writer.trigger(availableNow=True).start()
    try:
        if timeout_sec is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_sec):
            raise TimeoutError(f"stream {query.name} still busy after {timeout_sec} s")
    finally:
        query.stop()


def drain_to_memory(live: DataFrame, timeout_sec: float | None = None) -> DataFrame:
    """Drain a complete-mode aggregate into a fresh in-memory table."""
    name = f"live_{uuid.uuid4().hex}"
    writer = live.writeStream.outputMode("complete").format("memory").queryName(name)
    writer = writer.option("checkpointLocation", scratch_path(live.sparkSession, "memory"))
    drain(live.sparkSession, writer, timeout_sec)
    return live.sparkSession.table(name)


def drain_rows(stream: DataFrame, folder: str, timeout_sec: float | None = None) -> DataFrame:
    """Append the stream's rows to Parquet under ``folder`` and read them back."""
    drain(
        stream.sparkSession,
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .option("path", f"{folder}/rows"),
        timeout_sec,
    )
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


class LiveTable:
    """The state of a running aggregate after every batch, as a table.

    Batch ``b`` is written to its own directory in overwrite mode, so a batch
    that is run again after a failure replaces its own output and nothing else.
    The checkpoint makes later drains continue where the last one ended.
    """

    def __init__(self, live: DataFrame, folder: str) -> None:
        self.live = live
        self.folder = folder

    def _writer(self) -> Callable[[DataFrame, int], None]:
        folder = self.folder

        def write(snapshot: DataFrame, batch_id: int) -> None:
            snapshot.write.mode("overwrite").parquet(f"{folder}/table/batch_id={batch_id}")

        return write

    def drain(self, timeout_sec: float | None = None) -> None:
        drain(
            self.spark,
            self.live.writeStream.outputMode("complete")
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .foreachBatch(self._writer()),
            timeout_sec,
        )

    @property
    def spark(self) -> SparkSession:
        return self.live.sparkSession

    def snapshots(self) -> DataFrame:
        """Every version of the table: ``(batch, *columns)``, batches from 1."""
        schema = StructType(list(self.live.schema.fields)).add("batch_id", LongType())
        stored = self.spark.read.schema(schema).parquet(f"{self.folder}/table")
        return stored.select(
            (F.col("batch_id") + 1).alias("batch"), *[F.col(c) for c in self.live.columns]
        )

    def current(self) -> DataFrame:
        """The table after the last batch. Only that batch's directory is read."""
        versions = self.snapshots()
        latest = versions.agg(F.max("batch")).first()[0]
        return versions.where(F.col("batch") == latest).drop("batch")

    def history(self, average: str) -> DataFrame:
        """``(batch, total_txns, avg_of_group_avgs, weighted_avg)``, one row a batch."""
        return roll_up_segments(self.snapshots(), "txn_count", average, by=["batch"])
