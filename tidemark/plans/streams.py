"""Running aggregates over the event stream. The SQL states what a drained stream holds."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators.grouping import history_peak
from tidemark.operators.ordering import top_rows
from tidemark.operators.sampling import assign_batches
from tidemark.plans.registry import query
from tidemark.plans.reports import streaming_report
from tidemark.plans.sqltext import rnd
from tidemark.session import scratch_path
from tidemark.sources.files import inline_table, read_table
from tidemark.sources.stream import read_parquet_stream
from tidemark.streaming.live import LiveTable, drain_to_memory, query_status, segment_totals, start_memory_table
from tidemark.streaming.replay import disjoint_batches, overlapping_batches, replay

BATCHES = 5

TOTALS = f"""SELECT event_type, count(*) AS txn_count, {rnd("avg(value)", 2)} AS avg_value
             FROM events GROUP BY event_type"""
VERSIONS = f"""
WITH versions AS (
  SELECT cast(b AS bigint) AS batch, event_type, count(*) AS txn_count,
         {rnd("avg(value)", 2)} AS avg_value
  FROM events, (SELECT range AS b FROM range(1, {BATCHES + 1})) AS n
  WHERE event_id % {BATCHES} + 1 <= b GROUP BY b, event_type
), history AS (
  SELECT batch, cast(sum(txn_count) AS bigint) AS total_txns,
         {rnd("avg(avg_value)", 2)} AS avg_of_group_avgs,
         {rnd("sum(txn_count * avg_value) / sum(txn_count)", 2)} AS weighted_avg
  FROM versions GROUP BY batch
)"""


def event_totals(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    stream = read_parquet_stream(spark, f"{sf_dir}/events.parque[t]", schema)
    return segment_totals(stream, "event_type", "value")


def replayed(spark, sf_dir, batches: int = BATCHES) -> LiveTable:
    events = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return replay(
        disjoint_batches(events, "event_id", batches, seed=None),
        "event_type", "value", scratch_path(spark, "replay"),
    )


@query("a7_memory_table", TOTALS)
def memory_table(spark, sf_dir):
    return drain_to_memory(event_totals(spark, sf_dir))


@query("j1_running_aggregate", TOTALS)
def running_aggregate(spark, sf_dir):
    live = LiveTable(event_totals(spark, sf_dir), scratch_path(spark, "live"))
    live.drain()
    return live.current()


@query("j2_complete_mode", f"{VERSIONS} SELECT * FROM versions")
def complete_mode(spark, sf_dir):
    """Complete output after each batch: every segment again, with its new totals."""
    return replayed(spark, sf_dir).snapshots()


@query("j4_repeated_drain", TOTALS)
def repeated_drain(spark, sf_dir):
    """A second drain with nothing new adds nothing; each file counts once."""
    live = replayed(spark, sf_dir, batches=2)
    live.drain()
    return live.current()


@query("j5_replay_batches", f"SELECT event_id, cast(event_id % {BATCHES} + 1 AS integer) AS batch_no FROM events")
def replay_batches(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id")
    return assign_batches(events, "event_id", BATCHES, seed=None)


@query(
    "j5_overlapping_replay",
    f"""WITH drawn AS (
  SELECT cast(s + 1 AS bigint) AS batch, event_type, value FROM events, range(0, {BATCHES}) AS r(s)
  QUALIFY row_number() OVER (PARTITION BY s ORDER BY ('0x' || substr(md5(event_id || ':' || s), 1, 15))::BIGINT, event_id) <= 400
), versions AS (
  SELECT cast(b AS bigint) AS batch, event_type, count(*) AS txn_count, {rnd("avg(value)", 2)} AS avg_value
  FROM drawn, range(1, {BATCHES + 1}) AS n(b) WHERE drawn.batch <= b GROUP BY b, event_type
)
SELECT batch, event_type, txn_count, avg_value FROM versions""",
)
def overlapping_replay(spark, sf_dir):
    """Independent seeded samples of 400 events arrive one after the other; the table after each."""
    events = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    batches = overlapping_batches(events, "event_id", BATCHES, 400, portable=True)
    return replay(batches, "event_type", "value", scratch_path(spark, "overlap")).snapshots()


@query(
    "j3_query_status",
    """SELECT 'running' AS state, true AS active, false AS failed, count(*) AS rows_seen FROM events
UNION ALL SELECT 'stopped', false, false, count(*) FROM events""",
)
def query_states(spark, sf_dir):
    """A named query after it has read all events, and after its stop; its table stays."""
    name = f"events_{uuid.uuid4().hex}"
    started = start_memory_table(event_totals(spark, sf_dir), name)
    lines = []
    try:
        started.processAllAvailable()
        lines.append(("running", query_status(started)))
    finally:
        started.stop()
    lines.append(("stopped", query_status(started)))
    if any(status["name"] != name for _, status in lines):
        raise ValueError("the query lost its name")
    seen = spark.table(name).agg(F.sum("txn_count")).first()[0]
    return inline_table(
        spark, [(state, s["active"], s["error"] is not None, seen) for state, s in lines],
        "state string, active boolean, failed boolean, rows_seen bigint",
    )


@query("j6_batch_history", f"{VERSIONS} SELECT * FROM history")
def batch_history(spark, sf_dir):
    return replayed(spark, sf_dir).history("avg_value")


@query("j7_cumulative_curve", f"{VERSIONS} SELECT batch, total_txns FROM history")
def cumulative_curve(spark, sf_dir):
    return replayed(spark, sf_dir).history("avg_value").select("batch", "total_txns")


@query(
    "j8_final_ranking",
    f"""WITH t AS ({TOTALS})
SELECT *, cast(row_number() OVER (ORDER BY txn_count DESC, event_type) AS integer) AS "rank"
FROM t ORDER BY txn_count DESC, event_type""",
)
def final_ranking(spark, sf_dir):
    """All segments; their number is a count of the aggregate's rows."""
    current = replayed(spark, sf_dir).current()
    return top_rows(current, max(1, current.count()), "txn_count", "event_type")


@query("d21_history_peak", f"{VERSIONS} SELECT max(total_txns) AS peak FROM history")
def stream_peak(spark, sf_dir):
    return history_peak(replayed(spark, sf_dir).history("avg_value"), "total_txns")


@query(
    "m3_streaming_report",
    f"""{VERSIONS}, top AS (
  SELECT * FROM versions WHERE batch = {BATCHES} ORDER BY txn_count DESC, event_type LIMIT 1
)
SELECT 'total_streamed' AS insight, 'all' AS "key", cast(max(total_txns) AS double) AS "value" FROM history
UNION ALL SELECT 'batches', 'all', cast(max(batch) AS double) FROM history
UNION ALL SELECT 'top_segment_txns', event_type, cast(txn_count AS double) FROM top
UNION ALL SELECT 'top_segment_avg', event_type, avg_value FROM top""",
)
def report(spark, sf_dir):
    return streaming_report(replayed(spark, sf_dir), "event_type", "avg_value")
