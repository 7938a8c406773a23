"""Event-time queries: events arrive in batches, some of them late. The SQL states what may be known at the end.

Batch 1 has the first ten days of a month, batch 2 the next ten, batch 3 the
rest. ``late`` arrivals come one batch after their own. A batch is read under
the watermark that the batches before it have left.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources.files import read_table
from tidemark.streaming import windows as w

THIRD = "CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END"
DELAYED = f"least(3, {THIRD} + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END)"


#: Times as text, whatever the zone of the session.
CLOCK, SQL_CLOCK = "yyyy-MM-dd HH:mm:ss.SSSSSS", "'%Y-%m-%d %H:%M:%S.%f'"


def _clock(column: str):
    return F.date_format(column, CLOCK)


def _batches(events, numbered: str, overlap=None):
    for number in (1, 2, 3):
        held = F.expr(f"({numbered}) = {number}")
        yield events.where(held | F.expr(overlap.format(n=number)) if overlap else held)


def _arrivals(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def marks(numbered: str, delay: str) -> str:
    return f"""arrived AS (SELECT *, {numbered} AS batch FROM events),
marks AS (
  SELECT n AS batch, (SELECT date_trunc('millisecond', max(ts)) FROM arrived WHERE batch < n) - interval '{delay}' AS mark
  FROM range(1, 5) AS r(n)
), closed AS (SELECT mark FROM marks WHERE batch = 4)"""


@query(
    "j9_sliding_windows",
    f"""WITH {marks(DELAYED, "2 days")}, spans AS (
  SELECT a.*, time_bucket(interval '3 hours', ts, TIMESTAMP '1970-01-01') - to_hours(3 * k) AS start
  FROM arrived a, range(0, 2) AS r(k)
), totals AS (
  SELECT start, event_type, count(*) AS n_rows, sum(value) AS total
  FROM spans s JOIN marks m USING (batch)
  WHERE mark IS NULL OR start + interval '6 hours' > mark GROUP BY start, event_type
)
SELECT strftime(start, {SQL_CLOCK}) AS window_start, strftime(start + interval '6 hours', {SQL_CLOCK}) AS window_end, event_type, n_rows,
       cast(round(cast(total AS decimal(38,10)), 2) AS double) AS sum_value
FROM totals WHERE start + interval '6 hours' <= (SELECT mark FROM closed)""",
)
def sliding_windows(spark, sf_dir):
    """Rows and sums in windows of six hours every three, with a watermark of two days; late rows miss closed windows."""

    def build(stream):
        return w.sliding_totals(stream, "ts", ["event_type"], "value", "6 hours", "3 hours", "2 days")

    batches = _batches(_arrivals(spark, sf_dir), DELAYED)
    out = w.arrive(batches, build, scratch_path(spark, "sliding"))
    return out.withColumns({c: _clock(c) for c in ("window_start", "window_end")})


@query(
    "j10_late_rows",
    f"""WITH {marks(DELAYED, "2 days")}
SELECT cast(batch AS integer) AS batch, count(*) AS n_rows, cast(count(*) FILTER (ts < mark) AS bigint) AS n_late, strftime(mark, {SQL_CLOCK}) AS watermark
FROM arrived JOIN marks USING (batch) GROUP BY batch, mark""",
)
def late_rows(spark, sf_dir):
    arrivals = _arrivals(spark, sf_dir).withColumn("batch", F.expr(DELAYED))
    return w.late_rows(arrivals, "batch", "ts", "2 days").withColumn("watermark", _clock("watermark"))


@query(
    "j11_session_windows",
    f"""WITH {marks(THIRD, "1 day")}, gaps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= interval '6 hours' THEN 0 ELSE 1 END AS opens
  FROM events
), islands AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM gaps
), sessions AS (
  SELECT user_id, min(ts) AS first, max(ts) + interval '6 hours' AS last, count(*) AS n_rows, sum(value) AS total
  FROM islands GROUP BY user_id, island
)
SELECT strftime(first, {SQL_CLOCK}) AS session_start, strftime(last, {SQL_CLOCK}) AS session_end, user_id, n_rows,
       cast(round(cast(total AS decimal(38,10)), 2) AS double) AS sum_value
FROM sessions WHERE last <= (SELECT mark FROM closed)""",
)
def session_windows(spark, sf_dir):
    """Sessions of each user, ended by six hours without an event; those over the edge of two batches are one."""

    def build(stream):
        return w.session_totals(stream, "ts", ["user_id"], "value", "6 hours", "1 day")

    out = w.arrive(_batches(_arrivals(spark, sf_dir), THIRD), build, scratch_path(spark, "sessions"))
    return out.withColumns({c: _clock(c) for c in ("session_start", "session_end")})


@query("j12_stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Each batch also brings the last two days of the batch before again; every event comes out once."""
    again = f"({THIRD}) = {{n}} - 1 AND day(ts) > 10 * ({{n}} - 1) - 2"

    def build(stream):
        return w.drop_repeats(stream, "ts", ["event_id"], "5 days")

    out = w.arrive(_batches(_arrivals(spark, sf_dir), THIRD, again), build, scratch_path(spark, "repeats"))
    return out.select("event_id", "user_id", "event_type")


def _views_and_purchases(events):
    views = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed"))
    bought = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("bought"))
    return views, bought


@query(
    "j13_interval_join",
    f"""WITH {marks(THIRD, "1 day")}, ends AS (
  SELECT date_trunc('millisecond', least(max(ts) FILTER (event_type = 'view'), max(ts) FILTER (event_type = 'purchase')))
         - interval '1 day' AS mark FROM events
), views AS (SELECT * FROM events WHERE event_type = 'view'), bought AS (SELECT * FROM events WHERE event_type = 'purchase')
SELECT v.user_id, v.event_id AS view_id, b.event_id AS purchase_id
FROM views v LEFT JOIN bought b ON v.user_id = b.user_id AND b.ts >= v.ts AND b.ts <= v.ts + interval '12 hours'
WHERE b.event_id IS NOT NULL OR v.ts + interval '12 hours' < (SELECT mark FROM ends)""",
)
def interval_join(spark, sf_dir):
    """A user's purchases within twelve hours of a view, and views that none can follow any more."""

    def build(stream):
        return w.interval_join(
            *_views_and_purchases(stream), ["user_id"], "viewed", "bought", "12 hours", "1 day", "left_outer"
        )

    out = w.arrive(_batches(_arrivals(spark, sf_dir), THIRD), build, scratch_path(spark, "intervals"))
    return out.select("user_id", "view_id", "purchase_id")
