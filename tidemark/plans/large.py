"""Queries of the operators that part one large group, order or history into pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import global_order, sketches, snapshots
from tidemark.plans.registry import query
from tidemark.sources.files import read_table


@query(
    "d23_distinct_in_groups",
    """WITH pairs AS (SELECT l_returnflag, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag, cast(sum(n) AS bigint) AS n_rows, count(l_partkey) AS n_parts, max(n) AS top_times
FROM pairs GROUP BY l_returnflag""",
)
def distinct_in_groups(spark, sf_dir):
    return sketches.distinct_in_groups(read_table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_partkey", "n_parts")


@query(
    "d24_merged_sketches",
    """SELECT event_type, count(*) AS n_rows, true AS distinct_within_error, true AS distinct_as_of_whole, true AS median_within_error
FROM events GROUP BY event_type""",
)
def merged_sketches(spark, sf_dir):
    """States of each day, merged by type: rows, and whether the estimates keep their stated errors."""
    events = read_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    by = ["event_type"]
    merged = sketches.merge_sketches(sketches.batch_sketches(events, [*by, "day"], "event_id", "value"), by)
    found = sketches.read_sketches(merged, by, [0.5])
    whole = sketches.read_sketches(sketches.batch_sketches(events, by, "event_id", "value"), by, [0.5])
    known = found.withColumn("median", F.col("quantiles")[0]).join(
        whole.select(*by, F.col("n_distinct").alias("of_whole")), by
    )
    rows = events.join(known, by).groupBy(*by, "n_rows", "n_distinct", "of_whole").agg(
        F.count_distinct("event_id").alias("exact"),
        F.avg((F.col("value") < F.col("median")).cast("int")).alias("below"),
        F.avg((F.col("value") <= F.col("median")).cast("int")).alias("upto"),
    )
    far = F.abs(F.col("n_distinct") - F.col("exact")) / F.col("exact")
    return rows.select(
        *by, "n_rows", (far <= 3 * 1.04 / 64).alias("distinct_within_error"),
        (F.abs(F.col("n_distinct") - F.col("of_whole")) <= 3 * 1.04 / 64 * F.col("exact")).alias("distinct_as_of_whole"),
        ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_within_error"),
    )


def _two_snapshots(spark, sf_dir):
    """Lines as they are; and without every seventh order, every eleventh twice, every thirteenth with other values."""
    old = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    kept = old.where("l_orderkey % 7 <> 0").withColumns({
        "l_quantity": F.expr("CASE WHEN l_orderkey % 13 = 0 THEN l_quantity + 1 ELSE l_quantity END"),
        "l_returnflag": F.expr("CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN NULL ELSE l_returnflag END"),
    })
    return old, kept.union(kept.where("l_orderkey % 11 = 0"))


SNAPSHOTS = """WITH old AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem), kept AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 13 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
         CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN NULL ELSE l_returnflag END AS l_returnflag
  FROM old WHERE l_orderkey % 7 <> 0
), new AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE l_orderkey % 11 = 0
), removed AS (SELECT * FROM old EXCEPT ALL SELECT * FROM new), added AS (SELECT * FROM new EXCEPT ALL SELECT * FROM old)"""


@query(
    "g2_snapshot_difference",
    f"""{SNAPSHOTS}
SELECT *, 'removed' AS change, count(*) AS times FROM removed GROUP BY ALL
UNION ALL SELECT *, 'added', count(*) FROM added GROUP BY ALL""",
)
def snapshot_difference(spark, sf_dir):
    return snapshots.multiset_difference(*_two_snapshots(spark, sf_dir))


@query(
    "g3_changed_keys",
    f"""{SNAPSHOTS}, keys AS (
  SELECT l_orderkey, 1 AS r, 0 AS a FROM removed UNION ALL SELECT l_orderkey, 0, 1 FROM added
)
SELECT l_orderkey, CASE WHEN l_orderkey NOT IN (SELECT l_orderkey FROM new) THEN 'removed'
    WHEN l_orderkey NOT IN (SELECT l_orderkey FROM old) THEN 'added' ELSE 'changed' END AS change,
    cast(sum(r) AS bigint) AS n_removed, cast(sum(a) AS bigint) AS n_added
FROM keys GROUP BY l_orderkey""",
)
def changed_keys(spark, sf_dir):
    return snapshots.changed_keys(*_two_snapshots(spark, sf_dir), ["l_orderkey"])


@query(
    "g4_snapshot_intersection",
    f"""{SNAPSHOTS}
SELECT *, count(*) AS times FROM (SELECT * FROM old INTERSECT ALL SELECT * FROM new) GROUP BY ALL""",
)
def snapshot_intersection(spark, sf_dir):
    return snapshots.multiset_intersection(*_two_snapshots(spark, sf_dir))


@query(
    "k1_global_ranks",
    """SELECT l_orderkey, l_linenumber, l_quantity,
       row_number() OVER (ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_no,
       rank() OVER (ORDER BY l_quantity DESC) AS "rank", dense_rank() OVER (ORDER BY l_quantity DESC) AS "dense_rank",
       ntile(100) OVER (ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tile
FROM lineitem""",
)
def global_ranks(spark, sf_dir):
    """All lines by quantity: each value lies in many ranges' reach, and each range begins inside a value."""
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    ranked = global_order.number_rows(
        lines, "l_quantity", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], tiles=100, descending=True
    )
    return ranked.drop("l_partkey", "l_suppkey")


@query(
    "k2_gap_to_previous",
    """SELECT o_orderkey, date_diff('day', lag(o_orderdate) OVER (ORDER BY o_orderdate, o_orderkey), o_orderdate) AS gap_days
FROM orders""",
)
def gap_to_previous(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    before = global_order.previous_value(orders, ["o_orderdate", "o_orderkey"], "o_orderdate")
    return before.select("o_orderkey", F.datediff("o_orderdate", "previous").cast("long").alias("gap_days"))
