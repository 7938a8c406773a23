"""Grouped aggregates, orderings, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.expressions import flag, month_name, percent_of_rows, ratio, title_case
from tidemark.operators import grouping as g
from tidemark.operators.metrics import exact_auc
from tidemark.operators.ordering import best_row, calendar_order, sort_descending, top_rows
from tidemark.operators.sampling import assign_batches
from tidemark.plans.registry import query
from tidemark.plans.sqltext import rnd, with_contacts
from tidemark.sources.contacts import contacts_from_orders
from tidemark.sources.files import read_table
from tidemark.sources.schemas import CATEGORICAL
from tidemark.streaming.live import segment_totals

FREQUENCY_COLUMNS = ["y", "job", "marital", "education", "contact", "month"]


def category_counts_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", "{c}" AS "value", count(*) AS "count"
            FROM contacts GROUP BY "{c}" """
        for c in columns
    )


DONE = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"
MONTH = "lower(strftime(o_orderdate, '%b'))"


def _done():
    return F.col("o_orderstatus") == "F"


def _orders_with_month(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.select("o_totalprice", month_name(F.col("o_orderdate")).alias("month"))


@query("d1_row_count", 'SELECT count(*) AS "rows" FROM lineitem')
def row_count(spark, sf_dir):
    return g.row_count(read_table(spark, sf_dir, "lineitem"))


@query(
    "d2_frequency",
    'SELECT o_orderpriority, count(*) AS "count" FROM orders GROUP BY o_orderpriority',
)
def frequency(spark, sf_dir):
    return g.frequency(read_table(spark, sf_dir, "orders"), "o_orderpriority")


@query("d2_frequency_many_columns", with_contacts(category_counts_sql(FREQUENCY_COLUMNS)))
def frequency_many_columns(spark, sf_dir):
    return g.category_counts(contacts_from_orders(spark, sf_dir), FREQUENCY_COLUMNS)


@query(
    "d3_two_key_frequency",
    with_contacts('SELECT poutcome, y, count(*) AS "count" FROM contacts GROUP BY poutcome, y'),
)
def two_key_frequency(spark, sf_dir):
    return g.frequency(contacts_from_orders(spark, sf_dir), "poutcome", "y")


@query(
    "d4_balance_by_segment",
    f"""SELECT c_mktsegment, {rnd("avg(c_acctbal)", 2)} AS avg_balance, count(*) AS customers,
               cast(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS bigint) AS overdrawn
        FROM customer GROUP BY c_mktsegment""",
)
def balance_by_segment(spark, sf_dir):
    summary = g.segment_summary(
        read_table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal",
        F.col("c_acctbal") < 0, avg_as="avg_balance", positive_as="overdrawn",
    )
    return sort_descending(summary, "avg_balance", "c_mktsegment")


@query(
    "d4_balance_by_job",
    with_contacts(f"""
SELECT job, {rnd("avg(balance)", 2)} AS avg_balance, count(*) AS customers,
       cast(sum(CASE WHEN y = 'yes' THEN 1 ELSE 0 END) AS bigint) AS subscribers
FROM contacts GROUP BY job"""),
)
def balance_by_job(spark, sf_dir):
    summary = g.segment_summary(
        contacts_from_orders(spark, sf_dir), "job", "balance", F.col("y") == "yes",
        avg_as="avg_balance", positive_as="subscribers",
    )
    return sort_descending(summary, "avg_balance", "job")


@query(
    "d5_rate_by_priority",
    f"""SELECT o_orderpriority, {rnd(f"100.0 * sum({DONE}) / count(*)", 2)} AS rate_pct,
               count(*) AS customers
        FROM orders GROUP BY o_orderpriority""",
)
def rate_by_priority(spark, sf_dir):
    return g.rate_by(read_table(spark, sf_dir, "orders"), "o_orderpriority", _done())


@query(
    "d5_rate_by_outcome",
    with_contacts(f"""
SELECT poutcome,
       {rnd("100.0 * sum(CASE WHEN y = 'yes' THEN 1 ELSE 0 END) / count(*)", 2)} AS rate
FROM contacts GROUP BY poutcome"""),
)
def rate_by_outcome(spark, sf_dir):
    return g.rate_by(
        contacts_from_orders(spark, sf_dir), "poutcome", F.col("y") == "yes",
        rate_as="rate", count_as=None,
    )


@query(
    "d6_volume_by_month",
    f"""SELECT {MONTH} AS "month", count(*) AS contacts, {rnd("avg(o_totalprice)", 1)} AS avg_price
        FROM orders GROUP BY 1""",
)
def volume_by_month(spark, sf_dir):
    volume = g.volume_by(
        _orders_with_month(spark, sf_dir), "month", "o_totalprice", avg_as="avg_price"
    )
    return sort_descending(volume, "contacts", "month")


@query(
    "d7_average_by_class",
    f"SELECT l_returnflag, {rnd('avg(l_quantity)', 1)} AS avg_quantity FROM lineitem GROUP BY 1",
)
def average_by_class(spark, sf_dir):
    return g.average_by(
        read_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity", avg_as="avg_quantity"
    )


@query("d8_overall_rate", f"SELECT {rnd(f'100.0 * avg({DONE})', 6)} AS rate_pct FROM orders")
def overall_rate(spark, sf_dir):
    return g.overall_rate(read_table(spark, sf_dir, "orders"), _done(), digits=6)


@query(
    "d10_distinct_counts",
    with_contacts(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(DISTINCT "{c}") AS distinct_values FROM contacts"""
            for c in CATEGORICAL
        )
    ),
)
def distinct_counts(spark, sf_dir):
    return g.distinct_counts(contacts_from_orders(spark, sf_dir), CATEGORICAL)


@query(
    "d11_cross_tab",
    with_contacts("""
SELECT housing, count(*) FILTER (WHERE y = 'no') AS "no", count(*) FILTER (WHERE y = 'yes') AS "yes"
FROM contacts GROUP BY housing"""),
)
def cross_tab(spark, sf_dir):
    return g.cross_tab(contacts_from_orders(spark, sf_dir), "housing", "y", ["no", "yes"])


@query(
    "d11_cross_tab_found_values",
    """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
              count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
              count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
       FROM orders GROUP BY o_orderpriority""",
)
def cross_tab_found_values(spark, sf_dir):
    return g.cross_tab(read_table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


@query(
    "d17_share_of_total",
    f"""SELECT o_orderstatus, count(*) AS "count",
               {rnd("100.0 * count(*) / sum(count(*)) OVER ()", 1)} AS share_pct
        FROM orders GROUP BY o_orderstatus""",
)
def share_of_total(spark, sf_dir):
    return g.share_of_total(read_table(spark, sf_dir, "orders"), "o_orderstatus")


@query(
    "d18_two_key_averages",
    f"""SELECT l_returnflag, l_linestatus, {rnd("avg(l_quantity)", 4)} AS avg_l_quantity,
               {rnd("avg(l_extendedprice)", 4)} AS avg_l_extendedprice, count(*) AS "rows"
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def two_key_averages(spark, sf_dir):
    measures = ["l_quantity", "l_extendedprice"]
    averages = g.keyed_averages(
        read_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], measures
    )
    return averages.withColumns({f"avg_{m}": F.round(f"avg_{m}", 4) for m in measures})


@query(
    "d19_aggregate_of_aggregates",
    f"""
WITH s AS (SELECT event_type, count(*) AS n, {rnd("avg(value)", 2)} AS a FROM events GROUP BY 1)
SELECT cast(sum(n) AS bigint) AS total_txns, {rnd("avg(a)", 2)} AS avg_of_group_avgs,
       {rnd("sum(n * a) / sum(n)", 2)} AS weighted_avg FROM s""",
)
def aggregate_of_aggregates(spark, sf_dir):
    segments = segment_totals(read_table(spark, sf_dir, "events"), "event_type", "value")
    return g.roll_up_segments(segments, "txn_count", "avg_value")


@query(
    "d20_best_row",
    f"""SELECT o_orderpriority, {rnd(f"100.0 * sum({DONE}) / count(*)", 2)} AS rate_pct,
               count(*) AS customers
        FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
def best_priority(spark, sf_dir):
    rates = g.rate_by(read_table(spark, sf_dir, "orders"), "o_orderpriority", _done())
    return best_row(rates, "rate_pct", "o_orderpriority")


@query(
    "f1_sorted_frequency",
    with_contacts('SELECT job, count(*) AS "count" FROM contacts GROUP BY job'),
)
def sorted_frequency(spark, sf_dir):
    counts = g.frequency(contacts_from_orders(spark, sf_dir), "job")
    return sort_descending(counts, "count", "job")


@query(
    "f2_first_rows",
    """SELECT *, cast(row_number() OVER (ORDER BY contacts DESC, user_id) AS integer) AS "rank"
       FROM (SELECT user_id, count(*) AS contacts FROM events GROUP BY user_id)
       ORDER BY contacts DESC, user_id LIMIT 12""",
)
def first_rows(spark, sf_dir):
    counts = g.frequency(read_table(spark, sf_dir, "events"), "user_id", count_as="contacts")
    return top_rows(counts, 12, "contacts", "user_id")


@query(
    "f3_calendar_order",
    f"""SELECT {MONTH} AS "month", count(*) AS "count",
               cast(month(any_value(o_orderdate)) AS integer) AS month_no
        FROM orders GROUP BY 1""",
)
def calendar(spark, sf_dir):
    return calendar_order(g.frequency(_orders_with_month(spark, sf_dir), "month"), "month")


@query(
    "f4_top_k",
    """SELECT l_partkey, sum(l_quantity) AS quantity,
              cast(row_number() OVER (ORDER BY sum(l_quantity) DESC, l_partkey) AS integer) AS "rank"
       FROM lineitem GROUP BY l_partkey ORDER BY quantity DESC, l_partkey LIMIT 15""",
)
def top_k(spark, sf_dir):
    totals = read_table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity")
    )
    return top_rows(totals, 15, "quantity", "l_partkey")


@query(
    "g1_append_snapshots",
    f"""
SELECT event_type, count(*) AS txn_count, {rnd("avg(value)", 2)} AS avg_value, 1 AS batch
FROM events WHERE event_id % 2 = 0 GROUP BY event_type
UNION ALL
SELECT event_type, count(*), {rnd("avg(value)", 2)}, 2 FROM events GROUP BY event_type""",
)
def append_snapshots(spark, sf_dir):
    events = assign_batches(read_table(spark, sf_dir, "events"), "event_id", 2, seed=None)
    return g.append_snapshots(
        *[
            segment_totals(events.where(F.col("batch_no") <= b), "event_type", "value")
            .withColumn("batch", F.lit(b))
            for b in (1, 2)
        ]
    )


@query("h1_round", f"SELECT c_custkey, {rnd('c_acctbal', 1)} AS balance FROM customer")
def rounded(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer")
    return customer.select("c_custkey", F.round("c_acctbal", 1).alias("balance"))


@query(
    "h2_arithmetic",
    f"""SELECT o_orderpriority, {rnd(f"100.0 * sum({DONE}) / count(*)", 2)} AS rate,
               {rnd(f"100 - 100.0 * sum({DONE}) / count(*)", 2)} AS complement
        FROM orders GROUP BY 1""",
)
def arithmetic(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    rate = 100 * F.sum(flag(_done())) / F.count(F.lit(1))
    return orders.groupBy("o_orderpriority").agg(
        percent_of_rows(_done()).alias("rate"), F.round(100 - rate, 2).alias("complement")
    )


@query(
    "h3_guarded_ratio",
    f"""
WITH u AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS r,
                  count(*) FILTER (WHERE l_returnflag = 'A') AS a FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN r + a > 0 THEN {rnd("cast(r as double) / (r + a)", 6)}
                   ELSE 0 END AS return_share FROM u""",
)
def guarded_ratio(spark, sf_dir):
    returned, accepted = (F.count_if(F.col("l_returnflag") == f) for f in ("R", "A"))
    return read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.round(ratio(returned, returned + accepted), 6).alias("return_share")
    )


@query(
    "h4_upper_labels",
    """SELECT upper(event_type) AS label, count(*) AS "count" FROM events GROUP BY event_type""",
)
def upper_labels(spark, sf_dir):
    counts = g.frequency(read_table(spark, sf_dir, "events"), "event_type")
    return counts.select(F.upper("event_type").alias("label"), "count")


@query(
    "h5_title_labels",
    """SELECT list_aggregate(list_transform(
                regexp_extract_all(o_orderpriority, '[A-Za-z]+|[^A-Za-z]+'),
                lambda s: upper(s[1]) || lower(s[2:])), 'string_agg', '') AS label,
              count(*) AS "count"
       FROM orders GROUP BY o_orderpriority""",
)
def title_labels(spark, sf_dir):
    counts = g.frequency(read_table(spark, sf_dir, "orders"), "o_orderpriority")
    return counts.select(title_case(F.col("o_orderpriority")).alias("label"), "count")


@query(
    "h6_integer_cast",
    "SELECT l_returnflag, cast(sum(l_quantity) AS bigint) AS quantity FROM lineitem GROUP BY 1",
)
def integer_cast(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.sum("l_quantity").cast("bigint").alias("quantity")
    )


def _auc_sql(name: str, score: str) -> str:
    return f"""
{name} AS (
  SELECT sum((cum - p / 2.0) * n) / (sum(p) * sum(n)) AS auc FROM (
    SELECT p, n, sum(p) OVER (ORDER BY s DESC) AS cum FROM (
      SELECT {score} AS s, count(*) FILTER (WHERE quality = 1) AS p,
             count(*) FILTER (WHERE quality <> 1) AS n
      FROM labels JOIN documents USING (doc_id) GROUP BY 1)))"""


@query(
    "h8_choose_better",
    f"""
WITH {_auc_sql("by_length", "n_chars")}, {_auc_sql("by_mark", "toxic")}
SELECT CASE WHEN a.auc > b.auc THEN 'length' ELSE 'mark' END AS better,
       {rnd("cast(greatest(a.auc, b.auc) as double)", 6)} AS auc
FROM by_length a, by_mark b""",
)
def choose_better(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels")
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    scored = labels.join(documents, "doc_id")
    metrics = g.append_snapshots(
        exact_auc(scored, "quality", "n_chars").withColumn("model", F.lit("length")),
        exact_auc(scored, "quality", "toxic").withColumn("model", F.lit("mark")),
    )
    of = {m: F.max(F.when(F.col("model") == m, F.col("auc"))) for m in ("length", "mark")}
    return metrics.agg(
        F.when(of["length"] > of["mark"], "length").otherwise("mark").alias("better"),
        F.round(F.max("auc"), 6).alias("auc"),
    )
