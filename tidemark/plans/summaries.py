"""Partition sweep and the composite reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.models import compare_models, feature_importances
from tidemark.operators.partitioning import (
    SWEEP_COUNTS,
    fastest_setting,
    partition_sizes,
    spread_evenly,
    sweep_results,
    sweep_timings,
)
from tidemark.plans.learning import contact_split, fit_contacts, stored_contacts
from tidemark.plans.registry import query
from tidemark.plans.reports import (
    exploration_report,
    final_summary,
    modelling_report,
    streaming_report,
)
from tidemark.plans.sqltext import rnd, with_contacts
from tidemark.plans.streams import replayed
from tidemark.sources.contacts import contacts_from_orders
from tidemark.sources.files import read_table

# The sweep counts 1, 2, 4, 8, 16 as multiples of the session's parallelism, so
# that no setting puts a whole large table into one task.

def sweep_partitions(spark) -> dict[int, int]:
    return {f: f * spark.sparkContext.defaultParallelism for f in SWEEP_COUNTS}


@query("l1_partition_totals", 'SELECT count(*) AS "rows", true AS balanced FROM orders')
def partition_totals(spark, sf_dir):
    """Round-robin parts hold all rows and differ by at most one row per input task."""
    n = spark.sparkContext.defaultParallelism
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    sizes = partition_sizes(spread_evenly(orders, n))
    inputs = partition_sizes(orders).count()
    return sizes.agg(
        F.sum("rows").alias("rows"),
        (F.max("rows") - F.min("rows") <= inputs).alias("balanced"),
    )


@query(
    "l2_sweep_results",
    f"""
WITH a AS (
  SELECT l_returnflag, l_linestatus, {rnd("avg(l_quantity)", 4)} AS avg_l_quantity,
         {rnd("avg(l_extendedprice)", 4)} AS avg_l_extendedprice, count(*) AS "rows"
  FROM lineitem GROUP BY l_returnflag, l_linestatus
)
SELECT a.*, f AS factor FROM a, (VALUES (1), (2), (4), (8), (16)) AS v(f)""",
)
def sweep(spark, sf_dir):
    """The same aggregate at five partition counts, labelled by their factor."""
    measures = ["l_quantity", "l_extendedprice"]
    results = sweep_results(
        read_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], measures,
        sweep_partitions(spark),
    )
    results = results.withColumnRenamed("partitions", "factor")
    return results.withColumns({f"avg_{m}": F.round(f"avg_{m}", 4) for m in measures})


def _best_sql(insight: str, key: str, value: str) -> str:
    return f"""
UNION ALL SELECT * FROM (
  SELECT '{insight}', {key}, {value} FROM contacts GROUP BY {key} ORDER BY 3 DESC, 2 LIMIT 1)"""


RATE = rnd("100.0 * sum(CASE WHEN y = 'yes' THEN 1 ELSE 0 END) / count(*)", 2)


@query(
    "m1_exploration_report",
    with_contacts(
        f"""
SELECT 'overall_rate_pct' AS insight, 'yes' AS "key", {RATE} AS "value" FROM contacts
UNION ALL SELECT 'avg_duration', y, {rnd("avg(duration)", 1)} FROM contacts GROUP BY y"""
        + _best_sql("best_education_rate_pct", "education", RATE)
        + _best_sql("best_job_avg_balance", "job", rnd("avg(balance)", 2))
        + _best_sql("best_outcome_rate_pct", "poutcome", RATE)
    ),
)
def exploration(spark, sf_dir):
    return exploration_report(contacts_from_orders(spark, sf_dir))


def _modelling(contacts):
    train, test = contact_split(contacts)
    fitted = fit_contacts(train)
    return modelling_report(compare_models(fitted, test), feature_importances(fitted, train))


@query("m2_modelling_report")
def modelling(spark, sf_dir):
    return _modelling(stored_contacts(spark, sf_dir))


@query("l3_fastest_setting")
def fastest(spark, sf_dir):
    timings = sweep_timings(
        read_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"],
        ["l_quantity", "l_extendedprice"], list(sweep_partitions(spark).values()), runs=1,
    )
    return fastest_setting(timings)


@query("m4_final_summary")
def summary(spark, sf_dir):
    contacts = stored_contacts(spark, sf_dir)
    columns = contacts.drop("contact_id")
    timings = sweep_timings(
        columns, ["job", "education"], ["balance", "duration"],
        list(sweep_partitions(spark).values()), runs=1,
    )
    return final_summary(
        columns,
        exploration_report(columns),
        _modelling(contacts),
        streaming_report(replayed(spark, sf_dir), "event_type", "avg_value"),
        timings,
    )
