"""A contact table (one row per order) derived from the order-entry tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import month_name
from tidemark.sources.files import read_table
from tidemark.sources.schemas import CONTACT_SCHEMA


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "yes").otherwise("no")


def with_history(orders: DataFrame) -> DataFrame:
    """``orders`` with ``n_before, last_date, last_status``: the customer's earlier orders, and the last of them.

    Order is by date, then key, nulls first. A window holds the orders of one
    customer and month; what it ends with, one row, goes into a second window
    over the customer's months, and its offsets are added to the orders.
    """
    inside = Window.partitionBy("o_custkey", "h_month").orderBy("o_orderdate", "o_orderkey")
    last = F.struct("o_orderdate", "o_orderstatus")
    own = orders.withColumn("h_month", F.trunc("o_orderdate", "month")).select(
        "*",
        F.row_number().over(inside).alias("h_place"),
        F.lag(last).over(inside).alias("h_own"),
        F.lead(F.lit(1)).over(inside).isNull().alias("h_ends"),
    )
    months = Window.partitionBy("o_custkey").orderBy("h_month")
    ends = own.where("h_ends").select(
        F.col("o_custkey").alias("m_custkey"),
        F.col("h_month").alias("m_month"),
        (F.sum("h_place").over(months) - F.col("h_place")).alias("m_before"),
        F.lag(last).over(months).alias("m_last"),
    )
    same = F.col("o_custkey").eqNullSafe(F.col("m_custkey")) & F.col("h_month").eqNullSafe(F.col("m_month"))
    before = F.coalesce("h_own", "m_last")
    return own.join(ends, same).select(
        *orders.columns,
        (F.col("m_before") + F.col("h_place") - 1).alias("n_before"),
        before["o_orderdate"].alias("last_date"),
        before["o_orderstatus"].alias("last_status"),
    )


def contacts_from_orders(spark: SparkSession, folder: str, keep_key: bool = False) -> DataFrame:
    """Orders seen as campaign contacts, in ``CONTACT_SCHEMA``.

    Facts of an order are a plain aggregate with map-side combine. A customer's
    history looks only backwards (``with_history``) and is never in one task as
    a whole. Where customers are too many to broadcast, the join to them is one
    that adaptive execution splits for a customer with very many orders; the
    last join is on keys that are unique on both sides. Nation and region are
    broadcast by Spark itself, from their file sizes.
    """
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, folder, "customer")
    places = (
        read_table(spark, folder, "nation")
        .join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    per_order = (
        read_table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.count(F.lit(1)).alias("lines"),
            F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
            F.max(F.when(F.col("l_discount") >= 0.1, 1).otherwise(0)).alias("discounted"),
            F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("any_open"),
        )
    )
    people = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = (
        with_history(orders)
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )

    is_first = F.col("n_before") == 0
    columns = {
        "age": 18 + F.col("c_custkey") % 65,
        "job": F.col("c_mktsegment"),
        "marital": F.col("r_name"),
        "education": F.col("o_orderpriority"),
        "default": _yes_no(F.col("c_acctbal") < 0),
        "balance": F.floor("c_acctbal"),
        "housing": _yes_no(F.coalesce("returned", F.lit(0)) == 1),
        "loan": _yes_no(F.coalesce("discounted", F.lit(0)) == 1),
        "contact": F.when(F.col("any_open") == 1, "cellular")
        .when(F.col("any_open") == 0, "telephone")
        .otherwise("unknown"),
        "day": F.dayofmonth("o_orderdate"),
        "month": month_name(F.col("o_orderdate")),
        "duration": F.coalesce("quantity", F.lit(0.0)),
        "campaign": F.coalesce("lines", F.lit(0)),
        "pdays": F.when(is_first, -1).otherwise(
            F.datediff(F.col("o_orderdate").cast("date"), F.col("last_date").cast("date"))
        ),
        "previous": F.col("n_before"),
        "poutcome": F.when(is_first, "unknown")
        .when(F.col("last_status") == "F", "success")
        .when(F.col("last_status") == "O", "failure")
        .otherwise("other"),
        "y": _yes_no(F.col("o_orderstatus") == "F"),
    }
    typed = [columns[f.name].cast(f.dataType).alias(f.name) for f in CONTACT_SCHEMA.fields]
    key = [F.col("o_orderkey").alias("contact_id")] if keep_key else []
    return joined.select(*key, *typed)
