"""Sources, sinks, projections and filters."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from tidemark.functions.expressions import flag
from tidemark.operators.grouping import append_snapshots, average_for_value
from tidemark.operators.quantiles import trim_to_percentiles
from tidemark.plans.registry import query
from tidemark.plans.sqltext import rnd, with_contacts
from tidemark.sources.catalog import drop_view, list_tables, preview, register_view, save_table, table_shape
from tidemark.sources.contacts import contacts_from_orders
from tidemark.sources.files import inline_table, input_path, read_csv, read_table, write_csv
from tidemark.sources.schemas import CONTACT_SCHEMA
from tidemark.sources.stream import read_parquet_stream
from tidemark.streaming.live import drain_rows
from tidemark.session import scratch_path

CONTACT_COLUMNS = ", ".join(f'"{c}"' for c in CONTACT_SCHEMA.names)


@query("a1_csv_scan", with_contacts(f"SELECT {CONTACT_COLUMNS} FROM contacts"))
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "contacts-csv")
    write_csv(contacts_from_orders(spark, sf_dir), path)
    return read_csv(spark, path, CONTACT_SCHEMA, mode="FAILFAST")


@query("a2_path_by_variable", "SELECT r_regionkey, r_name FROM region")
def path_by_variable(spark, sf_dir):
    """The table's folder comes from a variable that is set, not from the default beside it."""
    folder = input_path("TIDEMARK_INPUT", "/no/such/folder", {"TIDEMARK_INPUT": sf_dir})
    return read_table(spark, folder, "region").select("r_regionkey", "r_name")


@query(
    "a5_catalog_list",
    "SELECT 'kept_suppliers' AS name, false AS temporary, count(*) AS n FROM supplier UNION ALL SELECT 'seen_suppliers', true, count(*) FROM supplier",
)
def catalog_list(spark, sf_dir):
    """A table and a view as the catalog lists them, each counted by the name it is listed with."""
    mark = uuid.uuid4().hex
    suppliers = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    save_table(suppliers, f"kept_suppliers_{mark}")
    register_view(suppliers, f"seen_suppliers_{mark}")
    listed = list_tables(spark).where(F.col("tableName").endswith(mark)).collect()
    counted = [
        spark.table(r["tableName"]).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(r["tableName"].removesuffix(f"_{mark}")).alias("name"), F.lit(r["isTemporary"]).alias("temporary"), "n"
        )
        for r in listed
    ]
    return append_snapshots(*counted)


@query(
    "a9_preview",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 7",
)
def first_rows(spark, sf_dir):
    """Seven rows of an ordered table: the order and the bound reach the scan's tasks as one step."""
    return preview(read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey"), 7)


@query(
    "a11_inline_table",
    """SELECT n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
WHERE n_regionkey = 1 GROUP BY n_name""",
)
def inline_rows(spark, sf_dir):
    """A few rows brought to the driver and made a table again, joined to a large one."""
    names = read_table(spark, sf_dir, "nation").where("n_regionkey = 1").select("n_nationkey", "n_name")
    held = inline_table(spark, [tuple(r) for r in preview(names, 100).collect()], "n_nationkey int, n_name string")
    customers = read_table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("c_custkey").alias("customers"))
    joined = held.join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return joined.select("n_name", F.coalesce("customers", F.lit(0)).alias("customers"))


@query("a3_stream_scan", "SELECT event_id, user_id, event_type, value FROM events")
def stream_scan(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    # a one-letter class makes the single path a glob, which a file stream needs
    stream = read_parquet_stream(spark, f"{sf_dir}/events.parque[t]", schema).select(
        "event_id", "user_id", "event_type", "value"
    )
    return drain_rows(stream, scratch_path(spark, "events-stream"))


@query("a4_managed_table", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def managed_table(spark, sf_dir):
    application = re.sub(r"\W", "_", spark.sparkContext.applicationId)
    orders = read_table(spark, sf_dir, "orders")
    return save_table(
        orders.select("o_orderkey", "o_orderpriority", "o_totalprice"),
        f"tidemark_orders_{application}",
    )


SEGMENT_SQL = """
SELECT c_mktsegment, {average} AS avg_balance, count(*) AS customers,
       cast(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS bigint) AS overdrawn
FROM {table} GROUP BY c_mktsegment"""


@query("a6_view_sql", SEGMENT_SQL.format(average=rnd("avg(c_acctbal)", 2), table="customer"))
def view_sql(spark, sf_dir):
    """SQL text over a temporary view, dropped again once the query is analysed."""
    register_view(read_table(spark, sf_dir, "customer"), "tidemark_customers")
    result = spark.sql(
        SEGMENT_SQL.format(average="round(avg(c_acctbal), 2)", table="tidemark_customers")
        + " ORDER BY avg_balance DESC, c_mktsegment"
    )
    drop_view(spark, "tidemark_customers")
    return result


@query("a10_table_shape", 'SELECT count(*) AS "rows", cast(11 AS bigint) AS "columns" FROM lineitem')
def lineitem_shape(spark, sf_dir):
    return table_shape(read_table(spark, sf_dir, "lineitem"))


@query("a8_csv_sink", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_sink(spark, sf_dir):
    customers = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    path = scratch_path(spark, "customer-csv")
    write_csv(customers, path)
    return read_csv(spark, path, customers.schema, mode="FAILFAST")


@query("b1_projection", "SELECT l_extendedprice, l_returnflag FROM lineitem")
def projection(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_returnflag")


@query(
    "b2_equality_filter",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def equality_filter(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@query(
    "b3_conditional_flag",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_done FROM orders",
)
def conditional_flag(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", flag(F.col("o_orderstatus") == "F").alias("is_done"))


@query(
    "b4_constant_range",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN -500 AND 5000",
)
def constant_range(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return customer.where(F.col("c_acctbal").between(-500, 5000))


def _trim_sql(table: str, columns: str, x: str, operators: tuple[str, str]) -> str:
    low, high = operators
    return f"""
SELECT {columns} FROM {table},
  (SELECT quantile_cont({x}, 0.01) AS p01, quantile_cont({x}, 0.99) AS p99 FROM {table}) AS q
WHERE {x} {low} p01 AND {x} {high} p99"""


@query(
    "b5_trim_open",
    _trim_sql("lineitem", "l_orderkey, l_linenumber, l_extendedprice", "l_extendedprice", (">", "<")),
)
def trim_open(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return trim_to_percentiles(lines, "l_extendedprice", closed=False)


@query("b6_trim_closed", _trim_sql("lineitem", "l_orderkey, l_quantity", "l_quantity", (">=", "<=")))
def trim_closed(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return trim_to_percentiles(lines, "l_quantity", closed=True)


@query(
    "b7_alias_literal",
    "SELECT c_custkey AS customer, c_acctbal AS balance, 1 AS batch FROM customer",
)
def alias_literal(spark, sf_dir):
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_acctbal").alias("balance"),
        F.lit(1).alias("batch"),
    )


@query(
    "b8_scalar_lookup",
    f"""SELECT {rnd("avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F')", 1)} AS "avg_F",
               {rnd("avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O')", 1)} AS "avg_O"
        FROM orders""",
)
def scalar_lookup(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return average_for_value(orders, "o_orderstatus", "o_totalprice", ["F", "O"])
