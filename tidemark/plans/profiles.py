"""Distribution profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import profile as p
from tidemark.operators.quantiles import quantiles, trim_to_percentiles
from tidemark.plans.registry import query
from tidemark.plans.sqltext import rnd, with_contacts
from tidemark.sources.contacts import contacts_from_orders
from tidemark.sources.files import read_table
from tidemark.sources.schemas import NUMERIC

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SUMMARY_MEASURES = ["age", "balance", "duration", "campaign", "pdays", "previous"]


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count("{c}") AS "count", {rnd(f'avg("{c}")', 4)} AS mean,
                   {rnd(f'stddev_samp("{c}")', 4)} AS stddev, cast(min("{c}") AS double) AS "min",
                   cast(max("{c}") AS double) AS "max" FROM {table}"""
        for c in columns
    )


def _corr_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS col_x, '{b}' AS col_y, {rnd(f'corr("{a}", "{b}")', 6)} AS corr
            FROM {table}"""
        for a in columns
        for b in columns
    )


@query("d9_summary_statistics", _describe_sql("lineitem", LINE_MEASURES))
def summary_statistics(spark, sf_dir):
    stats = p.summary_statistics(read_table(spark, sf_dir, "lineitem"), LINE_MEASURES)
    return _rounded(stats, 4, "mean", "stddev")


@query("d9_contact_summary", with_contacts(_describe_sql("contacts", SUMMARY_MEASURES)))
def contact_summary(spark, sf_dir):
    stats = p.summary_statistics(contacts_from_orders(spark, sf_dir), SUMMARY_MEASURES)
    return _rounded(stats, 4, "mean", "stddev")


@query("d12_correlation_matrix", _corr_sql("lineitem", LINE_MEASURES))
def correlation_matrix(spark, sf_dir):
    corr = p.correlation_matrix(read_table(spark, sf_dir, "lineitem"), LINE_MEASURES)
    return _rounded(corr, 6, "corr")


@query("d12_contact_correlation", with_contacts(_corr_sql("contacts", NUMERIC)))
def contact_correlation(spark, sf_dir):
    return _rounded(p.correlation_matrix(contacts_from_orders(spark, sf_dir), NUMERIC), 6, "corr")


@query(
    "d13_quantiles",
    " UNION ALL ".join(
        f"""SELECT {q}::double AS prob,
                   {rnd(f'quantile_cont(l_extendedprice, {q})', 4)} AS quantile FROM lineitem"""
        for q in (0.01, 0.5, 0.99)
    ),
)
def price_quantiles(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    return _rounded(quantiles(lines, "l_extendedprice", [0.01, 0.5, 0.99]), 4, "quantile")


@query(
    "d13_grouped_quantiles",
    " UNION ALL ".join(
        f"""SELECT event_type, {q}::double AS prob,
                   {rnd(f'quantile_cont(value, {q})', 4)} AS quantile FROM events GROUP BY 1"""
        for q in (0.25, 0.5, 0.75)
    ),
)
def grouped_quantiles(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return _rounded(quantiles(events, "value", [0.25, 0.5, 0.75], ["event_type"]), 4, "quantile")


def _histogram_sql(source: str, x: str, bins: int) -> str:
    """``source`` is a chain of CTEs that ends in one named ``data``."""
    return f"""
WITH {source}, r AS (
  SELECT cast(min({x}) AS double) AS lo, cast(max({x}) AS double) AS hi FROM data
), filled AS (
  SELECT least(cast(floor(({x} - lo) / (hi - lo) * {bins}) AS bigint), {bins - 1}) AS bin,
         count(*) AS n FROM data, r GROUP BY 1
)
SELECT b.bin, {rnd(f"lo + b.bin * ((hi - lo) / {bins})", 6)} AS bin_low,
       {rnd(f"lo + (b.bin + 1) * ((hi - lo) / {bins})", 6)} AS bin_high,
       coalesce(n, 0) AS "count"
FROM (SELECT range AS bin FROM range({bins})) b CROSS JOIN r LEFT JOIN filled USING (bin)"""


@query(
    "d14_histogram",
    _histogram_sql("data AS (SELECT 18 + c_custkey % 65 AS age FROM customer)", "age", 30),
)
def age_histogram(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer")
    ages = customer.select((18 + F.col("c_custkey") % 65).alias("age"))
    return _rounded(p.histogram(ages, "age", 30), 6, "bin_low", "bin_high")


@query(
    "d14_histogram_trimmed",
    _histogram_sql(
        """q AS (SELECT quantile_cont(o_totalprice, 0.01) AS a,
                        quantile_cont(o_totalprice, 0.99) AS b FROM orders),
           data AS (SELECT o_totalprice FROM orders, q WHERE o_totalprice > a AND o_totalprice < b)""",
        "o_totalprice", 40,
    ),
)
def trimmed_histogram(spark, sf_dir):
    prices = read_table(spark, sf_dir, "orders").select("o_totalprice")
    trimmed = trim_to_percentiles(prices, "o_totalprice", closed=False)
    return _rounded(p.histogram(trimmed, "o_totalprice", 40), 6, "bin_low", "bin_high")


def _density_sql(table: str, x: str, by: str | None = None, points: int = 200) -> str:
    key, first = (f"{by}, ", f"{by}, ") if by else ("", "")
    match = f"WHERE w.{by} = s.{by}" if by else ""
    out = f"s.{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
WITH s AS (
  SELECT {first}count(*) AS n, pow(count(*), -0.2) * stddev_samp({x}) AS h,
         min({x}) AS lo, (max({x}) - min({x})) / {points - 1} AS step
  FROM {table} {group}
), w AS (SELECT {key}{x} AS v, count(*) AS c FROM {table} GROUP BY {key}v)
SELECT {out}g.point, {rnd("min(lo + g.point * step)", 6)} AS x,
       {rnd("sum(c * exp(-0.5 * pow((lo + g.point * step - v) / h, 2))) / min(n * h * sqrt(2 * pi()))", 8)}
         AS density
FROM w, s, (SELECT range AS point FROM range({points})) g {match}
GROUP BY {out}g.point"""


@query("d15_density", _density_sql("customer", "c_acctbal"))
def balance_density(spark, sf_dir):
    curve = p.density(read_table(spark, sf_dir, "customer"), "c_acctbal")
    return curve.select(
        "point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density")
    )


@query("d15_density_by_class", _density_sql("lineitem", "l_quantity", "l_returnflag"))
def quantity_density(spark, sf_dir):
    curve = p.density(read_table(spark, sf_dir, "lineitem"), "l_quantity", ["l_returnflag"])
    return curve.select(
        "l_returnflag", "point", F.round("x", 6).alias("x"),
        F.round("density", 8).alias("density"),
    )


def _box_sql(source: str, x: str, by: str) -> str:
    return f"""
WITH {source}, q AS (
  SELECT {by}, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median,
         quantile_cont({x}, 0.75) AS q3 FROM data GROUP BY {by}
), f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT {by}, count(*) AS "count", {rnd("min(q1)", 4)} AS q1, {rnd("min(median)", 4)} AS median,
       {rnd("min(q3)", 4)} AS q3,
       {rnd(f"least(min({x}) FILTER (WHERE {x} >= lo), min(q1))", 4)} AS whisker_low,
       {rnd(f"greatest(max({x}) FILTER (WHERE {x} <= hi), min(q3))", 4)} AS whisker_high,
       count(*) FILTER (WHERE {x} < lo OR {x} > hi) AS outliers
FROM data JOIN f USING ({by}) GROUP BY {by}"""


BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "d16_box_statistics",
    _box_sql("data AS (SELECT event_type, value FROM events)", "value", "event_type"),
)
def box_statistics(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return _rounded(p.box_statistics(events, "value", ["event_type"]), 4, *BOX)


@query(
    "d16_box_statistics_trimmed",
    _box_sql(
        """p AS (SELECT quantile_cont(l_extendedprice, 0.01) AS a,
                        quantile_cont(l_extendedprice, 0.99) AS b FROM lineitem),
           data AS (SELECT l_returnflag, l_extendedprice FROM lineitem, p
                    WHERE l_extendedprice BETWEEN a AND b)""",
        "l_extendedprice", "l_returnflag",
    ),
)
def trimmed_box_statistics(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    trimmed = trim_to_percentiles(lines, "l_extendedprice")
    return _rounded(p.box_statistics(trimmed, "l_extendedprice", ["l_returnflag"]), 4, *BOX)


@query(
    "d22_binned_pairs",
    with_contacts("""
, data AS (SELECT age, balance, y FROM contacts WHERE balance BETWEEN -2000 AND 15000),
r AS (SELECT min(age) AS a0, max(age) AS a1, min(balance) AS b0, max(balance) AS b1 FROM data)
SELECT least(cast(floor((age - a0) / cast(a1 - a0 AS double) * 50) AS bigint), 49) AS x_bin,
       least(cast(floor((balance - b0) / cast(b1 - b0 AS double) * 50) AS bigint), 49) AS y_bin,
       y, count(*) AS "count"
FROM data, r GROUP BY 1, 2, 3"""),
)
def binned_pairs(spark, sf_dir):
    contacts = contacts_from_orders(spark, sf_dir).where(F.col("balance").between(-2000, 15000))
    return p.binned_pairs(contacts, "age", "balance", "y")
