"""SQL fragments shared by the equivalents of several queries."""

from __future__ import annotations


def rnd(expression: str, digits: int) -> str:
    """Decimal rounding, ties away from zero, as ``F.round`` does on doubles."""
    return f"cast(round(cast({expression} as decimal(38,{digits + 8})), {digits}) as double)"


def with_contacts(body: str) -> str:
    """Prefix a query with the ``contacts`` relation of ``contacts_from_orders``."""
    return f"""
WITH per_order AS (
  SELECT l_orderkey, sum(l_quantity) AS quantity, count(*) AS lines,
         bool_or(l_returnflag = 'R') AS returned,
         bool_or(l_discount >= 0.1) AS discounted,
         bool_or(l_linestatus = 'O') AS any_open
  FROM lineitem GROUP BY l_orderkey
), history AS (
  SELECT *, row_number() OVER earlier - 1 AS n_before,
         lag(o_orderdate) OVER earlier AS last_date,
         lag(o_orderstatus) OVER earlier AS last_status
  FROM orders
  WINDOW earlier AS (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST)
), joined AS (
  SELECT *
  FROM history
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN per_order ON o_orderkey = l_orderkey
), contacts AS (
  SELECT o_orderkey AS contact_id,
         cast(18 + c_custkey % 65 AS integer) AS age,
         c_mktsegment AS job, r_name AS marital, o_orderpriority AS education,
         CASE WHEN c_acctbal < 0 THEN 'yes' ELSE 'no' END AS "default",
         cast(floor(c_acctbal) AS integer) AS balance,
         CASE WHEN returned THEN 'yes' ELSE 'no' END AS housing,
         CASE WHEN discounted THEN 'yes' ELSE 'no' END AS loan,
         CASE WHEN any_open THEN 'cellular' WHEN NOT any_open THEN 'telephone'
              ELSE 'unknown' END AS contact,
         cast(day(o_orderdate) AS integer) AS "day",
         lower(strftime(o_orderdate, '%b')) AS "month",
         cast(coalesce(quantity, 0) AS integer) AS duration,
         cast(coalesce(lines, 0) AS integer) AS campaign,
         cast(CASE WHEN n_before = 0 THEN -1
              ELSE date_diff('day', last_date, o_orderdate) END AS integer) AS pdays,
         cast(n_before AS integer) AS previous,
         CASE WHEN n_before = 0 THEN 'unknown' WHEN last_status = 'F' THEN 'success'
              WHEN last_status = 'O' THEN 'failure' ELSE 'other' END AS poutcome,
         CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS y
  FROM joined
)
{body}"""


# Rows with a score for the evaluation queries: quality is the label, text
# length the score, absence of the toxic mark the prediction.
SCORED = """
scored AS (
  SELECT quality AS label, 1 - toxic AS prediction, cast(n_chars AS double) AS score
  FROM labels JOIN documents USING (doc_id)
)"""
