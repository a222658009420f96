"""Totals by a route of their own, to hold the star against.

One SQL statement over the raw tables and the raw quotes. It shares no function with the star: not the
line shape, the amounts, the calendar of rates, the labels or the sums. A fault on one side therefore
can't agree with itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom import fixtures
from ledgerloom.fixtures import Tables

LINES = """
WITH lines AS (
  SELECT CAST(o_orderdate AS DATE) AS day, coalesce(o_orderstatus, '') = 'P' AS cancelled,
         c_nationkey % 4 AS money,
         CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * (1BD - CAST(l_discount AS DECIMAL(5,4)))
              AS DECIMAL(19,4)) AS amount
  FROM {lineitem} LEFT JOIN {orders} ON o_orderkey = l_orderkey
  LEFT JOIN {customer} ON c_custkey = o_custkey
  UNION ALL
  SELECT CAST(ts AS DATE), pmod(event_id, 20) = 0, c_nationkey % 4, CAST(value AS DECIMAL(19,4))
  FROM {events} LEFT JOIN {customer} ON c_custkey = user_id
  WHERE event_type = 'purchase'
), spans AS (
  SELECT currency, rate, day, lead(day) OVER (PARTITION BY currency ORDER BY day) AS until FROM {quotes}
), held AS (
  SELECT currency, rate, explode(sequence(day, coalesce(until - 1, day))) AS day FROM spans
), ended AS (
  SELECT currency, max(day) AS day FROM {quotes} GROUP BY currency
), priced AS (
  -- The last quote of a currency holds for every later day.
  SELECT l.day, l.cancelled, round(l.amount * h.rate, 4) AS usd
  FROM lines l LEFT JOIN ended e ON e.currency = concat('CUR', l.money)
  LEFT JOIN held h ON h.currency = e.currency AND h.day = CASE WHEN l.day > e.day THEN e.day ELSE l.day END
)
"""
SUMS = """
  CAST(coalesce(sum(usd) FILTER (WHERE NOT cancelled), 0) AS DECIMAL(38,4)) AS revenue_usd,
  CAST(coalesce(sum(usd) FILTER (WHERE cancelled), 0) AS DECIMAL(38,4)) AS cancelled_usd
"""


def _run(t: Tables, rest: str) -> DataFrame:
    return t.spark.sql(
        LINES + rest, lineitem=t.lineitem, orders=t.orders, customer=t.customer, events=t.events,
        quotes=fixtures.fx_quotes(t),
    )


def quarters(t: Tables) -> DataFrame:
    """Sold and cancelled revenue per fiscal quarter: a year ends with March."""
    label = "concat('FY', year(add_months(day, 9)), '-Q', quarter(add_months(day, -3)))"
    return _run(t, f"SELECT {label} AS fiscal_quarter, {SUMS} FROM priced GROUP BY 1")


def totals(t: Tables) -> DataFrame:
    """Sold and cancelled revenue and the number of lines, in one row."""
    return _run(t, f"SELECT {SUMS}, count(*) AS sale_lines FROM priced")
