"""SQL building blocks of the oracles, written from the table definitions in FIXTURES.md."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def fold(text: str) -> str:
    return f"regexp_replace(upper(trim({text})), '[^A-Z0-9]', '', 'g')"


def fiscal_year(day: str) -> str:
    return f"'FY' || CAST(year({day}) + CASE WHEN month({day}) >= 4 THEN 1 ELSE 0 END AS VARCHAR)"


def fiscal_quarter(day: str) -> str:
    return (
        f"{fiscal_year(day)} || '-Q' || "
        f"CASE WHEN month({day}) BETWEEN 4 AND 6 THEN '1' WHEN month({day}) BETWEEN 7 AND 9 "
        f"THEN '2' WHEN month({day}) >= 10 THEN '3' ELSE '4' END"
    )


AMOUNT = (
    "CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * (CAST(1 AS DECIMAL(5,4)) - "
    "CAST(l_discount AS DECIMAL(5,4))) AS DECIMAL(19,4))"
)

FX_QUOTES = """fx_quotes AS (
  SELECT 'CUR' || CAST(c.idx AS VARCHAR) AS currency, CAST(d.day AS DATE) AS day,
         CASE WHEN c.idx = 0 THEN CAST(1 AS DECIMAL(18,8))
              ELSE CAST(CAST(1000 + c.idx * 250
                   + date_diff('day', DATE '1995-01-01', CAST(d.day AS DATE)) % 29 AS DECIMAL(9,0))
                   * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,8)) END AS rate
  FROM (SELECT DISTINCT n_nationkey % 4 AS idx FROM nation) c,
       (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS day) d
  WHERE isodow(d.day) < 6
)"""

PRODUCTS = """products AS (
  SELECT sku, CASE WHEN sku < 4 THEN 'D1' ELSE 'D2' END AS department,
         CASE WHEN sku < 4 THEN 'S1' ELSE 'S2' END AS product_segment
  FROM (SELECT CAST(unnest(range(8)) AS INTEGER) AS sku)
)"""

STORE_CUSTOMERS = """store_customers AS (
  SELECT c_custkey AS cust_id, c_name AS name,
         CASE WHEN c_custkey % 33 = 0 THEN NULL
              WHEN c_custkey % 3 = 0 THEN 'C' || c_custkey || '@example.com'
              WHEN c_custkey % 3 = 1 THEN '  c' || c_custkey || '@example.com '
              ELSE 'c' || c_custkey || '@example.com' END AS email,
         CASE c_custkey % 5 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name)
              WHEN 2 THEN ' ' || n_name || ' ' WHEN 3 THEN replace(n_name, '_', ' ')
              ELSE 'N' || n_nationkey END AS country_text,
         c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(19,4)) AS balance,
         'N' || c_nationkey AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

STORE_SALES = f"""store_sales AS (
  SELECT 'store' AS channel, l_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_partkey % 8 AS INTEGER) AS sku, CAST(l_quantity AS BIGINT) AS units,
         {AMOUNT} AS amount, coalesce(o_orderstatus = 'P', FALSE) AS is_cancelled, c_mktsegment AS segment,
         'N' || c_nationkey AS country, 'CUR' || (c_nationkey % 4) AS currency
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
)"""

WEB_LINES = f"""web_lines AS (
  SELECT event_id, ts, user_id, {K} AS k, CAST(value AS DECIMAL(19,4)) AS amount
  FROM events WHERE event_type = 'purchase'
)"""

WEB_SALES = """web_sales AS (
  SELECT 'web' AS channel, user_id AS order_key, CAST(ts AS DATE) AS order_date,
         CAST(CASE WHEN k >= 98 THEN k ELSE k % 8 END AS INTEGER) AS sku, CAST(1 AS BIGINT) AS units,
         amount, event_id % 20 = 0 AS is_cancelled, c_mktsegment AS segment,
         'N' || c_nationkey AS country, 'CUR' || (c_nationkey % 4) AS currency
  FROM web_lines LEFT JOIN customer ON user_id = c_custkey
)"""

ENRICHED = f"""sale_lines AS (
  SELECT * FROM store_sales UNION ALL SELECT * FROM web_sales
), rated AS (
  SELECT s.*, q.rate, q.day AS rate_day
  FROM sale_lines s ASOF LEFT JOIN fx_quotes q
    ON s.currency = q.currency AND s.order_date >= q.day
), enriched AS (
  SELECT r.channel, r.order_key, r.order_date, r.sku, r.units, r.amount, r.is_cancelled,
         coalesce(r.segment, 'UNKNOWN') AS customer_segment,
         coalesce(r.country, 'UNKNOWN') AS country, r.currency, r.rate, r.rate_day,
         CASE WHEN r.rate IS NULL THEN 'missing' WHEN r.rate_day = r.order_date THEN 'quoted'
              ELSE 'carried' END AS rate_status,
         CAST(round(r.amount * r.rate, 4) AS DECIMAL(19,4)) AS usd,
         {fiscal_year('r.order_date')} AS fiscal_year,
         {fiscal_quarter('r.order_date')} AS fiscal_quarter,
         coalesce(p.department, 'UNKNOWN') AS department,
         coalesce(p.product_segment, 'UNKNOWN') AS product_segment,
         p.sku IS NULL AS is_unknown_sku
  FROM rated r LEFT JOIN products p ON r.sku = p.sku
)"""


def total(expression: str, where: str | None = None) -> str:
    picked = f"sum({expression})" + (f" FILTER (WHERE {where})" if where else "")
    return f"CAST(coalesce({picked}, 0) AS DECIMAL(38,4))"


SUMMARY = f"""summary AS (
  SELECT fiscal_year, fiscal_quarter, department, product_segment, customer_segment, country,
         channel, count(*) AS sale_lines, CAST(sum(units) AS BIGINT) AS units,
         {total('usd', 'NOT is_cancelled')} AS revenue_usd,
         {total('usd', 'is_cancelled')} AS cancelled_usd,
         {total('usd', "NOT is_cancelled AND rate_status = 'carried'")} AS carried_rate_usd
  FROM enriched GROUP BY ALL
)"""

DAILY = f"""daily AS (
  SELECT order_date, country, count(DISTINCT (channel, order_key)) AS orders,
         CAST(sum(units) AS BIGINT) AS units, {total('usd', 'NOT is_cancelled')} AS revenue
  FROM enriched GROUP BY ALL
)"""

CHANGES = f"""changes AS (
  SELECT user_id AS key, event_id AS lsn, ts,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(19,4)) END AS value,
         CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
         CASE WHEN event_type <> 'error' THEN {K} END AS k
  FROM events WHERE NOT (event_id % 40 = 7 AND user_id % 4 = 3)
)"""

RUN_EVENTS = f"""raw_events AS (SELECT *, {K} AS k FROM events),
run_events AS (
  SELECT user_id % 10 AS run, event_id AS seq,
         CASE WHEN event_type = 'click' THEN 'activity' WHEN event_type = 'view' THEN 'lineage'
              WHEN event_type IN ('signup', 'error') THEN 'job' WHEN k < 5 THEN 'dropped'
              ELSE 'table' END AS kind,
         CASE WHEN event_type = 'signup' THEN CASE WHEN k % 2 = 0 THEN 'Started' ELSE 'Completed' END
              WHEN event_type = 'error' THEN CASE WHEN k % 3 = 0 THEN 'Cancelled' ELSE 'Failed' END
              WHEN event_type = 'click' THEN CASE WHEN k < 10 THEN 'Failed' ELSE 'Succeeded' END
         END AS status,
         CASE WHEN event_type IN ('signup', 'error') THEN 'Nightly' END AS job_type,
         CASE WHEN event_type = 'error' THEN 'r' || k END AS failure_reason,
         CASE WHEN event_type = 'click' THEN 'step' || (k % 4) END AS activity,
         CASE WHEN event_type = 'click' AND k BETWEEN 10 AND 14 THEN 'e' || k END AS error,
         CASE WHEN event_type = 'click' AND k >= 90 THEN k % 3 + 1 END AS retry,
         CASE WHEN event_type = 'view' THEN
           CASE k % 8 WHEN 0 THEN 'Copy' WHEN 1 THEN 'NotebookObserved' WHEN 2 THEN 'Warehouse'
                WHEN 3 THEN 'DirectLake' WHEN 4 THEN 'Notebook' WHEN 5 THEN 'Reported'
                WHEN 6 THEN 'Mystery' END END AS producer,
         CASE WHEN event_type = 'purchase' AND k < 5 THEN CAST(k + 1 AS BIGINT) END AS dropped
  FROM raw_events
)"""

FINDINGS = """judged AS (
  SELECT *,
    CASE WHEN kind = 'dropped' THEN 'DROPPED'
         WHEN kind = 'job' AND status IN ('Failed', 'Cancelled') THEN 'JOB'
         WHEN kind = 'activity' AND (error IS NOT NULL OR status = 'Failed') THEN 'ACTIVITY'
         WHEN kind = 'activity' AND retry > 0 THEN 'RETRY'
         WHEN kind = 'lineage' AND (producer IS NULL OR producer = 'Mystery') THEN 'LINEAGE'
    END AS tag
  FROM run_events
), classified AS (
  SELECT *,
    CASE tag WHEN 'DROPPED' THEN 'events lost: ' || dropped
             WHEN 'JOB' THEN job_type || ' -> ' || status || CASE WHEN failure_reason IS NULL THEN '' ELSE ' ' || failure_reason END
             WHEN 'ACTIVITY' THEN activity || ': ' || coalesce(error, status)
             WHEN 'RETRY' THEN activity || ': attempt ' || retry
             WHEN 'LINEAGE' THEN 'producer not known: ' || coalesce(producer, '')
    END AS why
  FROM judged
)"""

EDGES = """edges AS (
  SELECT 'customer:' || c_custkey AS src, 'nation:' || c_nationkey AS dst,
         'NotebookObserved' AS producer FROM customer
  UNION SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey, 'Reported' FROM supplier
  UNION SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey, 'Copy' FROM nation
  UNION SELECT 'region:' || r_regionkey, 'star:revenue', 'Warehouse' FROM region
)"""


def using(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


STAR = (FX_QUOTES, PRODUCTS, STORE_SALES, WEB_LINES, WEB_SALES, ENRICHED)
