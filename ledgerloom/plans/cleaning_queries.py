"""Queries on projections, filters, cleaning, change logs, windows and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import fixtures, schemas
from ledgerloom.fixtures import Tables
from ledgerloom.functions import fiscal, money, text
from ledgerloom.functions.encoding import digest, parse_json, row_json
from ledgerloom.operators import cdc, clean, fx, star
from ledgerloom.plans import common, sql
from ledgerloom.plans.landing_queries import to_model
from ledgerloom.plans.registry import query
from ledgerloom.sources import lines


@query(
    "prj_01_rename_project",
    sql.using(*sql.STAR, sql.DAILY) + """
SELECT strftime(order_date, '%Y-%m-%d') AS "OrderDate", country AS "Country", orders AS "Orders",
       units AS "Units", CAST(revenue AS DOUBLE) AS "Revenue" FROM daily""",
)
def rename_project(t: Tables) -> DataFrame:
    return to_model(common.daily(t))


@query(
    "prj_02_typed_edges",
    """
SELECT o_orderkey AS order_key, CAST(o_totalprice AS DECIMAL(19,4)) AS price,
       CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS VARCHAR) AS price_text,
       CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) AS price_export
FROM orders""",
)
def typed_edges(t: Tables) -> DataFrame:
    price = money.money(F.col("o_totalprice"))
    return t.orders.select(
        F.col("o_orderkey").alias("order_key"), price.alias("price"),
        text.exact_text(price).alias("price_text"), price.cast("double").alias("price_export"),
    )


JUDGED_SQL = """
SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_partkey AS part_key,
       CASE WHEN l_orderkey % 50 = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS quantity,
       CASE WHEN l_orderkey % 50 = 7 THEN 'quantity_text is not bigint' END AS bad_reason
FROM lineitem"""


@query("flt_01_malformed_quarantine", JUDGED_SQL)
def malformed_quarantine(t: Tables) -> DataFrame:
    judged = clean.quarantine(
        fixtures.store_order_events(t), {"quantity": ("quantity_text", "bigint")}
    )
    return judged.select("order_key", "line_no", "part_key", "quantity", "bad_reason")


@query(
    "flt_02_keep_flagged_rows",
    sql.using(*sql.STAR, sql.STORE_CUSTOMERS) + """
SELECT channel, is_cancelled, is_unknown_sku, count(*) AS n_lines,
       CAST(sum(amount) AS DECIMAL(38,4)) AS amount
FROM enriched GROUP BY ALL""",
)
def keep_flagged_rows(t: Tables) -> DataFrame:
    """Cancelled lines and unknown SKUs stay, marked; the counts add up to all lines."""
    lines_ = star.with_products(common.sale_lines(t), fixtures.product_rollup(t.spark))
    flagged = clean.flag(lines_, is_cancelled=F.col("is_cancelled"))
    return flagged.groupBy("channel", "is_cancelled", "is_unknown_sku").agg(
        F.count("*").alias("n_lines"), F.sum("amount").cast(money.TOTAL).alias("amount")
    )


@query(
    "flt_02_orphan_lines",
    f"""
SELECT o_orderkey IS NULL AS is_orphan_order, count(*) AS n_lines,
       CAST(sum({sql.AMOUNT}) AS DECIMAL(38,4)) AS amount
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 50 <> 3) o ON l_orderkey = o_orderkey
GROUP BY ALL""",
)
def orphan_lines(t: Tables) -> DataFrame:
    """Store lines against a delivery that misses some orders: they stay, marked."""
    orders = t.orders.filter("o_orderkey % 50 <> 3")
    return fixtures.store_sales(t, orders=orders).groupBy("is_orphan_order").agg(
        F.count("*").alias("n_lines"), F.sum("amount").cast(money.TOTAL).alias("amount")
    )


@query(
    "flt_02_missing_email_flag",
    sql.using(sql.STORE_CUSTOMERS)
    + "SELECT cust_id, email IS NULL AS has_no_email FROM store_customers",
)
def missing_email_flag(t: Tables) -> DataFrame:
    flagged = clean.flag(
        fixtures.store_customers(t), has_no_email=text.email_key(F.col("email")).isNull()
    )
    return flagged.select("cust_id", "has_no_email")


@query(
    "flt_04_membership",
    sql.using(sql.RUN_EVENTS) + """
SELECT run, seq, kind,
       kind = 'job' AND status NOT IN ('Started', 'NotStarted', 'InProgress', 'Completed')
         AS odd_status,
       kind = 'lineage' AND coalesce(producer, '') NOT IN
         ('Copy', 'NotebookObserved', 'Warehouse', 'DirectLake', 'Notebook', 'Reported')
         AS odd_producer
FROM run_events WHERE kind IN ('job', 'lineage')""",
)
def membership(t: Tables) -> DataFrame:
    known = schemas.PRODUCERS_OBSERVED + schemas.PRODUCERS_CLAIMED
    kind, producer = F.col("kind"), F.coalesce("producer", F.lit(""))
    odd_status = (kind == "job") & ~F.col("status").isin(schemas.JOB_STATUS_FINE)
    return fixtures.run_events(t).filter(kind.isin("job", "lineage")).select(
        "run", "seq", "kind", odd_status.alias("odd_status"),
        ((kind == "lineage") & ~producer.isin(known)).alias("odd_producer"),
    )


@query(
    "flt_05_prefix_filter",
    """
SELECT event_id AS seq, count(*) AS data_lines FROM events GROUP BY event_id""",
)
def prefix_filter(t: Tables) -> DataFrame:
    kept = lines.data_lines(fixtures.run_event_lines(t))
    return kept.groupBy("seq").agg(F.count("*").alias("data_lines"))


@query(
    "flt_06_boolean_portable",
    """
SELECT o_orderkey AS order_key, o_orderpriority AS priority FROM orders
WHERE o_orderstatus = 'P' AND CAST(o_totalprice > 100000 AS INTEGER) = 1""",
)
def boolean_portable(t: Tables) -> DataFrame:
    flagged = t.orders.select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderpriority").alias("priority"),
        (F.col("o_orderstatus") == "P").alias("is_partial"),
        (F.col("o_totalprice") > 100000).cast("int").alias("is_large"),
    )
    return flagged.filter(clean.is_truthy(["is_partial", "is_large"])).select(
        "order_key", "priority"
    )


# --- windows and change logs ------------------------------------------------------------------

LINE_COLUMNS = list(schemas.TABLES["lineitem"].names)


@query(
    "win_01_dedupe_redelivery",
    f"""
SELECT {', '.join(LINE_COLUMNS)},
       CAST(CASE WHEN l_orderkey % 34 = 0 THEN 2 ELSE 1 END AS INTEGER) AS delivery_no
FROM (SELECT DISTINCT * FROM lineitem)""",
)
def dedupe_redelivery(t: Tables) -> DataFrame:
    return clean.latest_delivery(fixtures.redelivered_lines(t), LINE_COLUMNS, "delivery_no")


@query(
    "win_01_latest_by_key",
    """
SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_partkey AS part_key,
       l_suppkey AS supp_key, shipped, quantity
FROM (SELECT *, CAST(l_shipdate AS DATE) AS shipped, CAST(l_quantity AS BIGINT) AS quantity,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey DESC, l_suppkey DESC,
                        CAST(l_quantity AS BIGINT) DESC) AS place FROM lineitem)
WHERE place = 1""",
)
def latest_by_key(t: Tables) -> DataFrame:
    """One row per order line number, latest version first; the ordering is total."""
    versions = t.lineitem.select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supp_key"),
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return clean.latest_delivery(
        versions, ["order_key", "line_no"], "shipped", ["part_key", "supp_key", "quantity"]
    )


LATEST_SQL = sql.using(sql.CHANGES) + """
SELECT key, lsn, ts, op, value, event_type, k
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY lsn DESC) AS place FROM changes)
WHERE place = 1 AND op <> 'd'"""


@query("win_02_cdc_latest", LATEST_SQL)
def cdc_latest(t: Tables) -> DataFrame:
    return cdc.current_state(cdc.unwrap(fixtures.change_envelopes(t)))


@query(
    "win_03_cdc_history",
    sql.using(sql.CHANGES) + """
SELECT key, lsn, op, value, event_type, k, ts AS valid_from, next_ts AS valid_to,
       next_ts IS NULL AS is_current
FROM (SELECT *, lead(ts) OVER (PARTITION BY key ORDER BY lsn) AS next_ts FROM changes)
WHERE op <> 'd'""",
)
def cdc_history(t: Tables) -> DataFrame:
    return cdc.history(cdc.unwrap(fixtures.change_envelopes(t)))


@query(
    "win_04_carry_forward",
    sql.using(sql.WEB_LINES) + """
, daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, max(amount) AS amount FROM web_lines GROUP BY ALL
), grid AS (
  SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM daily GROUP BY user_id
)
SELECT g.user_id, g.day, d.amount, CASE WHEN d.day = g.day THEN 'quoted' ELSE 'carried' END AS status
FROM grid g ASOF JOIN daily d ON g.user_id = d.user_id AND g.day >= d.day""",
)
def carry_forward(t: Tables) -> DataFrame:
    """Highest purchase per shopper and day; days without one take the last value."""
    spent = fixtures.web_purchases(t).select(
        "user_id", F.col("ts").cast("date").alias("day"), "amount"
    )
    return fx.carry_forward(spent, "user_id", "day", "amount")


@query("scl_15_cdc_unwrap", sql.using(sql.CHANGES) + "SELECT * FROM changes")
def cdc_unwrap(t: Tables) -> DataFrame:
    """Topic records, plain and wrapped, to flat rows; broken ones and tombstones stay apart."""
    return cdc.unwrap(cdc.read_envelopes(fixtures.change_records(t)))


# --- scalar functions ---------------------------------------------------------------------------


@query(
    "scl_01_fiscal_year",
    f"""
SELECT o_orderkey AS order_key, {sql.fiscal_year('o_orderdate')} AS by_end,
       'FY' || CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END
                    AS VARCHAR) AS by_start
FROM orders""",
)
def fiscal_year(t: Tables) -> DataFrame:
    day = F.col("day")
    return fixtures.order_days(t).select(
        "order_key", fiscal.fiscal_year(day).alias("by_end"),
        fiscal.fiscal_year(day, label_by="start").alias("by_start"),
    )


@query(
    "scl_02_fiscal_quarter",
    f"""
SELECT {sql.fiscal_quarter('o_orderdate')} AS fiscal_quarter, count(*) AS orders,
       min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day
FROM orders GROUP BY 1""",
)
def fiscal_quarter(t: Tables) -> DataFrame:
    return (
        fixtures.order_days(t)
        .groupBy(fiscal.fiscal_quarter(F.col("day")).alias("fiscal_quarter"))
        .agg(
            F.count("*").alias("orders"), F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
        )
    )


@query(
    "scl_03_utc_normalise",
    "SELECT event_id, ts AS instant, CAST(ts AS DATE) AS business_day FROM events",
)
def utc_normalise(t: Tables) -> DataFrame:
    """Offset text to the UTC instant; the business day is taken after the conversion."""
    written = t.events.select(
        "event_id", fixtures.offset_text(F.col("event_id"), F.col("ts")).alias("written")
    )
    instant = text.utc_instant(F.col("written"))
    return written.select(
        "event_id", instant.alias("instant"), instant.cast("date").alias("business_day")
    )


@query(
    "scl_04_date_text",
    "SELECT o_orderkey AS order_key, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def date_text(t: Tables) -> DataFrame:
    return fixtures.order_days(t).select("order_key", text.date_text(F.col("day")).alias("day"))


CONVERTED_SQL = "SELECT channel, order_key, order_date, sku, currency, amount, rate, usd FROM enriched"


@query("scl_05_fx_convert", sql.using(*sql.STAR) + CONVERTED_SQL)
def fx_convert(t: Tables) -> DataFrame:
    """Amounts of both channels in their own currency, the rate that held, and USD."""
    columns = ["channel", "order_key", "order_date", "sku", "currency", "amount", "rate", "usd"]
    return star.union_channels(*[lines.select(*columns) for lines in common.priced_channels(t)])


@query(
    "scl_06_email_key",
    sql.using(sql.STORE_CUSTOMERS)
    + "SELECT cust_id, nullif(lower(trim(email)), '') AS email_key FROM store_customers",
)
def email_key(t: Tables) -> DataFrame:
    return fixtures.store_customers(t).select(
        "cust_id", text.email_key(F.col("email")).alias("email_key")
    )


@query(
    "scl_07_country_key",
    sql.using(sql.STORE_CUSTOMERS)
    + f"SELECT cust_id, {sql.fold('country_text')} AS country_key FROM store_customers",
)
def country_key(t: Tables) -> DataFrame:
    return fixtures.store_customers(t).select(
        "cust_id", text.country_key(F.col("country_text")).alias("country_key")
    )


@query(
    "scl_08_exact_text",
    """
SELECT c_mktsegment AS segment,
       CAST(CAST(sum(CAST(c_acctbal AS DECIMAL(19,4))) AS DECIMAL(38,4)) AS VARCHAR) AS balance
FROM customer GROUP BY 1""",
)
def exact_text(t: Tables) -> DataFrame:
    balance = money.total(money.money(F.col("c_acctbal")))
    return t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        text.exact_text(balance).alias("balance")
    )


@query(
    "scl_09_default_if_missing",
    sql.using(sql.RUN_EVENTS) + """
SELECT run, seq, coalesce(nullif(status, ''), '?') AS status, coalesce(producer, '') AS producer,
       coalesce(dropped, 0) AS dropped FROM run_events""",
)
def default_if_missing(t: Tables) -> DataFrame:
    return fixtures.run_events(t).select(
        "run", "seq", text.default_if_missing(F.col("status"), "?").alias("status"),
        text.default_if_missing(F.col("producer"), "").alias("producer"),
        F.coalesce("dropped", F.lit(0)).alias("dropped"),
    )


@query(
    "scl_11_json_parse",
    f"""SELECT event_id, CASE WHEN event_id % 40 <> 7 THEN {sql.K} END AS k,
       event_id % 40 = 7 AS is_broken FROM events""",
)
def json_parse(t: Tables) -> DataFrame:
    """Tolerant parse; every fortieth text has lost its closing brace."""
    text_ = F.expr("CASE WHEN event_id % 40 = 7 THEN replace(props, '}', '') ELSE props END")
    parsed = t.events.select(
        "event_id", parse_json(text_, schemas.struct(k="int")).alias("p")
    )
    return parsed.selectExpr(
        "event_id", "CASE WHEN p._broken IS NULL THEN p.k END AS k", "p._broken IS NOT NULL AS is_broken"
    )


@query(
    "scl_12_json_write",
    """
SELECT o_orderkey AS order_key,
       '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"'
       || o_orderstatus || '"}' AS doc
FROM orders""",
)
def json_write(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_key"),
        row_json("o_orderkey", "o_custkey", "o_orderstatus").alias("doc"),
    )


@query(
    "scl_13_sha256",
    "SELECT p_partkey AS part_key, sha256(p_name || '|' || p_brand) AS sha256 FROM part",
)
def sha256(t: Tables) -> DataFrame:
    content = F.concat_ws("|", "p_name", "p_brand").cast("binary")
    return t.part.select(F.col("p_partkey").alias("part_key"), digest(content).alias("sha256"))
