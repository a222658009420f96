"""Queries on joins, aggregates, ordering and set operations over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import fixtures, schemas
from ledgerloom.fixtures import Tables
from ledgerloom.functions import fiscal
from ledgerloom.functions.money import total, total_text, total_where
from ledgerloom.operators import clean, compare, digests, fx, geography, identity, measures, metadata, star
from ledgerloom.plans import audit, common, sql
from ledgerloom.plans.registry import query

PEOPLE = f"""store_keys AS (
  SELECT nullif(lower(trim(email)), '') AS email_key, min(cust_id) AS store_id, count(*) AS store_rows
  FROM store_customers WHERE email IS NOT NULL GROUP BY 1
), web_keys AS (
  SELECT lower('C' || user_id || '@EXAMPLE.com') AS email_key, min(user_id) AS web_id,
         count(*) AS web_rows
  FROM (SELECT DISTINCT user_id FROM events) GROUP BY 1
), people AS (
  SELECT 'E:' || email_key AS person_id, email_key, store_id, web_id
  FROM store_keys FULL JOIN web_keys USING (email_key)
  UNION ALL
  SELECT 'S:' || cust_id, NULL, cust_id, NULL FROM store_customers WHERE email IS NULL
)"""


@query(
    "jn_01_identity_resolution",
    sql.using(sql.STORE_CUSTOMERS, PEOPLE) + """
SELECT person_id, email_key, store_id, web_id, store_id IS NOT NULL AS in_store,
       web_id IS NOT NULL AS in_web FROM people""",
)
def identity_resolution(t: Tables) -> DataFrame:
    return common.people(t).select(
        "person_id", "email_key", "store_id", "web_id", "in_store", "in_web"
    )


@query(
    "jn_01_duplicate_emails",
    """
SELECT 'web:' || user_id % 97 AS email_key, count(*) AS web_rows
FROM (SELECT DISTINCT user_id FROM events) GROUP BY 1 HAVING count(*) > 1""",
)
def duplicate_emails(t: Tables) -> DataFrame:
    """Accounts that share an email are folded to one and reported, not multiplied."""
    shared = F.concat(F.lit(" WEB:"), (F.col("user_id") % 97).cast("string"))
    web = fixtures.web_accounts(t).withColumn("email", shared)
    people = identity.resolve(fixtures.store_customers(t), web, "cust_id", "user_id")
    return identity.duplicate_emails(people).select("email_key", "web_rows")


@query(
    "jn_02_product_rollup",
    sql.using(*sql.STAR) + """
SELECT channel, sku, department, product_segment, is_unknown_sku, count(*) AS n_lines
FROM enriched GROUP BY ALL""",
)
def product_rollup(t: Tables) -> DataFrame:
    rolled = star.with_products(common.sale_lines(t), fixtures.product_rollup(t.spark))
    return rolled.groupBy(
        "channel", "sku", "department", "product_segment", "is_unknown_sku"
    ).agg(F.count("*").alias("n_lines"))


@query(
    "jn_03_fx_asof",
    sql.using(*sql.STAR) + """
SELECT channel, order_key, order_date, sku, currency, amount, rate, rate_day, rate_status, usd
FROM enriched""",
)
def fx_asof(t: Tables) -> DataFrame:
    return priced_lines(t).select(
        "channel", "order_key", "order_date", "sku", "currency", "amount", "rate", "rate_day",
        "rate_status", "usd",
    )


@query(
    "jn_04_asof_large",
    sql.using(sql.WEB_LINES) + """
, quotes AS (
  SELECT user_id, ts AS at, arg_max(amount, event_id) AS amount FROM web_lines GROUP BY ALL
), probes AS (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'purchase')
SELECT p.event_id, p.user_id, p.ts, q.amount AS asof_amount, q.at AS asof_at
FROM probes p ASOF LEFT JOIN quotes q ON p.user_id = q.user_id AND p.ts >= q.at""",
)
def asof_large(t: Tables) -> DataFrame:
    """Each other event of a shopper with the last purchase before it."""
    quotes = fixtures.web_purchases(t).select("user_id", "ts", "amount", "event_id")
    probes = t.events.filter(F.col("event_type") != "purchase").select("event_id", "user_id", "ts")
    return fx.asof_join(probes, quotes, "user_id", "ts", "ts", "amount", "event_id")


@query(
    "jn_05_fiscal_date_join",
    sql.using(*sql.STAR) + """
SELECT channel, order_date, fiscal_year, fiscal_quarter, count(*) AS n_lines
FROM enriched GROUP BY ALL""",
)
def fiscal_date_join(t: Tables) -> DataFrame:
    labelled = star.with_fiscal(common.sale_lines(t))
    return labelled.groupBy("channel", "order_date", "fiscal_year", "fiscal_quarter").agg(
        F.count("*").alias("n_lines")
    )


@query(
    "jn_06_conformed_country",
    sql.using(sql.STORE_CUSTOMERS)
    + "SELECT cust_id, country_text, country FROM store_customers",
)
def conformed_country(t: Tables) -> DataFrame:
    return geography.conform_country(
        fixtures.store_customers(t), fixtures.country_aliases(t), "country_text"
    ).select("cust_id", "country_text", "country")


@query(
    "jn_07_anti_orphans",
    sql.using(sql.STORE_CUSTOMERS) + """
SELECT cust_id, country_text FROM store_customers
WHERE country_text NOT IN (SELECT n_name FROM nation)""",
)
def anti_orphans(t: Tables) -> DataFrame:
    """Raw spellings that have no dimension row as they stand."""
    raw = fixtures.store_customers(t).select("cust_id", "country_text")
    named = t.nation.select(F.col("n_name").alias("country_text"))
    return geography.orphans(raw, named, "country_text")


QUARTERS = f"""quarters AS (
  SELECT fiscal_quarter, {sql.total('usd', 'NOT is_cancelled')} AS revenue_usd,
         {sql.total('usd', 'is_cancelled')} AS cancelled_usd
  FROM enriched GROUP BY ALL
)"""


def priced_lines(t: Tables) -> DataFrame:
    """Lines with their USD amount and nothing of the star's dimensions."""
    return star.price(common.sale_lines(t), common.rates(t))


@query(
    "jn_08_reconcile_join",
    sql.using(*sql.STAR, QUARTERS) + """
SELECT fiscal_quarter, revenue_usd AS revenue_usd_a, cancelled_usd AS cancelled_usd_a,
       revenue_usd AS revenue_usd_b, cancelled_usd AS cancelled_usd_b, TRUE AS agrees
FROM quarters""",
)
def reconcile_join(t: Tables) -> DataFrame:
    """Quarter totals by way of the summary against those of the audit over the raw tables."""
    by_summary = measures.slice_by(
        common.summary(t), ["fiscal_quarter"], ["revenue_usd", "cancelled_usd"]
    )
    return compare.reconcile(
        by_summary, audit.quarters(t), "fiscal_quarter", ["revenue_usd", "cancelled_usd"]
    )


TOTALS = f"""totals AS (
  SELECT {sql.total('usd', 'NOT is_cancelled')} AS revenue_usd,
         {sql.total('usd', 'is_cancelled')} AS cancelled_usd, count(*) AS sale_lines
  FROM enriched
)"""


@query(
    "jn_09_snapshot_compare",
    sql.using(*sql.STAR, TOTALS) + """
SELECT metric, value AS value_a, value AS value_b, TRUE AS agrees FROM (
  SELECT 'revenue_usd' AS metric, CAST(revenue_usd AS VARCHAR) AS value FROM totals
  UNION ALL SELECT 'cancelled_usd', CAST(cancelled_usd AS VARCHAR) FROM totals
  UNION ALL SELECT 'sale_lines', CAST(sale_lines AS VARCHAR) FROM totals
  UNION ALL SELECT 'refused', 'false' FROM totals
  UNION ALL SELECT 'contracts', '""" + ",".join(sorted(schemas.PUBLISHED_CONTRACTS)) + """' FROM totals)""",
)
def snapshot_compare(t: Tables) -> DataFrame:
    """Totals of the summary against the audit's, and the contract names of both, by metric."""
    contracts = F.lit(",".join(sorted(schemas.PUBLISHED_CONTRACTS))).alias("contracts")
    summary = compare.refuse_all_zero(measures.grand_totals(common.summary(t)))
    raw = compare.refuse_all_zero(audit.totals(t))
    return compare.compare_snapshots(summary.select("*", contracts), raw.select("*", contracts))


def _drift_sql() -> str:
    parts = [
        f"SELECT '{name}' AS table_name, unnest({schema.names}) AS column_name, "
        f"unnest({[f.dataType.simpleString() for f in schema]}) AS declared_type, "
        f"(SELECT count(*) FROM {name}) AS n_rows"
        for name, schema in schemas.TABLES.items()
    ]
    body = "\nUNION ALL ".join(parts)
    return (
        "SELECT table_name, column_name, declared_type, "
        "CASE WHEN column_name = 'o_orderpriority' THEN NULL ELSE declared_type END AS observed_type, "
        "CASE WHEN column_name = 'o_orderpriority' THEN 'missing' ELSE 'same' END AS status, n_rows "
        f"FROM ({body})\nUNION ALL SELECT 'orders', 'o_rank', NULL, 'string', 'added', "
        "(SELECT count(*) FROM orders)"
    )


@query("jn_10_schema_drift_join", _drift_sql())
def schema_drift_join(t: Tables) -> DataFrame:
    """Declared schemas against the schemas in the files, one column of which was renamed."""
    declared = {n: t.spark.createDataFrame([], s) for n, s in schemas.TABLES.items()}
    observed = {n: t.spark.read.parquet(f"{t.folder}/{n}.parquet") for n in schemas.TABLES}
    observed["orders"] = observed["orders"].withColumnRenamed("o_orderpriority", "o_rank")
    drift = metadata.drift(
        metadata.catalogue(t.spark, declared), metadata.catalogue(t.spark, observed)
    )
    return drift.join(metadata.row_counts(observed), "table_name")


@query(
    "jn_11_star_slice",
    sql.using(*sql.STAR, sql.DAILY) + """
SELECT country, coalesce(n_name, 'UNKNOWN') AS country_name,
       CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(revenue) AS DECIMAL(38,4)) AS revenue
FROM daily LEFT JOIN nation ON country = 'N' || n_nationkey GROUP BY ALL""",
)
def star_slice(t: Tables) -> DataFrame:
    return star.star_slice(common.daily(t), common.dim_country(t))


@query(
    "jn_12_build_dim_customer",
    sql.using(sql.STORE_CUSTOMERS, PEOPLE) + """
SELECT person_id AS customer_id, coalesce(name, 'UNKNOWN') AS name,
       coalesce(country, 'UNKNOWN') AS country
FROM people LEFT JOIN store_customers ON store_id = cust_id""",
)
def build_dim_customer(t: Tables) -> DataFrame:
    return common.dim_customer(t)


@query(
    "jn_13_build_dim_country",
    """
SELECT 'N' || n_nationkey AS country, n_name AS country_name, count(c_custkey) AS customers
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def build_dim_country(t: Tables) -> DataFrame:
    """The country dimension with the number of store customers that resolve to it."""
    known = fixtures.conformed_customers(t).groupBy("country").agg(
        F.count("*").alias("customers")
    )
    return common.dim_country(t).join(known, "country", "left").select(
        "country", "country_name", F.coalesce("customers", F.lit(0)).alias("customers")
    )


# --- aggregates -----------------------------------------------------------------------------------


@query(
    "agg_01_quarter_totals",
    sql.using(*sql.STAR, QUARTERS) + "SELECT * FROM quarters ORDER BY fiscal_quarter",
)
def quarter_totals(t: Tables) -> DataFrame:
    return measures.quarter_totals(common.summary(t))


FLAGSHIP_SQL = sql.using(*sql.STAR) + f"""
SELECT fiscal_quarter, {sql.total('usd', 'NOT is_cancelled')} AS revenue_usd,
       {sql.total('usd', 'is_cancelled')} AS cancelled_usd
FROM enriched WHERE channel = 'store' GROUP BY ALL ORDER BY fiscal_quarter"""


@query("agg_01_store_quarter_totals", FLAGSHIP_SQL)
def store_quarter_totals(t: Tables) -> DataFrame:
    """The flagship: store lines to USD revenue per fiscal quarter, through the summary."""
    return measures.quarter_totals(star.revenue_summary(common.enriched_store(t)))


@query("agg_02_grand_totals", sql.using(*sql.STAR, TOTALS) + "SELECT * FROM totals")
def grand_totals(t: Tables) -> DataFrame:
    return measures.grand_totals(common.summary(t))


@query("agg_03_daily_revenue", sql.using(*sql.STAR, sql.DAILY) + "SELECT * FROM daily")
def daily_revenue(t: Tables) -> DataFrame:
    return common.daily(t)


@query("agg_04_revenue_summary", sql.using(*sql.STAR, sql.SUMMARY) + "SELECT * FROM summary")
def revenue_summary(t: Tables) -> DataFrame:
    return common.summary(t)


@query(
    "agg_05_conditional_sums",
    sql.using(*sql.STAR) + f"""
SELECT channel, rate_status, {sql.total('usd', 'is_cancelled')} AS cancelled_usd,
       {sql.total('usd', 'NOT is_cancelled')} AS sold_usd,
       count(*) FILTER (WHERE is_unknown_sku) AS unknown_sku_lines
FROM enriched GROUP BY ALL""",
)
def conditional_sums(t: Tables) -> DataFrame:
    return common.enriched(t).groupBy("channel", "rate_status").agg(
        total_where(F.col("is_cancelled"), F.col("usd")).alias("cancelled_usd"),
        total_where(~F.col("is_cancelled"), F.col("usd")).alias("sold_usd"),
        F.count_if("is_unknown_sku").alias("unknown_sku_lines"),
    )


@query(
    "agg_06_reporting_pack",
    sql.using(*sql.STAR, sql.SUMMARY) + """
SELECT fiscal_year, product_segment, customer_segment,
       CAST(grouping(fiscal_year, product_segment, customer_segment) AS BIGINT) AS slice_id,
       CAST(sum(revenue_usd) AS DECIMAL(38,4)) AS revenue_usd
FROM summary
GROUP BY GROUPING SETS ((fiscal_year), (product_segment), (customer_segment), ())""",
)
def reporting_pack(t: Tables) -> DataFrame:
    return measures.reporting_pack(common.summary(t))


@query(
    "agg_10_row_count_gate",
    f"""
SELECT count(*) AS n_rows, count(*) > 0 AS readable
FROM (SELECT DISTINCT * FROM lineitem)""",
)
def row_count_gate(t: Tables) -> DataFrame:
    """Rows of the cleaned table, and whether it holds any."""
    names = list(schemas.TABLES["lineitem"].names)
    silver = clean.latest_delivery(fixtures.redelivered_lines(t), names, "delivery_no")
    return silver.agg(F.count("*").alias("n_rows")).withColumn("readable", F.col("n_rows") > 0)


@query(
    "agg_11_numeric_checksum",
    sql.using(*sql.STAR, sql.SUMMARY) + """
SELECT count(*) AS n_rows,
       CAST(sum(revenue_usd) + sum(cancelled_usd) + sum(carried_rate_usd) AS DECIMAL(38,4))
         AS decimal_total,
       CAST(0 AS DOUBLE) AS double_total
FROM summary""",
)
def numeric_checksum(t: Tables) -> DataFrame:
    return compare.checksum(common.summary(t))


@query(
    "agg_14_named_measures",
    sql.using(*sql.STAR, sql.SUMMARY) + """
SELECT customer_segment, channel, CAST(sum(sale_lines) AS BIGINT) AS sale_lines,
       CAST(sum(units) AS BIGINT) AS units,
       CAST(sum(revenue_usd) + sum(cancelled_usd) AS DECIMAL(38,4)) AS gross_usd,
       CAST(sum(revenue_usd) - sum(carried_rate_usd) AS DECIMAL(38,4)) AS quoted_rate_usd
FROM summary GROUP BY ALL""",
)
def named_measures(t: Tables) -> DataFrame:
    return measures.slice_by(
        common.summary(t), ["customer_segment", "channel"],
        ["sale_lines", "units", "gross_usd", "quoted_rate_usd"],
    )


# --- ordering and set operations ------------------------------------------------------------------


@query(
    "srt_01_order_by_key",
    sql.using(*sql.STAR, sql.DAILY) + "SELECT * FROM daily ORDER BY order_date, country",
)
def order_by_key(t: Tables) -> DataFrame:
    return common.daily(t).orderBy("order_date", "country")


@query(
    "set_01_union_channels",
    sql.using(*sql.STAR) + """
SELECT channel, country, count(*) AS n_lines, CAST(sum(units) AS BIGINT) AS units,
       CAST(sum(amount) AS DECIMAL(38,4)) AS amount
FROM enriched GROUP BY ALL""",
)
def union_channels(t: Tables) -> DataFrame:
    return common.sale_lines(t).groupBy("channel", "country").agg(
        F.count("*").alias("n_lines"), F.sum("units").alias("units"),
        total(F.col("amount")).alias("amount"),
    )


@query(
    "set_05_order_insensitive_equality",
    """
WITH delivered AS (
  SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 34 = 0
), cleaned AS (SELECT DISTINCT * FROM delivered), base AS (SELECT DISTINCT * FROM lineitem),
counted AS (
  SELECT (SELECT count(*) FROM (SELECT * FROM cleaned EXCEPT ALL SELECT * FROM base)) AS left_only,
         (SELECT count(*) FROM (SELECT * FROM base EXCEPT ALL SELECT * FROM cleaned)) AS right_only
)
SELECT left_only, right_only, left_only = 0 AND right_only = 0 AS equal FROM counted""",
)
def order_insensitive_equality(t: Tables) -> DataFrame:
    """Line items cleaned of redeliveries against the distinct line items."""
    names = list(schemas.TABLES["lineitem"].names)
    cleaned = clean.latest_delivery(fixtures.redelivered_lines(t), names, "delivery_no")
    return compare.same_rows(cleaned.drop("delivery_no"), t.lineitem.distinct())


@query(
    "set_05_differing_rows",
    """
SELECT CAST(o_orderdate AS DATE) AS day, side, status, count(*) AS copies FROM (
  SELECT o_orderdate, 'left' AS side, 'P' AS status FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderdate, 'right', 'F' FROM orders WHERE o_orderstatus = 'P')
GROUP BY ALL""",
)
def differing_rows(t: Tables) -> DataFrame:
    """Orders against a copy in which one status was rewritten."""
    left = t.orders.selectExpr("CAST(o_orderdate AS DATE) AS day", "o_orderstatus AS status")
    rewritten = F.when(F.col("status") == "P", "F").otherwise(F.col("status"))
    return compare.differing_rows(left, left.withColumn("status", rewritten))


@query(
    "set_05_differing_rows_by_digest",
    """
WITH wrong AS (SELECT * FROM lineitem WHERE l_orderkey % 500 = 7)
SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) + more AS BIGINT) AS quantity, side, count(*) AS copies
FROM wrong, (VALUES ('left', 0), ('right', 1)) v(side, more) GROUP BY ALL""",
)
def differing_rows_by_digest(t: Tables) -> DataFrame:
    """Line items against a copy in which some orders were changed: only ranges that differ are exchanged."""
    left = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"))
    changed = F.col("quantity") + F.when(F.col("l_orderkey") % 500 == 7, 1).otherwise(0)
    return digests.differing_rows_by_digest(left, left.withColumn("quantity", changed), ["l_orderkey"])


@query(
    "set_05_equal_by_digest",
    """
WITH base AS (SELECT DISTINCT * FROM lineitem)
SELECT count(*) AS left_rows, count(*) AS right_rows, TRUE AS equal FROM base""",
)
def equal_by_digest(t: Tables) -> DataFrame:
    """Line items cleaned of redeliveries against the distinct line items; no row of either is exchanged for it."""
    names = list(schemas.TABLES["lineitem"].names)
    cleaned = clean.latest_delivery(fixtures.redelivered_lines(t), names, "delivery_no")
    return digests.same_by_digest(cleaned.drop("delivery_no"), t.lineitem.distinct(), ["l_orderkey"])
