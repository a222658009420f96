"""Quality contracts. Each runs on what was built and on a frame made to violate it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerloom import fixtures, schemas
from ledgerloom.fixtures import Tables
from ledgerloom.functions import fiscal
from ledgerloom.functions.money import TOTAL
from ledgerloom.operators import contracts, measures, metadata, suites
from ledgerloom.operators.suites import Check, Suite
from ledgerloom.plans import audit, common, sql
from ledgerloom.plans.landing_queries import model_name, to_model
from ledgerloom.plans.registry import query
from ledgerloom.session import cut, new_folder
from ledgerloom.sources import landing, sinks

BUILT, BROKEN = "built", "broken"


def both(built: DataFrame, broken: DataFrame) -> DataFrame:
    """Violations of the built frame (none are expected) and of the broken one."""
    return built.withColumn("frame", F.lit(BUILT)).unionByName(
        broken.withColumn("frame", F.lit(BROKEN))
    )


@query(
    "dq_01_both_channels_present",
    sql.using(*sql.STAR, sql.SUMMARY) + """
SELECT 'channels_present' AS contract, channel AS detail, 'built' AS frame
FROM (SELECT unnest(['store', 'web']) AS channel)
WHERE channel NOT IN (SELECT channel FROM summary)
UNION ALL SELECT 'channels_present', 'web', 'broken'""",
)
def both_channels_present(t: Tables) -> DataFrame:
    summary = cut(common.summary(t))
    return both(
        contracts.channels_present(summary),
        contracts.channels_present(summary.filter(F.col("channel") != "web")),
    )


@query(
    "dq_02_country_resolves",
    sql.using(*sql.STAR, sql.STORE_CUSTOMERS) + """
SELECT DISTINCT 'country_resolves' AS contract, country AS detail, 'built' AS frame
FROM enriched WHERE country NOT IN (SELECT 'N' || n_nationkey FROM nation)
UNION ALL
SELECT 'country_resolves' AS contract, country_text AS detail, 'broken' AS frame
FROM (SELECT DISTINCT country_text FROM store_customers)
WHERE country_text NOT IN (SELECT 'N' || n_nationkey FROM nation)""",
)
def country_resolves(t: Tables) -> DataFrame:
    """The daily fact resolves; unconformed spellings do not."""
    countries = common.dim_country(t)
    return both(
        contracts.country_resolves(common.daily(t), countries),
        contracts.country_resolves(fixtures.store_customers(t), countries, "country_text"),
    )


@query(
    "dq_03_fiscal_not_calendar",
    """
SELECT 'fiscal_is_not_calendar' AS contract,
       strftime(o_orderdate, '%Y-%m-%d') || ' FY' || year(o_orderdate) AS detail,
       'broken' AS frame
FROM orders WHERE month(o_orderdate) >= 4 GROUP BY ALL""",
)
def fiscal_not_calendar(t: Tables) -> DataFrame:
    """Fiscal labels hold; calendar labels in their place violate from April on."""
    days = fixtures.order_days(t)
    day = F.col("day")
    return both(
        contracts.fiscal_is_not_calendar(
            days.withColumn("label", fiscal.fiscal_year(day)), "day", "label"
        ),
        contracts.fiscal_is_not_calendar(
            days.withColumn("label", fiscal.calendar_year_label(day)), "day", "label"
        ),
    )


@query(
    "dq_04_money_is_decimal",
    """
SELECT 'money_is_decimal' AS contract, 'lineitem.l_extendedprice' AS detail, 'broken' AS frame,
       count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'money_is_decimal', 'orders.o_totalprice', 'broken', count(*) FROM orders""",
)
def money_is_decimal(t: Tables) -> DataFrame:
    """The star stores money exactly; the raw tables do not, and say in how many rows."""
    money = ["revenue", "revenue_usd", "cancelled_usd", "carried_rate_usd",
             "l_extendedprice", "o_totalprice"]
    raw = {"lineitem": t.lineitem, "orders": t.orders}
    found = both(
        contracts.money_is_decimal(metadata.catalogue(t.spark, common.star_tables(t)), money),
        contracts.money_is_decimal(metadata.catalogue(t.spark, raw), money),
    )
    named = found.withColumn("table_name", F.substring_index("detail", ".", 1))
    return named.join(metadata.row_counts(raw), "table_name").drop("table_name")


CONSERVED = f"""kept AS (
  SELECT {sql.total('revenue_usd')} AS all_sold,
         {sql.total('revenue_usd', "channel = 'store'")} AS store_sold,
         {sql.total('cancelled_usd')} AS all_cancelled,
         {sql.total('cancelled_usd', "channel = 'store'")} AS store_cancelled,
         CAST(sum(sale_lines) AS DECIMAL(38,4)) AS all_lines,
         CAST(sum(sale_lines) FILTER (WHERE channel = 'store') AS DECIMAL(38,4)) AS store_lines
  FROM summary
)"""


@query(
    "dq_05_summary_conserves_revenue",
    sql.using(*sql.STAR, sql.SUMMARY, CONSERVED) + """
SELECT 'summary_conserves_revenue' AS contract,
       'revenue_usd ' || all_sold || ' ' || store_sold AS detail, 'broken' AS frame FROM kept
UNION ALL SELECT 'summary_conserves_revenue',
       'cancelled_usd ' || all_cancelled || ' ' || store_cancelled, 'broken' FROM kept
       WHERE all_cancelled <> store_cancelled
UNION ALL SELECT 'summary_conserves_revenue',
       'sale_lines ' || all_lines || ' ' || store_lines, 'broken' FROM kept""",
)
def summary_conserves_revenue(t: Tables) -> DataFrame:
    """The summary keeps what the raw tables hold; one that lost a channel does not."""
    raw = common.written(
        audit.totals(t).withColumn("sale_lines", F.col("sale_lines").cast(TOTAL)), "audit"
    )
    summary = common.written(common.summary(t), "summary")
    return both(
        contracts.summary_conserves_revenue(summary, raw),
        contracts.summary_conserves_revenue(summary.filter(F.col("channel") == "store"), raw),
    )


@query(
    "dq_06_non_empty_exports",
    """
SELECT 'not_empty' AS contract, 'Nothing' AS detail, 'broken' AS frame
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey < 0)""",
)
def non_empty_exports(t: Tables) -> DataFrame:
    tables = common.star_tables(t)
    nothing = {"Country": tables["Country"], "Nothing": t.orders.filter("o_orderkey < 0")}
    return both(contracts.not_empty(tables), contracts.not_empty(nothing))


@query(
    "dq_07_expected_counts",
    """
SELECT 'expected_counts' AS contract, 'orders ' || n || ' ' || (n + 1) AS detail,
       'broken' AS frame FROM (SELECT count(*) AS n FROM orders)""",
)
def expected_counts(t: Tables) -> DataFrame:
    """Counts of landed tables against the manifest that their producer wrote beside them.

    The producer counts what it sends, file by file, while it writes; the reader counts what it reads.
    """
    sent = {"orders": t.orders, "customer": t.customer}
    folder = new_folder(t.spark, "delivery")
    for name, frame in sent.items():
        sinks.write_with_manifest(frame, f"{folder}/{name}", name, f"{folder}/manifest")
    stated = t.spark.read.schema(sinks.MANIFEST).parquet(f"{folder}/manifest").select("table_name", "n_rows")
    read = metadata.row_counts({n: landing.read_master(t.spark, f"{folder}/{n}", f.schema) for n, f in sent.items()})
    one_more = stated.withColumn("n_rows", F.col("n_rows") + (F.col("table_name") == "orders").cast("bigint"))
    return both(
        contracts.expected_counts(read, stated), contracts.expected_counts(read, one_more)
    )


@query(
    "dq_08_generic_column_tests",
    """
SELECT 'not_null' AS contract, 'email: ' || count(*) AS detail FROM customer WHERE c_custkey % 33 = 0
UNION ALL
SELECT 'unique', l_orderkey || ' ' || l_linenumber || ' ' || count(*)
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'accepted_values', 'o_orderstatus P ' || count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT DISTINCT 'relationship', 'o_custkey ' || o_custkey FROM orders WHERE o_custkey % 10 = 0""",
)
def generic_column_tests(t: Tables) -> DataFrame:
    """The four generic tests, each on columns that do violate it."""
    some = t.customer.filter(F.col("c_custkey") % 10 != 0)
    found = [
        contracts.not_null(fixtures.store_customers(t), "email"),
        contracts.unique(t.lineitem, ["l_orderkey", "l_linenumber"]),
        contracts.accepted_values(t.orders, "o_orderstatus", ["F", "O"]),
        contracts.relationship(t.orders, "o_custkey", some, "c_custkey"),
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "dq_09_not_all_zero",
    sql.using(*sql.STAR, sql.SUMMARY) + """
SELECT 'not_all_zero' AS contract, 'every total is zero' AS detail, 'built' AS frame
FROM (SELECT sum(revenue_usd) AS r, sum(cancelled_usd) AS c, sum(sale_lines) AS n FROM summary)
WHERE coalesce(r, 0) = 0 AND coalesce(c, 0) = 0 AND coalesce(n, 0) = 0
UNION ALL SELECT 'not_all_zero', 'every total is zero', 'broken'
WHERE NOT EXISTS (SELECT 1 FROM summary WHERE units < 0)""",
)
def not_all_zero(t: Tables) -> DataFrame:
    summary = cut(common.summary(t))
    return both(
        contracts.not_all_zero(measures.grand_totals(summary)),
        contracts.not_all_zero(measures.grand_totals(summary.filter("units < 0"))),
    )


@query(
    "dq_10_contract_report",
    sql.using(*sql.STAR) + """
, found AS (
  SELECT 'unique' AS contract, count(*) AS n FROM (
    SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'not_null', count(*) FROM (SELECT 1 FROM customer WHERE c_custkey % 33 = 0 LIMIT 1)
  UNION ALL SELECT 'rate_is_known', count(*) FROM (
    SELECT DISTINCT currency FROM enriched WHERE rate_status = 'missing')
  UNION ALL SELECT 'no_orphan_lines', count(*) FROM (
    SELECT 1 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) LIMIT 1)
)
SELECT contract, CASE WHEN n > 0 THEN 'violated' ELSE 'holds' END AS status,
       coalesce(n, 0) AS violations
FROM (SELECT unnest([""" + ", ".join(f"'{c}'" for c in schemas.PUBLISHED_CONTRACTS) + """]) AS contract)
LEFT JOIN found USING (contract)""",
)
def contract_report(t: Tables) -> DataFrame:
    """Every published contract on one build, each table of it and of its sources read by one pass."""
    lines = common.written_lines(t)
    tables = common.star_tables(t, lines)
    known = tables["Country"].select(F.col("country").alias("_known"))
    unresolved = F.col("_known").isNull() & F.col("country").isNotNull() & (F.col("country") != schemas.UNKNOWN)

    def with_country(frame: DataFrame) -> DataFrame:
        return frame.join(known, F.col("country") == F.col("_known"), "left")

    measured = ["revenue_usd", "cancelled_usd", "sale_lines"]
    days = fixtures.order_days(t).withColumn("label", fiscal.fiscal_year(F.col("day")))
    built = [
        Suite("lines", lines, [
            Check("no_orphan_lines", F.col("is_orphan_order"), suites.ONCE),
            Check("rate_is_known", F.col("rate_status") == "missing", suites.VALUES, F.col("currency")),
        ]),
        Suite("Revenue", with_country(tables["Revenue"]), [
            Check("country_resolves", F.col("_known").isNull() & ~F.col("country").eqNullSafe(schemas.UNKNOWN),
                  suites.VALUES, F.col("country"))],
            key=["order_date", "country"], not_empty=True),
        Suite("Customer", with_country(tables["Customer"]), [
            suites.not_null("customer_id"), Check("relationship", unresolved, suites.VALUES, F.col("country"))],
            key=["customer_id"], not_empty=True),
        Suite("lineitem", t.lineitem, key=["l_orderkey", "l_linenumber"]),
        Suite("store_customers", fixtures.store_customers(t), [suites.not_null("email")]),
        Suite("order_days", days, [
            Check("fiscal_is_not_calendar", contracts.calendar_label_held("day", "label"), suites.VALUES, F.concat_ws(" ", "day", "label"))]),
    ]
    summary = Suite(
        "Reporting", tables["Reporting"], [suites.accepted_values("channel", schemas.CHANNELS)], not_empty=True,
        sums={**{m: F.col(m) for m in measured}, **{f"rows_{c}": (F.col("channel") == c).cast("bigint") for c in schemas.CHANNELS}})
    country = Suite("Country", tables["Country"], [suites.not_null("country")], key=["country"], not_empty=True)
    # Held as one row each, because several contracts read them.
    of_summary, of_country = cut(summary.evaluated()), cut(country.evaluated())
    totals = of_summary.select(*[F.coalesce(m, F.lit(0)).cast(TOTAL).alias(m) for m in measured])
    channels = of_summary.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("channel"), F.coalesce(f"rows_{c}", F.lit(0)).alias("n")) for c in schemas.CHANNELS])).alias("c")).select("c.*")
    raw = common.written(audit.totals(t).withColumn("sale_lines", F.col("sale_lines").cast(TOTAL)), "audit")
    stated = t.nation.agg(F.count("*").alias("n_rows")).select(F.lit("Country").alias("table_name"), "n_rows")
    rest = [
        contracts.channels_present(channels.where("n > 0")),
        contracts.money_is_decimal(
            metadata.catalogue(t.spark, tables), ["revenue", "revenue_usd", "cancelled_usd", "carried_rate_usd"]),
        contracts.summary_conserves_revenue(totals, raw),
        contracts.not_all_zero(totals),
        contracts.expected_counts(of_country.select(F.lit("Country").alias("table_name"), "n_rows"), stated),
    ]
    counted = [r.select("contract", F.lit(1).cast("bigint").alias("violations")) for r in rest]
    found = [s.violations() for s in built] + [summary.violations(of_summary), country.violations(of_country)]
    return suites.report(schemas.PUBLISHED_CONTRACTS, found + counted)


SUITES_SQL = """
SELECT 'unique' AS contract, 'lineitem' AS table_name, count(*) AS violations FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'few_units', 'lineitem', count(*) FROM lineitem WHERE l_quantity < 3
UNION ALL SELECT 'accepted_values', 'lineitem', count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
UNION ALL SELECT 'unique', 'orders', 0
UNION ALL SELECT 'not_empty', 'orders', 0
UNION ALL SELECT 'accepted_values', 'orders', count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'not_null', 'orders', 0
UNION ALL SELECT 'relationship', 'orders', count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 10 = 0
UNION ALL SELECT 'not_null', 'store_customers', CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM customer WHERE c_custkey % 33 = 0
UNION ALL SELECT 'not_empty', 'store_customers', 0"""


@query("dq_08_table_suites", SUITES_SQL)
def table_suites(t: Tables) -> DataFrame:
    """The generic tests of three tables, one pass over each."""
    some = t.customer.filter(F.col("c_custkey") % 10 != 0).select(F.col("c_custkey").alias("_known"))
    orders = t.orders.join(some, F.col("o_custkey") == F.col("_known"), "left")
    found = [
        Suite("lineitem", t.lineitem, [
            Check("few_units", F.col("l_quantity") < 3), suites.accepted_values("l_returnflag", ["A", "N"])],
            key=["l_orderkey", "l_linenumber"]),
        Suite("orders", orders, [
            suites.accepted_values("o_orderstatus", ["F", "O"]), suites.not_null("o_custkey"),
            Check("relationship", F.col("_known").isNull() & F.col("o_custkey").isNotNull(), suites.VALUES, F.col("o_custkey"))],
            key=["o_orderkey"], not_empty=True),
        Suite("store_customers", fixtures.store_customers(t), [suites.not_null("email")], not_empty=True),
    ]
    return reduce(DataFrame.unionByName, [s.violations() for s in found])


@query(
    "agg_13_sorted_names",
    """
SELECT array_to_string(list_sort(list(DISTINCT contract)), ',') AS contracts FROM (
  SELECT 'not_null' AS contract FROM customer WHERE c_custkey % 33 = 0
  UNION ALL SELECT 'accepted_values' FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'unique' FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
  UNION ALL SELECT 'relationship' FROM orders WHERE o_custkey % 10 = 0)""",
)
def sorted_names(t: Tables) -> DataFrame:
    """Names of the contracts that found something, sorted."""
    names = F.sort_array(F.collect_set("contract"))
    return generic_column_tests(t).agg(F.array_join(names, ",").alias("contracts"))


@query(
    "agg_12_group_to_list",
    sql.using(*sql.STAR, sql.SUMMARY, sql.DAILY) + """
SELECT 'Reporting' AS table_name, CAST(12 AS BIGINT) AS n_columns,
       (SELECT count(*) FROM summary) AS n_rows,
       'fiscal_year:string,fiscal_quarter:string,department:string,product_segment:string,'
       || 'customer_segment:string,country:string,channel:string,sale_lines:bigint,units:bigint,'
       || 'revenue_usd:decimal(38,4),cancelled_usd:decimal(38,4),carried_rate_usd:decimal(38,4)'
       AS columns
UNION ALL SELECT 'Revenue', 5, (SELECT count(*) FROM daily),
       'order_date:date,country:string,orders:bigint,units:bigint,revenue:decimal(38,4)'""",
)
def group_to_list(t: Tables) -> DataFrame:
    """Column list of the two facts beside their sizes."""
    facts = common.facts(common.written_lines(t))
    listed = metadata.columns_per_table(metadata.catalogue(t.spark, facts)).drop("schema_name")
    return listed.join(metadata.row_counts(facts), "table_name")


@query(
    "m_02_catalogue_covers_axes",
    sql.using(*sql.STAR, sql.SUMMARY)
    + "SELECT 'sales_person' AS column_name, count(*) AS n_rows FROM summary",
)
def catalogue_covers_axes(t: Tables) -> DataFrame:
    """Every axis is in the catalogue; one that was never built is reported."""
    built = {"Reporting": common.written(common.summary(t), "summary")}
    columns = metadata.catalogue(t.spark, built)
    wanted = [*schemas.SUMMARY_AXES, "sales_person"]
    missing = metadata.uncovered_axes(columns, "Reporting", wanted)
    sized = metadata.row_counts(built).withColumn("column_name", F.lit("sales_person"))
    return missing.join(sized, "column_name", "left").select("column_name", "n_rows")


@query(
    "m_03_exported_row_counts",
    sql.using(*sql.STAR, sql.SUMMARY, sql.DAILY) + """
SELECT 'Revenue' AS table_name, count(*) AS n_rows FROM daily
UNION ALL SELECT 'Reporting', count(*) FROM summary
UNION ALL SELECT 'Country', count(*) FROM nation
UNION ALL SELECT 'Customer', count(*) FROM (
  SELECT c_custkey FROM customer UNION
  SELECT user_id FROM events WHERE user_id % 33 <> 0
  UNION ALL SELECT DISTINCT user_id FROM events WHERE user_id % 33 = 0)""",
)
def exported_row_counts(t: Tables) -> DataFrame:
    return metadata.row_counts(common.star_tables(t))


STAR_SCHEMAS = {
    "Revenue": schemas.DAILY, "Customer": schemas.DIM_CUSTOMER, "Country": schemas.DIM_COUNTRY,
    "Reporting": schemas.SUMMARY,
}
STAR_SIZES = """sizes AS (
  SELECT 'Revenue' AS table_name, count(*) AS n_rows FROM daily
  UNION ALL SELECT 'Reporting', count(*) FROM summary
  UNION ALL SELECT 'Country', count(*) FROM nation
  UNION ALL SELECT 'Customer', count(*) FROM (
    SELECT c_custkey FROM customer UNION
    SELECT user_id FROM events WHERE user_id % 33 <> 0
    UNION ALL SELECT DISTINCT user_id FROM events WHERE user_id % 33 = 0)
)"""


def _star_columns_sql() -> str:
    listed = [
        f"SELECT '{name}' AS table_name, CAST(unnest(range(1, {len(schema) + 1})) AS INTEGER) "
        f"AS ordinal, unnest({schema.names}) AS column_name, "
        f"unnest({[f.dataType.simpleString() for f in schema]}) AS type"
        for name, schema in STAR_SCHEMAS.items()
    ]
    return "star_columns AS (" + "\n  UNION ALL ".join(listed) + ")"


STAR_CATALOGUE = sql.using(*sql.STAR, sql.SUMMARY, sql.DAILY, STAR_SIZES, _star_columns_sql())


@query(
    "m_01_column_catalogue",
    STAR_CATALOGUE + """
SELECT table_name, ordinal, column_name, type, n_rows
FROM star_columns JOIN sizes USING (table_name)""",
)
def column_catalogue(t: Tables) -> DataFrame:
    """Columns of the reporting model as built, with the size of each table."""
    tables = common.star_tables(t)
    return metadata.catalogue(t.spark, tables).drop("schema_name").join(
        metadata.row_counts(tables), "table_name"
    )


@query(
    "m_04_star_drift",
    STAR_CATALOGUE + """
SELECT table_name, column_name, type AS declared_type, type AS observed_type, 'same' AS status,
       n_rows
FROM star_columns JOIN sizes USING (table_name)""",
)
def star_drift(t: Tables) -> DataFrame:
    """Declared schemas of the reporting model against the tables as built."""
    tables = common.star_tables(t)
    declared = {n: t.spark.createDataFrame([], s) for n, s in STAR_SCHEMAS.items()}
    drift = metadata.drift(
        metadata.catalogue(t.spark, declared), metadata.catalogue(t.spark, tables)
    )
    return drift.join(metadata.row_counts(tables), "table_name")


EXPORTED_TYPE = {"date": "string", "decimal(38,4)": "double"}


def _export_sql() -> str:
    parts = []
    for name, schema in STAR_SCHEMAS.items():
        kinds = [f.dataType.simpleString() for f in schema]
        parts.append(
            f"SELECT '{name}' AS table_name, unnest({[model_name(c) for c in schema.names]}) AS column_name, "
            f"unnest({kinds}) AS declared_type, unnest({[EXPORTED_TYPE.get(k, k) for k in kinds]}) AS observed_type"
        )
    return sql.using(*sql.STAR, sql.SUMMARY, sql.DAILY, STAR_SIZES, f"pairs AS ({' UNION ALL '.join(parts)})") + """
SELECT table_name, column_name, declared_type, observed_type,
       CASE WHEN declared_type = observed_type THEN 'same' ELSE 'retyped' END AS status, n_rows
FROM pairs JOIN sizes USING (table_name)"""


@query("m_04_export_drift", _export_sql())
def export_drift(t: Tables) -> DataFrame:
    """Declared schemas of the reporting model against its export, where money and days change type."""
    tables = common.star_tables(t)
    declared = {
        n: t.spark.createDataFrame([], s).toDF(*map(model_name, s.names)) for n, s in STAR_SCHEMAS.items()
    }
    exported = {n: to_model(frame) for n, frame in tables.items()}
    drift = metadata.drift(
        metadata.catalogue(t.spark, declared), metadata.catalogue(t.spark, exported)
    )
    return drift.join(metadata.row_counts(tables), "table_name")
