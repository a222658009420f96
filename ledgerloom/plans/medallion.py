"""The layers end to end: each is built from the tables of the layer below and from nothing else.

Bronze lands every source. Silver cleans, conforms customers once, prices and labels the lines once, and
keeps what is broken apart. Gold reads silver tables only, so the large joins run a single time however
many gold tables there are.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom import fixtures, schemas
from ledgerloom.fixtures import Tables
from ledgerloom.functions import fiscal
from ledgerloom.functions.text import utc_instant
from ledgerloom.operators import cdc, clean, fx, geography, identity, metadata, star, upkeep
from ledgerloom.plans import common, sql
from ledgerloom.plans.registry import query
from ledgerloom.session import new_folder
from ledgerloom.sources import landing, sinks

LINE_ITEM = schemas.TABLES["lineitem"].names


def side_by_side(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Steps that don't need each other, each from a thread: cores that the last tasks of one leave go to the next.

    Returns when all have ended; the first that failed is raised. The costliest step comes first: Spark serves it first.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


class Layers:
    """Tables of one build below one folder."""

    def __init__(self, t: Tables, folder: str):
        self.t: Tables | None = t
        self.spark = t.spark
        self.folder = folder
        self.written: dict[str, DataFrame] = {}

    def write(
        self, name: str, frame: DataFrame, partition_by: str | None = None, dealt: bool = False
    ) -> None:
        path = sinks.write_table(frame, f"{self.folder}/{name}", partition_by, dealt=dealt)
        self.written[name] = landing.read_master(self.spark, path, frame.schema)

    def read(self, name: str) -> DataFrame:
        return self.written[name]

    def write_all(self, tables: dict[str, Callable[[], DataFrame]]) -> None:
        """Tables that are independent of each other, side by side."""

        def step(name: str, make: Callable[[], DataFrame]) -> Callable[[], None]:
            return lambda: self.write(name, make())

        side_by_side(self.spark, *[step(name, make) for name, make in tables.items()])

    def bronze(self) -> None:
        """As delivered: redeliveries kept, orders nested, changes in their envelopes."""
        t = self.t
        self.write_all({
            "bronze/line_items": lambda: fixtures.redelivered_lines(t),
            "bronze/changes": lambda: fixtures.change_envelopes(t),
            "bronze/web_orders": lambda: fixtures.web_orders_nested(t),
            "bronze/orders": lambda: t.orders,
            "bronze/store_customers": lambda: fixtures.store_customers(t),
            "bronze/web_accounts": lambda: fixtures.web_accounts(t),
            "bronze/country_aliases": lambda: fixtures.country_aliases(t),
            "bronze/fx_quotes": lambda: fixtures.fx_quotes(t),
            "bronze/products": lambda: fixtures.product_rollup(self.spark),
        })

    def silver(self) -> None:
        """From bronze alone."""
        self.write("silver/customers", fixtures.conform_customers(
            self.read("bronze/store_customers"), self.read("bronze/country_aliases")))
        changes = self.read("bronze/changes")
        side_by_side(self.spark, self.sale_lines, lambda: self.write_all({
            "silver/people": lambda: identity.resolve(
                self.read("bronze/store_customers"), self.read("bronze/web_accounts"),
                "cust_id", "user_id",
            ),
            "silver/shoppers": lambda: cdc.current_state(cdc.unwrap(changes)),
            "silver/quarantine": lambda: cdc.broken(changes),
            "silver/countries": lambda: geography.dim_country(self.read("bronze/country_aliases")),
        }))

    def sale_lines(self) -> None:
        """Both channels in one shape, conformed, priced and labelled."""
        customers = self.read("silver/customers")
        landed = self.read("bronze/line_items")
        items = clean.latest_delivery(landed, LINE_ITEM, "delivery_no", n_rows=landed.count())
        purchases = landing.explode_lines(self.read("bronze/web_orders")).select(
            "event_id", utc_instant(F.col("placed_at")).alias("ts"), "user_id", "k", "amount"
        )
        lines = star.union_channels(
            fixtures.store_sales(None, items, self.read("bronze/orders"), customers),
            fixtures.web_sales(None, purchases, customers),
        )
        rates = fx.calendar(self.read("bronze/fx_quotes"))
        if rates.is_sent:
            # The lines double in width from here on and stay in place, so they are dealt out for the writer now.
            years = lines.withColumn("fiscal_year", fiscal.fiscal_year(F.col("order_date")))
            lines = years.hint("rebalance", "fiscal_year")
        enriched = star.enrich(lines, self.read("bronze/products"), rates)
        self.write("silver/sale_lines", star.with_fiscal(enriched), "fiscal_year", dealt=rates.is_sent)

    def gold(self) -> None:
        """From silver alone."""
        lines = self.read("silver/sale_lines")
        channels = [lines.filter(F.col("channel") == c) for c in schemas.CHANNELS]
        side_by_side(
            self.spark,
            lambda: self.write("gold/daily_revenue", star.daily_revenue(*channels)),
            lambda: self.write("gold/revenue_summary", star.revenue_summary(lines), "fiscal_year"),
            lambda: self.write_all({
                "gold/dim_customer": lambda: identity.dim_customer(
                    self.read("silver/people"), self.read("silver/customers")),
                "gold/dim_country": lambda: self.read("silver/countries"),
            }),
        )


def build(t: Tables, folder: str) -> Layers:
    layers = Layers(t, folder)
    layers.bronze()
    layers.silver()
    layers.gold()
    return layers


@query(
    "snk_04_gold_from_layers", sql.using(*sql.STAR, sql.SUMMARY) + "SELECT * FROM summary"
)
def gold_from_layers(t: Tables) -> DataFrame:
    """The summary as read from the gold table of a full build."""
    layers = build(t, new_folder(t.spark, "layers"))
    return layers.read("gold/revenue_summary").select(*schemas.SUMMARY.names)


@query(
    "snk_04_gold_after_deliveries", sql.using(*sql.STAR, sql.SUMMARY) + "SELECT * FROM summary"
)
def gold_after_deliveries(t: Tables) -> DataFrame:
    """The summary kept up to date: one order in fifty comes late, one in fifty came wrong and is delivered again."""
    lines = common.written_lines(t)
    store = F.col("channel") == "store"
    late, wrong = store & (F.col("order_key") % 50 == 3), store & (F.col("order_key") % 50 == 4)
    stored = lines.where(~late).withColumns({
        "units": F.when(wrong, F.col("units") + 5).otherwise(F.col("units")),
        "is_cancelled": F.when(wrong, ~F.col("is_cancelled")).otherwise(F.col("is_cancelled")),
    })
    summary = upkeep.MaintainedSummary(t.spark, new_folder(t.spark, "kept-summary"))
    summary.rebuild(stored)
    for delivery in (lines.where(wrong), lines.where(late)):
        summary.apply(upkeep.superseded(stored, delivery), delivery)
    return summary.read()


@query(
    "snk_04_layer_sizes",
    sql.using(*sql.STAR, sql.SUMMARY, sql.DAILY, sql.CHANGES) + """
SELECT 'bronze/line_items' AS table_name,
       count(*) + count(*) FILTER (WHERE l_orderkey % 34 = 0) AS n_rows FROM lineitem
UNION ALL SELECT 'bronze/orders', count(*) FROM orders
UNION ALL SELECT 'bronze/country_aliases', 2 * count(*) FROM nation
UNION ALL SELECT 'bronze/fx_quotes', count(*) FROM fx_quotes
UNION ALL SELECT 'bronze/products', 8
UNION ALL SELECT 'silver/customers', count(*) FROM customer
UNION ALL SELECT 'silver/countries', count(*) FROM nation
UNION ALL SELECT 'bronze/web_orders', count(*) FROM (
  SELECT DISTINCT user_id, CAST(ts AS DATE) FROM web_lines)
UNION ALL SELECT 'bronze/changes', count(*) + count(*) FILTER (WHERE event_type = 'error') FROM events
UNION ALL SELECT 'silver/quarantine', count(*) FROM events WHERE event_id % 40 = 7 AND user_id % 4 = 3
UNION ALL SELECT 'bronze/store_customers', count(*) FROM customer
UNION ALL SELECT 'bronze/web_accounts', count(DISTINCT user_id) FROM events
UNION ALL SELECT 'silver/sale_lines', count(*) FROM enriched
UNION ALL SELECT 'silver/people', count(*) FROM (
  SELECT c_custkey FROM customer UNION SELECT user_id FROM events WHERE user_id % 33 <> 0
  UNION ALL SELECT DISTINCT user_id FROM events WHERE user_id % 33 = 0)
UNION ALL SELECT 'silver/shoppers', count(*) FROM (
  SELECT arg_max(op, lsn) AS op FROM changes GROUP BY key) WHERE op <> 'd'
UNION ALL SELECT 'gold/revenue_summary', count(*) FROM summary
UNION ALL SELECT 'gold/daily_revenue', count(*) FROM daily
UNION ALL SELECT 'gold/dim_customer', count(*) FROM (
  SELECT c_custkey FROM customer UNION SELECT user_id FROM events WHERE user_id % 33 <> 0
  UNION ALL SELECT DISTINCT user_id FROM events WHERE user_id % 33 = 0)
UNION ALL SELECT 'gold/dim_country', count(*) FROM nation""",
)
def layer_sizes(t: Tables) -> DataFrame:
    return metadata.row_counts(build(t, new_folder(t.spark, "layers")).written)
