"""Retail inputs derived from the given tables, each a lazy DataFrame.

Nothing here is sampled: every derivation covers its whole source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom import schemas
from ledgerloom.functions.money import MONEY, line_amount
from ledgerloom.operators import geography

QUOTE_FIRST, QUOTE_LAST = "1995-01-01", "2024-01-31"
REDELIVERED_EVERY = 34


class Tables:
    """The given tables of one folder, read with their declared schemas."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in schemas.TABLES:
            raise AttributeError(name)
        return self.spark.read.schema(schemas.TABLES[name]).parquet(f"{self.folder}/{name}.parquet")


K = "CAST(get_json_object(props, '$.k') AS INT)"


def events_with_k(t: Tables) -> DataFrame:
    """Events with ``k`` of their JSON properties, for uses that look at it many times.

    ``json_tuple`` parses once per row; an expression would be copied into every later condition.
    """
    columns = [c for c in schemas.TABLES["events"].names if c != "props"]
    return t.events.select(*columns, F.json_tuple("props", "k").alias("k")).withColumn(
        "k", F.col("k").cast("int")
    )


def product_rollup(spark: SparkSession) -> DataFrame:
    """SKU to department to segment."""
    return spark.range(8).selectExpr(
        "CAST(id AS INT) AS sku",
        "CASE WHEN id < 4 THEN 'D1' ELSE 'D2' END AS department",
        "CASE WHEN id < 4 THEN 'S1' ELSE 'S2' END AS product_segment",
    )


def fx_quotes(t: Tables) -> DataFrame:
    """Weekday quotes per currency; currency 0 is the reporting currency."""
    moving = f"1000 + idx * 250 + date_diff(day, DATE'{QUOTE_FIRST}') % 29"
    rate = f"CAST({moving} AS DECIMAL(9,0)) * CAST(0.001 AS DECIMAL(4,3))"
    return (
        t.nation.selectExpr("n_nationkey % 4 AS idx")
        .distinct()
        .selectExpr(
            "idx", f"explode(sequence(DATE'{QUOTE_FIRST}', DATE'{QUOTE_LAST}')) AS day"
        )
        .filter("dayofweek(day) NOT IN (1, 7)")
        .selectExpr(
            "concat('CUR', idx) AS currency",
            "day",
            f"CAST(CASE WHEN idx = 0 THEN 1 ELSE {rate} END AS DECIMAL(18,8)) AS rate",
        )
    )


def country_aliases(t: Tables) -> DataFrame:
    """Folded spelling to country code and name."""
    return geography.alias_table(
        t.nation.selectExpr("concat('N', n_nationkey) AS country", "n_name AS country_name")
    )


def store_customers(t: Tables) -> DataFrame:
    """Store customer master: mixed-case and padded emails, countries spelt five ways."""
    address = "concat('c', c_custkey, '@example.com')"
    return t.customer.join(
        t.nation.select("n_nationkey", "n_name"), F.expr("c_nationkey = n_nationkey"), "left"
    ).selectExpr(
        "c_custkey AS cust_id",
        "c_name AS name",
        f"""CASE WHEN c_custkey % 33 = 0 THEN NULL
                 WHEN c_custkey % 3 = 0 THEN initcap({address})
                 WHEN c_custkey % 3 = 1 THEN concat('  ', {address}, ' ')
                 ELSE {address} END AS email""",
        """CASE c_custkey % 5 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name)
                WHEN 2 THEN concat(' ', n_name, ' ') WHEN 3 THEN replace(n_name, '_', ' ')
                ELSE concat('N', c_nationkey) END AS country_text""",
        "c_mktsegment AS segment",
        f"CAST(c_acctbal AS {MONEY}) AS balance",
    )


def web_accounts(t: Tables) -> DataFrame:
    """One account per shopper, keyed on email alone."""
    user = F.col("user_id").cast("string")
    return (
        t.events.select("user_id")
        .distinct()
        .select("user_id", F.concat(F.lit("C"), user, F.lit("@EXAMPLE.com")).alias("email"))
    )


def conform_customers(customers: DataFrame, aliases: DataFrame) -> DataFrame:
    """Store customers with their country folded to its code; currency follows the country."""
    folded = geography.conform_country(customers, aliases, "country_text")
    number = "try_cast(regexp_extract(country, '([0-9]+)$', 1) AS INT)"
    return folded.selectExpr(
        "cust_id", "name", "email", "segment", "country", f"concat('CUR', {number} % 4) AS currency"
    )


def conformed_customers(t: Tables) -> DataFrame:
    return conform_customers(store_customers(t), country_aliases(t))


LINE_SHAPE = [
    "channel", "order_key", "order_date", "cust_id", "sku", "units", "amount", "is_cancelled",
    "segment", "country", "currency", "is_orphan_order",
]


def store_sales(
    t: Tables | None, lineitem: DataFrame | None = None, orders: DataFrame | None = None,
    customers: DataFrame | None = None,
) -> DataFrame:
    """Store sale lines in the shared line shape; what isn't handed in comes from the given tables.

    A line whose order is not there stays, with ``is_orphan_order`` set and no day or buyer.
    Orders meet customers first, so the line items, by far the widest side, shuffle once and as raw
    columns; amounts are computed behind the join. The two facts are joined by shuffle whatever
    their size: neither is ever sent whole to every executor.
    """
    buyers = (conformed_customers(t) if customers is None else customers).select(
        "cust_id", "segment", "country", "currency"
    )
    orders = (t.orders if orders is None else orders).selectExpr(
        "o_orderkey AS order_key", "o_custkey AS cust_id", "TRUE AS has_order",
        "CAST(o_orderdate AS DATE) AS order_date", "o_orderstatus = 'P' AS is_cancelled",
    ).join(buyers, "cust_id", "left")
    lines = (t.lineitem if lineitem is None else lineitem).selectExpr(
        "l_orderkey AS order_key", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    ).hint("merge")
    return lines.join(orders, "order_key", "left").withColumns(
        {
            "is_orphan_order": F.col("has_order").isNull(),
            "is_cancelled": F.coalesce("is_cancelled", F.lit(False)),
            "channel": F.lit("store"),
            "sku": F.expr("CAST(l_partkey % 8 AS INT)"),
            "units": F.expr("CAST(l_quantity AS BIGINT)"),
            "amount": line_amount(F.col("l_extendedprice"), F.col("l_discount")),
        }
    ).select(*LINE_SHAPE)


def web_sales(
    t: Tables | None, purchases: DataFrame | None = None, customers: DataFrame | None = None
) -> DataFrame:
    """Web sale lines in the shared line shape; SKUs 98 and 99 are in no catalogue."""
    buyers = (conformed_customers(t) if customers is None else customers).select(
        "cust_id", "segment", "country", "currency"
    )
    return (
        (web_purchases(t) if purchases is None else purchases)
        .selectExpr(
            "'web' AS channel", "user_id AS order_key", "CAST(ts AS DATE) AS order_date",
            "user_id AS cust_id", "CASE WHEN k >= 98 THEN k ELSE k % 8 END AS sku",
            "CAST(1 AS BIGINT) AS units", "amount", "event_id % 20 = 0 AS is_cancelled",
            "FALSE AS is_orphan_order",
        )
        .join(buyers, "cust_id", "left")
        .select(*LINE_SHAPE)
    )


def web_purchases(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'purchase'").selectExpr(
        "event_id", "ts", "user_id", f"{K} AS k", f"CAST(value AS {MONEY}) AS amount"
    )


def offset_text(event_id: Column, ts: Column) -> Column:
    """Fifteen in a hundred instants are written with a real offset, the others with Z."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    shifted = F.date_format(ts - F.expr("INTERVAL 5 HOURS"), pattern)
    return F.when(
        (event_id % 20).isin(1, 2, 3), F.concat(shifted, F.lit("-05:00"))
    ).otherwise(F.concat(F.date_format(ts, pattern), F.lit("Z")))


def web_orders_nested(t: Tables) -> DataFrame:
    """Baskets (a shopper's purchases of one day) with their lines inside."""
    line = F.struct(
        "event_id",
        offset_text(F.col("event_id"), F.col("ts")).alias("placed_at"),
        "k",
        "amount",
    )
    return (
        web_purchases(t)
        .select("user_id", F.col("ts").cast("date").alias("placed_on"), line.alias("line"))
        .groupBy("user_id", "placed_on")
        .agg(F.array_sort(F.collect_list("line")).alias("lines"))
    )


def redelivered_lines(t: Tables) -> DataFrame:
    """Line items with the second copy of a share of them."""
    again = t.lineitem.filter(f"l_orderkey % {REDELIVERED_EVERY} = 0")
    return t.lineitem.withColumn("delivery_no", F.lit(1)).unionByName(
        again.withColumn("delivery_no", F.lit(2))
    )


def store_order_events(t: Tables) -> DataFrame:
    """Order events with a quantity that is not always a number."""
    return t.lineitem.selectExpr(
        "l_orderkey AS order_key", "l_linenumber AS line_no", "l_partkey AS part_key",
        "l_suppkey AS supp_key",
        """CASE WHEN l_orderkey % 50 = 7 THEN 'N/A'
                ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS quantity_text""",
        f"CAST(l_extendedprice AS {MONEY}) AS price",
        "l_discount AS discount",
    )


CHANGE_TOPIC = "erp.shopper"
CHANGE_BROKEN = "(event_id % 40 = 7 AND user_id % 4 = 3)"


def change_envelopes(t: Tables) -> DataFrame:
    """Change log of one row per shopper, as it is after reading; ``before`` is left empty.

    A topic of four partitions by key. A delete is followed by its tombstone, and the third
    partition has records that were cut off.
    """
    row = f"named_struct('value', CAST(value AS {MONEY}), 'event_type', event_type, 'k', {K})"
    none = f"CAST(NULL AS {schemas.CHANGE_ROW.simpleString()})"
    whole = lambda column: f"CASE WHEN kind = 'good' THEN {column} END"
    kind = f"CASE WHEN {CHANGE_BROKEN} THEN 'broken' ELSE 'good' END"
    kinds = f"CASE WHEN event_type = 'error' THEN array({kind}, 'tombstone') ELSE array({kind}) END"
    return t.events.selectExpr("*", f"posexplode({kinds}) AS (place, kind)").selectExpr(
        f"'{CHANGE_TOPIC}' AS topic", "CAST(user_id % 4 AS INT) AS topic_partition",
        "2 * event_id + place AS topic_offset", "user_id AS key",
        f"{whole('event_id')} AS lsn", f"{whole('ts')} AS ts",
        whole("CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END") + " AS op",
        f"{none} AS before",
        f"CASE WHEN kind = 'good' AND event_type <> 'error' THEN {row} END AS after",
        """CASE kind WHEN 'broken' THEN concat('{"op": "', event_id) WHEN 'good' THEN 'parsed' END AS value""",
        "kind",
    )


def change_records(t: Tables) -> DataFrame:
    """The same log as topic records; half of the keys come wrapped with their schema."""
    envelopes = change_envelopes(t)
    plain = F.to_json(F.struct(
        "before", "after", F.struct("lsn").alias("source"), "op",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
    ), {"ignoreNullFields": "false"})
    wrapped = F.concat(F.lit('{"schema": {"type": "struct"}, "payload": '), plain, F.lit("}"))
    key = F.concat(F.lit('{"user_id": '), F.col("key").cast("string"), F.lit("}"))
    value = F.when(F.col("kind") == "good", F.when(F.col("key") % 2 == 0, wrapped).otherwise(plain))
    return envelopes.select(
        "topic", "topic_partition", "topic_offset", key.alias("key"),
        F.when(F.col("kind") == "broken", F.col("value")).otherwise(value).alias("value"),
    )


def change_manifest(t: Tables) -> DataFrame:
    """What the producer says it published, per topic partition."""
    deleted = F.when(F.col("event_type") == "error", 1).otherwise(0)
    return t.events.groupBy((F.col("user_id") % 4).cast("int").alias("topic_partition")).agg(
        (F.count("*") + F.sum(deleted)).alias("expected_events"),
        F.max(2 * F.col("event_id") + deleted).alias("expected_last"),
    )


def run_events(t: Tables) -> DataFrame:
    """A run-event log in the declared run-event shape."""
    names = schemas.PRODUCERS_OBSERVED + schemas.PRODUCERS_CLAIMED + ["Mystery"]
    producers = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    is_job = "event_type IN ('signup', 'error')"
    is_lost = "event_type = 'purchase' AND k < 5"
    return events_with_k(t).selectExpr(
        "user_id % 10 AS run",
        "event_id AS seq",
        f"""CASE WHEN event_type = 'click' THEN 'activity' WHEN event_type = 'view' THEN 'lineage'
                 WHEN {is_job} THEN 'job' WHEN {is_lost} THEN 'dropped' ELSE 'table' END AS kind""",
        """CASE event_type WHEN 'signup' THEN if(k % 2 = 0, 'Started', 'Completed')
                WHEN 'error' THEN if(k % 3 = 0, 'Cancelled', 'Failed')
                WHEN 'click' THEN if(k < 10, 'Failed', 'Succeeded') END AS status""",
        f"CASE WHEN {is_job} THEN 'Nightly' END AS job_type",
        "CASE WHEN event_type = 'error' THEN concat('r', k) END AS failure_reason",
        "CASE WHEN event_type = 'click' THEN concat('step', k % 4) END AS activity",
        "CASE WHEN event_type = 'click' AND k BETWEEN 10 AND 14 THEN concat('e', k) END AS error",
        "CASE WHEN event_type = 'click' AND k >= 90 THEN k % 3 + 1 END AS retry",
        f"CASE WHEN event_type = 'view' THEN CASE k % 8 {producers} END END AS producer",
        f"CASE WHEN {is_lost} THEN CAST(k + 1 AS BIGINT) END AS dropped",
    )


def run_event_lines(t: Tables) -> DataFrame:
    """The log as a line stream: ``data:`` lines, keep-alive comments, and cut-off lines."""
    fields = [f for f in schemas.RUN_EVENT.names]
    good = F.concat(F.lit("data: "), F.to_json(F.struct(*fields)))
    cut_off = F.concat(F.lit('data: {"seq": '), F.col("seq").cast("string"))
    seq = F.col("seq")
    line = F.when(seq % 40 == 7, cut_off).otherwise(good)
    noise = F.when(seq % 50 == 0, F.array(F.lit(": keep-alive"), F.concat(F.lit("  "), line)))
    return run_events(t).select(
        "seq", F.explode(F.coalesce(noise, F.array(line))).alias("value")
    )


def moves(t: Tables, batch: int = 500) -> DataFrame:
    """Lineage moves: customers and suppliers feed nations, nations regions, regions the star.

    The readers of one nation come in batches of at most ``batch`` keys per move.
    """

    def node(kind: str, key: Column) -> Column:
        return F.concat(F.lit(f"{kind}:"), key.cast("string"))

    def feed(frame: DataFrame, kind: str, key: str, target: Column, producer: Column) -> DataFrame:
        part = (F.col(key) / batch).cast("bigint")
        return (
            frame.select(
                target.alias("target"), part.alias("part"), node(kind, F.col(key)).alias("node"),
                producer.alias("producer"),
            )
            .groupBy("target", "part", "producer")
            .agg(F.collect_list("node").alias("reads"))
            .select(
                F.concat_ws("/", F.lit(kind), "target", F.col("part").cast("string")).alias("move"),
                F.lit(kind).alias("step"),
                "producer",
                "reads",
                F.array("target").alias("writes"),
            )
        )

    nation = node("nation", F.col("c_nationkey"))
    return (
        feed(t.customer, "customer", "c_custkey", nation, F.lit("NotebookObserved"))
        .unionByName(
            feed(
                t.supplier, "supplier", "s_suppkey", node("nation", F.col("s_nationkey")),
                F.lit("Reported"),
            )
        )
        .unionByName(
            feed(
                t.nation, "nation", "n_nationkey", node("region", F.col("n_regionkey")),
                F.lit("Copy"),
            )
        )
        .unionByName(
            feed(t.region, "region", "r_regionkey", F.lit("star:revenue"), F.lit("Warehouse"))
        )
    )


def source_nodes(t: Tables) -> DataFrame:
    """Every node that is declared a source system's."""

    def nodes(frame: DataFrame, kind: str, key: str) -> DataFrame:
        return frame.select(F.concat(F.lit(f"{kind}:"), F.col(key).cast("string")).alias("node"))

    return (
        nodes(t.customer, "customer", "c_custkey")
        .unionByName(nodes(t.supplier, "supplier", "s_suppkey"))
        .unionByName(nodes(t.part, "part", "p_partkey"))
    )


def order_days(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey AS order_key", "CAST(o_orderdate AS DATE) AS day")
