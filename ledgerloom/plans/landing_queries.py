"""Queries on sources and sinks. Each lands whole derived tables first and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ledgerloom import fixtures, schemas
from ledgerloom.fixtures import Tables
from ledgerloom.functions.encoding import row_json
from ledgerloom.functions.money import TOTAL
from ledgerloom.operators import clean, measures, metadata, observer
from ledgerloom.plans import common, sql
from ledgerloom.plans.registry import query
from ledgerloom.session import new_folder
from ledgerloom.sources import landing, lines, sinks
from ledgerloom.streaming import batchlog, cdc_stream, delivery, observer_stream

# Sizes of landed files: rows, or whole orders, so that their number follows the data.
LANDED_ROWS, PAGE_ORDERS, FILE_ROWS, FEWEST_FILES = 500_000, 1_000, 1_000_000, 8


@query(
    "src_01_csv_landing",
    sql.using(sql.STORE_CUSTOMERS) + """
SELECT cust_id, name, email, country_text, segment, balance, NULL::VARCHAR AS corrupt
FROM store_customers
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'cut off at ' || cust_id
FROM store_customers WHERE cust_id % 40 = 7""",
)
def csv_landing(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "csv")
    fillers = {
        c: ((F.col("cust_id") * i) % 97).cast("string")
        for i, c in enumerate(schemas.STORE_CUSTOMER_FILLERS, start=1)
    }
    wide = fixtures.store_customers(t).withColumns(fillers)
    (
        wide.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    cut_off = F.concat(F.lit("cut off at "), F.col("cust_id").cast("string")).alias("cust_id")
    wide.filter("cust_id % 40 = 7").select(cut_off).write.mode("append").option("header", True).csv(folder)
    return landing.read_csv(t.spark, folder, schemas.STORE_CUSTOMER).select(
        *schemas.STORE_CUSTOMER_CORE.names, F.col(landing.CORRUPT).alias("corrupt")
    )


@query(
    "src_02_jsonl_landing",
    """
SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_partkey AS part_key,
       l_suppkey AS supp_key,
       CASE WHEN l_orderkey % 50 = 7 THEN 'N/A'
            ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity_text,
       CAST(l_extendedprice AS DECIMAL(19,4)) AS price, l_discount AS discount,
       CASE WHEN l_orderkey % 50 = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS quantity,
       CASE WHEN l_orderkey % 50 = 7 THEN 'quantity_text is not bigint' END AS bad_reason,
       NULL::VARCHAR AS corrupt
FROM lineitem WHERE l_orderkey % 200 <> 13
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'row is corrupt',
       '{"order_key":' || l_orderkey || ',"line'
FROM lineitem WHERE l_orderkey % 200 = 13""",
)
def jsonl_landing(t: Tables) -> DataFrame:
    """Order events land as lines, some cut off, and are judged: nothing that arrived is left out."""
    folder = new_folder(t.spark, "jsonl")
    cut_off = F.concat(F.lit('{"order_key":'), F.col("order_key").cast("string"), F.lit(',"line'))
    line = row_json(*schemas.STORE_ORDER_EVENT.names)
    fixtures.store_order_events(t).select(
        F.when(F.col("order_key") % 200 == 13, cut_off).otherwise(line).alias("value")
    ).write.text(folder)
    landed = landing.read_json_lines(t.spark, folder, schemas.STORE_ORDER_EVENT)
    return clean.quarantine(
        landed, {"quantity": ("quantity_text", "bigint")}, landing.CORRUPT
    ).withColumnRenamed(landing.CORRUPT, "corrupt")


def landed_web_orders(t: Tables) -> DataFrame:
    """Web orders landed as one JSON array per page and read back with their nesting."""
    folder = new_folder(t.spark, "nested")
    orders = fixtures.web_orders_nested(t)
    # Whole orders, about a thousand to a page, so the number of pages follows the orders.
    count = orders.count() // PAGE_ORDERS + 1
    page = F.pmod(F.xxhash64("user_id", "placed_on"), F.lit(count)).alias("page")
    pages = orders.groupBy(page).agg(
        F.to_json(F.collect_list(F.struct(*schemas.WEB_ORDER.names))).alias("value")
    )
    pages.select("value", "page").write.partitionBy("page").text(folder)
    broken = t.events.filter("event_id = 0").select(F.concat(F.lit('[{"user_id": '), "event_id").alias("value"))
    broken.write.text(f"{folder}/page=broken")
    return landing.read_json_arrays(t.spark, f"{folder}/*", schemas.WEB_ORDER)


NESTED_SQL = sql.using(sql.WEB_LINES) + """
SELECT user_id, CAST(ts AS DATE) AS placed_on,
       CAST(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                               ORDER BY event_id) - 1 AS INTEGER) AS line_pos,
       event_id,
       CASE WHEN event_id % 20 IN (1, 2, 3)
            THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '-05:00'
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS placed_at,
       k, amount
FROM web_lines"""


@query(
    "src_03_nested_json_landing",
    sql.using(sql.WEB_LINES) + """
SELECT user_id, CAST(ts AS DATE) AS placed_on, count(*) AS n_lines,
       CAST(sum(amount) AS DECIMAL(38,4)) AS amount, NULL::VARCHAR AS corrupt
FROM web_lines GROUP BY user_id, CAST(ts AS DATE)
UNION ALL SELECT NULL, NULL, NULL, NULL, '[{"user_id": ' || event_id || chr(10) FROM events WHERE event_id = 0""",
)
def nested_json_landing(t: Tables) -> DataFrame:
    amount = F.aggregate(
        "lines", F.lit(0).cast(TOTAL), lambda acc, line: (acc + line["amount"]).cast(TOTAL)
    )
    return landed_web_orders(t).select(
        "user_id", "placed_on", F.size("lines").cast("bigint").alias("n_lines"),
        amount.alias("amount"), F.col(landing.CORRUPT).alias("corrupt"),
    )


@query("scl_14_explode_lines", NESTED_SQL)
def explode_lines(t: Tables) -> DataFrame:
    whole = landed_web_orders(t).filter(F.col(landing.CORRUPT).isNull()).drop(landing.CORRUPT)
    return landing.explode_lines(whole)


@query(
    "src_04_parquet_landing",
    """
SELECT p_partkey AS part_key, CAST(p_partkey % 8 AS INTEGER) AS sku,
       CASE WHEN p_partkey % 8 < 4 THEN 'S1' ELSE 'S2' END AS product_segment
FROM part""",
)
def parquet_landing(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "master")
    sku = (F.col("p_partkey") % 8).cast("int")
    parts = t.part.select(F.col("p_partkey").alias("part_key"), sku.alias("sku"))
    rollup = fixtures.product_rollup(t.spark)
    parts.join(rollup, "sku").select(*schemas.PRODUCT_MASTER.names).write.parquet(folder)
    master = landing.read_master(t.spark, folder, schemas.PRODUCT_MASTER)
    return master.select("part_key", "sku", "product_segment")


def _write_files(rows: DataFrame, folder: str) -> None:
    """One text file per ``file_no``, its lines in key order, so equal rows give equal bytes."""
    (
        rows.repartition("file_no").sortWithinPartitions("file_no", "p_partkey")
        .select("file_no", "value").write.partitionBy("file_no").text(folder)
    )


def _master_files(t: Tables) -> tuple[str, str]:
    """A served and a delivered folder; every fifth delivered file has an altered line."""
    keys = t.part.agg(F.count("*").alias("n"), (F.max("p_partkey") + 1).alias("top")).first()
    files = max(FEWEST_FILES, -(-keys["n"] // FILE_ROWS))
    part = t.part.select(
        F.expr(f"p_partkey * {files} DIV {keys['top']}").alias("file_no"),
        "p_partkey",
        F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_brand").alias("value"),
    )
    served, delivered = new_folder(t.spark, "served"), new_folder(t.spark, "delivered")
    _write_files(part, served)
    hit = (F.col("file_no") % 5 == 1) & (F.col("p_partkey") % 50 == 0)
    altered = F.when(hit, F.concat("value", F.lit("!"))).otherwise(F.col("value"))
    _write_files(part.withColumn("value", altered), delivered)
    return served, delivered


FILES_SQL = f"""
WITH size AS (
  SELECT greatest({FEWEST_FILES}, CAST(ceil(count(*) / {FILE_ROWS}.0) AS BIGINT)) AS files,
         max(p_partkey) + 1 AS top FROM part
), lines AS (
  SELECT p_partkey * files // top AS file_no, p_partkey,
         p_partkey || '|' || p_name || '|' || p_brand AS line FROM part, size
), altered AS (
  SELECT *, line || CASE WHEN file_no % 5 = 1 AND p_partkey % 50 = 0 THEN '!' ELSE '' END
         AS sent FROM lines
), files AS (
  SELECT CAST(file_no AS VARCHAR) AS name,
         sha256(string_agg(sent, chr(10) ORDER BY p_partkey) || chr(10)) AS sha256,
         sha256(string_agg(line, chr(10) ORDER BY p_partkey) || chr(10)) AS published_sha256
  FROM altered GROUP BY file_no
)
"""
NAME = "file_no=([0-9]+)/"


@query(
    "src_05_verified_binary_read",
    FILES_SQL + """
SELECT CAST(a.file_no AS VARCHAR) AS file_no, a.line AS value
FROM altered a JOIN files f ON f.name = CAST(a.file_no AS VARCHAR)
WHERE f.sha256 = f.published_sha256""",
)
def verified_binary_read(t: Tables) -> DataFrame:
    served, delivered = _master_files(t)
    verdicts = landing.verify_delivery(
        landing.file_digests(t.spark, delivered, NAME),
        landing.file_digests(t.spark, served, NAME),
    )
    rows = t.spark.read.schema("value string, file_no string").text(delivered)
    return landing.accepted_rows(rows, verdicts, "file_no").select("file_no", "value")


@query(
    "src_06_landing_byte_identity",
    FILES_SQL + """
SELECT name, sha256, published_sha256,
       CASE WHEN sha256 = published_sha256 THEN 'accepted' ELSE 'quarantined' END AS verdict
FROM files""",
)
def landing_byte_identity(t: Tables) -> DataFrame:
    served, delivered = _master_files(t)
    verdicts = landing.verify_delivery(
        landing.file_digests(t.spark, delivered, NAME),
        landing.file_digests(t.spark, served, NAME),
    )
    return verdicts.select("name", "sha256", "published_sha256", "verdict")


def landed_changes(t: Tables) -> str:
    """The change log as topic records, in files of ascending offsets and bounded size."""
    folder = new_folder(t.spark, "changes")
    (
        fixtures.change_records(t)
        .repartitionByRange("topic_offset").sortWithinPartitions("topic_offset")
        .select(F.to_json(F.struct(*schemas.CHANGE_RECORD.names)).alias("value"))
        .write.option("maxRecordsPerFile", LANDED_ROWS).text(folder)
    )
    return folder


ORIGIN_SQL = """origin AS (
  SELECT event_id AS lsn, 'erp.shopper' AS topic, CAST(user_id % 4 AS INTEGER) AS topic_partition,
         2 * event_id AS topic_offset FROM events
)"""


@query(
    "src_07_cdc_stream_source",
    sql.using(sql.CHANGES, ORIGIN_SQL) + "SELECT * FROM changes JOIN origin USING (lsn)",
)
def cdc_stream_source(t: Tables) -> DataFrame:
    good, _ = cdc_stream.land_changes(
        cdc_stream.envelope_source(t.spark, landed_changes(t), files_per_batch=2),
        *[new_folder(t.spark, f"cdc-{n}") for n in ("rows", "quarantine", "check")],
    )
    return good


@query(
    "src_07_cdc_quarantine",
    """
SELECT 'erp.shopper' AS topic, CAST(user_id % 4 AS INTEGER) AS topic_partition,
       2 * event_id AS topic_offset, '{"op": "' || event_id AS value
FROM events WHERE event_id % 40 = 7 AND user_id % 4 = 3""",
)
def cdc_quarantine(t: Tables) -> DataFrame:
    """The broken records of the stream, with where they came from."""
    _, broken = cdc_stream.land_changes(
        cdc_stream.envelope_source(t.spark, landed_changes(t), files_per_batch=2),
        *[new_folder(t.spark, f"cdc-{n}") for n in ("rows", "quarantine", "check")],
    )
    return broken


def landed_lines(t: Tables) -> str:
    folder = new_folder(t.spark, "lines")
    (
        fixtures.run_event_lines(t).repartitionByRange("seq").select("value")
        .write.option("maxRecordsPerFile", LANDED_ROWS).text(folder)
    )
    return folder


@query(
    "src_08_event_line_source",
    sql.using(sql.RUN_EVENTS) + """
SELECT run, seq, kind, status, job_type, failure_reason, activity, error, retry, producer, dropped
FROM run_events WHERE seq % 40 <> 7""",
)
def event_line_source(t: Tables) -> DataFrame:
    raw = t.spark.read.text(landed_lines(t))
    return lines.good_events(lines.parse_events(raw)).select(*schemas.RUN_EVENT.names)


@query(
    "src_08_broken_lines",
    """SELECT 'data: {"seq": ' || event_id AS value FROM events WHERE event_id % 40 = 7""",
)
def broken_lines(t: Tables) -> DataFrame:
    raw = t.spark.read.text(landed_lines(t))
    broken = lines.broken_lines(lines.parse_events(raw))
    return broken.select(F.concat(F.lit("data: "), "value").alias("value"))


@query(
    "src_09_table_scan_projection",
    sql.using(*sql.STAR, sql.DAILY) + "SELECT order_date, country, revenue FROM daily",
)
def table_scan_projection(t: Tables) -> DataFrame:
    folder = sinks.write_table(common.daily(t), new_folder(t.spark, "daily"))
    daily = landing.read_master(t.spark, folder, schemas.DAILY)
    return daily.select("order_date", "country", "revenue")


def _given(t: Tables) -> dict[str, DataFrame]:
    """The given tables with the schema that their files have."""
    return {name: t.spark.read.parquet(f"{t.folder}/{name}.parquet") for name in schemas.TABLES}


# DuckDB's own view of the same files, in Spark's type names.
SEEN_COLUMNS = f"""seen AS (
  SELECT table_name, CAST(ordinal_position AS INTEGER) AS ordinal, column_name,
         CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS type
  FROM information_schema.columns WHERE table_name IN {tuple(schemas.TABLES)}
), sizes AS ({" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in schemas.TABLES)})"""


@query(
    "src_10_metadata_scan",
    sql.using(SEEN_COLUMNS)
    + "SELECT table_name, ordinal, column_name, type, n_rows FROM seen JOIN sizes USING (table_name)",
)
def metadata_scan(t: Tables) -> DataFrame:
    """The catalogue in ordinal order with the size of each table (counted from file footers)."""
    given = _given(t)
    columns = metadata.catalogue(t.spark, given).drop("schema_name")
    return (
        columns.join(metadata.row_counts(given), "table_name")
        .select("table_name", "ordinal", "column_name", "type", "n_rows")
        .orderBy("table_name", "ordinal")
    )


@query(
    "src_11_run_metrics_read",
    """
SELECT count(*) AS rows_in, count(*) FILTER (WHERE l_orderkey % 50 = 7) AS rows_bad,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS DECIMAL(38,4)) AS price_total
FROM lineitem""",
)
def run_metrics_read(t: Tables) -> DataFrame:
    """Metrics taken while a transform writes, stored beside its output and read back."""
    judged = clean.quarantine(
        fixtures.store_order_events(t), {"quantity": ("quantity_text", "bigint")}
    )
    seen = Observation("quarantine")
    watched = judged.observe(
        seen,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("bad_reason").isNotNull()).alias("rows_bad"),
        F.sum("price").cast(TOTAL).alias("price_total"),
    )
    watched.write.parquet(new_folder(t.spark, "judged"))
    metrics = f"rows_in bigint, rows_bad bigint, price_total {TOTAL}"
    folder = new_folder(t.spark, "metrics")
    got = seen.get
    t.spark.createDataFrame(
        [(got["rows_in"], got["rows_bad"], got["price_total"])], metrics
    ).write.parquet(folder)
    return t.spark.read.schema(metrics).parquet(folder)


def landed_deliveries(t: Tables) -> tuple[str, str]:
    """Orders landed by delivery month in 21 parts each, and marker notices for the months.

    Every third month is announced twice.
    """
    data, markers = new_folder(t.spark, "deliveries"), new_folder(t.spark, "markers")
    landed = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("delivery_id"),
        (F.col("o_orderkey") % 21).cast("int").alias("part"),
        "o_orderkey", "o_totalprice",
    )
    sinks.write_table(landed, data, partition_by="delivery_id")
    notices = (
        landed.select("delivery_id").distinct()
        .withColumn("again", F.substring("delivery_id", 6, 2).cast("int") % 3 == 0)
        .select(
            F.col("delivery_id").alias("value"),
            F.explode(
                F.when(F.col("again"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
            ).alias("notice"),
        )
    )
    notices.repartitionByRange("notice", "value").select("value").write.text(markers)
    return data, markers


@query(
    "src_12_marker_source",
    "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS delivery_id FROM orders",
)
def marker_source(t: Tables) -> DataFrame:
    _, markers = landed_deliveries(t)
    out, check = new_folder(t.spark, "announced"), new_folder(t.spark, "announced-check")
    announced = delivery.markers(t.spark, markers, files_per_batch=2)
    batchlog.run_available(
        announced.writeStream.format("parquet").option("path", out), check
    )
    return t.spark.read.schema("delivery_id string").parquet(out)


EXPORT_SQL = sql.using(*sql.STAR, sql.SUMMARY) + """
SELECT fiscal_year AS "FiscalYear", fiscal_quarter AS "FiscalQuarter", department AS "Department",
       product_segment AS "ProductSegment", customer_segment AS "CustomerSegment",
       country AS "Country", channel AS "Channel", sale_lines AS "SaleLines", units AS "Units",
       CAST(revenue_usd AS DOUBLE) AS "RevenueUsd", CAST(cancelled_usd AS DOUBLE) AS "CancelledUsd",
       CAST(carried_rate_usd AS DOUBLE) AS "CarriedRateUsd"
FROM summary"""


def model_name(column: str) -> str:
    return "".join(word.capitalize() for word in column.split("_"))


def to_model(frame: DataFrame) -> DataFrame:
    """Model names and export types: counts stay integers, money leaves as double, days as text."""
    edges = {"decimal": "double", "date": "string"}

    def exported(name: str, kind: str):
        column = F.col(name)
        target = next((new for old, new in edges.items() if kind.startswith(old)), None)
        return (column.cast(target) if target else column).alias(model_name(name))

    return frame.select(*[exported(n, k) for n, k in frame.dtypes])


@query("snk_01_json_export", EXPORT_SQL)
def json_export(t: Tables) -> DataFrame:
    """The four model tables as one document; the reporting table is read back from it."""
    tables = {name: to_model(frame) for name, frame in common.star_tables(t).items()}
    folder = sinks.write_document(tables, new_folder(t.spark, "export"))
    return t.spark.read.schema(tables["Reporting"].schema).json(f"{folder}/Reporting")


@query(
    "snk_02_jsonl_event_log",
    sql.using(sql.RUN_EVENTS, sql.FINDINGS) + """
SELECT run, seq, tag, why FROM classified WHERE tag IS NOT NULL AND seq % 40 <> 7""",
)
def jsonl_event_log(t: Tables) -> DataFrame:
    """Events streamed to a JSON Lines log; findings are re-examined from the log."""
    log, check = new_folder(t.spark, "event-log"), new_folder(t.spark, "event-log-check")
    events = lines.good_events(lines.parse_events(lines.follow(t.spark, landed_lines(t), 2)))
    observer_stream.log_as_json(events, log, check)
    again = observer.classify(t.spark.read.schema(schemas.RUN_EVENT).json(log))
    return again.filter(F.col("tag").isNotNull()).select("run", "seq", "tag", "why")


@query(
    "snk_03_snapshot_write",
    sql.using(*sql.STAR) + f"""
SELECT CAST({sql.total('usd', 'NOT is_cancelled')} AS VARCHAR) AS revenue_usd,
       CAST({sql.total('usd', 'is_cancelled')} AS VARCHAR) AS cancelled_usd,
       CAST(count(*) AS VARCHAR) AS sale_lines, '{",".join(sorted(schemas.PUBLISHED_CONTRACTS))}' AS contracts
FROM enriched""",
)
def snapshot_write(t: Tables) -> DataFrame:
    totals = measures.grand_totals(common.summary(t))
    names = F.lit(",".join(sorted(schemas.PUBLISHED_CONTRACTS))).alias("contracts")
    texts = totals.select(*[F.col(c).cast("string").alias(c) for c in totals.columns], names)
    folder = sinks.write_snapshot(texts, new_folder(t.spark, "snapshot"))
    return t.spark.read.schema(texts.schema).json(folder)


@query(
    "snk_04_medallion_table_write",
    sql.using(*sql.STAR, sql.SUMMARY) + "SELECT * FROM summary",
)
def medallion_table_write(t: Tables) -> DataFrame:
    """The summary as a table partitioned by fiscal year."""
    folder = sinks.write_table(
        common.summary(t), new_folder(t.spark, "summary"), partition_by="fiscal_year"
    )
    return landing.read_master(t.spark, folder, schemas.SUMMARY).select(*schemas.SUMMARY.names)


@query(
    "snk_05_catalogue_write",
    sql.using(SEEN_COLUMNS) + """
SELECT table_name, count(*) AS n_columns,
       string_agg(column_name || ':' || type, ',' ORDER BY ordinal) AS columns, any_value(n_rows) AS n_rows
FROM seen JOIN sizes USING (table_name) GROUP BY table_name""",
)
def catalogue_write(t: Tables) -> DataFrame:
    """Column lists and sizes of the given tables, written as JSON and read back."""
    given = _given(t)
    listed = metadata.columns_per_table(metadata.catalogue(t.spark, given)).join(
        metadata.row_counts(given), "table_name"
    )
    folder = new_folder(t.spark, "catalogue")
    listed.select("table_name", "n_columns", "columns", "n_rows").write.json(folder)
    return t.spark.read.schema(
        "table_name string, n_columns bigint, columns string, n_rows bigint"
    ).json(folder)
