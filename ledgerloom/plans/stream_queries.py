"""Streaming queries: each runs over all that has landed, and its final table is the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import fixtures
from ledgerloom.fixtures import Tables
from ledgerloom.operators import cdc
from ledgerloom.plans import sql
from ledgerloom.plans.cleaning_queries import LATEST_SQL
from ledgerloom.plans.landing_queries import LANDED_ROWS, landed_changes, landed_deliveries, landed_lines
from ledgerloom.plans.observer_queries import RUN_SUMMARY
from ledgerloom.plans.registry import query
from ledgerloom.session import new_folder
from ledgerloom.streaming import batchlog, cdc_stream, delivery, observer_stream


def observed_log(t: Tables) -> DataFrame:
    return observer_stream.observe(
        t.spark, landed_lines(t), new_folder(t.spark, "observed"),
        new_folder(t.spark, "observed-check"), files_per_batch=2,
    )


@query(
    "str_01_event_observer",
    sql.using(sql.RUN_EVENTS, sql.FINDINGS)
    + "SELECT run, seq, kind, tag, why FROM classified WHERE seq % 40 <> 7",
)
def event_observer(t: Tables) -> DataFrame:
    log = observed_log(t)
    return log.filter(F.col("_broken").isNull()).select("run", "seq", "kind", "tag", "why")


@query(
    "str_02_loss_signal",
    sql.using(
        sql.RUN_EVENTS, "picked AS (SELECT * FROM run_events WHERE seq % 40 <> 7)", RUN_SUMMARY
    ) + """
SELECT run, loss_signals, events_lost, loss_signals > 0 AS incomplete FROM run_summary""",
)
def loss_signal(t: Tables) -> DataFrame:
    return observer_stream.loss(observed_log(t))


@query("str_03_cdc_apply", LATEST_SQL)
def cdc_apply(t: Tables) -> DataFrame:
    """Micro-batches applied to a state table that compacts every second batch."""
    changes = cdc_stream.envelope_source(t.spark, landed_changes(t), files_per_batch=1)
    table = cdc_stream.apply_changes(
        changes, new_folder(t.spark, "state"), new_folder(t.spark, "state-check"), compact_every=2
    )
    return table.current()


@query("str_04_cdc_stateful", LATEST_SQL)
def cdc_stateful(t: Tables) -> DataFrame:
    changes = cdc_stream.envelope_source(t.spark, landed_changes(t), files_per_batch=2)
    return cdc_stream.run_keyed_state(changes, new_folder(t.spark, "keyed-check"))


@query(
    "str_04_state_as_of_batch",
    """
SELECT count(DISTINCT user_id) AS keys_held, count(DISTINCT user_id) AS not_gone_back FROM events
WHERE NOT (event_id % 40 = 7 AND user_id % 4 = 3)""",
)
def state_as_of_batch(t: Tables) -> DataFrame:
    """The store one batch before the end beside the store at the end: no key may go back to an older lsn."""
    changes = cdc_stream.envelope_source(t.spark, landed_changes(t), files_per_batch=2)
    check = new_folder(t.spark, "as-of-check")
    cdc_stream.run_keyed_state(changes, check)
    before = max(0, (batchlog.last_commit(t.spark, check) or 0) - 1)
    first = cdc_stream.read_keyed_state(t.spark, check, before).select("key", F.col("lsn").alias("lsn_before"))
    last = cdc_stream.read_keyed_state(t.spark, check)
    both = last.join(first, "key", "full_outer")
    return both.agg(F.count("lsn").alias("keys_held"), F.count_if(F.expr("lsn >= coalesce(lsn_before, lsn)")).alias("not_gone_back"))


COMPLETE_SQL = """
WITH told AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS topic_partition,
         CAST(count(*) + count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS expected_events,
         max(2 * event_id + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS expected_last,
         count(*) FILTER (WHERE event_id % 40 = 7 AND user_id % 4 = 3) AS broken
  FROM events GROUP BY 1
)
SELECT *, expected_events AS events_read, expected_last AS last_offset, broken = 0 AS complete FROM told"""


@query("agg_15_completeness_count", COMPLETE_SQL)
def completeness_count(t: Tables) -> DataFrame:
    return cdc.completeness(fixtures.change_envelopes(t), fixtures.change_manifest(t))


@query("str_05_completeness_gate", COMPLETE_SQL)
def completeness_gate(t: Tables) -> DataFrame:
    """Stream in, count by the carried partition, and publish only when nothing is short or broken."""
    out, check = new_folder(t.spark, "gated"), new_folder(t.spark, "gated-check")
    envelopes = cdc_stream.envelope_source(t.spark, landed_changes(t), files_per_batch=2)
    batchlog.run_available(envelopes.writeStream.format("parquet").option("path", out), check)
    read = t.spark.read.schema(envelopes.schema).parquet(out)
    report = delivery.gate(read, fixtures.change_manifest(t))
    delivery.publish_if_complete(
        report, cdc.current_state(cdc.unwrap(read)), new_folder(t.spark, "published")
    )
    return report


@query(
    "str_06_marker_triggered_refresh",
    """
SELECT strftime(o_orderdate, '%Y-%m') AS delivery_id, count(DISTINCT o_orderkey % 21) AS parts,
       count(*) AS n_rows
FROM orders GROUP BY 1""",
)
def marker_triggered_refresh(t: Tables) -> DataFrame:
    data, markers = landed_deliveries(t)
    schema = "part int, o_orderkey bigint, o_totalprice double, delivery_id string"
    runs = delivery.refresh_on_marker(
        delivery.markers(t.spark, markers, files_per_batch=2),
        lambda: t.spark.read.schema(schema).parquet(data),
        new_folder(t.spark, "runs"), new_folder(t.spark, "runs-check"),
    )
    return runs.select("delivery_id", "parts", "n_rows")


@query("str_07_redelivery_stream_dedupe", "SELECT event_id, ts, user_id, value FROM events")
def redelivery_stream_dedupe(t: Tables) -> DataFrame:
    """Events with a share of them delivered twice; one of each is kept.

    Copies may be any time apart and files may be read in any order: every id is remembered.
    """
    landed = new_folder(t.spark, "redelivered")
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")
    again = rows.filter(F.col("event_id") % fixtures.REDELIVERED_EVERY == 0)
    rows.unionByName(again).repartitionByRange("event_id").write.option(
        "maxRecordsPerFile", LANDED_ROWS
    ).parquet(landed)
    stream = (
        t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(landed)
    )
    out, check = new_folder(t.spark, "first"), new_folder(t.spark, "first-check")
    delivery.run_redelivery_stream(delivery.drop_redeliveries(stream, ["event_id"]), out, check)
    kept = t.spark.read.schema(rows.schema).parquet(out)
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "str_08_stream_progress",
    sql.using(sql.RUN_EVENTS, sql.FINDINGS) + """
SELECT count(*) AS lines_read,
       count(*) FILTER (WHERE seq % 40 <> 7) AS events,
       count(*) FILTER (WHERE seq % 40 = 7) AS broken_lines,
       count(*) FILTER (WHERE seq % 40 <> 7 AND tag IS NOT NULL) AS findings,
       TRUE AS running_count_closes
FROM classified""",
)
def stream_progress(t: Tables) -> DataFrame:
    """Totals at the end of the stream; the running count must end on the number of lines."""
    log = observed_log(t)
    last = observer_stream.progress(log).agg(F.max("events_so_far").alias("counted"))
    totals = observer_stream.totals(log)
    return totals.join(last, F.col("lines_read") == F.col("counted"), "left").select(
        *totals.columns, F.col("counted").isNotNull().alias("running_count_closes")
    )
