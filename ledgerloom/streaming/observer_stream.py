"""The run-event observer as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ledgerloom.functions.encoding import BROKEN
from ledgerloom.operators import observer
from ledgerloom.schemas import RUN_EVENT
from ledgerloom.sources import lines
from ledgerloom.streaming import batchlog

LOGGED = T.StructType(
    RUN_EVENT.fields
    + [T.StructField(c, T.StringType()) for c in (BROKEN, "tag", "why")]
)


def observe(
    spark: SparkSession, incoming: str, log: str, checkpoint: str,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Classify each event as it arrives and log all of them; broken lines are logged too.

    Written batch by batch, so nothing is held in memory until the end of the run, and a summary
    is a batch read of the log.
    """
    parsed = lines.parse_events(lines.follow(spark, incoming, files_per_batch))
    marked = observer.classify(parsed)
    batchlog.run_available(
        marked.writeStream.foreachBatch(
            lambda batch, batch_id: batchlog.write_batch(batch, batch_id, log)
        ),
        checkpoint,
    )
    return batchlog.read_log(spark, log, LOGGED)


def log_as_json(events: DataFrame, folder: str, checkpoint: str) -> None:
    """Every event to a JSON Lines log with Spark's exactly-once file sink."""
    batchlog.run_available(
        events.writeStream.format("json").option("path", folder), checkpoint
    )


def progress(log: DataFrame) -> DataFrame:
    """Events per batch and the running count over the batches so far."""
    so_far = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per micro-batch reaches this window, whatever the number of events.
    return batchlog.batch_sizes(log).withColumn("events_so_far", F.sum("rows_in").over(so_far))


def totals(log: DataFrame) -> DataFrame:
    """What the run's end reports: all lines, good events, broken lines, findings."""
    return log.agg(
        F.count("*").alias("lines_read"),
        F.count_if(F.col(BROKEN).isNull()).alias("events"),
        F.count_if(F.col(BROKEN).isNotNull()).alias("broken_lines"),
        F.count_if(F.col(BROKEN).isNull() & F.col("tag").isNotNull()).alias("findings"),
    )


def loss(log: DataFrame) -> DataFrame:
    """Loss signals per run and whether its record is whole."""
    good = lines.good_events(log)
    return observer.run_summary(good).select("run", "loss_signals", "events_lost", "incomplete")
