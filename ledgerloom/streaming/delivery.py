"""Deliveries: marker-triggered refresh, completeness gate, streaming redelivery removal."""

from __future__ import annotations

import threading
from collections import Counter, defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ledgerloom.operators import cdc
from ledgerloom.schemas import struct
from ledgerloom.streaming import batchlog

ANNOUNCED = struct(delivery_id="str")
RUNS = struct(delivery_id="str", parts="long", n_rows="long")


def markers(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Delivery ids announced by marker files; a second notice of a delivery is dropped.

    The stream watches the marker folder and never the data files, so a delivery of many parts is
    one event. The state is one id per delivery ever announced.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    notices = reader.load(folder)
    return notices.select(F.trim("value").alias("delivery_id")).dropDuplicates(["delivery_id"])


def parts_and_rows(landed: DataFrame) -> DataFrame:
    """What a refresh saw of each delivery."""
    return landed.groupBy("delivery_id").agg(
        F.count_distinct("part").alias("parts"), F.count("*").alias("n_rows")
    )


# Prune by a subquery of its own where the ids are too many to be broadcast.
PRUNE = "spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly"


def announced_rows(landed: DataFrame, ids: DataFrame) -> DataFrame:
    """Landed rows of the announced ids, by a join that prunes the landing table's folders.

    However many ids there are, they stay a table: the scan lists and reads the partitions that the join's own
    filter names at run time. A blank id announces nothing.
    """
    told = ids.filter(F.col("delivery_id") > "").select("delivery_id").distinct()
    return landed.join(told, "delivery_id", "left_semi")


def refresh_on_marker(
    announced: DataFrame, landing: Callable[[], DataFrame], folder: str, checkpoint: str,
    build: Callable[[DataFrame], DataFrame] = parts_and_rows, schema: T.StructType = RUNS,
) -> DataFrame:
    """One refresh per delivery: ``build`` runs once on the landed rows of what was announced.

    The ids of a batch are written down and joined with the landing table on its partition column.
    """
    ids = f"{folder}-announced"

    def refresh(batch: DataFrame, batch_id: int) -> None:
        batchlog.write_batch(batch, batch_id, ids)
        landed = landing()
        spark = landed.sparkSession
        before = spark.conf.get(PRUNE)
        spark.conf.set(PRUNE, "false")
        try:
            told = batchlog.read_batches(spark, ids, ANNOUNCED, range(batch_id, batch_id + 1))
            batchlog.write_batch(build(announced_rows(landed, told)), batch_id, folder)
        finally:
            spark.conf.set(PRUNE, before)

    batchlog.run_available(announced.writeStream.foreachBatch(refresh), checkpoint)
    return batchlog.read_log(announced.sparkSession, folder, schema)


def gate(read: DataFrame, expected: DataFrame) -> DataFrame:
    """Completeness per topic partition; the gate is open only if all rows are complete."""
    return cdc.completeness(read, expected)


def publish_if_complete(report: DataFrame, table: DataFrame, folder: str) -> bool:
    """Write the table only when no partition of the stream is short."""
    if not report.filter(~F.col("complete")).isEmpty():
        return False
    table.write.mode("overwrite").parquet(folder)
    return True


def drop_redeliveries(
    rows: DataFrame, identity: Sequence[str], event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """First delivery of each identity.

    Without ``delay`` every identity is remembered (on disk, in the state store), so no row is ever
    late and no copy slips through. With it, state is kept for ``delay`` behind the newest event: it
    must cover the longest distance between a row and its copy, and rows later than that are
    dropped by Spark's watermark, which ``run_redelivery_stream`` counts.
    """
    if delay is None:
        return rows.dropDuplicates(list(identity))
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(identity))


def run_redelivery_stream(first_rows: DataFrame, folder: str, checkpoint: str) -> int:
    """Write the stream to Parquet; returns the number of rows the watermark dropped as late.

    Counted batch by batch over the whole run: a query's own progress list is short.
    """
    streams = first_rows.sparkSession.streams
    late = LateRows()
    streams.addListener(late)
    query = (
        first_rows.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
        return late.of_run(str(query.runId))
    finally:
        query.stop()
        streams.removeListener(late)


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks dropped, by run, over every batch."""

    def __init__(self):
        self.rows: Counter[str] = Counter()
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        run = event.progress
        self.rows[str(run.runId)] += sum(o.numRowsDroppedByWatermark for o in run.stateOperators)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended[str(event.runId)].set()

    def of_run(self, run_id: str, seconds: float = 60) -> int:
        """Events arrive in order and the last one ends the run; without it the count is not whole."""
        if not self.ended[run_id].wait(seconds):
            raise TimeoutError(f"no end of run {run_id} was told in {seconds} s")
        return self.rows[run_id]
