"""Change-data capture as a stream: source, state kept as a table, state kept by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.operators import cdc
from ledgerloom.schemas import struct
from ledgerloom.streaming import batchlog

FLAT = struct(key="long", lsn="long", ts="ntz", op="str", value="money", event_type="str", k="int")


QUARANTINED = struct(topic="str", topic_partition="int", topic_offset="long", value="str")
FLAT_WITH_ORIGIN = T.StructType(
    struct(topic="str", topic_partition="int", topic_offset="long").fields + FLAT.fields
)


def envelope_source(
    spark: SparkSession, location: str, fmt: str = "text", files_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Change envelopes with their kind and origin, broken ones and tombstones included.

    ``text`` follows a folder of record lines. ``kafka`` subscribes to the topic named by
    ``location`` where its connector is deployed, from its first record unless told otherwise.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        told = {"startingOffsets": "earliest", **(options or {})}
        records = reader.options(**told).option("subscribe", location).load().select(
            "topic", F.col("partition").alias("topic_partition"),
            F.col("offset").alias("topic_offset"),
            F.col("key").cast("string"), F.col("value").cast("string"),
        )
    else:
        reader = reader.options(**(options or {}))
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        records = cdc.read_records(reader.load(location))
    return cdc.read_envelopes(records)


def land_changes(
    envelopes: DataFrame, good: str, quarantine: str, checkpoint: str
) -> tuple[DataFrame, DataFrame]:
    """Stream good changes to one table and broken records to another; both are read back."""

    def land(batch: DataFrame, batch_id: int) -> None:
        batchlog.write_batch(cdc.unwrap(batch, origin=True), batch_id, good)
        batchlog.write_batch(cdc.broken(batch), batch_id, quarantine)

    batchlog.run_available(envelopes.writeStream.foreachBatch(land), checkpoint)
    spark = envelopes.sparkSession
    return (
        batchlog.read_log(spark, good, FLAT_WITH_ORIGIN).drop("batch"),
        batchlog.read_log(spark, quarantine, QUARANTINED).drop("batch"),
    )


class StateTable:
    """Current state as a base plus one small delta per micro-batch.

    A batch writes only its own newest change per key, so the cost of a batch follows the batch and
    not the table. Every ``compact_every`` batches the deltas fold into a new base. Deletes stay as
    tombstones with their lsn, so a late older change cannot bring a row back, and all choices are
    by lsn, so replaying a batch or receiving it out of order changes nothing. Nothing here deletes
    files, and ``compact_every`` is fixed for the life of a table: deltas and bases older than the newest base may be removed by the owner.
    """

    def __init__(self, spark: SparkSession, folder: str, compact_every: int = 20):
        self.spark = spark
        self.deltas = f"{folder}/deltas"
        self.bases = f"{folder}/bases"
        self.quarantine = f"{folder}/quarantine"
        self.compact_every = compact_every

        self.last: int | None = None

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take flat changes, or envelopes, of which the broken ones go to quarantine."""
        if "kind" in batch.columns:
            batchlog.write_batch(cdc.broken(batch), batch_id, self.quarantine)
            batch = cdc.unwrap(batch)
        batchlog.write_batch(cdc.newest(batch), batch_id, self.deltas)
        self.last = max(batch_id, -1 if self.last is None else self.last)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def compact(self, batch_id: int) -> None:
        """Write a base that covers all batches up to ``batch_id``."""
        upto = self.log(batch_id).drop("batch")
        cdc.newest(upto).write.mode("overwrite").parquet(f"{self.bases}/as_of={batch_id}")

    def _base(self, before: int) -> int:
        # Compactions happen at known batches, so the newest base of an earlier batch has a known
        # name: no listing of what was ever written.
        return before // self.compact_every * self.compact_every - 1

    def log(self, upto: int) -> DataFrame:
        """Base and later deltas, as many changes per key as there are batches since the base."""
        base = self._base(upto)
        deltas = batchlog.read_batches(self.spark, self.deltas, FLAT, range(base + 1, upto + 1))
        if base < 0:
            return deltas
        rows = self.spark.read.schema(FLAT).parquet(f"{self.bases}/as_of={base}")
        return rows.withColumn("batch", F.lit(base).cast("bigint")).unionByName(deltas)

    def current(self) -> DataFrame:
        """Live rows after the last batch; tombstones are left out."""
        upto = batchlog.last_batch(self.spark, self.deltas) if self.last is None else self.last
        return cdc.newest(self.log(upto).drop("batch")).filter(F.col("op") != "d")


def apply_changes(
    changes: DataFrame, folder: str, checkpoint: str, compact_every: int = 20
) -> StateTable:
    """Run the stream over what has arrived and keep its state table."""
    table = StateTable(changes.sparkSession, folder, compact_every)
    batchlog.run_available(changes.writeStream.foreachBatch(table.apply), checkpoint)
    return table


def keyed_state(changes: DataFrame) -> DataFrame:
    """Newest change per key in Spark's own state store; of envelopes, the good ones.

    An aggregate and not a Python state function: it combines before the shuffle, so one hot key
    cannot fill a task, and an older lsn never replaces a newer one.
    """
    return cdc.newest(cdc.unwrap(changes) if "kind" in changes.columns else changes)


def read_keyed_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """What the state store of ``keyed_state`` holds, deletes included; of the newest batch or of an earlier one.

    Spark retains some earlier batches (``spark.sql.streaming.minBatchesToRetain``).
    Read by Spark's state data source, one task a store partition: nothing is kept beside the store, which
    Spark compacts itself. The columns of an aggregate's state are its buffers in order: the highest lsn, the row, and
    the lsn that the row belongs to.
    """
    if batchlog.last_commit(spark, checkpoint) is None:
        return spark.createDataFrame([], FLAT)
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    lsn, row, _ = state.schema["value"].dataType.names
    return state.select("key.key", F.col("value")[lsn].alias("lsn"), F.col("value")[row].alias("_row")).select("key", "lsn", "_row.*")


def run_keyed_state(changes: DataFrame, checkpoint: str) -> DataFrame:
    """Work through what has arrived; the live rows are then read from the state store itself."""
    batchlog.run_available(keyed_state(changes).writeStream.outputMode("update").format("noop"), checkpoint)
    return read_keyed_state(changes.sparkSession, checkpoint).filter(F.col("op") != "d")
