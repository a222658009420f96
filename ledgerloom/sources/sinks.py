"""Writers. All are distributed; no rows pass through the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, functions as F

from ledgerloom.schemas import struct

MANIFEST = struct(table_name="str", n_rows="long")

def write_document(tables: Mapping[str, DataFrame], folder: str) -> str:
    """Several named row sets as one document: a JSON folder per name."""
    for name, frame in tables.items():
        frame.write.mode("overwrite").json(f"{folder}/{name}")
    return folder


def write_snapshot(snapshot: DataFrame, folder: str) -> str:
    """The one-row totals record as one file."""
    snapshot.coalesce(1).write.mode("overwrite").json(folder)
    return folder


def write_table(
    frame: DataFrame, folder: str, partition_by: str | None = None, fmt: str = "parquet", dealt: bool = False
) -> str:
    """A medallion table. ``rebalance`` lets AQE split a hot partition value over several files.

    ``dealt`` says that the rows were rebalanced by that value already, when they were narrower.
    """
    if partition_by and not dealt:
        frame = frame.hint("rebalance", partition_by)
    writer = frame.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(folder)
    return folder


def write_with_manifest(frame: DataFrame, folder: str, name: str, manifest: str) -> str:
    """A delivery and, written after it, the number of rows that its producer sent: counted by the pass that wrote them."""
    sent = Observation(f"sent_{name}")
    frame.observe(sent, F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(folder)
    stated = frame.sparkSession.createDataFrame([(name, sent.get["n_rows"])], MANIFEST)
    stated.coalesce(1).write.mode("append").parquet(manifest)
    return folder
