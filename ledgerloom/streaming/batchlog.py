"""Append-by-batch tables: each micro-batch owns one folder, so a replayed batch overwrites itself."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_batch(batch: DataFrame, batch_id: int, folder: str) -> None:
    batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def read_log(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All batches with their number in ``batch``."""
    wide = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
    return spark.read.schema(wide).option("basePath", folder).parquet(folder)


def read_batches(
    spark: SparkSession, folder: str, schema: T.StructType, batches: range
) -> DataFrame:
    """Some batches by their paths: no other folder is listed."""
    wide = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
    if not batches:
        return spark.createDataFrame([], wide)
    paths = [f"{folder}/batch={n}" for n in batches]
    return spark.read.schema(wide).option("basePath", folder).parquet(*paths)


def last_batch(spark: SparkSession, folder: str) -> int:
    """Number of the newest batch, -1 if there is none."""
    found = read_log(spark, folder, T.StructType([])).agg(F.max("batch")).first()[0]
    return -1 if found is None else found


def last_state(spark: SparkSession, folder: str) -> int:
    """Number of the newest ``state=N`` folder that has rows, -1 if there is none; each row tells it in ``of_state``."""
    try:
        found = spark.read.schema("of_state bigint").parquet(folder).agg(F.max("of_state")).first()[0]
    except AnalysisException:  # nothing was written yet
        return -1
    return -1 if found is None else found


def last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """Number of the newest batch that a stream has committed; its commit files are named by it."""
    files = spark.read.text(f"{checkpoint}/commits").select(F.col("_metadata.file_name").try_cast("bigint").alias("batch"))
    return files.agg(F.max("batch")).first()[0]


def run_available(writer, checkpoint: str) -> None:
    """Work through everything that has arrived, then stop; failures surface here."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def batch_sizes(log: DataFrame) -> DataFrame:
    """Rows per micro-batch."""
    return log.groupBy("batch").agg(F.count("*").alias("rows_in"))
