"""A line stream that carries events: batch and streaming share the parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.encoding import BROKEN, parse_json
from ledgerloom.schemas import RUN_EVENT

PREFIX = "data:"


def data_lines(lines: DataFrame) -> DataFrame:
    """Lines that begin with the prefix once trimmed."""
    return lines.withColumn("value", F.trim("value")).filter(F.col("value").startswith(PREFIX))


def parse_events(lines: DataFrame) -> DataFrame:
    """Events of the data lines; a line that does not parse keeps its text in ``_broken``."""
    text = F.trim(F.substr("value", F.lit(len(PREFIX) + 1)))
    return data_lines(lines).select(parse_json(text, RUN_EVENT).alias("e")).select("e.*")


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def broken_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("value"))


def follow(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of a growing folder as a stream."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)
