"""Landing readers. The format is a parameter; schemas are always declared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions.encoding import digest

CORRUPT = "_corrupt"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def read_csv(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A CSV delivery in any number of parts; a row that breaks its schema keeps its text."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(folder)
    )


def read_json_lines(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(folder)
    )


def read_json_arrays(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array each. Such a file is one task: keep pages moderate.

    A page that does not parse comes as one row with its text.
    """
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(folder)
    )


def read_master(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(folder)


def explode_lines(orders: DataFrame, lines: str = "lines") -> DataFrame:
    """One row per line with its place; an order without lines keeps one row."""
    rest = [c for c in orders.columns if c != lines]
    return orders.select(*rest, F.posexplode_outer(lines).alias("line_pos", "line")).select(
        *rest, "line_pos", "line.*"
    )


def file_digests(spark: SparkSession, folder: str, name_pattern: str) -> DataFrame:
    """(name, sha256, bytes) of every file; ``name_pattern`` takes the logical name off the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(
        F.regexp_extract("path", name_pattern, 1).alias("name"),
        digest(F.col("content")).alias("sha256"),
        F.col("length").alias("bytes"),
    )


def verify_delivery(delivered: DataFrame, published: DataFrame) -> DataFrame:
    """Each file with a verdict: accepted only if its digest is the published one."""
    told = published.select("name", F.col("sha256").alias("published_sha256"))
    verdict = (
        F.when(F.col("published_sha256").isNull(), "not_published")
        .when(F.col("sha256").isNull(), "not_delivered")
        .when(F.col("sha256") == F.col("published_sha256"), "accepted")
        .otherwise("quarantined")
    )
    return delivered.join(told, "name", "full_outer").withColumn("verdict", verdict)


def accepted_rows(rows: DataFrame, verdicts: DataFrame, name: str) -> DataFrame:
    """Rows of accepted files only."""
    ok = verdicts.filter(F.col("verdict") == "accepted").select(F.col("name").alias("_name"))
    return rows.join(ok, F.col(name).cast("string") == F.col("_name"), "left_semi")
