"""The column catalogue, derived from what was built."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CATALOGUE = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)


def catalogue(
    spark: SparkSession, tables: Mapping[str, DataFrame], schema_name: str = "main"
) -> DataFrame:
    """(schema, table, ordinal, column, type) of every table; reads no data."""
    rows = [
        (schema_name, table, place, field.name, field.dataType.simpleString())
        for table, frame in tables.items()
        for place, field in enumerate(frame.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, CATALOGUE)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counted = [
        frame.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def columns_per_table(columns: DataFrame) -> DataFrame:
    """Column list of each (schema, table) in ordinal order."""
    entry = F.struct("ordinal", F.concat_ws(":", "column_name", "type").alias("entry"))
    listed = F.array_sort(F.collect_list(entry))
    return columns.groupBy("schema_name", "table_name").agg(
        F.count("*").alias("n_columns"),
        F.array_join(F.transform(listed, lambda e: e["entry"]), ",").alias("columns"),
    )


def uncovered_axes(columns: DataFrame, table: str, axes: list[str]) -> DataFrame:
    """Reporting axes that the catalogue does not list for the star."""
    wanted = columns.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(a) for a in axes])).alias("column_name")
    )
    listed = columns.filter(F.col("table_name") == table).select("column_name")
    return wanted.join(listed, "column_name", "left_anti")


def drift(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Declared against observed columns: added, missing or retyped."""
    key = ["table_name", "column_name"]
    a = declared.select(*key, F.col("type").alias("declared_type"))
    b = observed.select(*key, F.col("type").alias("observed_type"))
    status = (
        F.when(F.col("declared_type").isNull(), "added")
        .when(F.col("observed_type").isNull(), "missing")
        .when(F.col("declared_type") != F.col("observed_type"), "retyped")
        .otherwise("same")
    )
    return a.join(b, key, "full_outer").withColumn("status", status)
