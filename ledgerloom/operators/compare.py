"""Comparison of independent computations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.functions.money import TOTAL


def reconcile(left: DataFrame, right: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Every key of either side with both values; ``agrees`` is exact and null-safe."""
    a = left.select(key, *[F.col(m).alias(f"{m}_a") for m in measures])
    b = right.select(key, *[F.col(m).alias(f"{m}_b") for m in measures])
    agrees = F.lit(True)
    for m in measures:
        agrees = agrees & F.col(f"{m}_a").eqNullSafe(F.col(f"{m}_b"))
    return a.join(b, key, "full_outer").withColumn("agrees", agrees)


def snapshot_metrics(snapshot: DataFrame) -> DataFrame:
    """A wide snapshot as (metric, value), values as exact text."""
    texts = snapshot.select(*[F.col(c).cast("string").alias(c) for c in snapshot.columns])
    return texts.unpivot([], snapshot.columns, "metric", "value")


def compare_snapshots(left: DataFrame, right: DataFrame) -> DataFrame:
    return reconcile(snapshot_metrics(left), snapshot_metrics(right), "metric", ["value"])


def refuse_all_zero(snapshot: DataFrame) -> DataFrame:
    """Add ``refused``: a snapshot of zeros proves nothing and must not compare equal."""
    zero = F.lit(True)
    for c in snapshot.columns:
        zero = zero & (F.col(c).try_cast(TOTAL) == 0)
    return snapshot.withColumn("refused", F.coalesce(zero, F.lit(False)))


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one multiset holds more often than the other: the side, and how many more.

    Both sides meet in one aggregate that combines map-side, so a row repeated without end costs
    its task one partial row per map partition, and each input is read once.
    """
    columns = left.columns
    plus = left.withColumn("_copy", F.lit(1).cast("bigint"))
    minus = right.select(*columns).withColumn("_copy", F.lit(-1).cast("bigint"))
    net = plus.unionByName(minus).groupBy(*columns).agg(F.sum("_copy").alias("_net"))
    return net.filter("_net <> 0").select(
        *columns,
        F.expr("CASE WHEN _net > 0 THEN 'left' ELSE 'right' END").alias("side"),
        F.abs("_net").alias("copies"),
    )


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows each side has alone, and whether the multisets are equal."""
    return differing_rows(left, right).selectExpr(
        "coalesce(sum(copies) FILTER (WHERE side = 'left'), 0) AS left_only",
        "coalesce(sum(copies) FILTER (WHERE side = 'right'), 0) AS right_only",
        "count(*) = 0 AS equal",
    )


def missing_each_way(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference in both directions."""
    only_left = left.subtract(right).withColumn("side", F.lit("left"))
    return only_left.unionByName(right.subtract(left).withColumn("side", F.lit("right")))


def in_both(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def checksum(frame: DataFrame) -> DataFrame:
    """Row count and the sum over all fractional cells; decimals stay exact, integers are left out."""
    decimals = [f.name for f in frame.schema if isinstance(f.dataType, T.DecimalType)]
    doubles = [f.name for f in frame.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]

    def added(columns: Sequence[str], kind: str):
        result = F.lit(0).cast(kind)
        for c in columns:
            result = (result + F.coalesce(F.sum(c), F.lit(0)).cast(kind)).cast(kind)
        return result

    return frame.agg(
        F.count("*").alias("n_rows"),
        added(decimals, TOTAL).alias("decimal_total"),
        added(doubles, "double").alias("double_total"),
    )
