"""Keeping the revenue summary up to date by signed deltas, instead of building it anew.

All its measures add up, so a delivery changes it by what its lines bring and takes away what earlier versions of
the same lines had brought. Only fiscal years that a delivery touches are read and written again; a year's
rows lie in folders of the build that wrote them last, and a small table says which. Readers of the state before
keep what they read; a build that was broken off leaves the table as it was, because the new state is told last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions.money import TOTAL
from ledgerloom.operators.star import LINE_MEASURES, revenue_summary
from ledgerloom.schemas import SUMMARY, SUMMARY_AXES, struct
from ledgerloom.session import cut
from ledgerloom.streaming import batchlog

# Lines without a day are in no fiscal year; their rows have a folder of this name.
UNDATED = "undated"
STATE = struct(fiscal_year="str", build="long", of_state="long")
LINE_KEY = ["channel", "order_key"]


def signed(summary: DataFrame, sign: int) -> DataFrame:
    return summary.select(*SUMMARY_AXES, *[(F.col(m) * sign).alias(m) for m in LINE_MEASURES])


def delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """What the summary changes by if the sale lines ``before`` become ``after``; axes without a change are left out."""
    moved = signed(revenue_summary(after), 1).unionByName(signed(revenue_summary(before), -1))
    summed = _summed(moved)
    changed = F.lit(False)
    for m in LINE_MEASURES:
        changed = changed | (F.col(m) != 0)
    return summed.where(changed)


def _summed(rows: DataFrame) -> DataFrame:
    kinds = {"sale_lines": "bigint", "units": "bigint"}
    return rows.groupBy(*SUMMARY_AXES).agg(*[F.sum(m).cast(kinds.get(m, TOTAL)).alias(m) for m in LINE_MEASURES])


def superseded(lines: DataFrame, delivery: DataFrame) -> DataFrame:
    """Stored lines of the orders that a delivery brings again; an order is delivered whole."""
    keys = delivery.select(*LINE_KEY).distinct()
    return lines.join(keys, LINE_KEY, "left_semi")


class MaintainedSummary:
    """A summary table below ``folder``: rows by build and fiscal year, and which build holds each year."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.state = batchlog.last_state(spark, f"{folder}/states")

    def years(self) -> DataFrame:
        """``fiscal_year, build`` of the newest state."""
        if self.state < 0:
            return self.spark.createDataFrame([], STATE).select("fiscal_year", "build")
        return self.spark.read.schema(STATE).parquet(f"{self.folder}/states/state={self.state}").select("fiscal_year", "build")

    def _rows(self, years: DataFrame) -> DataFrame:
        """Rows of the given years, from the folders that hold them: the join prunes all others."""
        if self.state < 0:
            return self.spark.createDataFrame([], SUMMARY)
        kept = T.StructType([f for f in SUMMARY.fields if f.name != "fiscal_year"])
        wide = T.StructType([*kept.fields, *(STATE[c] for c in ("build", "fiscal_year"))])
        rows = self.spark.read.schema(wide).option("basePath", f"{self.folder}/rows").parquet(f"{self.folder}/rows")
        held = years.where(F.col("fiscal_year") > "").select("fiscal_year", "build")
        return rows.join(held, ["fiscal_year", "build"], "left_semi").select(*SUMMARY.names)

    def read(self) -> DataFrame:
        rows = self._rows(self.years())
        return rows.withColumn("fiscal_year", F.nullif("fiscal_year", F.lit(UNDATED)))

    def _publish(self, rows: DataFrame, kept: DataFrame) -> None:
        """Write the rows of whole years as a build of its own; then tell that they hold, beside the kept years."""
        build = self.state + 1
        rows.repartition("fiscal_year").write.mode("overwrite").partitionBy("fiscal_year").parquet(f"{self.folder}/rows/build={build}")
        years = rows.select("fiscal_year").distinct().withColumn("build", F.lit(build).cast("bigint"))
        state = kept.unionByName(years).withColumn("of_state", F.lit(build).cast("bigint"))
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/states/state={build}")
        self.state = build

    def rebuild(self, lines: DataFrame) -> None:
        """All years from all lines."""
        self._publish(_dated(revenue_summary(lines)), self.years().limit(0))

    def apply(self, before: DataFrame, after: DataFrame) -> DataFrame:
        """Take a delivery: lines that it replaces and lines that it brings. Returns the delta."""
        change = cut(_dated(delta(before, after)))
        touched = cut(change.select("fiscal_year").distinct())
        held = self.years()
        old = self._rows(held.join(touched, "fiscal_year", "left_semi"))
        # A year is rewritten whole; groups that nothing is left of go.
        rows = _summed(old.unionByName(change)).where("sale_lines <> 0")
        self._publish(rows, held.join(touched, "fiscal_year", "left_anti"))
        return change


def _dated(summary: DataFrame) -> DataFrame:
    return summary.withColumn("fiscal_year", F.coalesce("fiscal_year", F.lit(UNDATED))).select(*SUMMARY.names)
