"""Named measures, evaluated for any slice of the summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.money import TOTAL, total


def _registry() -> dict[str, Column]:
    revenue, cancelled = total(F.col("revenue_usd")), total(F.col("cancelled_usd"))
    carried = total(F.col("carried_rate_usd"))
    return {
        "sale_lines": F.coalesce(F.sum("sale_lines"), F.lit(0)),
        "units": F.coalesce(F.sum("units"), F.lit(0)),
        "revenue_usd": revenue,
        "cancelled_usd": cancelled,
        "carried_rate_usd": carried,
        "gross_usd": (revenue + cancelled).cast(TOTAL),
        "quoted_rate_usd": (revenue - carried).cast(TOTAL),
    }


def measure_names() -> list[str]:
    """Names of the registered measures (needs an active session)."""
    return list(_registry())


def slice_by(summary: DataFrame, axes: Sequence[str], measures: Sequence[str]) -> DataFrame:
    registry = _registry()
    unknown = [m for m in measures if m not in registry]
    if unknown:
        raise KeyError(f"no such measure: {unknown}")
    return summary.groupBy(*axes).agg(*[registry[m].alias(m) for m in measures])


def quarter_totals(summary: DataFrame) -> DataFrame:
    return slice_by(summary, ["fiscal_quarter"], ["revenue_usd", "cancelled_usd"]).orderBy(
        "fiscal_quarter"
    )


def grand_totals(summary: DataFrame) -> DataFrame:
    return slice_by(summary, [], ["revenue_usd", "cancelled_usd", "sale_lines"])


def reporting_pack(summary: DataFrame) -> DataFrame:
    """Revenue by year, by product segment, by customer segment, and in all: one scan.

    ``slice_id`` tells a rolled-up axis from a label that is null in the data.
    """
    fy, product, customer = (F.col(c) for c in
                             ("fiscal_year", "product_segment", "customer_segment"))
    return summary.groupingSets([[fy], [product], [customer], []], fy, product, customer).agg(
        F.grouping_id().cast("bigint").alias("slice_id"),
        total(F.col("revenue_usd")).alias("revenue_usd"),
    )
